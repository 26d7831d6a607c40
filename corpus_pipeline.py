"""Five stages that clean a document table and encode it; each reads what the one before wrote.

Decisions: documents that fail the quality rules go; one document of each group of near copies stays, that of least
doc_id; byte strings of 50 that start in an earlier document go from the texts (n_chars follows); contaminated documents
go; what is left is encoded, and decoded from its ids. A document whose text is all repeated stays, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.llm.decontaminate import drop_contaminated
from cliploom.llm.frames import discard, scratch, scratch_path
from cliploom.llm.parity_join import one_of_each
from cliploom.llm.quality_rules import keep_good
from cliploom.llm.rank_bpe import encode_decode
from cliploom.llm.suffix_dedup import strip_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_labelled=20_000)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, k=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return strip_repeats(docs, length=50).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, share=20)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", encoding),
]
#: Learned rules and connected components are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each earlier one written to the shared folder and read again.

    What a stage leaves there is removed once the next one has been written, the table that the last one reads when the
    application ends.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    path = None
    for n, (_, stage) in enumerate(before):
        kept: list[str] = []
        with scratch(kept):
            out = stage(spark, docs, sf_dir)
            kept.append(scratch_path(spark, f"stage{n}"))
            out.write.parquet(kept[0])
        if path:
            discard(path)
        path = kept[0]
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
