"""The five stages against plain versions, each on what its predecessor kept."""

import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cliploom.llm import quality_rules, queries

from .test_dedup import brute_text
from .test_join import brute
from .test_text_ops import brute_contamination

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    library = Tokenizer.from_file(queries.vocabulary())
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    steps = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        assert n == len(corpus_pipeline.STAGES) - 1 or out.columns == names
        out.write.parquet(str(tmp_path / str(n)))
        steps[name] = docs.collect(), spark.read.parquet(str(tmp_path / str(n))).collect()
        docs = spark.read.parquet(str(tmp_path / str(n)))
    pairs = lambda rs: [(r["doc_id"], r["text"]) for r in rs]

    before, after = steps["quality rules"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = {r["doc_id"] for r in quality_rules.judge(spark.read.parquet(f"{DATA}/documents.parquet"), labels).collect() if r["kept"]}
    assert {r["doc_id"] for r in after} == kept and kept
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    failed = {r["doc_id"] for r in quality_rules.judge(spark.read.parquet(f"{DATA}/documents.parquet"), labels).collect() if r["base_failed"]}
    assert len(good - failed - kept) <= 0.05 * len(good)

    before, after = steps["n-gram Jaccard join"]
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, _, c in brute(pairs(before), 5, 80) if d == c)

    before, after = steps["suffix-array dedup"]
    assert sorted(pairs(after)) == sorted(brute_text(pairs(before), 50))
    assert all(r["n_chars"] == len(r["text"]) for r in after) and sum(r["n_chars"] for r in after) < sum(r["n_chars"] for r in before)
    assert len(after) == len(before)

    before, after = steps["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert sorted(pairs(after)) == sorted((d, t) for (d, t), r in zip(pairs(before), brute_contamination(pairs(before), items), strict=True) if not r[-1])

    before, after = steps["BPE encoding"]
    assert {r["doc_id"]: list(r["ids"]) for r in after} == {d: library.encode(t, add_special_tokens=False).ids for d, t in pairs(before)}


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 50


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))


@pytest.mark.parametrize("name", [k for k in queries.queries() if k != "op10_token_output"])
def test_queries_run(spark, name):
    assert queries.queries()[name](spark, DATA).count() > 0


def test_last_stage_decodes(spark):
    rows = [(1, "Xin chào, the cat 😀\n\n  ß"), (2, ""), (3, None), (4, "\x00 a\r\n" + "word " * 200)]
    got = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA).collect()
    assert sorted((r["doc_id"], r["decoded"]) for r in got) == [(d, t or "") for d, t in rows]
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    """Null ids and columns, null and empty texts, repeated rows, one text longer than a slab, a benchmark passage, and no rows at all."""
    import random

    r = random.Random(11)
    some = lambda n: " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(r.randrange(9999)) for _ in range(n)) + "."
    long, copy = some(130_000), some(90)
    rows = [(1, some(80)), (2, None), (3, ""), (None, some(70)), (4, copy), (4, copy), (5, copy + " x"), (6, long), (None, None), (7, some(60) + "\n" + copy[:300] + "\n" + some(60))]
    docs = spark.createDataFrame([(d, t, None, "s", None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    (tmp_path / "t").mkdir()
    spark.createDataFrame([(1, 1, 0), (None, 0, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "t" / "labels.parquet"))
    spark.createDataFrame([(1, some(20)), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "t" / "benchmark.parquet"))
    for case, df in (("rows", docs), ("none", docs.limit(0))):
        found = []
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, df, str(tmp_path / "t")).write.parquet(str(tmp_path / case / str(n)))
            df = spark.read.parquet(str(tmp_path / case / str(n)))
            found.append(df.collect())
        if case == "none":
            assert not any(found)
            continue
        ids = [sorted(str(x["doc_id"]) for x in f) for f in found]
        assert ids[0] == sorted(["1", "None", "4", "4", "5", "6", "7"])  # the base limits reject short and empty texts
        assert ids[1] == sorted(["1", "None", "4", "4", "6", "7"])  # 5 is near 4
        assert ids[2:] == [ids[1]] * 3
        left = {x["doc_id"]: x["text"] for x in found[2]}
        assert left[6] == long and len(left[7]) < len(rows[-1][1]) - 200
        assert {x["doc_id"]: x["decoded"] for x in found[4]} == left
