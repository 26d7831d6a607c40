"""A bounded sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import named


def labelled_rows(docs: DataFrame, marks: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """(order, mark, text) of at most `most` rows of docs that marks (doc_id, mark) name: those of least hash of id, mark and text, none twice.

    An id may have any number of rows, so what bounds the ids does not bound the rows: these are counted after the join. Null ids and marks name nothing.
    """
    some = marks.dropna().distinct().withColumn("hash", F.xxhash64("doc_id", "mark")).orderBy("hash", "doc_id", "mark").limit(most)
    rows = docs.select(named(docs, id_col).cast("long").alias("doc_id"), named(docs, text_col).cast("string").alias("text")).join(F.broadcast(some), "doc_id").withColumn("order", F.xxhash64("hash", "text"))
    last = rows.select("order").distinct().orderBy("order").limit(most).agg(F.max("order")).collect()[0][0]
    return rows.where(F.col("order") <= F.lit(last if last is not None else 0)).dropDuplicates(["order"]).select("order", "mark", "text")
