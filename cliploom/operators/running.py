"""Running sums and maxima that do not put a whole key into one task.

Rows are cut into chunks along their order. Each chunk runs on its own; the totals of chunks, a row each, run over a
key; and each row adds what came before its chunk.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the folder of spark.checkpoint.dir, where what it is made of is used more than once; without that setting a local session takes a folder of its own."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="cliploom-"))
    return df.checkpoint()


HOW = {"sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))), "max": (F.max, F.greatest), "last": (lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a))}


def running(df: DataFrame, keys: list[str], order: list, value: str, how: str, chunk: Column, name: str, before: bool = False) -> DataFrame:
    """df with name: the sum, maximum or last non-null of value over the rows of the keys up to each row, or those before it.

    chunk must not fall along the order. For "last" the total of a chunk is its greatest place's value.
    """
    one, both = HOW[how]
    x = df.withColumn("_chunk", chunk)
    local = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    x = x.withColumn("_local", one(value).over(local))
    if how == "last":
        total = x.where(F.col(value).isNotNull()).groupBy(*keys, "_chunk").agg(F.max_by(value, F.struct(*order)).alias("_total"))
    else:
        total = x.groupBy(*keys, "_chunk").agg(one(value).alias("_total"))
    if how == "last":  # chunks without a value pass on what came before them
        total = x.select(*keys, "_chunk").distinct().join(total, [*keys, "_chunk"], "left")
    carry = total.withColumn("_carry", one("_total").over(Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))).drop("_total")
    on = [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in [*keys, "_chunk"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    out = x.alias("_a").join(carry.alias("_b"), cond, "left")
    return out.select(*[F.col(f"_a.{c}") for c in df.columns], both(F.col("_carry"), F.col("_local")).alias(name))
