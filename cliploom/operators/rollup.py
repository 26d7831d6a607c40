"""Corpus summaries: rollups of sources, percentiles, reproducible splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .selection import nearest_ranks, percentiles


def source_rollup(accepted: DataFrame, sources: DataFrame) -> DataFrame:
    """Clips and milliseconds of each source; sources without clips stay."""
    a = accepted.groupBy("source_id").agg(F.count("*").alias("clips"), F.sum(F.floor(F.col("duration") * 1000 + 0.5)).alias("ms"))
    return sources.select("source_id").distinct().join(a, "source_id", "left").select("source_id", F.coalesce("clips", F.lit(0)).alias("clips"), F.coalesce("ms", F.lit(0)).alias("ms"))


def nearest_rank(df: DataFrame, value: str, points=(0.0, 0.1, 0.5, 0.9, 1.0)) -> DataFrame:
    """(p, value) at the sorted place round-half-even(p * (n - 1)); no rows for an empty input."""
    return nearest_ranks(df, [], value, points).select("p", "value")


def linear_spread(df: DataFrame, value: str, low: float = 0.08, high: float = 0.92) -> DataFrame:
    """n and the difference of two linear percentiles; 0 under 8 rows."""
    x = percentiles(df, [], value, (low, high)).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), (F.max("value") - F.min("value")).alias("spread"))
    return x.select("n", F.when(F.col("n") < 8, 0.0).otherwise(F.col("spread")).alias("spread"))


def split(accepted: DataFrame, key: str, seed: int = 1234, ratio: float = 0.02, most: int = 100) -> DataFrame:
    """accepted with part ('val' or 'train'): the first of the order by md5(seed|key) are for validation.

    Only the head of that order is found (a top-k of at most `most` rows), not the whole order.
    """
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    n = accepted.agg(F.count("*").alias("n")).select(F.least(F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.col("n") * ratio))), F.greatest(F.lit(0), F.col("n") - 1)).alias("k"))
    head = accepted.select(F.col(key).alias("_key"), order.alias("_o")).orderBy("_o", "_key").limit(most)
    val = head.withColumn("_r", F.row_number().over(Window.orderBy("_o", "_key"))).join(F.broadcast(n), F.col("_r") <= F.col("k")).select("_key", F.lit(True).alias("_val"))
    return accepted.join(F.broadcast(val), accepted[key] == val["_key"], "left").withColumn("part", F.when(F.col("_val"), "val").otherwise("train")).drop("_key", "_val")


POINTS = {"min": 0.0, "p10": 0.1, "median": 0.5, "p90": 0.9, "max": 1.0}


def corpus_summary(accepted: DataFrame, key: str, text: str = "text", **options) -> DataFrame:
    """One row: clips, total_seconds, total_hours, mean_duration (0 without clips), duration_percentiles, chars_percentiles (null without clips), train, val.

    Sources are a table of their own (source_rollup), since their number is not bounded. options: those of split.
    """
    x = accepted.agg(F.count("*").alias("clips"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("_s"), F.coalesce(F.avg("duration"), F.lit(0.0)).alias("_m"))
    x = x.select("clips", F.bround("_s", 2).alias("total_seconds"), F.bround(F.col("_s") / 3600, 3).alias("total_hours"), F.bround("_m", 3).alias("mean_duration"))
    values = {"duration_percentiles": F.col("duration").cast("double"), "chars_percentiles": F.length(text).cast("double")}
    both = accepted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("_what"), v.alias("_x")) for k, v in values.items()])).alias("_v")).select("_v.*")
    at = nearest_ranks(both, ["_what"], "_x", tuple(POINTS.values()))
    own = lambda name, p: F.max(F.when((F.col("_what") == name) & (F.col("p") == p), F.col("value")))
    one = lambda name: F.struct(*[F.bround(own(name, p), 3).alias(k) for k, p in POINTS.items()])
    x = x.crossJoin(at.agg(*[F.when(F.count_if(F.col("_what") == name) > 0, one(name)).alias(name) for name in values]))
    val = split(accepted, key, **options).agg(F.count(F.when(F.col("part") == "val", 1)).alias("val"))
    return x.crossJoin(val).withColumn("train", F.col("clips") - F.col("val")).select("clips", "total_seconds", "total_hours", "mean_duration", "duration_percentiles", "chars_percentiles", "train", "val")


def mersenne_split(ids: list, seed: int = 1234, ratio: float = 0.02, most: int = 100) -> tuple[list, list]:
    """(validation, training) of ids in order, shuffled as Python's random does; for lists that fit the driver."""
    import random

    out = list(ids)
    random.Random(seed).shuffle(out)
    n = min(min(most, max(1, int(len(out) * ratio))), max(0, len(out) - 1))
    return out[:n], out[n:]
