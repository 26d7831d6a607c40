"""State of jobs from a log of field updates: last writer wins, progress and time left. The windows are an extension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("total", "done", "state", "started", "done_at", "file", "error")


def latest(log: DataFrame, fields=FIELDS, key: str = "job", at: str = "at") -> DataFrame:
    """A row a job with the last non-null value of each field; static, or a stream in complete or update mode."""
    return log.groupBy(key).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(at))).alias(f) for f in fields if f in log.columns])


def seconds_left(now: Column) -> Column:
    """From the rate so far, less what passed since the last step; null before the first."""
    rate = (F.col("done_at") - F.col("started")) / F.col("done")
    return F.when(F.col("done") > 0, F.greatest(F.lit(0), F.floor(rate * (F.col("total") - F.col("done")) - (now - F.col("done_at")) + 0.5).cast("long")))


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events of each type in each window of event time; later rows than the watermark are left out by the stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("value") * 100 + 0.5)).alias("cents"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
