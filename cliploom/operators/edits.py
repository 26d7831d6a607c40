"""Corrections by hand laid over clips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename


def outcome(records: DataFrame, clips: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """records (name, duration, text) with outcome: unmatched, mismatched (durations differ), unchanged or applied.

    Of clips with one file name the last counts.
    """
    c = clips.groupBy(basename(F.col("wav")).alias("name")).agg(F.max_by(F.struct(F.col("duration").alias("d"), F.coalesce("text", F.lit("")).alias("t"), F.col("idx").alias("i")), "idx").alias("_c"))
    x = records.join(c, "name", "left")
    o = (
        F.when(F.col("_c").isNull(), "unmatched")
        .when(F.abs(F.col("_c.d") - F.col("duration")) > tolerance, "mismatched")
        .when((F.coalesce("text", F.lit("")) == "") | (F.col("text") == F.col("_c.t")), "unchanged")
        .otherwise("applied")
    )
    return x.withColumn("outcome", o).withColumn("idx", F.col("_c.i")).drop("_c")


def apply(records: DataFrame, clips: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """clips with the texts of applied records, word for word, as manual and certain."""
    a = outcome(records, clips, tolerance).where("outcome = 'applied'").select(F.col("idx").alias("_idx"), F.col("text").alias("_text"))
    x = clips.join(a, clips["idx"] == a["_idx"], "left")
    hit = F.col("_idx").isNotNull()
    source = F.col("text_source") if "text_source" in clips.columns else F.lit(None).cast("string")
    return x.withColumns({"text": F.when(hit, F.col("_text")).otherwise(F.col("text")), "text_source": F.when(hit, "manual").otherwise(source), "ctc_score": F.when(hit, 1.0).otherwise(F.col("ctc_score")), "completeness": F.when(hit, 1.0).otherwise(F.col("completeness"))}).drop("_idx", "_text")
