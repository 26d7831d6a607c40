"""Which stages of a run are due, from a table of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("decode", "vad", "denoise", "asr", "align", "segment", "cut", "text", "qc", "export")


def wanted(spec: str) -> list[str]:
    """Stages of a comma list, in their order; an unknown or an empty one raises."""
    names = [x.strip() for x in spec.split(",") if x.strip()]
    if unknown := [x for x in names if x not in STAGES]:
        raise ValueError(f"unknown stages: {', '.join(unknown)}")
    if not names:
        raise ValueError("no stages")
    return [s for s in STAGES if s in names]


def due(plan: DataFrame, artefacts: DataFrame, asked: list[str], force: bool = False) -> DataFrame:
    """plan (source_id, stage, outputs, needs: arrays of names) with run: asked for, forced or without an output, and all needs there."""
    have = artefacts.groupBy("source_id").agg(F.collect_set("name").alias("_have"))
    x = plan.join(have, "source_id", "left").withColumn("_have", F.coalesce("_have", F.array().cast("array<string>")))
    missing = F.size(F.array_except("outputs", "_have")) > 0
    ready = F.size(F.array_except("needs", "_have")) == 0
    return x.withColumn("run", F.col("stage").isin(asked) & (F.lit(force) | missing) & ready).drop("_have")


def complete_sources(artefacts: DataFrame, needed=("qc", "source")) -> DataFrame:
    """Sources that have all of the needed artefacts."""
    return artefacts.where(F.col("name").isin(*needed)).groupBy("source_id").agg(F.count_distinct("name").alias("n")).where(F.col("n") == len(needed)).select("source_id")
