"""Rejection rules with every reason kept, first-clean-wins deduplication, and counts of reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """Limits of the rules; None switches a rule off. A value at its limit passes."""

    min_duration: float = 1.5
    max_duration: float = 12.0
    min_chars: int = 4
    min_chars_per_sec: float = 4.0
    max_chars_per_sec: float = 28.0
    max_clip_ratio: float = 0.005
    min_snr_db: float = 10.0
    min_asr_prob: float = 0.55
    min_word_prob: float | None = None
    min_ctc_score: float | None = 0.6
    min_completeness: float | None = 0.80
    max_no_speech_prob: float = 0.5
    ctc_overrides_no_speech: float | None = 0.75
    drop_duplicate_text: bool = True


def _or(df: DataFrame, name: str, default) -> Column:
    """A column, or the default where it is null or absent."""
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def reasons(df: DataFrame, t: Thresholds = Thresholds()) -> Column:
    """The codes of the rules that a clip breaks, in order of the rules."""
    text, duration = _or(df, "text", ""), _or(df, "duration", 0.0)
    chars = F.length(text)
    rate = chars / F.when(duration > 0, duration)
    ctc = _or(df, "ctc_score", 1.0)
    speechless = _or(df, "no_speech_prob", 0.0) > t.max_no_speech_prob
    if t.ctc_overrides_no_speech is not None:
        speechless = speechless & (_or(df, "ctc_score", 0.0) < t.ctc_overrides_no_speech)
    rules = [
        ("duration_too_short", duration < t.min_duration),
        ("duration_too_long", duration > t.max_duration),
        ("text_too_short", chars < t.min_chars),
        ("speech_rate_low", rate < t.min_chars_per_sec),
        ("speech_rate_high", rate > t.max_chars_per_sec),
        ("clipping", _or(df, "clip_ratio", 0.0) > t.max_clip_ratio),
        ("low_snr", _or(df, "snr_db", 0.0) < t.min_snr_db),
        ("low_asr_confidence", _or(df, "asr_prob", 1.0) < t.min_asr_prob),
        ("low_word_confidence", None if t.min_word_prob is None else _or(df, "min_word_prob", 1.0) < t.min_word_prob),
        ("text_audio_mismatch", None if t.min_ctc_score is None else ctc < t.min_ctc_score),
        ("text_incomplete", None if t.min_completeness is None else _or(df, "completeness", 1.0) < t.min_completeness),
        ("no_speech", speechless),
        ("empty_text", text == ""),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules if c is not None]))


def review(clips: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """clips with reasons and accepted; duplicate_text comes last, where an accepted clip of the source with less idx has the same text but for case.

    The least accepted idx of a text is an aggregate with a map-side half, joined back, so that a text or a source
    with a third of the rows is not sorted in one task.
    """
    x = clips.withColumn("reasons", reasons(clips, t))
    if t.drop_duplicate_text:
        key = F.lower(F.coalesce("text", F.lit("")))
        first = x.where((F.size("reasons") == 0) & (key != "")).groupBy("source_id", F.xxhash64(key).alias("_h"), key.alias("_key")).agg(F.min("idx").alias("_first"))
        x = x.withColumn("_h", F.xxhash64(key)).withColumn("_key", key).join(first, ["source_id", "_h", "_key"], "left")
        x = x.withColumn("reasons", F.when(F.col("idx") > F.col("_first"), F.concat("reasons", F.array(F.lit("duplicate_text")))).otherwise(F.col("reasons"))).drop("_h", "_key", "_first")
    return x.withColumn("accepted", F.size("reasons") == 0)


def reason_histogram(reviewed: DataFrame) -> DataFrame:
    """reason, n, first (place of its first appearance: idx and place in the list), most frequent first."""
    r = reviewed.select("idx", F.posexplode("reasons").alias("pos", "reason"))
    return r.groupBy("reason").agg(F.count("*").alias("n"), F.min(F.struct("idx", "pos")).alias("f")).select("reason", "n", F.col("f.idx").alias("first_idx"), F.col("f.pos").cast("long").alias("first_pos")).orderBy(F.desc("n"), "first_idx", "first_pos")


def merge_histograms(parts: DataFrame) -> DataFrame:
    """Totals of (source_id, reason, n) histograms over sources."""
    return parts.groupBy("reason").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "reason")


def funnel(reviewed: DataFrame) -> DataFrame:
    """Counts of each source."""
    return reviewed.groupBy("source_id").agg(F.count("*").alias("total"), F.count_if("accepted").alias("n_accepted"), F.count_if(~F.col("accepted")).alias("n_rejected"), F.count_if(F.array_contains("reasons", "duplicate_text")).alias("n_duplicate"))


def rescore(clips: DataFrame, threshold: float = 0.8, min_completeness: float = 0.9, min_gain: float = 0.05, tolerance: float = 0.05, completeness_gain: float = 0.05) -> DataFrame:
    """Whether a second reading (new_score, new_completeness) replaces the first (ctc_score, completeness), and why."""
    old, new = F.coalesce("ctc_score", F.lit(0.0)), F.coalesce("new_score", F.lit(0.0))
    old_full, new_full = F.col("completeness"), F.col("new_completeness")
    candidate = ~((old >= threshold) & (old_full >= min_completeness))
    by_score = new > old + min_gain
    closer = (F.abs(1 - new_full) + completeness_gain < F.abs(1 - old_full)) & (new > old - tolerance)
    return clips.withColumn("decision", F.when(~candidate, "kept").when(by_score, "by_score").when(closer, "by_completeness").otherwise("tried"))


def chosen_text(refined: str = "refined_text", rescored: str = "rescored_text", raw: str = "raw_text") -> Column:
    """The refined text, else the rescored, else the raw; empty counts as missing."""
    return F.coalesce(F.nullif(refined, F.lit("")), F.nullif(rescored, F.lit("")), F.col(raw))
