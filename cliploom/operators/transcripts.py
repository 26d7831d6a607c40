"""From a recogniser's segments to words and to the records of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .intervals import overlap_repair

#: Decimals of times and of scores in the records.
TIMES, SCORES = 3, 4


def rounded(c: Column, places: int) -> Column:
    return F.floor(c * 10**places + 0.5) / 10**places


def normalise(segments: DataFrame) -> DataFrame:
    """segments (source_id, seg, s, e, text, no_speech_prob, avg_logprob, words: array of (word, s, e, prob)) without gaps: missing probabilities of the segment
    are 0, those of words 1, times of words those of the segment; texts lose white space at the ends, a missing list of words is empty."""
    none = F.array().cast(segments.schema["words"].dataType)
    words = F.transform(F.coalesce("words", none), lambda w: F.struct(F.coalesce(w["word"], F.lit("")).alias("word"), F.coalesce(w["s"], F.col("s")).alias("s"), F.coalesce(w["e"], F.col("e")).alias("e"), F.coalesce(w["prob"], F.lit(1.0)).alias("prob")))
    return segments.withColumns({"text": strip(F.coalesce("text", F.lit(""))), "no_speech_prob": F.coalesce("no_speech_prob", F.lit(0.0)), "avg_logprob": F.coalesce("avg_logprob", F.lit(0.0)), "words": words})


def flatten_words(segments: DataFrame, chunk: float = 60.0) -> DataFrame:
    """(source_id, ord, seg, text, prob, s, e, s2, e2): the words of normalised segments in order of time, s2 and e2 without overlaps.

    A segment without a list of words is one word, its own text; empty words go.
    """
    whole = F.array(F.struct(F.col("text").alias("word"), "s", "e", F.lit(1.0).alias("prob")))
    listed = F.when(F.size("words") == 0, whole).otherwise(F.col("words"))
    w = segments.select("source_id", "seg", F.posexplode(listed).alias("_n", "w"))
    w = w.select("source_id", (F.col("seg") * (1 << 20) + F.col("_n")).alias("ord"), "seg", strip(F.col("w.word")).alias("text"), F.col("w.prob").alias("prob"), F.col("w.s").alias("s"), F.col("w.e").alias("e")).where("text <> ''")
    return overlap_repair(w, chunk=chunk)


def segment_records(words: DataFrame, spans: DataFrame, segments: DataFrame, most: float) -> tuple[DataFrame, DataFrame]:
    """(a record of each group, figures of each source) from words (source_id, group_block, seg, ord, s, e, text, prob, ctc_score), the
    spans of groups (source_id, group_block, start, end) and the segments that own the words (source_id, seg, no_speech_prob).

    no_speech_prob is the greatest of the owners, 0 without any; a group longer than `most` counts as oversize.
    """
    owners = words.select("source_id", "group_block", "seg").distinct().join(segments.select("source_id", "seg", "no_speech_prob"), ["source_id", "seg"])
    silent = owners.groupBy("source_id", "group_block").agg(F.max("no_speech_prob").alias("no_speech_prob"))
    ctc = F.coalesce("ctc_score", F.lit(1.0))
    in_order = F.sort_array(F.collect_list(F.struct("s", "e", "ord", "text")))
    g = words.groupBy("source_id", "group_block").agg(
        F.min_by("s", F.struct("s", "e", "ord")).alias("speech_start"), F.max_by("e", F.struct("s", "e", "ord")).alias("speech_end"), F.count("*").alias("word_count"),
        F.avg("prob").alias("asr_prob"), F.min("prob").alias("min_word_prob"), F.avg(ctc).alias("ctc_score"), F.min(ctc).alias("min_ctc_word_score"),
        F.trim(F.regexp_replace(F.array_join(F.transform(in_order, lambda r: r["text"]), " "), r"(?U)\s+", " ")).alias("raw_text"),
    )
    x = g.join(spans, ["source_id", "group_block"]).join(silent, ["source_id", "group_block"], "left")
    scores = {c: rounded(F.coalesce(c, F.lit(0.0)), SCORES) for c in ("asr_prob", "min_word_prob", "ctc_score", "min_ctc_word_score", "no_speech_prob")}
    times = {c: rounded(v, TIMES) for c, v in {"start": F.col("start"), "end": F.col("end"), "duration": F.col("end") - F.col("start"), "speech_start": F.col("speech_start"), "speech_end": F.col("speech_end")}.items()}
    records = x.select("source_id", "group_block", *[v.alias(c) for c, v in (times | scores).items()], "raw_text", "word_count")
    figures = x.groupBy("source_id").agg(F.count("*").alias("groups"), F.count_if(F.col("end") - F.col("start") > most).alias("oversize"), F.sum("word_count").alias("words"))
    return records, figures


def outcome_counts(clips: DataFrame, **outcomes: Column) -> DataFrame:
    """How many clips of each source there are, and for how many each outcome holds."""
    return clips.groupBy("source_id").agg(F.count("*").alias("clips"), *[F.count_if(c).alias(k) for k, c in outcomes.items()])
