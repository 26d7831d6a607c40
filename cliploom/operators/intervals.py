"""Interval algebra of silences, words and frames.

Range joins carry the source and a time bucket as equality keys: an interval is copied to each bucket that it
touches, pairs are checked again, and a pair counts only in the first bucket that both touch. A hot source is so
spread over its buckets, and no nested-loop join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running
from .selection import medians

CHUNK = 4096.0  # seconds or places of one chunk of an ordered run


def overlap_repair(words: DataFrame, chunk: float = CHUNK) -> DataFrame:
    """words (source_id, ord, s, e) with starts pushed to the greatest end before and ends not before starts.

    Order is (s, e, ord). The first word of a source keeps its own end; every other end is at least its start, and
    the running maximum of ends is both the new end and the next start's floor.
    """
    order = ["s", "e", "ord"]
    lead = words.groupBy("source_id").agg(F.min(F.struct(*order)).alias("_f"))
    x = words.join(lead, "source_id").withColumn("_g", F.when(F.struct(*order) == F.col("_f"), F.col("e")).otherwise(F.greatest("s", "e"))).drop("_f")
    x = running(x, ["source_id"], order, "_g", "max", F.floor(F.col("s") / chunk), "e2")
    x = running(x, ["source_id"], order, "_g", "max", F.floor(F.col("s") / chunk), "_p", before=True)
    return x.withColumn("s2", F.greatest("s", F.coalesce("_p", "s"))).drop("_g", "_p")


def complement(regions: DataFrame, totals: DataFrame, min_length: float = 0.05, chunk: float = CHUNK) -> DataFrame:
    """(source_id, s, e): what regions (source_id, ord, s, e) leave of [0, total], in pieces of min_length at least.

    Regions count in the given order; each gap begins at the greatest end so far.
    """
    x = running(regions, ["source_id"], ["ord"], "e", "max", F.floor(F.col("ord") / chunk), "_p", before=True)
    gaps = x.select("source_id", F.greatest(F.lit(0.0), F.coalesce("_p", F.lit(0.0))).alias("s"), F.col("s").alias("e"))
    last = regions.groupBy("source_id").agg(F.max("e").alias("_m"))
    tail = totals.join(last, "source_id", "left").select("source_id", F.greatest(F.lit(0.0), F.coalesce("_m", F.lit(0.0))).alias("s"), F.col("total").cast("double").alias("e"))
    return gaps.unionByName(tail).where(F.col("e") - F.col("s") >= min_length)


def islands(frames: DataFrame, quiet: Column, step: float = 0.01, min_length: float = 0.10, chunk: int = 65536) -> DataFrame:
    """(source_id, lo, hi, s, e) of runs of quiet frames; hi is past the end, lengths are compared before rounding to 4 places.

    frames (source_id, frame) are dense. A run begins where the frame before is not quiet, so chunks of frames are
    enough: the number of quiet frames before is a running sum.
    """
    x = frames.withColumn("_q", F.coalesce(quiet, F.lit(False)).cast("long"))
    x = running(x, ["source_id"], ["frame"], "_q", "sum", F.floor(F.col("frame") / chunk), "_n").where("_q = 1")
    g = x.groupBy("source_id", (F.col("frame") - F.col("_n")).alias("_island")).agg(F.min("frame").alias("lo"), (F.max("frame") + 1).alias("hi"))
    at = lambda c: F.col(c) * F.lit(step)
    four = lambda c: F.floor(at(c) * 1e4 + 0.5) / 1e4
    return g.where(at("hi") - at("lo") >= min_length).select("source_id", "lo", "hi", four("lo").alias("s"), four("hi").alias("e"))


def reference_level(frames: DataFrame, offset: float = 25.0) -> DataFrame:
    """The median level of frames inside speech, else of all, less an offset, for each source."""
    both = frames.select("source_id", F.explode(F.when(F.col("inside"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("_all"), "level")
    m = medians(both, ["source_id", "_all"], "level")
    found = m.groupBy("source_id").agg(F.min_by("median", "_all").alias("_m"))
    return frames.select("source_id").distinct().join(found, "source_id", "left").select("source_id", (F.col("_m") - offset).alias("threshold"))


def noise_budget(regions: DataFrame, budget: float = 30.0, min_length: float = 0.30, trim: float = 0.05, min_trimmed: float = 0.1) -> DataFrame:
    """Regions (source_id, ord, s, e), longest first, until the trimmed lengths of a source reach the budget; the one that reaches it is in.

    A source stops after few regions: those whose length cannot matter never enter the ordered step once enough longer
    ones are there, since the sum runs in chunks of falling length.
    """
    x = regions.where(F.col("e") - F.col("s") >= min_length).withColumn("len", F.col("e") - F.col("s")).withColumn("kept", (F.col("e") - trim) - (F.col("s") + trim)).where(F.col("kept") >= min_trimmed)
    x = running(x, ["source_id"], [F.desc("len"), F.asc("ord")], "kept", "sum", -F.ceil(F.log2(F.col("len")) * 8), "_before", before=True)
    return x.where(F.coalesce("_before", F.lit(0.0)) < budget).select("source_id", "ord", (F.col("s") + trim).alias("s"), (F.col("e") - trim).alias("e"))


def _buckets(df: DataFrame, lo: str, hi: str, width: float, name: str) -> DataFrame:
    b = lambda c: F.floor(c / width)
    return df.withColumn(f"_{name}", b(F.col(lo))).withColumn("_bucket", F.explode(F.sequence(b(F.col(lo)), b(F.greatest(lo, hi)))))


def overlaps(left: DataFrame, right: DataFrame, width: float = 60.0, how: str = "inner", more: Column | None = None) -> DataFrame:
    """Pairs of left (source_id, s, e, ...) and right (source_id, rs, re, ...) with rs < e and re > s.

    how: inner, left_semi or left_anti; more: a further condition on a pair.
    """
    meet = (F.col("rs") < F.col("e")) & (F.col("re") > F.col("s"))
    if more is not None:
        meet = meet & more
    pairs = _buckets(left, "s", "e", width, "lb").join(_buckets(right, "rs", "re", width, "rb"), ["source_id", "_bucket"]).where(meet & (F.col("_bucket") == F.greatest("_lb", "_rb")))
    if how == "inner":
        return pairs.drop("_bucket", "_lb", "_rb")
    keys = pairs.select("source_id", "ord").distinct()
    return left.join(keys, ["source_id", "ord"], how)


def frames_in_speech(frames: DataFrame, speech: DataFrame, step: float, chunk: int = 4096) -> DataFrame:
    """frames (source_id, frame) that lie in a region (source_id, s, e): from trunc(s / step) to before ceil(e / step)."""
    lo, hi = F.greatest(F.lit(0), (F.col("s") / step).cast("long")), F.ceil(F.col("e") / step)
    r = speech.select("source_id", lo.alias("lo"), hi.alias("hi")).where("hi > lo")
    r = r.select("source_id", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / chunk), F.floor((F.col("hi") - 1) / chunk))).alias("_bucket"))
    f = frames.withColumn("_bucket", F.floor(F.col("frame") / chunk))
    return f.join(r.withColumnRenamed("source_id", "_s"), (F.col("source_id") == F.col("_s")) & (f["_bucket"] == r["_bucket"]) & (F.col("frame") >= F.col("lo")) & (F.col("frame") < F.col("hi")), "left_semi").drop("_bucket")


def word_rate(text: str = "text", s: str = "rs", e: str = "re") -> Column:
    """Seconds a character of a word without the punctuation around it."""
    return (F.col(e) - F.col(s)) / F.greatest(F.length(F.btrim(F.col(text), F.lit(".,!?…;:\"')]}»"))), F.lit(1))


def rate_limits(words: DataFrame, factor: float = 2.0, floor: float = 0.12) -> DataFrame:
    """Twice the median rate of each source, at least the floor."""
    m = medians(words.select("source_id", word_rate().alias("_rate")), ["source_id"], "_rate")
    return words.select("source_id").distinct().join(m, "source_id", "left").select("source_id", F.greatest(F.lit(floor), F.col("median") * factor).alias("limit"))


def cut_points(silences: DataFrame, words: DataFrame, limits: DataFrame, pad: float = 0.08, most: float = 0.8, width: float = 60.0) -> DataFrame:
    """Silences (source_id, ord, s, e) as cuts: time, before, after, length; none where a stretched word covers `most` of it."""
    x = silences.where("e > s").join(limits, "source_id")
    stretched = ((F.least("re", "e") - F.greatest("rs", "s")) / (F.col("e") - F.col("s")) >= most) & (word_rate() >= F.col("limit"))
    kept = overlaps(x, words, width, "left_anti", stretched)
    mid = (F.col("s") + F.col("e")) / 2.0
    return kept.select("source_id", "ord", mid.alias("time"), F.least(mid, F.col("s") + pad).alias("before"), F.greatest(mid, F.col("e") - pad).alias("after"), (F.col("e") - F.col("s")).alias("length"))


def silence_targets(silences: DataFrame, shortest: float = 0.1, longest: float = 1.0) -> DataFrame:
    """The silences that purity is measured on, by their length, both limits included."""
    return silences.where((F.col("e") - F.col("s")).between(shortest, longest))


def silence_coverage(silences: DataFrame, words: DataFrame, most: float = 0.2, width: float = 60.0) -> DataFrame:
    """n_targets and n_clean of each source: silences of which words cover less than `most`; one without length is no clean one."""
    p = overlaps(silences, words, width).groupBy("source_id", "ord").agg(F.sum(F.greatest(F.lit(0.0), F.least("re", "e") - F.greatest("rs", "s"))).alias("covered"))
    x = silences.join(p, ["source_id", "ord"], "left")
    clean = F.try_divide(F.coalesce("covered", F.lit(0.0)), F.col("e") - F.col("s")) < most
    return x.groupBy("source_id").agg(F.count("*").alias("n_targets"), F.count_if(clean).alias("n_clean"))


def purity(coverage: DataFrame) -> DataFrame:
    """The share of clean targets, 0 without any."""
    return coverage.agg(F.coalesce(F.sum("n_clean") / F.sum("n_targets"), F.lit(0.0)).alias("purity"))


def assign_blocks(words: DataFrame, cuts: DataFrame, chunk: float = CHUNK) -> DataFrame:
    """words with block: the number of cuts at or before the midpoint. A running count over cuts and words in order of time; no join."""
    w = words.withColumn("_t", (F.col("s") + F.col("e")) / 2.0).withColumn("_cut", F.lit(0).cast("long"))
    c = cuts.select("source_id", F.col("time").alias("_t"), F.lit(1).cast("long").alias("_cut"))
    both = c.unionByName(w, allowMissingColumns=True)
    out = running(both, ["source_id"], ["_t", F.desc("_cut")], "_cut", "sum", F.floor(F.col("_t") / chunk), "block").where("_cut = 0")
    return out.select(*words.columns, "block")


def boundary_audit(edges: DataFrame, frames: DataFrame, thresholds: DataFrame, half: float, width: float = 60.0) -> DataFrame:
    """(source_id, ord, label, n, loud): samples within `half` of each edge (source_id, ord, label, at), and whether their mean power is over the threshold."""
    x = edges.withColumn("s", F.col("at") - half).withColumn("e", F.col("at") + half)
    f = frames.withColumn("rs", F.col("t")).withColumn("re", F.col("t"))
    near = _buckets(x, "s", "e", width, "lb").join(f.withColumn("_bucket", F.floor(F.col("t") / width)), ["source_id", "_bucket"]).where("t >= s and t < e")
    g = near.groupBy("source_id", "ord", "label").agg(F.count("*").alias("n"), F.sum("power").alias("power"))
    return g.join(thresholds, "source_id").select("source_id", "ord", "label", "n", (F.col("power") > F.col("threshold") * F.col("n")).alias("loud"))


def last_in_order(value: str, *order: str) -> Column:
    return F.max_by(value, F.struct(*order))


def ends_sentence(text: Column) -> Column:
    """Whether a last word ends in . ! ? or …, closing marks apart."""
    return F.coalesce(F.right(F.rtrim(text, F.lit("\"')]}»")), F.lit(1)).isin(*".!?…"), F.lit(False))


