"""Greedy folds whose next step depends on their own last: chunk bounds, groups of blocks, packing by bytes.

A fold streams through the ordered rows of a partition in Arrow batches and holds one key's state. Where a fold starts
anew whatever went before (an empty block), the rows between two such places are a key of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..functions.text import strip
from . import jumps
from .running import cut_lineage, running


def fold(df: DataFrame, keys: list[str], order: list[str], schema: str, step: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """step over the ordered rows of each key, as an iterator; its rows are the result."""
    rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        stream = (r for b in batches for r in b.to_pylist())
        out = []
        for _, mine in groupby(stream, key=lambda r: tuple(r[k] for k in keys)):
            for r in step(mine):
                out.append(dict(r))
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, target)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, target)

    return rows.mapInArrow(run, schema)


#: Rows of a source that one task folds; longer sources go by pointers.
MOST = 1 << 17


def _by_length(rows: DataFrame, key: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with at most `most` rows, and of the others, None without any; there is one of these at most for each `most` rows."""
    long = cut_lineage(rows.groupBy(key).count().where(F.col("count") > most).select(F.col(key).alias("_long")))
    if long.isEmpty():
        return rows, None
    return rows.join(long, F.col(key) == F.col("_long"), "left_anti"), rows.join(long, F.col(key) == F.col("_long"), "left_semi")


def chunk_bounds(silences: DataFrame, totals: DataFrame, target: float = 20.0, min_silence: float = 0.4, most: int = MOST) -> DataFrame:
    """(source_id, n, bound): 0, then centres of long silences at least target after the last bound, then the total.

    The last bound moves to the total if less than half a target is left and it is not the first.
    """
    mid = silences.where(F.col("e") - F.col("s") >= min_silence).select("source_id", ((F.col("s") + F.col("e")) / 2).alias("t"), F.lit(0).alias("end"))
    short, long = _by_length(mid.unionByName(totals.select("source_id", F.col("total").cast("double").alias("t"), F.lit(1).alias("end"))), "source_id", most)
    out = _folded_bounds(short, target)
    return out if long is None else out.unionByName(pointed_bounds(long.where("end = 0"), totals, target))


def pointed_bounds(mid: DataFrame, totals: DataFrame, target: float, width: float | None = None) -> DataFrame:
    """chunk_bounds of centres (source_id, t) by next-pointers, for sources of any length; those without a centre have no rows."""
    width = width or 4096 * target
    t = F.col("t").cast("double")
    places = mid.where(t >= target).select("source_id", t.alias("at")).unionByName(mid.select("source_id", F.lit(0.0).alias("at")).distinct())
    passed = jumps.path(jumps.first_from(places, target, width), width)
    n = running(passed.withColumn("_1", F.lit(1)), ["source_id"], ["at"], "_1", "sum", F.floor(F.col("at") / width), "_n").select("source_id", (F.col("_n") - 1).cast("long").alias("n"), F.col("at").alias("bound"))
    last = n.groupBy("source_id").agg(F.max(F.struct("n", "bound")).alias("_l")).join(totals, "source_id").select("source_id", F.col("_l.n").alias("_n"), F.col("_l.bound").alias("_b"), F.col("total").cast("double").alias("_t"))
    last = last.withColumn("_moves", (F.col("_t") - F.col("_b") < target / 2) & (F.col("_n") > 0))
    kept = n.join(last, "source_id").select("source_id", "n", F.when(F.col("_moves") & (F.col("n") == F.col("_n")), F.col("_t")).otherwise(F.col("bound")).alias("bound"))
    return kept.unionByName(last.where(~F.col("_moves")).select("source_id", (F.col("_n") + 1).alias("n"), F.col("_t").alias("bound")))


def _folded_bounds(rows: DataFrame, target: float) -> DataFrame:
    def step(rows):
        n, last, held = 0, 0.0, {"n": 0, "bound": 0.0}
        for r in rows:
            held["source_id"] = r["source_id"]
            if r["end"]:
                if r["t"] - last < target / 2 and n > 0:
                    held["bound"] = r["t"]
                    yield held
                else:
                    yield held
                    yield {"source_id": r["source_id"], "n": n + 1, "bound": r["t"]}
                return
            if r["t"] - last >= target:
                yield held
                n, last = n + 1, r["t"]
                held = {"source_id": r["source_id"], "n": n, "bound": last}

    return fold(rows, ["source_id"], ["end", "t"], "source_id long, n long, bound double", step)


def greedy_groups(blocks: DataFrame, min_duration: float = 1.5, target: float = 8.0, max_duration: float = 12.0, chunk: int = 65536) -> DataFrame:
    """blocks (source_id, block, span_start, span_end, n_words, ends) with the first block of their group; empty blocks are in none.

    An empty block ends a group, so the run of blocks between two empty ones is folded by itself.
    """
    x = blocks.withColumn("_e", (F.col("n_words") == 0).cast("long"))
    x = running(x, ["source_id"], ["block"], "_e", "sum", F.floor(F.col("block") / chunk), "island").where("n_words > 0")

    def step(rows):
        start = end = first = None
        ends = False
        for r in rows:
            if first is not None:
                span, joined = end - start, r["span_end"] - start
                extend = span < min_duration and joined <= max_duration
                stop = joined > target or (ends and span >= min_duration)
            if first is None or not (extend or not stop):
                first, start = r["block"], r["span_start"]
            end, ends = r["span_end"], bool(r["ends"])
            yield {"source_id": r["source_id"], "block": r["block"], "group_block": first}

    return fold(x.select("source_id", "island", "block", "span_start", "span_end", "ends"), ["source_id", "island"], ["block"], "source_id long, block long, group_block long", step)


def pack_bytes(pieces: DataFrame, limit: int, key: str = "source_id", order: str = "ord", text: str = "text", most: int = MOST) -> DataFrame:
    """(key, first, last, text): pieces without blanks at their ends joined by a blank while their UTF-8 bytes are at most limit; a longer piece stands alone, empty ones are left out."""
    rows = pieces.select(F.col(key).cast("long").alias("k"), F.col(order).cast("long").alias("o"), strip(F.coalesce(F.col(text), F.lit(""))).alias("t")).where("t <> ''")
    short, long = _by_length(rows, "k", most)

    def step(rows):
        held, size = None, 0
        for r in rows:
            n = len(r["t"].encode())
            if held and size + 1 + n <= limit:
                held["last"], size = r["o"], size + 1 + n
                held["text"].append(r["t"])
            else:
                if held:
                    yield held | {"text": " ".join(held["text"])}
                held, size = {"k": r["k"], "first": r["o"], "last": r["o"], "text": [r["t"]]}, n
        if held:
            yield held | {"text": " ".join(held["text"])}

    out = fold(short, ["k"], ["o"], "k long, first long, last long, text string", step)
    return (out if long is None else out.unionByName(pointed_packs(long, limit))).withColumnRenamed("k", key)


def pointed_packs(rows: DataFrame, limit: int, width: float | None = None, chunk: int = 65536) -> DataFrame:
    """pack_bytes of (k, o, t) by next-pointers, for keys of any length; o is distinct in a key, and as dense as chunks of `chunk` places of it should be full."""
    width = width or 4096.0 * limit
    at = F.floor(F.col("o") / chunk)
    x = running(rows.withColumn("_b", (F.octet_length("t") + 1).cast("long")), ["k"], ["o"], "_b", "sum", at, "_end")
    x = x.withColumn("begin", (F.col("_end") - F.col("_b")).cast("double"))
    # A pack from `begin` ends before the first piece whose end is more than limit + 1 bytes after it, which is the piece that begins its next one.
    ends = x.select("k", F.col("_end").cast("double").alias("at"), "begin")
    starts = x.select("k", F.col("begin").alias("at"))
    asked = jumps.first_from(ends.select("k", "at").unionByName(starts), limit + 2.0, width, "k").join(starts, ["k", "at"], "left_semi")
    over = asked.join(ends.select("k", F.col("at").alias("to"), F.col("begin").alias("_next")), ["k", "to"])
    after = x.select("k", F.col("begin").alias("at"), F.col("_end").cast("double").alias("_after"), F.lit(1).alias("_"))
    nodes = after.join(over.select("k", "at", "_next"), ["k", "at"], "left").join(starts.select("k", F.col("at").alias("_after"), F.lit(True).alias("_there")), ["k", "_after"], "left")
    # A piece that alone is over the limit would point to itself: then to the one behind it, if there is one.
    nodes = nodes.select("k", "at", F.when(F.col("_next") > F.col("at"), F.col("_next")).when(F.col("_next") == F.col("at"), F.when(F.col("_there"), F.col("_after"))).alias("to"))
    heads = jumps.path(nodes, width, "k").withColumn("_head", F.col("at"))
    x = x.join(heads.withColumnRenamed("at", "begin"), ["k", "begin"], "left")
    x = running(x, ["k"], ["o"], "_head", "last", at, "_pack")
    packs = x.groupBy("k", "_pack").agg(F.min("o").alias("first"), F.max("o").alias("last"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o", "t"))), lambda r: r["t"]), " ").alias("text"))
    return packs.drop("_pack")


def blocks_of(words: DataFrame, cuts: DataFrame, totals: DataFrame) -> DataFrame:
    """(source_id, block, span_start, span_end): a block before, between and after cuts, empty ones too."""
    w = Window.partitionBy("source_id").orderBy("time", "ord")
    c = cuts.select("source_id", F.row_number().over(w).cast("long").alias("block"), F.col("after").alias("span_start"), F.lead("before").over(w).alias("_next"))
    head = totals.join(cuts.groupBy("source_id").agg(F.min_by("before", F.struct("time", "ord")).alias("_next")), "source_id", "left").select("source_id", F.lit(0).cast("long").alias("block"), F.lit(0.0).alias("span_start"), "_next")
    return head.unionByName(c).join(totals, "source_id").select("source_id", "block", "span_start", F.coalesce("_next", F.col("total").cast("double")).alias("span_end"))


def segments(words: DataFrame) -> DataFrame:
    """One row a (source_id, group_block): counts, extremes, thousandths of the mean score, first start, last end and joined text of its words."""
    milli = lambda c: F.floor(c * 1000 + 0.5)
    return words.groupBy("source_id", "group_block").agg(
        F.count("*").alias("word_count"), F.min("s").alias("speech_start"), F.max("e").alias("speech_end"),
        F.sum(milli(F.col("prob"))).alias("prob_milli"), F.min("prob").alias("min_word_prob"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s", "e", "ord", "text"))), lambda r: r["text"]), " ").alias("raw_text"),
    )
