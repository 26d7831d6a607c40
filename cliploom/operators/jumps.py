"""Paths of next-pointers through ordered places, without a task that holds a whole key.

Each place points to a later one. A key's axis is cut into blocks; a block gives each of its places the first one on its path that lies beyond the
block (by doubling pointers inside it), and those that are so entered make a coarser table, which is cut again, until a key is one block. Then the path
is walked down: a block is entered in one place at most, and marks what it passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import cut_lineage, running

#: How many blocks make one of the next level.
FAN = 1024


def first_from(places: DataFrame, reach, width: float, key: str = "source_id") -> DataFrame:
    """(key, at, to): of each of the places (key, at) the first place q with q - at >= reach, null without one. width: of a chunk of the axis."""
    cand = places.select(key, F.col("at").cast("double").alias("at")).distinct().withColumn("_o", -F.col("at"))
    chunk = F.floor(F.col("_o") / width)
    cand = running(cand, [key], ["_o"], "at", "last", chunk, "_more", before=True)
    # What is asked for begins a little early, so that rounding of a sum can't step over a place; the difference decides.
    early = (F.col("at") + reach) - (F.abs(F.col("at")) + reach) * 2.0**-48
    void = F.lit(None).cast("struct<at:double,more:double>")
    both = cand.select(key, "at", "_o", F.lit(0).alias("_kind"), F.struct("at", F.col("_more").alias("more")).alias("_v")).unionByName(cand.select(key, "at", (-early).alias("_o"), F.lit(1).alias("_kind"), void.alias("_v")))
    found = running(both, [key], ["_o", "_kind"], "_v", "last", chunk, "_f").where("_kind = 1")
    return found.select(key, "at", F.when(F.col("_f.at") - F.col("at") >= reach, F.col("_f.at")).otherwise(F.col("_f.more")).alias("to"))


def _exits(t: pa.Table) -> pa.Table:
    """Of each place of a block the first one on its path beyond the block."""
    t = t.sort_by("at")
    at, to = (np.asarray(t.column(c).fill_null(np.inf), np.float64) for c in ("at", "to"))
    here = np.minimum(np.searchsorted(at, to), len(at) - 1)
    p = np.where(at[here] == to, here, np.arange(len(at)))
    while not np.array_equal(p, q := p[p]):
        p = q
    out = to[p]
    return t.select([0]).append_column("at", t.column("at")).append_column("out", pa.array(out, mask=np.isinf(out)))


def _walk(t: pa.Table) -> pa.Table:
    """The places that are passed from the one that is marked."""
    t = t.sort_by("at")
    at, to = (np.asarray(t.column(c).fill_null(np.inf), np.float64) for c in ("at", "to"))
    passed, i = [], np.flatnonzero(np.asarray(t.column("_start").fill_null(False)))
    i = int(i[0]) if len(i) else len(at)
    while i < len(at):
        passed.append(i)
        j = int(np.searchsorted(at, to[i]))
        i = j if j < len(at) and at[j] == to[i] else len(at)
    return t.take(pa.array(passed, pa.int64())).select([0, 1])


def path(nodes: DataFrame, width: float, key: str = "source_id") -> DataFrame:
    """(key, at) of the places on the path from the first one of each key of nodes (key, at, to), to > at or null; keys are not null."""
    kind = nodes.schema[key].dataType.simpleString()
    nodes = cut_lineage(nodes.select(key, "at", "to"))
    span = nodes.groupBy(key).agg((F.max("at") - F.min("at")).alias("s")).agg(F.max("s")).collect()[0][0] or 0.0
    levels, w = [], float(width)
    heads = nodes.groupBy(key).agg(F.min("at").alias("at"))
    while True:
        levels.append((nodes, w))
        if span < w:  # a key may still touch two blocks; they are put together at the top
            break
        exits = cut_lineage(nodes.groupBy(key, F.floor(F.col("at") / w).alias("_b")).applyInArrow(lambda t: _exits(t.select([key, "at", "to"])), f"{key} {kind}, at double, out double"))
        entered = exits.where("out is not null").select(key, F.col("out").alias("at")).unionByName(heads).distinct()
        nodes = cut_lineage(entered.join(exits, [key, "at"]).select(key, "at", F.col("out").alias("to")))
        w *= FAN
    marked = heads
    for top, (nodes, w) in zip([True, *[False] * (len(levels) - 1)], reversed(levels), strict=True):
        x = nodes.join(marked.withColumn("_start", F.lit(True)), [key, "at"], "left").select(key, "at", "to", "_start", (F.lit(0) if top else F.floor(F.col("at") / w)).alias("_b"))
        marked = cut_lineage(x.groupBy(key, "_b").applyInArrow(lambda t: _walk(t.select([key, "at", "to", "_start"])), f"{key} {kind}, at double"))
    return marked
