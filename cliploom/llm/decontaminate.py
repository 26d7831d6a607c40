"""Benchmark decontamination by winnowing.

In each sliding run of `window - gram + 1` grams of `gram` words the least gram hash is kept, so any shared span of
`window` words shares a kept hash. The hashes kept of the benchmark are joined with those of the documents, and each
hit is extended to the whole windows that hold it: a window counts only if all its words agree.

The benchmark is the stated query set: it meets all rows block by block. A block is at most `block_bytes` of text (or
one item), the size is checked as it is formed, and each is one broadcast that executors keep on disk. A worker holds
the indexes of at most KEPT_BLOCKS blocks. Of a larger benchmark first those items go that share no kept hash with any
document, by a join of the distinct hashes of both sides; what is left goes over the documents in groups of KEPT_BLOCKS blocks, a
pass each, and the hits of passes are merged. So memory stays bounded and nothing is left out.

A word is a run of ASCII digits, letters (A-Z lower-cased) and bytes above 127. An item of fewer words than a window,
but of some, is one window of its own length. Nulls have no words: a null document is not contaminated, a null item is
never found; empty tables give no rows or no hits. Items of equal text each count; ties of hashes keep the last; repeated
documents each get their row; a null doc_id comes back null. A text longer than a slab is one slab. Extra columns, whatever
their names, are ignored (kept by `drop_contaminated`).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import U, Words, covered, memo, separators, slabs, starts_of_runs, text_buffer
from .frames import named, numbered, settled, slim

GRAM = 5
KEPT_BLOCKS = 8
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]  # after lower-casing


def words_of(buf: np.ndarray, offs: np.ndarray) -> Words:
    return Words(buf, offs, separators(SEPARATORS), fold=True)


def winnow(w: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the grams that are least, the last of equals, in some run of window - gram + 1 grams of one row."""
    g, ok = w.grams(gram)
    span = window - gram + 1
    n = len(g) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    low = U((1 << 22) - 1)
    blocks, step = [], 1 << 21
    for a in range(0, n, step):
        x = g[a : a + step + span - 1]
        least = (x & ~low) | (low - np.arange(len(x), dtype=U))
        m = len(x) - span + 1
        have = 1
        while have < span:
            by = min(have, span - have)
            least = np.minimum(least[: len(least) - by], least[by:])
            have += by
        at = (low - (least[:m] & low)).astype(np.int64) + a
        begins = np.arange(a, a + m)
        blocks.append(np.unique(at[begins + window <= np.repeat(w.first[1:], w.count)[a : a + m]]))
    at = np.unique(np.concatenate(blocks))
    return at, g[at]


class Index:
    """A block of benchmark items: kept hashes, and whole windows by length with the items that have them."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        raw = [(t or "").encode() for t in texts]
        buf, offs = text_buffer(pa.array(raw, pa.large_binary()))
        w = words_of(buf, offs)
        self.ids, self.kept = ids, np.unique(winnow(w, min(GRAM, window), window)[1])
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({min(window, c) for c in w.count.tolist() if c}):
            g, ok = w.grams(n)
            rows = w.row[: len(g)]
            ok &= (w.count[rows] == n) if n < window else (w.count[rows] >= window)
            at = np.flatnonzero(ok)
            pairs = np.unique(np.stack([g[at], rows[at].astype(U)]), axis=1) if len(at) else np.zeros((2, 0), U)
            new = starts_of_runs(pairs[0])
            self.windows[n] = (pairs[0][new], np.r_[new, pairs.shape[1]], pairs[1].astype(np.int64))

    def hits(self, w: Words, window: int):
        """(places, lengths, places in windows[n]) of all windows of the words that are in the index."""
        for n, (keys, *_ ) in self.windows.items():
            if not len(keys) or len(w.hash) < n:
                continue
            if n == window:
                at, kept = winnow(w, min(GRAM, window), window)
                at = at[_in(kept, self.kept)]
                if not len(at):
                    continue
                near = covered(len(w.hash), np.maximum(at - (window - min(GRAM, window)), 0), at + 1)
                g, ok = w.grams(n)
                at = np.flatnonzero(ok & near[: len(g)])
                g = g[at]
            else:
                g, ok = w.grams(n)
                at = np.flatnonzero(ok)
                g = g[at]
            i = np.searchsorted(keys, g)
            hit = keys[np.minimum(i, len(keys) - 1)] == g
            yield n, at[hit], i[hit]


def _in(x: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(x), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)] == x


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Lists of (item id, text), each of about block_bytes at most or one item; the driver holds one at a time."""
    some, size = [], 0
    for r in benchmark.select(named(benchmark, item_col).cast("string"), named(benchmark, text_col).cast("string")).toLocalIterator():
        n = len(r[1].encode()) if r[1] else 0
        if some and size + n > block_bytes:
            yield some
            some, size = [], 0
        some.append((r[0], r[1]))
        size += n
    if some:
        yield some


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and share * n_hit >= n_words), items and spans (word ranges that are hit) of each row.

    One pass over the documents without a shuffle for a benchmark of one block.
    """
    rows = slim(docs, id_col, text_col)
    groups = _groups(rows, benchmark, item_col, item_text_col, block_bytes, window)
    first = _verdicts(rows, groups[0] if groups else [], window, share)
    if len(groups) < 2:
        return first.drop("_key")
    # More than one pass: what later ones hit, kept for the rows that are hit, and merged by row. Equal rows have equal hits.
    hits = settled(_union([first, *(_verdicts(rows, g, window, share) for g in groups[1:])]).where("n_hit > 0").select("doc_id", "_key", "items", "spans").distinct(), "hits")
    places = F.expr("size(array_distinct(flatten(transform(flatten(collect_list(spans)), s -> sequence(s.start, s.end - 1)))))")
    merged = hits.groupBy("_key").agg(places.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    merged = merged.select("_key", F.col("n_hit").cast("long").alias("n_hit"), "items", F.aggregate(F.array_sort("spans"), F.expr(f"cast(array() as {SPANS})"), _join_spans).alias("spans"))
    base = _verdicts(rows, [], window, share).select("doc_id", "n_words", "_key")
    none = {"n_hit": F.lit(0).cast("long"), "items": F.expr("cast(array() as array<string>)"), "spans": F.expr(f"cast(array() as {SPANS})")}
    x = base.join(merged, "_key", "left").select("doc_id", "n_words", *[F.coalesce(c, v).alias(c) for c, v in none.items()])
    n_items = F.size("items").cast("long").alias("n_items")
    return x.select("doc_id", "n_words", "n_hit", n_items, F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "items", "spans")


SPANS = "array<struct<start:int,end:int>>"


def _join_spans(done, s):
    """The spans so far and one that begins no earlier, which may run on from the last."""
    last = F.element_at(done, -1)
    one = lambda a, b: F.array(F.struct(a.cast("int").alias("start"), b.cast("int").alias("end")))
    on = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"])
    return F.when(on, F.concat(F.slice(done, 1, F.size(done) - 1), one(last["start"], F.greatest(last["end"], s["end"])))).otherwise(F.concat(done, one(s["start"], s["end"])))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of docs that are not contaminated, all columns as they are."""
    names, text = docs.columns, named(docs, text_col).cast("string")
    groups = _groups(docs.select(F.lit(0).alias("doc_id"), text.alias("text")), benchmark, item_col, item_text_col, block_bytes, window)
    if len(groups) > 1:  # several passes: texts are judged under a key of their own, and the contaminated keys joined out
        key = F.xxhash64(text, F.length(text), F.crc32(text.cast("binary")))
        bad = contamination(docs.select(key.alias("doc_id"), text.alias("text")).dropDuplicates(["doc_id"]), benchmark, window, share, item_col=item_col, item_text_col=item_text_col, block_bytes=block_bytes)
        bad = bad.where("contaminated").select(F.col("doc_id").alias("_key"))
        return docs.join(bad, key == bad["_key"], "left_anti")
    sent = groups[0] if groups else []

    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(names.index(text_col)).cast(pa.string()))
            keep = np.ones(b.num_rows, bool)
            for x, y in slabs(offs):
                w = words_of(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])
                hit = np.zeros(len(w.start), bool)
                for index in _indexes(sent, window):
                    for n, at, _ in index.hits(w, window):
                        hit |= covered(len(hit), at, at + n)
                n_hit = np.diff(np.r_[0, np.cumsum(hit)][w.first])
                keep[x:y] = ~((n_hit > 0) & (share * n_hit >= w.count))
            yield b.filter(pa.array(keep))

    plain = numbered(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*names)


def _groups(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int, window: int) -> list[list]:
    """Groups of at most KEPT_BLOCKS broadcast blocks, of all items or, where these are more than one group, of those that may be found."""
    some, full = [], False
    for b in _blocks(benchmark, item_col, text_col, block_bytes):
        if len(some) == KEPT_BLOCKS:
            full = True
            break
        some.append(b)
    if full:
        some = _blocks(_live(rows, benchmark, item_col, text_col, window), "item", "text", block_bytes)
    sc, sent = rows.sparkSession.sparkContext, []
    for b in some:
        sent.append((uuid.uuid4().hex, sc.broadcast(([i for i, _ in b], [t for _, t in b]))))
    return [sent[i : i + KEPT_BLOCKS] for i in range(0, len(sent), KEPT_BLOCKS)]


def _live(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, text) of the items that share a kept hash with some document, and of those too short to have one."""

    def hashes(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(0))
            for x, y in slabs(offs):
                h = np.unique(winnow(words_of(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x]), min(GRAM, window), window)[1])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    def item_hashes(batches):
        for b in batches:
            for i, t in zip(b.column(0), b.column(1), strict=True):
                h = np.unique(winnow(words_of(*text_buffer(pa.array([t.as_py() or ""], pa.string()))), min(GRAM, window), window)[1]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * max(1, len(h)), pa.string()), pa.array(h if len(h) else [None], pa.int64())], ["item", "h"])

    items = settled(benchmark.select(named(benchmark, item_col).cast("string").alias("item"), named(benchmark, text_col).cast("string").alias("text")), "items")
    seen = rows.select("text").mapInArrow(hashes, "h long").distinct()
    keys = items.mapInArrow(item_hashes, "item string, h long")
    live = keys.join(seen, "h", "left_semi").select("item").union(keys.where("h is null").select("item")).distinct()
    return items.join(live, items["item"].eqNullSafe(live["item"]), "left_semi")


def _indexes(sent: list, window: int):
    """The index of each block in turn, kept by the worker."""
    for name, block in sent:
        yield memo(f"winnowed {name} {window}", lambda b=block: Index(*b.value, window))


def _verdicts(rows: DataFrame, sent: list, window: int, share: int) -> DataFrame:
    """The columns of contamination() by the items of these blocks, and a key of the row."""
    slim = rows.select("doc_id", "text", F.xxhash64("doc_id", "text", F.length("text"), F.crc32(F.col("text").cast("binary"))).alias("_key"))

    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            for x, y in slabs(offs):
                w = words_of(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])
                hit = np.zeros(len(w.start), bool)
                row = w.row
                items: list[set[str]] = [set() for _ in range(y - x)]
                for index in _indexes(sent, window):
                    for n, at, key in index.hits(w, window):
                        hit |= covered(len(hit), at, at + n)
                        _, cut, rows = index.windows[n]
                        for r, k in set(zip(row[at].tolist(), key.tolist(), strict=True)):
                            items[r].update(index.ids[i] if index.ids[i] is not None else "" for i in rows[cut[k] : cut[k + 1]].tolist())
                n_hit = np.diff(np.r_[0, np.cumsum(hit)][w.first])
                spans = [[] for _ in range(y - x)]
                for r in np.flatnonzero(n_hit).tolist():
                    h = np.r_[0, hit[w.first[r] : w.first[r + 1]].astype(np.int8), 0]
                    e = np.flatnonzero(np.diff(h))
                    spans[r] = [{"start": int(s), "end": int(t)} for s, t in zip(e[::2], e[1::2], strict=True)]
                found = [sorted(s) for s in items]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x, y - x), pa.array(w.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(s) for s in found], pa.int64()), pa.array([hashlib.sha256(",".join(s).encode()).hexdigest() for s in found]), pa.array((n_hit > 0) & (share * n_hit >= w.count)), pa.array(found, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), b.column(2).slice(x, y - x)],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans", "_key"],
                )

    return slim.mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<start:int,end:int>>, _key long")
