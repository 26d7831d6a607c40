"""Questions and answers between batches of documents and hash buckets.

Documents are dealt to batches by a hash of their id, once; each round reuses that exchange. A batch sends each
bucket one message: its distinct keys, already merged, so that a key that a third of the corpus holds reaches its
bucket at most once per batch. The bucket answers each batch by the places of keys in its message. Batches and buckets are
of one size, whatever that of the input, so that a task's memory is too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import text_buffer, tidy
from .frames import named, rows_as_struct

REPLY = "batch int, round int, bucket int, reply binary"


#: Bytes of input, as it lies on disk, of a batch of documents, and of a bucket.
BATCH_BYTES, BUCKET_BYTES = 3 << 19, 2 << 20


def size_of(docs: DataFrame, text_col: str) -> int:
    """Bytes of docs: the planner's estimate, or the sum of lengths where it has none."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if not 0 < size < 1 << 56:
        size = docs.agg(F.sum(F.octet_length(named(docs, text_col).cast("string")))).collect()[0][0] or 0
    return size


def sizes(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """(batches, buckets) for an input of this size.

    Both have the same bytes at every size of input, so memory does not follow it. What follows is the number of messages, which
    is at most one for each key: beyond some 100 GB a message has few keys and costs about 40 bytes beside them.
    """
    size = size_of(docs, text_col)
    return max(4, -(-size // BATCH_BYTES)), max(3, -(-size // BUCKET_BYTES))


def batches(docs: DataFrame, id_col: str, text_col: str, n: int, carry: bool = False) -> DataFrame:
    """(batch, doc_id, text) of all rows, and with carry their whole rows but the text; a null id is dealt out by its text."""
    i, t = named(docs, id_col).cast("long"), named(docs, text_col).cast("string")
    more = [rows_as_struct(docs, text_col).alias("row")] if carry else []
    return docs.select(F.pmod(F.xxhash64(F.coalesce(i, F.xxhash64(t))), F.lit(n)).cast("int").alias("batch"), i.alias("doc_id"), t.alias("text"), *more)


class Batch:
    """A batch's rows by rising doc_id (nulls first, ties by text), as one byte array."""

    def __init__(self, table: pa.Table):
        key = table.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).min)
        text = table.column("text").combine_chunks()
        ids = np.asarray(key)
        order = np.argsort(ids, kind="stable")
        if (np.diff(ids[order]) == 0).any():  # equal ids: the order of arrival must not matter
            order = np.lexsort((np.array([x.as_py() or "" for x in text], object).astype(str), ids)) if len(ids) else order
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        self.buf, self.offs = text_buffer(self.table.column("text"))


def ask(rows: DataFrame, compose: Callable, replies: DataFrame | None = None) -> DataFrame:
    """(bucket, batch, message) of each batch; compose(Batch, {(round, bucket): reply}) yields (bucket, bytes)."""

    def out(batch: int, pairs) -> pa.Table:
        pairs = list(pairs)
        tidy()
        return pa.table({"bucket": pa.array([b for b, _ in pairs], pa.int32()), "batch": pa.array([batch] * len(pairs), pa.int32()), "message": pa.array([m for _, m in pairs], pa.large_binary()).cast(pa.binary())})

    schema = "bucket int, batch int, message binary"
    if replies is None:
        return rows.groupBy("batch").applyInArrow(lambda t: out(t.column("batch")[0].as_py(), compose(Batch(t), {})), schema)
    return rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(lambda t, r: out(t.column("batch")[0].as_py(), compose(Batch(t), heard(r))) if len(t) else out(0, []), schema)


def answer(messages: DataFrame, number: int, decide: Callable) -> DataFrame:
    """REPLY rows; decide([message, ...]) gives a reply, or None, for each message of a bucket."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("batch")
        batch, bucket = t.column("batch").to_pylist(), t.column("bucket")[0].as_py()
        kept = [(b, r) for b, r in zip(batch, decide(t.column("message").to_pylist()), strict=True) if r]
        tidy()
        return pa.table({"batch": pa.array([b for b, _ in kept], pa.int32()), "round": pa.array([number] * len(kept), pa.int32()), "bucket": pa.array([bucket] * len(kept), pa.int32()), "reply": pa.array([r for _, r in kept], pa.binary())})

    return messages.groupBy("bucket").applyInArrow(run, REPLY)


def finish(rows: DataFrame, replies: DataFrame, judge: Callable, schema: str) -> DataFrame:
    """Rows of schema; judge(Batch, {(round, bucket): reply}) gives a table for each batch."""

    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        tidy()
        return judge(Batch(t), heard(r))

    return rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(run, schema)


def heard(r: pa.Table) -> dict[tuple[int, int], bytes]:
    return {(n, b): x for n, b, x in zip(r.column("round").to_pylist(), r.column("bucket").to_pylist(), r.column("reply").to_pylist(), strict=True)}


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket by high bits: sorted keys are in order of buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_bucket(sorted_keys: np.ndarray, n: int):
    """(bucket, from, to) of each bucket that sorted keys fall in."""
    cut = np.searchsorted(bucket_of(sorted_keys, n), np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cut)).tolist():
        yield b, int(cut[b]), int(cut[b + 1])
