"""Token-id files: patched frame-of-reference blocks with an index.

A file is a row of segments, each of which can be read alone. All numbers are little-endian.

    segment: magic "TOKPFOR1", u32 documents, u64 ids, u32 block size, u32 blocks, u64 bytes of the payload
             documents x (i64 doc_id, u8 1 if it is null, u32 ids)       in columns, one after the other
             blocks x u64 start of the block in the payload
             payload, then one line feed
    block:   u32 minimum, u8 width, u16 exceptions, ids - minimum in `width` bits each (low bits of exceptions),
             exceptions x u16 place, exceptions x u32 full difference

The width holds the `percentile` of a block's differences; what is larger is patched from the exception list. Blocks run
on over the ends of documents; the last of a segment is filled up with its minimum.

Files are written by Spark's text writer (a segment and its line feed are one line of bytes), so that its commit
protocol decides about tasks that run twice, and read by the binaryFile reader; any file system that Spark knows will
do. Files in order of the two numbers in their names hold documents in order of doc_id. Nulls are empty texts, which have the
end id only; null doc_ids come first; rows of equal doc_id are in order of text, repeated rows next to each other; a text longer than
a segment is one by itself; extra columns, whatever their names, are ignored; an empty table has no segments.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .columns import slabs, text_buffer
from .frames import slim
from .rank_bpe import tokenizer
from .rounds import size_of

MAGIC = b"TOKPFOR1"
#: Partition and counter in the name of a file of Spark's writer, numbers of any length.
FILE = r"/part-(\d+)-[^/]*-c(\d+)[^/]*$"
#: Partitions whose totals are summed in one go.
CHUNK = 1024
#: Bytes of input, as it lies on disk, of a range of doc_ids at most; characters of a text that ranges go by where ids are equal.
RANGE_BYTES, PREFIX = 64 << 20, 64
HEAD = np.dtype([("magic", "S8"), ("documents", "<u4"), ("ids", "<u8"), ("block", "<u4"), ("blocks", "<u4"), ("payload", "<u8")])
BLOCK = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def pack(doc_ids: np.ndarray, null: np.ndarray, count: np.ndarray, ids: np.ndarray, block: int = 1024, percentile: float = 95) -> bytes:
    """One segment. block: ids in a block, a multiple of 8 and at most 65536."""
    n_blocks = -(-len(ids) // block)
    full = np.zeros(n_blocks * block, np.uint32)
    full[: len(ids)] = ids
    if len(ids) % block:
        full[len(ids) :] = ids[len(ids) // block * block :].min()
    full = full.reshape(n_blocks, block)
    low = full.min(1) if n_blocks else np.zeros(0, np.uint32)
    diff = full - low[:, None]
    at = min(block - 1, int(np.ceil(block * percentile / 100)) - 1)
    typical = np.partition(diff, at, axis=1)[:, at] if n_blocks else np.zeros(0, np.uint32)
    width = np.zeros(n_blocks, np.int64)
    for b in range(32):
        width += typical >= (np.uint64(1) << np.uint64(b))
    over = diff.astype(np.uint64) >> width.astype(np.uint64)[:, None] > 0
    packed: list[bytes] = [b""] * n_blocks
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        if w:
            unit = np.dtype("<u2") if w <= 16 else np.dtype("<u4")
            for some in np.array_split(rows, -(-len(rows) // 256)):
                x = diff[some].astype(unit)
                bits = np.unpackbits(x.view(np.uint8).reshape(len(some), block, unit.itemsize), axis=2, bitorder="little")[:, :, :w]
                raw = np.packbits(bits.reshape(len(some), -1), axis=1, bitorder="little")
                for i, r in zip(some.tolist(), raw, strict=True):
                    packed[i] = r.tobytes()
    parts, start, size = [], np.zeros(n_blocks, np.uint64), 0
    n_over = over.sum(1)
    for i in range(n_blocks):
        place = np.flatnonzero(over[i]) if n_over[i] else np.zeros(0, np.int64)
        raw = np.array([(low[i], width[i], len(place))], BLOCK).tobytes() + packed[i] + place.astype("<u2").tobytes() + diff[i][place].astype("<u4").tobytes()
        start[i] = size
        size += len(raw)
        parts.append(raw)
    head = np.array([(MAGIC, len(doc_ids), len(ids), block, n_blocks, size)], HEAD).tobytes()
    return b"".join([head, doc_ids.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), count.astype("<u4").tobytes(), start.astype("<u8").tobytes(), *parts])


class Segment:
    """A segment in a buffer, from `at`; `end` is where the next one begins."""

    def __init__(self, raw: memoryview, at: int):
        self.raw = raw
        h = np.frombuffer(raw, HEAD, 1, at)[0]
        if h["magic"] != MAGIC:
            raise ValueError("not a token segment")
        self.n_ids, self.block, n, b = int(h["ids"]), int(h["block"]), int(h["documents"]), int(h["blocks"])
        at += HEAD.itemsize
        self.doc_ids = np.frombuffer(raw, "<i8", n, at)
        self.null = np.frombuffer(raw, np.uint8, n, at + 8 * n) > 0
        self.count = np.frombuffer(raw, "<u4", n, at + 9 * n).astype(np.int64)
        self.start = np.frombuffer(raw, "<u8", b, at + 13 * n).astype(np.int64)
        self.payload = at + 13 * n + 8 * b
        self.end = self.payload + int(h["payload"]) + 1

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks first to last - 1, found by the index."""
        n, m = last - first, self.block
        out = np.zeros((n, m), np.uint32)
        head = [np.frombuffer(self.raw, BLOCK, 1, self.payload + s)[0] for s in self.start[first:last].tolist()]
        width = np.array([h["width"] for h in head], np.int64)
        low = np.array([h["low"] for h in head], np.uint32)
        body = self.start[first:last] + self.payload + BLOCK.itemsize
        for w in np.unique(width).tolist():
            if w:
                rows = np.flatnonzero(width == w)
                size = 2 if w <= 16 else 4
                for some in np.array_split(rows, -(-len(rows) // 256)):
                    raw = np.stack([np.frombuffer(self.raw, np.uint8, m * w // 8, s) for s in body[some].tolist()])
                    bits = np.zeros((len(some), m, 8 * size), np.uint8)
                    bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(some), m, w)
                    out[some] = np.packbits(bits.reshape(len(some), -1), axis=1, bitorder="little").view(f"<u{size}").reshape(len(some), m)
        for i in np.flatnonzero(np.array([h["exceptions"] for h in head], np.int64)).tolist():
            k, s = int(head[i]["exceptions"]), int(body[i]) + m * int(width[i]) // 8
            out[i, np.frombuffer(self.raw, "<u2", k, s)] = np.frombuffer(self.raw, "<u4", k, s + 2 * k)
        return (out + low[:, None]).ravel()

    def ids(self) -> np.ndarray:
        return self.blocks(0, len(self.start))[: self.n_ids]

    def document(self, k: int) -> np.ndarray:
        """Ids of one document: only its blocks are unpacked."""
        s = int(self.count[:k].sum())
        e = s + int(self.count[k])
        return self.blocks(s // self.block, -(-e // self.block))[s - s // self.block * self.block :][: e - s]


def segments(raw: bytes):
    view, at = memoryview(raw), 0
    while at < len(view):
        s = Segment(view, at)
        yield s
        at = s.end


def write_tokens(docs: DataFrame, path: str, vocab_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = 1 << 20, file_segments: int = 16, **packing) -> None:
    """Encodes docs in ascending doc_id order and writes files of at most file_segments segments, each of about segment_bytes of text or one document."""

    def run(batches):
        bpe = tokenizer(vocab_path)
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            doc = b.column(0)
            null = np.asarray(doc.is_null().to_numpy(zero_copy_only=False), bool)
            key = np.asarray(doc.fill_null(0))
            out = []
            for x, y in slabs(offs, segment_bytes):
                ids, cut = bpe.encode_flat(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])
                whole = np.insert(ids, cut[1:], end_id)
                out.append(pack(key[x:y], null[x:y], np.diff(cut) + 1, whole, **packing))
                if len(out) == 8:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["segment"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["segment"])

    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size_of(docs, text_col) // RANGE_BYTES))
    # Ranges know the beginning of a text only, so that their bounds are small; rows that agree in it are in one range, and sorted there.
    ordered = slim(docs, id_col, text_col).repartitionByRange(n, F.col("doc_id"), F.left("text", F.lit(PREFIX))).sortWithinPartitions("doc_id", "text")
    lines = ordered.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
    lines.write.option("maxRecordsPerFile", file_segments).text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each document in the files.

    Each file is read once. Its place in the order is in its name, as two numbers: the range partition that wrote it and a
    counter. Starts run inside a partition; what lies before a partition comes from the totals of partitions, a row each.
    """
    names = F.col("path")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        .select(F.regexp_extract(names, FILE, 1).cast("int").alias("part"), F.regexp_extract(names, FILE, 2).cast("long").alias("file"), "content")
    )

    def documents(batches):
        for b in batches:
            for part, file, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                at = 0
                for s in segments(raw.as_py()):
                    ids = memoryview(s.ids().astype("<u4", copy=False)).cast("B")
                    n = len(s.count)
                    ends = (4 * np.r_[0, np.cumsum(s.count)]).tolist()
                    crc = [zlib.crc32(ids[x:y]) for x, y in zip(ends, ends[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, file, np.int64)), pa.array(np.arange(at, at + n)), pa.array(s.doc_ids, pa.int64(), mask=s.null), pa.array(s.count, pa.int64()), pa.array(crc, pa.int64())], ["part", "file", "k", "doc_id", "n_tokens", "ids_crc32"])
                    at += n

    rows = files.mapInArrow(documents, "part int, file long, k long, doc_id long, n_tokens long, ids_crc32 long").repartition("part")
    inside = Window.partitionBy("part").orderBy("file", "k").rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy("part").agg(F.sum("n_tokens").alias("total")).withColumn("chunk", F.floor(F.col("part") / CHUNK).cast("int"))
    chunks = total.groupBy("chunk").agg(F.sum("total").alias("total"))
    last = total.agg(F.max("chunk").alias("last"))
    # What lies before a chunk: each chunk's total goes to all later ones, which are few.
    later = chunks.join(F.broadcast(last)).where("chunk < last").select(F.explode(F.sequence(F.col("chunk") + 1, F.col("last"))).alias("chunk"), "total").groupBy("chunk").agg(F.sum("total").alias("before"))
    within = Window.partitionBy("chunk").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = total.withColumn("run", F.coalesce(F.sum("total").over(within), F.lit(0))).join(later, "chunk", "left").select("part", (F.col("run") + F.coalesce("before", F.lit(0))).alias("base"))
    placed = rows.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(base, "part")
    return placed.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
