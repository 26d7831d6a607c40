"""Forced alignment of long recordings chunk by chunk, with a fallback.

Words go to the chunk that holds their middle, frames of scores to each chunk that they lie in or within a margin of. Each (source, chunk) is
aligned by itself; times are those of the recording. A chunk that can't be aligned keeps its words' times and is counted, and so do words with no
character in the vocabulary. A source of any length lies over as many tasks as it has chunks.

Frames are many and their scores wide, so they are packed where they are read: what is sent is a row for some seconds of frames, compressed without
loss. Words carry all of their columns to their chunk, and none of them is joined again.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ctc import viterbi

TIMES, SCORES = 3, 4
#: Blocks of frames a time bucket has: a chunk gets whole blocks, so few more frames than lie in it.
PIECES = 12


def chunks_of(bounds: DataFrame) -> DataFrame:
    """(source_id, chunk, left, right) between neighbours of bounds (source_id, n, bound), whose n are 0, 1, ..."""
    right = bounds.select("source_id", (F.col("n") - 1).alias("chunk"), F.col("bound").alias("right"))
    return bounds.select("source_id", F.col("n").alias("chunk"), F.col("bound").alias("left")).join(right, ["source_id", "chunk"])


def _dealt(chunks: DataFrame, margin: float, width: float) -> DataFrame:
    """The span [_lo, _hi) of each chunk with its margins, for each time bucket that it touches, hashed by source and bucket."""
    lo, hi = F.col("left") - margin, F.col("right") + margin
    x = chunks.select(F.col("source_id").alias("_s"), "chunk", lo.alias("_lo"), hi.alias("_hi"))
    return x.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width)))).hint("shuffle_hash")


def _inside(rows: DataFrame, at: Column, chunks: DataFrame, margin: float, width: float, how: str = "inner") -> DataFrame:
    """rows with the chunk of each [left - margin, right + margin) that holds `at`: an equality join on source and time bucket.

    The chunks are hashed by bucket. rows are never sent to all: the planner takes frames, which come of an explode, for as small as what they are made of.
    how: inner, or left, which keeps rows outside of all chunks.
    """
    holds = (F.col("source_id") == F.col("_s")) & (F.floor(at / width) == F.col("_bucket")) & (at >= F.col("_lo")) & (at < F.col("_hi"))
    return rows.join(_dealt(chunks, margin, width), holds, how).drop("_bucket", "_s", "_lo", "_hi")


def packed(frames: DataFrame, width: float) -> DataFrame:
    """frames (source_id, t, scores) in blocks (source_id, bucket, first, last, n, classes, times, scores) of width / PIECES seconds at most, packed where they are.

    Scores go class by class, times by their steps, both compressed: nothing is lost, and equal steps and quiet classes take next to no room.
    Frames may come in any order; those of one block that lie in several batches make several rows. Frames without a source or a time go.
    """
    kind = "float" if _kind(frames) == "f4" else "double"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            source, t = (np.asarray(x.column(k)) for k in (0, 1))
            order = np.lexsort((t, source))
            order = order[np.isfinite(t[order])]
            if not len(order):
                continue
            source, t, values = source[order], t[order], x.column(2).take(pa.array(order))
            lengths = np.asarray(values.value_lengths().fill_null(0))
            flat, ends = np.asarray(values.flatten()), np.r_[0, np.cumsum(lengths)]
            bucket, piece = np.floor(t / width).astype(np.int64), np.floor(t / (width / PIECES))
            starts = np.flatnonzero(np.r_[True, (source[1:] != source[:-1]) | (bucket[1:] != bucket[:-1]) | (piece[1:] != piece[:-1]) | (lengths[1:] != lengths[:-1])])
            times, scores = [], []
            for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(t)], strict=True):
                times.append(_shrunk(np.diff(t[a:z].view(np.int64), prepend=0)))
                scores.append(_shrunk(flat[ends[a] : ends[z]].reshape(z - a, lengths[a]).T))
            last = np.r_[starts[1:], len(t)] - 1
            blocks = [source[starts], bucket[starts], t[starts], t[last], (last - starts + 1).astype(np.int32), lengths[starts].astype(np.int32), pa.array(times, pa.binary()), pa.array(scores, pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in blocks], names=["source_id", "bucket", "first", "last", "n", "classes", "times", "scores"])

    x = frames.select(F.col("source_id").cast("long"), F.col("t").cast("double"), F.col("scores").cast(f"array<{kind}>"))
    return x.where("source_id is not null and t is not null").mapInArrow(pack, "source_id long, bucket long, first double, last double, n int, classes int, times binary, scores binary")


def _kind(frames: DataFrame) -> str:
    return "f4" if frames.schema["scores"].dataType.elementType.typeName() == "float" else "f8"


def _shrunk(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x), "zstd", asbytes=True)


def _grown(x: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, n * np.dtype(kind).itemsize, "zstd"), kind)


def unpacked(blocks: pa.Table, lo: float, hi: float, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Times and scores, in order of time, of the frames in [lo, hi) that blocks of packed() hold, whose scores are floats of the kind."""
    times, scores = [np.zeros(0)], []
    for n, classes, t, x in zip(*(blocks.column(c).to_pylist() for c in ("n", "classes", "times", "scores")), strict=True):
        t = np.cumsum(_grown(t, "i8", n)).view(np.float64)
        keep = (t >= lo) & (t < hi)
        if keep.any():
            times.append(t[keep])
            scores.append(_grown(x, kind, n * classes).reshape(classes, n)[:, keep])
    t = np.concatenate(times)
    order = np.argsort(t, kind="stable")
    return t[order], (np.concatenate(scores, 1).T[order] if scores else np.zeros((0, 0)))


def targets(texts: list, vocab: dict[str, int], delimiter: str) -> tuple[list[int], list[int]]:
    """Ids of the characters of words with a delimiter between words, and the place of the word of each, -1 for delimiters. Words without a known character are skipped."""
    tokens, owners = [], []
    for k, text in enumerate(texts):
        ids = [vocab[c] for c in unicodedata.normalize("NFC", text or "").lower() if c != delimiter and c in vocab]
        if ids:
            between = [vocab[delimiter]] if tokens else []
            tokens += between + ids
            owners += [-1] * len(between) + [k] * len(ids)
    return tokens, owners


def log_softmax(scores: np.ndarray) -> np.ndarray:
    """Rows of scores as logarithms of probabilities."""
    x = np.ascontiguousarray(scores, np.float64)
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def aligned_words(words: DataFrame, frames: DataFrame, bounds: DataFrame, vocab: dict[str, int], step: float, blank: int = 0, delimiter: str = "|", margin: float = 2.5, width: float = 60.0) -> DataFrame:
    """words (source_id, ord, s, e, text, ...) with s, e of the alignment where there is one, ctc_score (null elsewhere), realigned, its chunk (null outside of all), and failed: whether that was not aligned.

    frames (source_id, t, scores): scores of classes from t on, for `step` seconds. ord is distinct in a source. Words outside of all chunks stay as they are.
    """
    if delimiter not in vocab:
        raise ValueError(f"the vocabulary has no delimiter {delimiter}")
    chunks, middle, kind = chunks_of(bounds), (F.col("s") + F.col("e")) / 2, _kind(frames)
    # Words outside of all chunks go by their bucket, below the numbers of chunks, so that those of a source are not one group.
    away = -1 - F.pmod(F.coalesce(F.floor(middle / width), F.lit(0)), F.lit(1 << 40))
    mine = _inside(words, middle, chunks, 0.0, width, "left").withColumn("_k", F.coalesce(F.col("chunk").cast("long"), away)).drop("chunk")
    heard = packed(frames, width).join(_dealt(chunks, margin, width), (F.col("source_id") == F.col("_s")) & (F.col("bucket") == F.col("_bucket")) & (F.col("first") < F.col("_hi")) & (F.col("last") >= F.col("_lo")))
    heard = heard.select("source_id", F.col("chunk").cast("long").alias("_k"), "_lo", "_hi", "n", "classes", "times", "scores")

    def run(key, w: pa.Table, f: pa.Table) -> pa.Table:
        w, n = w.sort_by("ord"), len(w)
        first, end, score = (np.full(n, np.nan) for _ in range(3))
        tokens, owners = targets(w.column("text").to_pylist(), vocab, delimiter)
        spans = None
        if tokens and len(f):
            t, scores = unpacked(f, f.column("_lo")[0].as_py(), f.column("_hi")[0].as_py(), kind)
            spans = viterbi(log_softmax(scores), np.array(tokens, np.int64), blank) if len(t) else None
        if spans is not None:
            owners = np.array(owners)
            own, owners = spans[owners >= 0], owners[owners >= 0]
            at = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            k = owners[at]
            first[k], end[k] = t[np.minimum.reduceat(own[:, 0], at).astype(int)], t[np.maximum.reduceat(own[:, 1], at).astype(int) - 1] + step
            score[k] = np.add.reduceat(own[:, 2], at) / np.diff(np.r_[at, len(own)])
        gone, chunk = np.isnan(first), key[1].as_py()
        chunk = chunk if chunk >= 0 else None
        found = [pa.array([chunk] * n, pa.int64()), *(pa.array(x, mask=gone) for x in (first, end, score)), pa.array(np.full(n, spans is None and chunk is not None))]
        return pa.table([*(w.column(c) for c in kept), *found], names=[*kept, "chunk", "_a", "_b", "_c", "_f"])

    kept = words.columns
    schema = T.StructType([*words.schema.fields, T.StructField("chunk", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("_a", "_b", "_c")), T.StructField("_f", T.BooleanType())])
    x = mine.groupBy(F.col("source_id").cast("long").alias("_s"), "_k").cogroup(heard.groupBy("source_id", "_k")).applyInArrow(run, schema)
    hit = F.coalesce(F.col("_b") > F.col("_a"), F.lit(False))
    r = lambda c, p: F.floor(F.col(c) * 10**p + 0.5) / 10**p
    return x.withColumns({"s": F.when(hit, r("_a", TIMES)).otherwise(F.col("s")), "e": F.when(hit, r("_b", TIMES)).otherwise(F.col("e")), "ctc_score": F.when(hit, r("_c", SCORES)), "realigned": hit, "failed": F.col("_f")}).drop("_a", "_b", "_c", "_f")


def counters(aligned: DataFrame, bounds: DataFrame) -> DataFrame:
    """(source_id, chunks, failed_chunks, words, realigned): a chunk fails if it has words and could not be aligned."""
    n = bounds.groupBy("source_id").agg((F.count("*") - 1).alias("chunks"))
    # Counted by chunk first, so that what is aligned is computed once.
    w = aligned.groupBy("source_id", "chunk").agg(F.count("*").alias("words"), F.count_if("realigned").alias("realigned"), F.max("failed").alias("failed"))
    w = w.groupBy("source_id").agg(F.sum("words").alias("words"), F.sum("realigned").alias("realigned"), F.count_if("failed").alias("failed_chunks"))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return n.join(w, "source_id", "left").select("source_id", "chunks", none("failed_chunks"), none("words"), none("realigned"))
