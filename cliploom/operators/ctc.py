"""Emissions of a connectionist acoustic model: greedy decoding, forced alignment, scores and completeness."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import cut_lineage


def best_class(scores: Column) -> Column:
    """The first greatest of an array, from 0."""
    return F.array_position(scores, F.array_max(scores)) - 1


def greedy(emissions: DataFrame, blank: int = 0) -> DataFrame:
    """(clip, classes): repeats merged, then blanks dropped; a blank keeps repeats apart."""
    w = Window.partitionBy("clip").orderBy("frame")
    x = emissions.select("clip", "frame", best_class(F.col("scores")).alias("c")).withColumn("p", F.lag("c").over(w))
    kept = x.where((F.col("c") != blank) & (F.col("p").isNull() | (F.col("p") != F.col("c"))))
    g = kept.groupBy("clip").agg(F.transform(F.sort_array(F.collect_list(F.struct("frame", "c"))), lambda r: r["c"]).alias("classes"))
    return emissions.select("clip").distinct().join(g, "clip", "left").select("clip", F.coalesce("classes", F.array().cast("array<bigint>")).alias("classes"))


def decode(classes: Column, alphabet: list[str], delimiter: str = "|") -> Column:
    """Text of classes; the delimiter reads as a blank."""
    letters = F.array(*[F.lit(" " if a == delimiter else a) for a in alphabet])
    return F.trim(F.regexp_replace(F.array_join(F.transform(classes, lambda c: F.element_at(letters, (c + 1).cast("int"))), ""), " +", " "))


def completeness(text: Column, decoded: Column) -> Column:
    """Length of the text over that of what was decoded; 1 if nothing was."""
    n = F.length(decoded)
    return F.when(n > 0, F.length(text) / n).otherwise(1.0)


#: Steps back that viterbi holds at once; of a longer path some score rows are held, and the steps between two of them are found anew.
CELLS = 1 << 26


def viterbi(logp: np.ndarray, tokens: np.ndarray, blank: int = 0, cells: int = CELLS) -> np.ndarray | None:
    """(first frame, end frame, mean probability) of each token on the best path; None if it doesn't fit.

    No path is better than that of each frame's best class, so where this one reads as the tokens nothing is searched.
    """
    t_max, n = len(logp), len(tokens)
    if not n or t_max < n + int((tokens[1:] == tokens[:-1]).sum()):
        return None
    best = logp.argmax(1)
    starts = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    p, ends, said = np.exp(logp[np.arange(t_max), best]), np.r_[starts[1:], t_max], best[starts] != blank
    if np.array_equal(best[starts[said]], tokens) and np.isfinite(p).all() and p.all():
        return np.column_stack([starts, ends, np.add.reduceat(p, starts) / (ends - starts)])[said]
    labels = np.full(2 * n + 1, blank)
    labels[1::2] = tokens
    jump = np.zeros(len(labels), bool)
    jump[3::2] = tokens[1:] != tokens[:-1]

    def run(score: np.ndarray, t: int, end: int, back: np.ndarray | None = None) -> np.ndarray:
        for k in range(t, end):
            best = score.copy()
            one = score[:-1] > score[1:]
            np.maximum(score[1:], score[:-1], out=best[1:])
            two = (score[:-2] > best[2:]) & jump[2:]
            np.copyto(best[2:], score[:-2], where=two)
            if back is not None:
                back[k - t, 1:] = one
                np.copyto(back[k - t, 2:], 2, where=two)
            best += logp[k].take(labels)
            score = best
        return score

    score = np.full(len(labels), -np.inf)
    score[:2] = logp[0, labels[:2]]
    rows = t_max if t_max * len(labels) <= cells else max(cells // len(labels), int(np.ceil(np.sqrt(8 * t_max))))
    starts, held = list(range(1, t_max, rows)), []
    for k in starts[:-1]:
        held.append(score)
        score = run(score, k, k + rows)
    path, at = np.zeros(t_max, np.int64), None
    for k in reversed(starts):
        end = min(k + rows, t_max)
        back = np.zeros((end - k, len(labels)), np.int8)
        last = run(score if at is None else held.pop(), k, end, back)
        if at is None:
            score, at = last, len(labels) - 1 if last[-1] >= last[-2] else len(labels) - 2
        for t in range(end - 1, k - 1, -1):
            path[t] = at
            at -= int(back[t - k, at])
    path[0] = (len(labels) - 1 if score[-1] >= score[-2] else len(labels) - 2) if at is None else at
    if not np.isfinite(score[path[-1]]):
        return None
    first, end = (np.searchsorted(path, np.arange(1, 2 * n, 2), side) for side in ("left", "right"))
    said = np.flatnonzero(path % 2)
    p = np.exp(logp[said, labels[path[said]]])
    return np.column_stack([first, end, np.add.reduceat(p, np.searchsorted(said, first)) / (end - first)])


def tokenise(words: DataFrame, vocab: dict[str, int], delimiter: str = "|") -> DataFrame:
    """(clip, tokens, owners) of words (clip, word, text): character ids with a delimiter between words, and the word of each, -1 for delimiters.

    Texts are composed (NFC) and lower-cased; characters out of the vocabulary go. Words with none left are skipped, the others keep
    their numbers; a clip without any has no row. A clip is a window of seconds, so its words fit a task.
    """
    if delimiter not in vocab:
        raise ValueError(f"the vocabulary has no delimiter {delimiter}")

    def run(t: pa.Table) -> pa.Table:
        tokens, owners = [], []
        for r in t.sort_by("word").to_pylist():
            ids = [vocab[c] for c in unicodedata.normalize("NFC", r["text"] or "").lower() if c != delimiter and c in vocab]
            if ids:
                between = [vocab[delimiter]] if tokens else []
                tokens += between + ids
                owners += [-1] * len(between) + [r["word"]] * len(ids)
        n = 1 if tokens else 0
        return pa.table({"clip": t.column("clip").slice(0, n), "tokens": pa.array([tokens][:n], pa.list_(pa.int64())), "owners": pa.array([owners][:n], pa.list_(pa.int64()))})

    x = words.select(F.col("clip").cast("long").alias("clip"), F.col("word").cast("long").alias("word"), F.col("text").alias("text"))
    return x.groupBy("clip").applyInArrow(run, "clip long, tokens array<long>, owners array<long>")


def owned(spans: DataFrame, targets: DataFrame) -> DataFrame:
    """Spans of align with the word that each token belongs to, from targets (clip, owners): what word_spans and clip_scores take."""
    return spans.join(targets.select("clip", F.posexplode("owners").alias("token", "word")), ["clip", "token"])


def align(emissions: DataFrame, targets: DataFrame, blank: int = 0) -> DataFrame:
    """(clip, token, first, end, score) of targets (clip, tokens), a row a clip; a clip that doesn't fit has no rows.

    Where greedy decoding gives the tokens, its path is the best one and is read off the frames in Spark, for clips of any length. For
    the others a clip is a window of seconds, so its frames fit a task.
    """
    said = targets.select("clip", F.col("tokens").cast("array<bigint>").alias("tokens"))
    heard = greedy(emissions, blank).withColumnRenamed("clip", "_clip")
    rest = cut_lineage(said.join(heard, (F.col("clip") == F.col("_clip")) & (F.col("tokens") == F.col("classes")), "left_anti"))
    if rest.isEmpty():
        return _greedy_spans(emissions.join(said.select("clip"), "clip", "left_semi"), blank)
    own = said.join(rest.select("clip"), "clip", "left_anti").select("clip")
    return _greedy_spans(emissions.join(own, "clip", "left_semi"), blank).unionByName(_searched(emissions.join(rest.select("clip"), "clip", "left_semi"), rest, blank))


def _greedy_spans(emissions: DataFrame, blank: int) -> DataFrame:
    """Spans of what greedy decoding gives: frames of one class in a row, with the mean of its probability."""
    top = F.zip_with("scores", F.array_repeat(F.array_max("scores"), F.size("scores").cast("int")), lambda v, m: F.exp(v.cast("double") - m))
    over = F.aggregate(top, F.lit(0.0), lambda a, v: a + v)
    w = Window.partitionBy("clip").orderBy("frame")
    x = emissions.select(F.col("clip").cast("long").alias("clip"), F.col("frame").cast("long").alias("frame"), best_class(F.col("scores")).alias("c"), (1 / over).alias("p"))
    x = x.withColumns({"_k": F.row_number().over(w).cast("long") - 1, "_same": F.col("c").eqNullSafe(F.lag("c").over(w))})
    x = x.withColumn("token", F.sum(F.when(~F.col("_same") & (F.col("c") != blank), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).where(F.col("c") != blank)
    return x.groupBy("clip", "token").agg(F.min("_k").alias("first"), (F.max("_k") + 1).alias("end"), F.avg("p").alias("score"))


def _searched(emissions: DataFrame, targets: DataFrame, blank: int) -> DataFrame:
    """align by search of the best path, clip by clip."""

    def run(key, e: pa.Table, t: pa.Table) -> pa.Table:
        spans = None
        if len(e) and len(t):
            e = e.sort_by("frame")
            x = np.asarray(e.column("scores").combine_chunks().flatten(), np.float64).reshape(len(e), -1)
            x = x - x.max(1, keepdims=True)
            x -= np.log(np.exp(x).sum(1, keepdims=True))
            spans = viterbi(x, np.array(t.column("tokens")[0].as_py() or [], np.int64), blank)
        spans = np.zeros((0, 3)) if spans is None else spans
        values = [np.full(len(spans), key[0].as_py(), np.int64), np.arange(len(spans)), spans[:, 0].astype(np.int64), spans[:, 1].astype(np.int64), spans[:, 2]]
        return pa.table(dict(zip(("clip", "token", "first", "end", "score"), values, strict=True)))

    return emissions.select("clip", "frame", "scores").groupBy("clip").cogroup(targets.select("clip", "tokens").groupBy("clip")).applyInArrow(run, "clip long, token long, first long, end long, score double")


def word_spans(tokens: DataFrame) -> DataFrame:
    """(clip, word, first, end, score) from spans with the word that each token belongs to; delimiters have word -1."""
    return tokens.where("word >= 0").groupBy("clip", "word").agg(F.min("first").alias("first"), F.max("end").alias("end"), F.avg("score").alias("score"))


def clip_scores(tokens: DataFrame, clips: DataFrame) -> DataFrame:
    """The mean score of the tokens that are no delimiters; 0 for clips without any."""
    s = tokens.where("word >= 0").groupBy("clip").agg(F.avg("score").alias("ctc_score"))
    return clips.select("clip").distinct().join(s, "clip", "left").select("clip", F.coalesce("ctc_score", F.lit(0.0)).alias("ctc_score"))


def retime(words: DataFrame, aligned: DataFrame) -> DataFrame:
    """words (clip, word, s, e) with the aligned times where the end is after the start, and whether they are."""
    a = aligned.select("clip", "word", F.col("first").alias("_a"), F.col("end").alias("_b"), F.col("score").alias("_s"))
    x = words.join(a, ["clip", "word"], "left")
    hit = F.coalesce(F.col("_b") > F.col("_a"), F.lit(False))
    r = lambda c, p: F.floor(F.col(c) * 10**p + 0.5) / 10**p
    return x.withColumns({"s": F.when(hit, r("_a", 3)).otherwise(F.col("s")), "e": F.when(hit, r("_b", 3)).otherwise(F.col("e")), "ctc_score": F.when(hit, r("_s", 4)), "realigned": hit}).drop("_a", "_b", "_s")


def regroup(words: DataFrame, segments: DataFrame) -> DataFrame:
    """segments (source_id, seg, s, e, ...) with the words of each nested in order, and its times from them if it has any."""
    g = words.groupBy("source_id", "seg").agg(F.sort_array(F.collect_list(F.struct("s", "e", "text"))).alias("words"), F.min("s").alias("_s"), F.max("e").alias("_e"))
    x = segments.join(g, ["source_id", "seg"], "left")
    return x.withColumns({"s": F.coalesce("_s", "s"), "e": F.coalesce("_e", "e")}).drop("_s", "_e")
