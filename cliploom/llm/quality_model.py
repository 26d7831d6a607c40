"""A quality classifier: logistic regression on hashed n-grams of words, learned with follow-the-regularised-leader updates.

Features of a text are n-grams of its words (A-Z lower-cased) and of the shapes of its words (capitals, letters, digits and marks, runs as
one), hashed to 2^BITS places; a feature's value is log(1 + count), and a text's values have length 1. A score is a sparse dot
product through the logistic function. Each coordinate keeps z and n of the update and has no weight until |z| passes l1.

At most max_labelled labelled rows are learned from, those of least hash of (doc_id, label, text), each row but once however often it is repeated.
They are dealt to `shards` groups by that hash; a pass goes over each group in order of it, then z and n are averaged over the groups, so a pass is
one Spark job, and what reaches the driver is shards x 2^BITS pairs of numbers, whatever the input. All documents are scored, whole.

Null texts are empty; a text without words has the score of the bias alone. Without labels, or with one class only, all scores are 0.5 or
what that class gives. Null ids and null labels teach nothing; null ids are scored. A label is good if it is 1. Rows are kept as they are,
repeated ones included; an id with two labels teaches both. An empty table gives none; a text longer than a slab is one slab; extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import SPACE_LIKE, U, Words, memo, mix, separators, slabs, starts_of_runs, text_buffer, tidy
from .frames import named, settled
from .labelled import labelled_rows
from .language_mix import held_out

BITS = 18
WORD_GRAMS, SHAPE_GRAMS = (1, 2), (1, 2, 3)


class Rates(NamedTuple):
    """Parameters of the update. Chosen on labelled rows whose crc32 leaves 1 modulo 5, with those that leave 2 to 4 to learn from."""

    alpha: float = 8.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


def _shape_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B], t[0x61:0x7B], t[0x30:0x3A], t[0x80:] = ord("A"), ord("a"), ord("0"), ord("a")
    return t


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of the features of the texts of a slab, by row and then place."""
    sep = separators(SPACE_LIKE)
    shape = memo("shapes", _shape_table)[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | sep[buf[1:]]
    keep[offs[:-1][np.diff(offs) > 0]] = True
    short = np.r_[0, np.cumsum(keep)][offs]
    keys = []
    for salt, words, sizes in ((1, Words(buf, offs, sep, fold=True), WORD_GRAMS), (2, Words(shape[keep], short, sep), SHAPE_GRAMS)):
        row = words.row.astype(U) << U(BITS)
        for k in sizes:
            if len(words.hash) >= k:
                g, ok = words.grams(k)
                keys.append(row[: len(g)][ok] | mix(g[ok] + U(8 * salt + k)) >> U(64 - BITS))
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, U)
    first = starts_of_runs(key)
    key, value = key[first], np.log1p(np.diff(np.r_[first, len(key)]))
    row = (key >> U(BITS)).astype(np.int64)
    length = np.sqrt(np.bincount(row, value * value, len(offs) - 1))
    return row, (key & U((1 << BITS) - 1)).astype(np.int64), value / length[row]


class Model(NamedTuple):
    """The state of the update; bias has the z and n of the weight that every text has."""

    z: np.ndarray
    n: np.ndarray
    bias: np.ndarray
    rates: Rates

    @staticmethod
    def empty(rates: Rates = Rates()) -> Model:
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(2), rates)

    def weights(self, z: np.ndarray, n: np.ndarray, l1: float | None = None) -> np.ndarray:
        r = self.rates
        l1 = r.l1 if l1 is None else l1
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((r.beta + np.sqrt(n)) / r.alpha + r.l2), 0.0)

    def learn(self, place: np.ndarray, value: np.ndarray, good: bool) -> None:
        """One update, in place."""
        z, n = self.z[place], self.n[place]
        w, b = self.weights(z, n), self.weights(self.bias[:1], self.bias[1:], 0.0)
        error = logistic(w @ value + b[0]) - good
        for at, weight, slope, zs, ns in ((place, w, error * value, self.z, self.n), (np.array([0]), b, np.array([error]), self.bias[:1], self.bias[1:])):
            more = ns[at] + slope * slope
            zs[at] += slope - (np.sqrt(more) - np.sqrt(ns[at])) / self.rates.alpha * weight
            ns[at] = more

    def packed(self) -> bytes:
        return np.concatenate([self.bias, self.z, self.n]).astype("<f4").tobytes()

    @staticmethod
    def mean(parts: list[bytes], rates: Rates) -> Model:
        x = np.zeros(2 + (2 << BITS))
        for p in parts:
            x += np.frombuffer(p, "<f4")
        x /= len(parts)
        return Model(x[2 : 2 + (1 << BITS)], x[2 + (1 << BITS) :], x[:2], rates)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(order, good, text) of at most max_labelled labelled rows that are not held out, none twice."""
    known = labels.select(named(labels, label_id).cast("long").alias("doc_id"), (named(labels, label).cast("int") == 1).alias("mark")).where(~held_out(F.col("doc_id")))
    return labelled_rows(docs, known, max_labelled, id_col, text_col).withColumnRenamed("mark", "good")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, passes: int = 5, shards: int = 8, rates: Rates = Rates(), **columns) -> Model:
    """The model of at most max_labelled labelled rows; columns: id_col, text_col, label_id, label."""
    sample = settled(labelled(docs, labels, max_labelled, **columns).select(F.pmod("order", F.lit(shards)).cast("int").alias("shard"), "order", "good", "text"), "labelled").repartition(shards, "shard")
    model = Model.empty(rates)
    for _ in range(passes):
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def run(t: pa.Table) -> pa.Table:
            t = t.sort_by("order")
            m = Model(sent.value.z.copy(), sent.value.n.copy(), sent.value.bias.copy(), sent.value.rates)  # noqa: B023
            good = np.asarray(t.column("good"))
            buf, offs = text_buffer(t.column("text"))
            for x, y in slabs(offs):
                row, place, value = features(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])
                cut = np.searchsorted(row, np.arange(y - x + 1))
                for i in range(y - x):
                    m.learn(place[cut[i] : cut[i + 1]], value[cut[i] : cut[i + 1]], bool(good[x + i]))
            tidy()
            return pa.table({"shard": t.column("shard").slice(0, 1), "model": pa.array([m.packed()], pa.binary())})

        parts = sample.groupBy("shard").applyInArrow(run, "shard int, model binary").orderBy("shard").collect()
        if not parts:
            return model
        model = Model.mean([bytes(p["model"]) for p in parts], rates)
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of each row. No shuffle; the model, of fixed size, is broadcast."""
    weights, bias = model.weights(model.z, model.n).astype(np.float32), float(model.weights(model.bias[:1], model.bias[1:], 0.0)[0])
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = sent.value
        for b in batches:
            buf, offs = text_buffer(b.column(2))
            for x, y in slabs(offs):
                row, place, value = features(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])
                found = logistic(np.bincount(row, w[place] * value, y - x) + bias)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), b.column(1).slice(x, y - x), pa.array(found), pa.array((found >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(named(docs, id_col).cast("long").alias("doc_id"), held_out(named(docs, id_col)).alias("held_out"), named(docs, text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
