"""Language identification as inference of a mixture.

Each language has probabilities of character trigrams, counted over all documents that may be learned from. A document
is a mixture of languages: expectation-maximisation finds the shares that make its trigrams most likely. The set of
languages grows by the one that raises the likelihood most while the gain is more than the penalty of a further share,
`penalty * ln(trigrams)` (by half, it is the Bayesian information criterion). The language of greatest share is
predicted, and its share is the score.

All documents of a batch go through each step together, on trigrams dealt to `bins` bins by a hash. Trigrams are of
letters (others count as a blank, runs of them once), lower-cased. A text that is null or has no letter is `und` with
score 0; with no languages to choose from all are. Repeated rows each get their row, a null id comes back null and is not
held out. Of equally likely languages the first by name is taken. An empty table gives no rows; a text longer than a slab is one slab.
Extra columns, whatever their names, are ignored. The number of languages must be small: the model is languages x bins numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import U, memo, mix, slabs, text_buffer
from .frames import named

BINS = 4096


def _letter_table() -> np.ndarray:
    """For each code point of the BMP: 0 for no letter, else its lower case (itself where that is longer)."""
    table = np.zeros(0x10000, np.uint16)
    for c in range(0x10000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, 0 for a blank; row of each; whether each row has a letter) with blanks around each row and runs of blanks once."""
    table = memo("letters", _letter_table)
    text = buf.tobytes().decode(errors="replace")
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    head = np.flatnonzero((buf & 0xC0) != 0x80)
    if len(head) != len(points):  # not UTF-8: row by row
        parts = [np.frombuffer(buf[a:b].tobytes().decode(errors="replace").encode("utf-32-le"), "<u4") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        size = np.array([len(p) for p in parts], np.int64)
        points = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        row = np.repeat(np.arange(len(parts)), size)
    else:
        row = np.searchsorted(offs, head, "right") - 1
    low = np.where(points < 0x10000, table[np.minimum(points, 0xFFFF)], 0).astype(np.uint32)
    for i in np.flatnonzero(points >= 0x10000).tolist():
        c = chr(points[i])
        low[i] = ord(c.lower()[0]) if c.isalpha() else 0
    n = len(offs) - 1
    some = np.zeros(n, bool)
    some[row[low > 0]] = True
    keep = low > 0
    keep[1:] |= (low[1:] == 0) & (low[:-1] > 0) & (row[1:] == row[:-1])
    low, row = low[keep], row[keep]
    first = np.searchsorted(row, np.arange(n))
    return np.insert(low, first, 0), np.insert(row, first, np.arange(n)), some


def trigrams(col, bins: int = BINS):
    """(first row, counts of rows x bins, whether rows have letters), a slab of rows at a time."""
    buf, offs = text_buffer(col)
    for x, y in slabs(offs, 1 << 20):
        for a in range(x, y, 1024):
            b = min(y, a + 1024)
            c, row, some = letters(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            c = c.astype(U)
            if len(c) < 3:
                yield a, np.zeros((b - a, bins), np.float32), some
                continue
            g = mix(c[:-2] | c[1:-1] << U(21) | c[2:] << U(42)) % U(bins)
            one = row[:-2] == row[2:]
            flat = np.bincount(row[:-2][one] * bins + g[one].astype(np.int64), minlength=(b - a) * bins)
            yield a, flat.reshape(b - a, bins).astype(np.float32), some


def count_languages(docs: DataFrame, text_col: str, lang_col: str, bins: int = BINS) -> DataFrame:
    """(lang, bin, n) over all rows with a language. A batch sends a row for each language and bin that it has, so a frequent language is merged before the shuffle."""
    rows = docs.select(named(docs, lang_col).cast("string").alias("lang"), named(docs, text_col).cast("string").alias("text")).where(F.col("lang").isNotNull())

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            lang = np.array(b.column(0).to_pylist(), object)
            for a, counts, _ in trigrams(b.column(1), bins):
                here = lang[a : a + len(counts)]
                for k in set(here.tolist()):
                    if k not in total:
                        total[k] = np.zeros(bins, np.int64)
                    total[k] += counts[here == k].sum(0, dtype=np.float64).astype(np.int64)
        for k, v in total.items():
            at = np.flatnonzero(v)
            if not len(at):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([0], pa.int32()), pa.array([0], pa.int64())], ["lang", "bin", "n"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(at)), pa.array(at, pa.int32()), pa.array(v[at], pa.int64())], ["lang", "bin", "n"])

    return rows.mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


class Model:
    """Trigram probabilities of each language, smoothed by half a count a bin."""

    def __init__(self, counts: dict[str, np.ndarray], bins: int = BINS):
        self.langs = sorted(counts)
        self.p = np.stack([(counts[k] + 0.5) / (counts[k].sum() + 0.5 * bins) for k in self.langs]).astype(np.float32) if counts else np.zeros((0, bins), np.float32)

    def shares(self, c: np.ndarray, penalty: float, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
        """(shares of rows x languages, number of languages of each row) for counts of rows x bins."""
        n, m = len(c), len(self.langs)
        total = c.sum(1)
        single = c @ np.log(self.p).T
        best = single.argmax(1)
        chosen = np.zeros((n, m), bool)
        chosen[np.arange(n), best] = True
        share, score = chosen.astype(np.float32), single[np.arange(n), best].astype(np.float64)
        cost = penalty * np.log(np.maximum(total, 2))
        open_rows = np.flatnonzero(total > 0)
        for _ in range(m - 1):
            if not len(open_rows):
                break
            # the language that the likelihood rises most for, to first order, with a little of it
            r = c[open_rows] / (share[open_rows] @ self.p)
            slope = np.where(chosen[open_rows], -np.inf, r @ self.p.T)
            add = slope.argmax(1)
            try_rows = slope[np.arange(len(add)), add] > total[open_rows] * 1.0001
            open_rows, add = open_rows[try_rows], add[try_rows]
            if not len(open_rows):
                break
            more = chosen[open_rows].copy()
            more[np.arange(len(add)), add] = True
            s = np.where(more, np.where(chosen[open_rows], share[open_rows] * 0.9, 0.1), 0).astype(np.float32)
            x, weight = c[open_rows], total[open_rows][:, None]
            for _ in range(steps):
                s = s * ((x / (s @ self.p)) @ self.p.T) / weight
            now = (x * np.log(s @ self.p)).sum(1, dtype=np.float64)
            up = now > score[open_rows] + cost[open_rows]
            open_rows, more, s, now = open_rows[up], more[up], s[up], now[up]
            chosen[open_rows], share[open_rows], score[open_rows] = more, s, now
        return share, chosen.sum(1)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bins: int = BINS, max_languages: int = 1000) -> Model:
    """The driver gets languages x bins counts at most; more languages than max_languages are refused."""
    counts = count_languages(docs, text_col, lang_col, bins)
    rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("c")).limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    out = {}
    for r in rows:
        v = np.zeros(bins)
        for k, n in r["c"]:
            v[k] += n
        out[r["lang"]] = v
    return Model(out, bins)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 3.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages (those chosen with their shares) of each row. No shuffle; the model is broadcast, its size fixed by fit."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(named(docs, id_col).cast("long").alias("doc_id"), held_out(named(docs, id_col)).alias("held_out"), named(docs, text_col).cast("string").alias("text"))

    def run(batches):
        m = sent.value
        for b in batches:
            for a, counts, some in trigrams(b.column(2), m.p.shape[1]):
                n = len(counts)
                if m.langs:
                    share, _ = m.shares(counts, penalty)
                    top = share.argmax(1)
                    lang = [m.langs[k] if ok else "und" for k, ok in zip(top.tolist(), some.tolist(), strict=True)]
                    score = np.where(some, np.clip(share[np.arange(n), top].astype(float), 0, 1), 0.0)
                    mixed = [{m.langs[k]: float(s[k]) for k in np.flatnonzero(s > 0).tolist()} if ok else {} for s, ok in zip(share, some.tolist(), strict=True)]
                else:
                    lang, score, mixed = ["und"] * n, np.zeros(n), [{}] * n
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, n), b.column(1).slice(a, n), pa.array(lang, pa.string()), pa.array(score), pa.array([list(x.items()) for x in mixed], pa.map_(pa.string(), pa.float64()))], ["doc_id", "held_out", "lang_pred", "score", "languages"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages map<string,double>")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", penalty: float = 3.0) -> DataFrame:
    """predict() by a model of the rows that are not held out."""
    return predict(docs, fit(docs.where(~held_out(named(docs, id_col))), text_col, lang_col), id_col, text_col, penalty)


