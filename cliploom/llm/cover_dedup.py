"""Repeated word windows over a whole corpus by difference-cover anchors.

A difference cover modulo a period has, for any two positions, a shift below the period that brings both onto cover
positions. So windows of `window - period + 1` words are hashed only where the place in the document is a cover
position, and still any repeated window of `window` words has an aligned anchor in each of its copies. Anchors
that occur once anywhere are dropped; from the others the match is extended: the whole windows that hold such an
anchor are compared.

Words are runs of other characters than space, tab, LF, VT, FF and CR, unchanged. Nulls have no words. A null doc_id
comes back null; repeated rows, and rows of one doc_id, count as further occurrences and each get their row, so of ties none stays. An empty table
gives none; a text longer than a slab is one slab. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import SPACE_LIKE, U, Words, covered, planes, separators, slabs, starts_of_runs, unplanes
from .rounds import Batch, answer, ask, batches, by_bucket, finish, sizes


def difference_cover(period: int) -> list[int]:
    """A small set of residues whose differences are all residues (greedy, then checked)."""
    best: list[int] | None = None
    for step in range(2, period):
        cover, seen = [0, 1], {0, 1, period - 1}
        while len(seen) < period:
            gain = {c: len({(c - x) % period for x in cover} | {(x - c) % period for x in cover} | seen) for c in range(period) if c not in cover}
            top = max(gain.values())
            ties = [c for c in gain if gain[c] == top]
            cover.append(ties[step % len(ties)])
            seen |= {(cover[-1] - x) % period for x in cover} | {(x - cover[-1]) % period for x in cover}
        if best is None or len(cover) < len(best):
            best = cover
    best = best or list(range(period))
    assert {(a - b) % period for a in best for b in best} == set(range(period))
    return sorted(best)


class Anchors:
    """The words of a batch, slab by slab, with hashes at cover positions."""

    def __init__(self, b: Batch, window: int, period: int, cover: list[int]):
        sep, on = separators(SPACE_LIKE), np.zeros(period, bool)
        on[cover] = True
        self.slabs, keys, where = [], [], []
        base = 0
        for x, y in slabs(b.offs):
            w = Words(b.buf[b.offs[x] : b.offs[y]], b.offs[x : y + 1] - b.offs[x], sep)
            g, ok = w.grams(window - period + 1)
            place = np.arange(len(g)) - np.repeat(w.first[:-1], w.count)[: len(g)]
            ok &= on[place % period] & (np.repeat(w.count, w.count)[: len(g)] >= window)
            at = np.flatnonzero(ok)
            keys.append(g[at])
            where.append(at + base)
            self.slabs.append((x, y, base, w))
            base += len(w.start)
        self.n_words = base
        self.key = np.concatenate(keys) if keys else np.zeros(0, U)
        self.at = np.concatenate(where) if where else np.zeros(0, np.int64)

    def candidates(self, hit: np.ndarray, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the whole windows that hold an anchor that was hit."""
        near = covered(self.n_words, np.maximum(self.at[hit] - period + 1, 0), self.at[hit] + 1)
        keys, where = [], []
        for _, _, base, w in self.slabs:
            if not near[base : base + len(w.start)].any():
                continue
            g, ok = w.grams(window)
            at = np.flatnonzero(ok & near[base : base + len(g)])
            keys.append(g[at])
            where.append(at + base)
        return (np.concatenate(where), np.concatenate(keys)) if keys else (np.zeros(0, np.int64), np.zeros(0, U))


def _send(keys: np.ndarray, buckets: int):
    """One message a bucket: distinct keys in order, and whether each is there more than once."""
    s = np.sort(keys)
    new = starts_of_runs(s)
    many = (np.diff(np.r_[new, len(s)]) > 1).astype(np.uint8)
    k = s[new]
    for b, i, j in by_bucket(k, buckets):
        yield b, np.uint32(j - i).tobytes() + planes(k[i:j]) + np.packbits(many[i:j]).tobytes()


def _repeated(messages: list[bytes]) -> list[bytes | None]:
    """For each message the places of the keys that are also elsewhere."""
    size = [int(np.frombuffer(m, "<u4", 1)[0]) for m in messages]
    k = np.concatenate([unplanes(memoryview(m)[4:], n) for m, n in zip(messages, size, strict=True)])
    many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8, offset=4 + 8 * n), count=n) for m, n in zip(messages, size, strict=True)])
    order = np.argsort(k, kind="stable")
    new = starts_of_runs(k[order])
    count = np.add.reduceat(1 + many[order].astype(np.int64), new)
    use = np.empty(len(k), bool)
    use[order] = np.repeat(count > 1, np.diff(np.r_[new, len(k)]))
    out, at = [], 0
    for n in size:
        out.append(np.packbits(use[at : at + n]).tobytes() if use[at : at + n].any() else None)
        at += n
    return out


def _hits(keys: np.ndarray, buckets: int, number: int, got: dict) -> np.ndarray:
    """Which of the keys that were sent are repeated."""
    s = np.unique(keys)
    use = np.zeros(len(s), bool)
    for b, i, j in by_bucket(s, buckets):
        if (number, b) in got:
            use[i:j] = np.unpackbits(np.frombuffer(got[number, b], np.uint8), count=j - i)
    return use[np.searchsorted(s, keys)] if len(s) else np.zeros(0, bool)


def remove_repeats(docs: DataFrame, window: int = 35, period: int = 21, id_col: str = "doc_id", text_col: str = "text", n_batches: int | None = None, n_buckets: int | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by a space (kept_sha256 if digest) of each row, without every word covered by a window whose words also start anywhere else."""
    period = max(1, min(period, window - 1))
    cover = difference_cover(period)
    if not (n_batches and n_buckets):
        n_batches, n_buckets = sizes(docs, text_col)
    rows = batches(docs, id_col, text_col, n_batches)

    def offer(b: Batch, _):
        return _send(Anchors(b, window, period, cover).key, n_buckets)

    def extend(b: Batch, got: dict):
        a = Anchors(b, window, period, cover)
        return _send(a.candidates(_hits(a.key, n_buckets, 1, got), window, period)[1], n_buckets)

    def judge(b: Batch, got: dict) -> pa.Table:
        a = Anchors(b, window, period, cover)
        where, keys = a.candidates(_hits(a.key, n_buckets, 1, got), window, period)
        at = where[_hits(keys, n_buckets, 2, got)]
        gone = covered(a.n_words, at, at + window)
        count, removed, kept = [], [], []
        for _, _, base, w in a.slabs:
            mask = gone[base : base + len(w.start)]
            total = np.r_[0, np.cumsum(mask)]
            count.append(w.count)
            removed.append(total[w.first[1:]] - total[w.first[:-1]])
            raw, s, e = w.buf.tobytes(), w.start.tolist(), w.end.tolist()
            left = np.flatnonzero(~mask).tolist()
            words = [raw[s[i] : e[i]] for i in left]
            cut = (w.first - total[w.first]).tolist()
            for i, j in zip(cut, cut[1:], strict=False):
                t = b" ".join(words[i:j])
                kept.append(hashlib.sha256(t).hexdigest() if digest else t.decode(errors="replace"))
        cat = lambda p: pa.array(np.concatenate(p) if p else np.zeros(0, np.int64), pa.int64())
        return pa.table({"doc_id": b.table.column("doc_id"), "n_words": cat(count), "n_removed": cat(removed), ("kept_sha256" if digest else "kept"): pa.array(kept, pa.string())})

    first = answer(ask(rows, offer), 1, _repeated)
    second = answer(ask(rows, extend, first), 2, _repeated)
    return finish(rows, first.unionByName(second), judge, f"doc_id long, n_words long, n_removed long, {'kept_sha256' if digest else 'kept'} string")
