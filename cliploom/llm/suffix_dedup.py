"""Substring removal over a whole corpus by prefix-free parsing.

Trigger: each string of `length` bytes has one window of rolling hashes, and the least hash in it marks a trigger. Starts
that share a trigger form a phrase; with the length - 1 bytes that follow, phrases overlap as those of a prefix-free
parse do, and equal strings lie in phrases of equal trigger at equal distance from it, in whatever document.

Dictionary: distinct phrases, held by trigger in hash buckets, each with the least doc_id. Equal phrases settle all their
suffixes at once, so that highly repetitive text costs one comparison a phrase. Only where one trigger has several phrases
are suffixes put in order, as a prefix-free parse does it:

    suffix array of the dictionary   what lies before the trigger, with the trigger itself at its end, and all suffixes of
                                     that; none is the beginning of another, for the trigger is nowhere else in it
    suffix array of the parse        what follows from the trigger on, by rank, with the prefix length that neighbours share
    corpus order                     starts by rank of their suffix in the dictionary, then by rank of the parse from their trigger
                                     on; equal neighbours, to depth `length`, share the least doc_id

Hot triggers: one that a batch has in more than MOST_IN_BATCH phrases, or a bucket in more than MOST_KINDS, is named once
a batch, and its starts are dealt one by one to buckets by the hash of their string, merged in the batch. So what reaches a
bucket for one trigger does not follow the number of documents that have it.

Matches never cross rows. Nulls count as empty texts; a null doc_id sorts before all others and comes back null; rows
of equal doc_id do not remove each other's text (ties are of no one); repeated rows each get their row. An empty table gives none.
A text of any length is one row of one batch, parsed by parts of SLAB bytes. Extra columns, whatever their names, are ignored
(kept by `strip_repeats`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from .columns import Rolling, U, byte_codes, lanes_of, mix, planes, span_hash, starts_of_runs, unplanes
from .frames import quoted
from .rounds import Batch, answer, ask, batches, by_bucket, finish, sizes

GRAM = 20
CTX = 6  # bytes of a phrase's hash that are sent, beside the 8 of its trigger's
SLAB = 1 << 18
#: A trigger with more phrases than that in a batch or in a bucket, or from more batches, is hot.
MOST_IN_BATCH, MOST_KINDS, MOST_ENTRIES = 4, 64, 1024
#: State of an entry of the dictionary: of one document, of more, of a hot trigger; and in the answer: settled, mixed, hot.
HOT = 2
FAR = np.iinfo(np.int64).max


class Phrases:
    """Phrases of a batch: trigger hash, phrase hash, first start, number of starts, bytes before the trigger, row."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, length: int):
        gram = min(GRAM, max(1, length // 2))
        m = length - gram + 1
        n = len(buf) - length + 1
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for a in range(0, max(n, 0), SLAB):
            for c, x in zip(cols, self._slab(buf[a : a + SLAB + length - 1], a, offs, length, gram, m), strict=True):
                c.append(x)
        self.trigger, self.hash, self.start, self.count, self.left = (np.concatenate(c) if c else np.zeros(0, d) for c, d in zip(cols, (U, U, *[np.int64] * 3), strict=True))
        self.row = np.searchsorted(offs, self.start, "right") - 1

    @staticmethod
    def _slab(x: np.ndarray, a: int, offs: np.ndarray, length: int, gram: int, m: int):
        n = len(x) - length + 1
        roll = Rolling(byte_codes()[x])
        g = mix(roll.fixed(gram))
        low = U((1 << 21) - 1)
        least = (g & ~low) | np.arange(len(g), dtype=U)
        span = 1
        while span < m:  # window minimum by doubling
            step = min(span, m - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        at = (least[:n] & low).astype(np.int64)
        first = np.searchsorted(offs, a, "right") - 1
        last = np.searchsorted(offs, a + n, "left")
        ok = np.ones(n, bool)
        for e in np.unique(offs[first + 1 : last + 2]).tolist():  # starts too near the end of their row
            ok[max(0, e - length + 1 - a) : max(0, min(n, e - a))] = False
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(at[1:], at[:-1], out=new[1:])
        begin = ok.copy()
        begin[1:] &= new[1:] | ~ok[:-1]
        last_of = ok.copy()
        last_of[:-1] &= new[1:] | ~ok[1:]
        lo, hi = np.flatnonzero(begin), np.flatnonzero(last_of)
        t = at[lo]
        h = mix(roll.spans(lo, hi + length) + ((t - lo) * 4096 + hi - lo).astype(U) * U(0x9E3779B97F4A7C15)) if length <= 256 else span_hash(x, lo, hi + length)
        return mix(g[t] * U(0xC2B2AE3D27D4EB4F)), h, lo + a, hi - lo + 1, t - lo  # least hashes are small: mixed anew, they fill all buckets alike


class Parse:
    """The distinct phrases of a batch in order of trigger, and the entries that stand for them: one each, or one for all of a hot trigger."""

    def __init__(self, b: Batch, length: int, buckets: int):
        p = self.phrases = Phrases(b.buf, b.offs, length)
        short = p.hash & U((1 << (8 * CTX)) - 1)
        self.order = np.lexsort((short, p.trigger))  # stable: rows are by rising doc_id
        t, h = p.trigger[self.order], short[self.order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        self.group = np.cumsum(new) - 1  # distinct phrase of each phrase, in order
        self.one = self.order[new]  # a phrase of least doc_id of each
        self.doc = b.ids[p.row[self.one]]
        many = np.zeros(len(self.one), np.uint8)
        many[self.group[b.ids[p.row[self.order]] != self.doc[self.group]]] = 1
        t = p.trigger[self.one]
        first = starts_of_runs(t)
        kinds = np.diff(np.r_[first, len(t)])
        self.of_trigger = np.repeat(np.arange(len(first)), kinds)
        crowd = kinds[self.of_trigger] > MOST_IN_BATCH
        lead = np.zeros(len(t), bool)
        lead[first] = True
        self.entry = np.flatnonzero(~crowd | lead)
        self.state = np.where(crowd, HOT, many)[self.entry].astype(np.uint8)
        self.parts = list(by_bucket(t[self.entry], buckets))

    def answers(self, got: dict):
        """(least doc_id of each distinct phrase that is elsewhere, which of them are mixed by bucket, which of them have a hot trigger)."""
        whole = np.full(len(self.one), FAR)
        hot = np.zeros(int(self.of_trigger[-1]) + 1 if len(self.one) else 0, bool)
        mixed = []
        for k, i, _ in self.parts:
            if (1, k) in got:
                at, least, state = _first_reply(got[1, k])
                e = self.entry[i + at]
                whole[e] = least
                hot[self.of_trigger[e[state == HOT]]] = True
                if (state == 1).any():
                    mixed.append((k, e[state == 1]))
        hot = np.flatnonzero(hot[self.of_trigger]) if len(self.one) else np.zeros(0, np.int64)
        whole[hot] = FAR
        return whole, mixed, hot


class Strings:
    """The distinct strings that start in some phrases, each with its hash, that of its trigger, and the least doc_id of the batch."""

    def __init__(self, b: Batch, parse: Parse, hot: np.ndarray, length: int):
        p, q = parse.phrases, parse.one[hot]
        self.count = p.count[q]
        start = np.repeat(p.start[q], self.count) + _ramp(self.count)
        h = span_hash(b.buf, start, start + length) if len(start) else np.zeros(0, U)
        t = np.repeat(p.trigger[q] & U(0xFFFFFFFF), self.count)
        doc = np.repeat(parse.doc[hot], self.count)
        order = np.lexsort((doc, t, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (t[order][1:] != t[order][:-1])
        one = order[new]
        self.hash, self.trigger, self.doc = h[one], t[one], doc[one]
        self.of = np.empty(len(h), np.int64)  # distinct string of each start
        self.of[order] = np.cumsum(new) - 1


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, "


def deduplicate(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", n_batches: int | None = None, n_buckets: int | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes (kept_sha256 if digest) of each row, without every byte covered by a string of `length` bytes that also starts in a row of smaller doc_id.

    Three passes over one exchange of the texts; what else is shuffled is about 17 bytes a phrase, a phrase being 16
    bytes of text on average for strings of 50.
    """
    return _run(docs, length, id_col, text_col, n_batches, n_buckets, digest, False).drop("row")


def strip_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", n_batches: int | None = None, n_buckets: int | None = None) -> DataFrame:
    """docs with the kept text; a character that is cut in part goes as a whole. Nulls become empty texts; other columns are as they are."""
    x = _run(docs, length, id_col, text_col, n_batches, n_buckets, False, True)
    return x.select(*[F.col("kept_text").alias(c) if c == text_col else F.col(f"`row`.{quoted(c)}").alias(c) for c in docs.columns])


def _run(docs, length, id_col, text_col, n_batches, n_buckets, digest, carry) -> DataFrame:
    if not (n_batches and n_buckets):
        n_batches, n_buckets = sizes(docs, text_col)
    rows = batches(docs, id_col, text_col, n_batches, carry)
    first = answer(ask(rows, lambda b, _: _offer(Parse(b, length, n_buckets))), 1, _dictionary)
    second = answer(ask(rows, lambda b, got: _details(b, length, n_buckets, got), first), 2, lambda m: _settle(m, length))
    kept = ("kept_text" if carry else "kept_sha256") if carry or digest else "kept"
    schema = _parse_datatype_string(RESULT + f"{kept} {'binary' if kept == 'kept' else 'string'}")
    if carry:
        schema = StructType([*schema.fields, rows.schema["row"]])
    return finish(rows, first.unionByName(second), lambda b, got: _judge(b, length, n_buckets, got, kept), schema)


def _offer(p: Parse):
    q = p.one[p.entry]
    trigger, h, doc = p.phrases.trigger[q], p.phrases.hash[q], p.doc[p.entry]
    for k, i, j in p.parts:
        yield k, np.uint32(j - i).tobytes() + planes(np.diff(trigger[i:j], prepend=U(0))) + planes(h[i:j], CTX) + planes(doc[i:j]) + p.state[i:j].tobytes()


def _dictionary(messages: list[bytes]) -> list[bytes | None]:
    """For each entry whose trigger is in two documents: the phrase's least doc_id, and whether other phrases share the trigger."""
    size = [int(np.frombuffer(m, "<u4", 1)[0]) for m in messages]
    t, h, d, state = [], [], [], []
    for m, n in zip(messages, size, strict=True):
        v = memoryview(m)
        t.append(np.cumsum(unplanes(v[4:], n), dtype=U))
        h.append(unplanes(v[4 + 8 * n :], n, CTX))
        d.append(unplanes(v[4 + (8 + CTX) * n :], n, 8, np.int64))
        state.append(np.frombuffer(v[4 + (16 + CTX) * n :], np.uint8, n))
    t, h, d, state = map(np.concatenate, (t, h, d, state))
    order = np.lexsort((h, t))
    ts, hs, ds = t[order], h[order], d[order]
    new_t = starts_of_runs(ts)
    entries = np.diff(np.r_[new_t, len(ts)])
    low, high, most = (f.reduceat(x, new_t) for f, x in ((np.minimum, ds), (np.maximum, ds), (np.maximum, state[order])))
    of_t = np.repeat(np.arange(len(new_t)), entries)
    shared = ((low != high) | (most > 0))[of_t]
    new_h = np.ones(len(ts), bool)
    new_h[1:] = (ts[1:] != ts[:-1]) | (hs[1:] != hs[:-1])
    kinds = np.add.reduceat(new_h.astype(np.int64), new_t)
    crowded = (most == HOT) | (kinds > MOST_KINDS) | ((kinds > 1) & (entries > MOST_ENTRIES))
    of_h = np.cumsum(new_h) - 1
    least, use, say = np.empty(len(t), np.int64), np.empty(len(t), bool), np.empty(len(t), np.uint8)
    least[order], use[order], say[order] = np.minimum.reduceat(ds, np.flatnonzero(new_h))[of_h], shared, np.where(crowded, HOT, kinds > 1)[of_t]
    out, at = [], 0
    for n in size:
        i = np.flatnonzero(use[at : at + n])
        out.append(np.uint32(len(i)).tobytes() + planes(i.astype(np.int64), 4) + planes(least[at + i]) + say[at + i].tobytes() if len(i) else None)
        at += n
    return out


def _first_reply(r: bytes):
    n, v = int(np.frombuffer(r, "<u4", 1)[0]), memoryview(r)
    return unplanes(v[4:], n, 4, np.int64), unplanes(v[4 + 4 * n :], n, 8, np.int64), np.frombuffer(v[4 + 12 * n :], np.uint8, n)


def _wide(length: int) -> int:
    """Bytes that hold a phrase's number of starts, which is at most length."""
    return (length.bit_length() + 7) // 8


def _details(b: Batch, length: int, buckets: int, got: dict):
    """To the bucket of its trigger the text of each mixed phrase; to the bucket of its hash each string of a hot trigger."""
    parse, wide = Parse(b, length, buckets), _wide(length)
    p = parse.phrases
    _, mixed, hot = parse.answers(got)
    cold: dict[int, bytes] = {}
    for k, e in mixed:
        q = parse.one[e]
        text = b"".join(b.buf[s : s + c + length - 1].tobytes() for s, c in zip(p.start[q].tolist(), p.count[q].tolist(), strict=True))
        cold[k] = planes(p.trigger[q]) + planes(p.hash[q], CTX) + planes(parse.doc[e]) + planes(p.count[q], wide) + planes(p.left[q], wide) + text
    number = {k: len(e) for k, e in mixed}
    strings = Strings(b, parse, hot, length)
    warm = {k: (i, j) for k, i, j in by_bucket(strings.hash, buckets)}
    for k in sorted({*cold, *warm}):
        i, j = warm.get(k, (0, 0))
        head = np.array([number.get(k, 0), j - i, len(cold.get(k, b""))], "<u4").tobytes()
        yield k, head + cold.get(k, b"") + planes(np.diff(strings.hash[i:j], prepend=U(0))) + planes(strings.trigger[i:j], 4) + planes(strings.doc[i:j])


def _settle(messages: list[bytes], length: int) -> list[bytes | None]:
    """Least doc_ids: of the string at each start of each mixed phrase, then of each string of a hot trigger (left out if all are the batch's own)."""
    heads = [np.frombuffer(m, "<u4", 3).tolist() for m in messages]
    cold = _cold(messages, [h[0] for h in heads], length)
    h, t, d = [], [], []
    for m, (_, n, skip) in zip(messages, heads, strict=True):
        v = memoryview(m)[12 + skip :]
        h.append(np.cumsum(unplanes(v, n), dtype=U))
        t.append(unplanes(v[8 * n :], n, 4))
        d.append(unplanes(v[12 * n :], n, 8, np.int64))
    h, t, d = map(np.concatenate, (h, t, d))
    order = np.lexsort((d, t, h))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (t[order][1:] != t[order][:-1])
    least = np.empty(len(h), np.int64)
    least[order] = d[order][new][np.cumsum(new) - 1]
    out, at = [], 0
    for c, (_, n, _) in zip(cold, heads, strict=True):
        lower = planes(least[at : at + n]) if (least[at : at + n] < d[at : at + n]).any() else b""
        out.append(np.uint32(len(c)).tobytes() + c + lower if c or lower else None)
        at += n
    return out


def _cold(messages: list[bytes], size: list[int], length: int) -> list[bytes]:
    """Least doc_id of the string at each start of each mixed phrase of each message."""
    if not sum(size):
        return [b""] * len(size)
    t, h, d, c, left, text, wide = [], [], [], [], [], [], _wide(length)
    for m, n in zip(messages, size, strict=True):
        v = memoryview(m)[12:]
        t.append(unplanes(v, n))
        h.append(unplanes(v[8 * n :], n, CTX))
        d.append(unplanes(v[(8 + CTX) * n :], n, 8, np.int64))
        c.append(unplanes(v[(16 + CTX) * n :], n, wide, np.int64))
        left.append(unplanes(v[(16 + CTX + wide) * n :], n, wide, np.int64))
        text.append(np.frombuffer(v[(16 + CTX + 2 * wide) * n :], np.uint8, int(c[-1].sum()) + (length - 1) * n))
    t, h, d, c, left, text = map(np.concatenate, (t, h, d, c, left, text))
    begin = np.cumsum(c + length - 1) - (c + length - 1)
    order = np.lexsort((d, h, t))
    new = np.ones(len(t), bool)
    new[1:] = (t[order][1:] != t[order][:-1]) | (h[order][1:] != h[order][:-1])
    entry = np.empty(len(t), np.int64)
    entry[order] = np.cumsum(new) - 1
    one = order[new]  # distinct phrases, least doc_id first
    starts = np.r_[0, np.cumsum(c[one])]
    least = np.empty(int(starts[-1]), np.int64)
    edges, last = [0], 0
    for x in [*starts_of_runs(t[one])[1:].tolist(), len(one)]:  # blocks of whole triggers of about BLOCK_STARTS starts
        if starts[x] - starts[last] >= BLOCK_STARTS or x == len(one):
            edges.append(x)
            last = x
    for i, j in zip(edges, edges[1:], strict=False):
        q = one[i:j]
        at, classes = corpus_order(text, t[q], begin[q], c[q], left[q], length)
        low = np.minimum.reduceat(np.repeat(d[q], c[q])[at], starts_of_runs(classes))
        least[starts[i] + at] = low[classes]
    out, i = [], 0
    for n in size:
        e = entry[i : i + n]
        take = np.repeat(starts[e], c[one][e]) + _ramp(c[one][e])
        out.append(np.uint32(len(take)).tobytes() + planes(least[take]) if n else b"")
        i += n
    return out


BLOCK_STARTS = 200_000


def _lane_keys(lanes: np.ndarray, at: np.ndarray, size: np.ndarray, most: int) -> list[np.ndarray]:
    """The size bytes from each place as big-endian numbers of eight, in order, with zeros past their ends."""
    keys = []
    for o in range(0, most, 8):
        n = np.clip(size - o, 0, 8)
        x = lanes[np.where(n > 0, at + o, 0)].byteswap()
        keys.append(np.where(n > 0, x & ~_LOW[n], U(0)))
    return keys


_LOW = np.array([(1 << 64 - 8 * n) - 1 for n in range(9)], U)


def _ranks(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by the keys, the first first; which in it differ from the one before; rank of each among the distinct)."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, new, rank


def corpus_order(text: np.ndarray, trigger: np.ndarray, begin: np.ndarray, count: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All starts of distinct phrases by trigger and then by the string of `length` bytes there: (their numbers in order, class of equal strings of each in order).

    A phrase has count starts from begin on, its trigger left bytes after the first, and length - 1 bytes after its last start.
    """
    lanes, gram = lanes_of(text), min(GRAM, max(1, length // 2))
    # Suffix array of the parse, to the depth asked: what follows from each phrase's trigger on.
    keys = _lane_keys(lanes, begin + left, count + length - 1 - left, length)
    order, new, follow = _ranks([trigger, *keys])
    one = order[new]
    same = np.zeros(len(one), np.int64)  # bytes that each has in common with the one before
    alive = np.ones(len(one), bool)
    alive[:1] = False
    alive[1:] &= trigger[one][1:] == trigger[one][:-1]
    for k in keys:
        x = np.zeros(len(one), U)
        x[1:] = k[one][1:] ^ k[one][:-1]
        same[alive] += 8 - sum((x[alive] >> U(8 * n) > 0).astype(np.int64) for n in range(8))
        alive &= x == 0
    # Suffix array of the dictionary: distinct beginnings of phrases up to the trigger, and all suffixes of them.
    _, new, piece = _ranks([trigger, left, count, *_lane_keys(lanes, begin, left, int(left.max(initial=0)))])
    some = np.empty(int(piece.max(initial=-1)) + 1, np.int64)
    some[piece] = np.arange(len(piece))
    c = count[some]
    inner, offset = _ramp(c), np.repeat(left[some], c) - _ramp(c)
    keys = _lane_keys(lanes, np.repeat(begin[some], c) + inner, offset + gram, int(left.max(initial=0)) + gram)
    _, _, suffix = _ranks([np.repeat(trigger[some], c), *keys, offset])
    # Corpus order: the rank of the suffix, then that of the parse from the trigger on.
    base = (np.cumsum(c) - c)[piece]
    a = suffix[np.repeat(base, count) + _ramp(count)]
    f = np.repeat(follow, count)
    o = np.repeat(left, count) - _ramp(count)
    order = np.lexsort((f, a))
    a, f, o = a[order], f[order], o[order]
    new = np.ones(len(order), bool)
    new[1:] = a[1:] != a[:-1]
    by_offset = np.argsort(o, kind="stable")
    for i in np.split(by_offset, starts_of_runs(o[by_offset])[1:]) if len(o) else ():
        run = np.cumsum(same < length - o[i[0]])  # runs of the parse that agree as far as these strings go
        i = i[~new[i]]
        new[i] = run[f[i]] != run[f[i - 1]]
    return order, np.cumsum(new) - 1


def _ramp(counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _judge(b: Batch, length: int, buckets: int, got: dict, name: str) -> pa.Table:
    parse = Parse(b, length, buckets)
    p, order, group = parse.phrases, parse.order, parse.group
    whole, mixed, hot = parse.answers(got)
    place = np.full(len(parse.one), -1, np.int64)  # in detail: the least doc_id of each start
    detail, n_detail = [], 0
    for k, e in mixed:
        n = int(np.frombuffer(got[2, k], "<u4", 1, 4)[0])
        detail.append(unplanes(memoryview(got[2, k])[8:], n, 8, np.int64))
        c = p.count[parse.one[e]]
        place[e] = n_detail + np.cumsum(c) - c
        n_detail += n
    strings = Strings(b, parse, hot, length)
    least = strings.doc
    for k, i, j in by_bucket(strings.hash, buckets):
        if (2, k) in got:
            r = memoryview(got[2, k])[4 + int(np.frombuffer(got[2, k], "<u4", 1)[0]) :]
            if len(r):
                least[i:j] = unplanes(r, j - i, 8, np.int64)
    place[hot] = n_detail + np.cumsum(strings.count) - strings.count
    detail = np.concatenate([*detail, least[strings.of]])
    doc = b.ids[p.row[order]]
    d = np.zeros(len(b.buf) + 1, np.int32)
    clear = np.flatnonzero((whole[group] < doc))
    lo = p.start[order[clear]]
    np.add.at(d, lo, 1)
    np.add.at(d, lo + p.count[order[clear]] + length - 1, -1)
    fine = np.flatnonzero((whole[group] >= doc) & (place[group] >= 0))
    c = p.count[order[fine]]
    inner = _ramp(c)
    hit = detail[np.repeat(place[group[fine]], c) + inner] < np.repeat(doc[fine], c)
    lo = (np.repeat(p.start[order[fine]], c) + inner)[hit]
    np.add.at(d, lo, 1)
    np.add.at(d, lo + length, -1)
    gone = np.cumsum(d[:-1]) > 0
    n = np.diff(b.offs)
    total = np.r_[0, np.cumsum(gone)]
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    starts = np.r_[0, np.cumsum(head)]
    spans = starts[b.offs[1:]] - starts[b.offs[:-1]]
    inside = b.offs[:-1] < len(gone)  # a run that goes on from the row before begins anew here
    o = b.offs[:-1][inside]
    begins = gone[o] & ~head[o] & (n[inside] > 0)
    spans[np.flatnonzero(inside)[begins]] += 1
    removed = total[b.offs[1:]] - total[b.offs[:-1]]
    kept = []
    for i, (x, y) in enumerate(zip(b.offs[:-1].tolist(), b.offs[1:].tolist(), strict=True)):
        raw = b.buf[x:y].tobytes() if not removed[i] else b.buf[x:y][~gone[x:y]].tobytes()
        kept.append(hashlib.sha256(raw).hexdigest() if name == "kept_sha256" else raw.decode(errors="ignore") if name == "kept_text" else raw)
    return pa.table({"doc_id": b.table.column("doc_id"), "n_bytes": pa.array(n), "n_removed": pa.array(removed), "n_spans": pa.array(spans), name: pa.array(kept, pa.binary() if name == "kept" else pa.string()), **({"row": b.table.column("row")} if name == "kept_text" else {})})
