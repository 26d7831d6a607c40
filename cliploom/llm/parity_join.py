"""Set-similarity join of documents by parity sketches.

A sketch is a row of 64-bit words: each shingle of a document's set is XORed, as a random word, into the part that its
hash falls in. A shingle that only one of two sets has changes one word at most, so the number of words that differ is a
lower bound of the symmetric difference. Sets that reach the similarity differ by at most `d` shingles, d being fixed by
the band of sizes; with more than d words, one word at least is the same in both (pigeonhole). Words are joined, and
what meets is verified on the sets themselves.

Equal sets are one class from the start, represented by its least doc_id, so copies are not expanded into pairs. A word that
many classes share is frequent: a batch that has it often sends its bucket one entry, its members stay with the batch, and
each that has more than d other words sets it aside, which loses no link: of those others one is the same in both. So what
reaches a bucket for one word does not follow the number of near copies. Documents that meet in a word are verified in three
steps, each only between different components so far: every document with the least that it met, with the least of each
word, then all pairs left, the nearest of each two components before the others. So a group of near copies costs about one verification a document. Before that last step a meeting
of more than SPLIT members is split by prefixes: each set's rarest shingles, as many as it may lack and one more, one of which
similar sets share. Links, components and fingerprints stay distributed.

Shingles are runs of `k` words; with fewer words the whole sequence is one. A null or empty text has an empty set and is
linked with nothing; rows of one doc_id are one document, with the links of each; a row of null doc_id is linked with
nothing and has a null component. An empty table gives none; a text of any length is one set; of equal sets, and of components, the
least doc_id stands for all. Extra columns, whatever their names, are ignored (kept by `one_of_each`); repeated rows each get their row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import SPACE_LIKE, U, Words, mix, planes, separators, slabs, unplanes
from .frames import named, scratch, scratch_path, settled, shuffles_dropped
from .rounds import Batch, answer, ask, batches, by_bucket, finish, sizes

K1, K2 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
#: A word of more classes, or of more in one batch, is set aside where a document can do without.
FREQUENT, MOST_IN_BATCH = 32, 4
SKETCH_BITS = 2048
#: Members of a block of a word that many share.
BLOCK = 1024
#: Most doc_ids that are broadcast, 8 bytes each.
MOST_SENT = 1 << 20
#: Members of a meeting that is split further, and most shingles that are known as frequent there.
SPLIT, MOST_SHINGLES = 16 * BLOCK, 1 << 16
#: Bytes of each shingle's hash that are kept for the comparison of two sets.
SET_BYTES = 6
NULL_ID = np.iinfo(np.int64).min


class Bands:
    """Bands of set sizes for a similarity of percent / 100."""

    def __init__(self, percent: int, ratio: float = 1.6, spare: float = 0.15):
        self.percent, self.ratio, self.low = percent, ratio, [1]
        while self.low[-1] < 1 << 40:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * ratio)))
        self.spare = spare

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(band, d, parts) of each band in which a set of n shingles looks for partners: its own, and each below where a partner may be."""
        c = int(np.searchsorted(self.low, n, "right")) - 1
        out = [self._at(c)]
        while c and n * self.percent <= 100 * (self.low[c] - 1):
            c -= 1
            out.append(self._at(c))
        return [x for x in out if x[1]]  # d = 0: only equal sets, which are one class

    def _at(self, c: int) -> tuple[int, int, int]:
        small = self.low[c + 1] - 1
        both = small + 100 * small // self.percent
        d = (100 - self.percent) * both // (100 + self.percent)
        return c, d, d + 1 + max(2, int(self.spare * (d + 1)))


def shingle_sets(b: Batch, k: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each row's shingles."""
    out: list[np.ndarray] = []
    sep = separators(SPACE_LIKE)
    for x, y in slabs(b.offs):
        w = Words(b.buf[b.offs[x] : b.offs[y]], b.offs[x : y + 1] - b.offs[x], sep, fold=True)
        g, _ = w.grams(k)
        short = {n: w.grams(n)[0] for n in range(1, k) if (w.count == n).any()}
        for s, n in zip(w.first[:-1].tolist(), w.count.tolist(), strict=True):
            out.append(np.unique(g[s : s + n - k + 1]) if n >= k else short[n][s : s + 1] ^ U(n) if n else np.zeros(0, U))
    return out


def _prints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set."""
    a = np.array([np.bitwise_xor.reduce(mix(s ^ K1)) if len(s) else 0 for s in sets], U)
    b = np.array([np.add.reduce(mix(s ^ K2)) if len(s) else 0 for s in sets], U)
    return mix(a ^ np.array([len(s) for s in sets], U)), b


def _classes(b: Batch, sets: list[np.ndarray], buckets: int):
    """Rows that have a class in order of its fingerprint, least doc_id first, the first row of each, and its message parts."""
    p, q = _prints(sets)
    use = np.flatnonzero(np.array([len(s) > 0 for s in sets], bool) & (b.ids != NULL_ID)) if sets else np.zeros(0, np.int64)
    order = use[np.lexsort((q[use], p[use]))]
    new = np.ones(len(order), bool)
    new[1:] = (p[order][1:] != p[order][:-1]) | (q[order][1:] != q[order][:-1])
    one = order[new]
    return p, q, order, np.cumsum(new) - 1, one, list(by_bucket(p[one], buckets))


def _representatives(b: Batch, sets: list[np.ndarray], buckets: int, got: dict) -> np.ndarray:
    """The least doc_id of each row's class; the row's own if it has none."""
    _, _, order, group, one, parts = _classes(b, sets, buckets)
    least = b.ids[one].copy()
    for k, i, j in parts:
        if (1, k) in got:
            least[i:j] = unplanes(got[1, k], j - i, 8, np.int64)
    rep = b.ids.copy()
    rep[order] = least[group]
    return rep


def _least(messages: list[bytes]) -> list[bytes | None]:
    size = [len(m) // 24 for m in messages]
    p, q, d = (np.concatenate([unplanes(memoryview(m)[8 * at * n :], n, 8, t) for m, n in zip(messages, size, strict=True)]) for at, t in ((0, U), (1, U), (2, np.int64)))
    order = np.lexsort((d, q, p))
    new = np.ones(len(order), bool)
    new[1:] = (p[order][1:] != p[order][:-1]) | (q[order][1:] != q[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = d[order][new][np.cumsum(new) - 1]
    cut = np.cumsum(size)[:-1]
    return [planes(x) if (x != y).any() else None for x, y in zip(np.split(out, cut), np.split(d, cut), strict=True)]


def sketch_words(s: np.ndarray, bands: Bands) -> list[tuple[np.ndarray, int, int]]:
    """(words of the sketch, band, how many it has beyond d + 1) of a set, for each of its bands."""
    out = []
    content = mix(s ^ K2)
    for band, d, parts in bands.of(len(s)):
        part = ((s >> U(32)) * U(parts) >> U(32)).astype(np.int64)  # sorted hashes: parts are in order
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        word, place = np.bitwise_xor.reduceat(content, first), part[first]
        spare = len(word) - (d + 1)
        if spare < 0:  # too few words for the pigeonhole: its empty ones count too
            empty = np.setdiff1d(np.arange(parts), place)
            word, place = np.r_[word, np.zeros(len(empty), U)], np.r_[place, empty]
        out.append((mix(word ^ mix(np.full(len(place), band, U) * K1 + place.astype(U) * K2)), band, min(spare, 30_000)))
    return out


class Sketches:
    """The words of the sketches of a batch's classes, in order, and an entry for each member of a word, or one for all of many."""

    def __init__(self, b: Batch, sets: list[np.ndarray], rep: np.ndarray, bands: Bands, buckets: int):
        cols: list[list[np.ndarray]] = [[], [], [], []]
        seen: set[tuple[int, bytes]] = set()
        for i in np.flatnonzero((rep == b.ids) & (b.ids != NULL_ID)).tolist():
            if len(sets[i]):
                key = (int(b.ids[i]), sets[i].tobytes())
                if key in seen:
                    continue
                seen.add(key)
                for w, c, s in sketch_words(sets[i], bands):
                    for col, x in zip(cols, (w, np.full(len(w), b.ids[i]), np.full(len(w), c, np.uint8), np.full(len(w), s, np.int16)), strict=True):
                        col.append(x)
        word, doc, band, spare = (np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(cols, (U, np.int64, np.uint8, np.int16), strict=True))
        order = np.lexsort((doc, word))
        self.word, self.doc, self.band, self.spare = word[order], doc[order], band[order], spare[order]
        first = np.flatnonzero(np.r_[True, self.word[1:] != self.word[:-1]]) if len(word) else np.zeros(0, np.int64)
        self.members = np.diff(np.r_[first, len(word)])
        self.of = np.repeat(np.arange(len(first)), self.members)  # number of each member's word
        many = self.members > MOST_IN_BATCH
        lead = np.zeros(len(word), bool)
        lead[first] = True
        self.entry = np.flatnonzero(~many[self.of] | lead)
        self.many = many[self.of[self.entry]]
        self.parts = list(by_bucket(self.word[self.entry], buckets))

    def messages(self):
        for t, i, j in self.parts:
            e = self.entry[i:j]
            yield t, np.uint32(j - i).tobytes() + planes(np.diff(self.word[e], prepend=U(0))) + planes(self.doc[e]) + np.packbits(self.many[i:j]).tobytes()

    def heard(self, got: dict) -> tuple[set[int], np.ndarray, np.ndarray, np.ndarray]:
        """(doc_ids that met another in a word that is not frequent; and of the members of frequent words who cannot do without: word, doc_id, least doc_id)."""
        met: list[np.ndarray] = []
        frequent, least = np.zeros(len(self.members), bool), np.zeros(len(self.members), np.int64)
        for t, i, j in self.parts:
            if (2, t) in got:
                e, r, n = self.entry[i:j], got[2, t], -(-(j - i) // 8)
                met.append(self.doc[e[np.unpackbits(np.frombuffer(r, np.uint8, n), count=j - i) > 0]])
                hot = e[np.unpackbits(np.frombuffer(r, np.uint8, n, n), count=j - i) > 0]
                frequent[self.of[hot]] = True
                least[self.of[hot]] = unplanes(memoryview(r)[2 * n :], len(hot), 8, np.int64)
        at = np.flatnonzero(frequent[self.of])
        order = at[np.lexsort((self.band[at], self.doc[at]))]
        new = np.ones(len(order), bool)
        new[1:] = (self.doc[order][1:] != self.doc[order][:-1]) | (self.band[order][1:] != self.band[order][:-1])
        first = np.flatnonzero(new)
        bound = np.diff(np.r_[first, len(order)]) > np.minimum.reduceat(self.spare[order], first) if len(order) else np.zeros(0, bool)
        use = order[np.repeat(bound, np.diff(np.r_[first, len(order)]))]
        return set(np.concatenate([*met, np.zeros(0, np.int64)]).tolist()) | set(self.doc[use].tolist()), self.word[use], self.doc[use], least[self.of[use]]


class Meetings:
    """The entries of a bucket in order of word and doc_id, and which words are shared and frequent."""

    def __init__(self, messages: list[bytes]):
        self.size = [int(np.frombuffer(m, "<u4", 1)[0]) for m in messages]
        word, doc, many = [], [], []
        for m, n in zip(messages, self.size, strict=True):
            v = memoryview(m)[4:]
            word.append(np.cumsum(unplanes(v, n), dtype=U))
            doc.append(unplanes(v[8 * n :], n, 8, np.int64))
            many.append(np.unpackbits(np.frombuffer(v[16 * n :], np.uint8), count=n))
        word, doc, many = map(np.concatenate, (word, doc, many))
        self.order = np.lexsort((doc, word))
        self.word, self.doc = word[self.order], doc[self.order]
        self.first = np.flatnonzero(np.r_[True, self.word[1:] != self.word[:-1]])
        count = np.diff(np.r_[self.first, len(word)])
        self.of = np.repeat(np.arange(len(self.first)), count)
        lo, hi = (f.reduceat(self.doc, self.first) for f in (np.minimum, np.maximum))
        crowd = np.maximum.reduceat(many[self.order], self.first) > 0
        self.least, self.frequent = lo, crowd | (count > FREQUENT)
        self.shared = (lo != hi) | crowd


def _meet(messages: list[bytes]) -> list[bytes | None]:
    """For each entry whether it met another in a word that is not frequent, whether its word is frequent and shared, and the least doc_id of those."""
    m = Meetings(messages)
    met, hot, least = np.zeros(len(m.order), bool), np.zeros(len(m.order), bool), np.empty(len(m.order), np.int64)
    met[m.order], hot[m.order], least[m.order] = (m.shared & ~m.frequent)[m.of], (m.shared & m.frequent)[m.of], m.least[m.of]
    out, at = [], 0
    for n in m.size:
        x, y = met[at : at + n], hot[at : at + n]
        out.append(np.packbits(x).tobytes() + np.packbits(y).tobytes() + planes(least[at : at + n][y]) if x.any() or y.any() else None)
        at += n
    return out


MEETING = "kind string, doc_id long, n long, rep long, sketch binary, shingles binary, meeting long, least long"
MEETING_ARROW = pa.schema([("kind", pa.string()), *((c, pa.int64()) for c in ("doc_id", "n", "rep")), ("sketch", pa.binary()), ("shingles", pa.binary()), ("meeting", pa.int64()), ("least", pa.int64())])


def _meeting_rows(meeting: np.ndarray, doc: np.ndarray, least: np.ndarray) -> pa.Table:
    known = {"kind": pa.array(["meeting"] * len(doc), pa.string()), "doc_id": pa.array(doc), "meeting": pa.array(meeting.view(np.int64)), "least": pa.array(least)}
    return pa.table([known[f.name] if f.name in known else pa.nulls(len(doc), f.type) for f in MEETING_ARROW], schema=MEETING_ARROW)


def _lists(t: pa.Table) -> pa.Table:
    """A row for each document in each word that it shares and that is not frequent; words that the same few documents share are one."""
    m = Meetings(t.column("message").to_pylist())
    name = mix(np.add.reduceat(mix(m.doc.view(U) ^ K1), m.first))
    at = np.flatnonzero((m.shared & ~m.frequent)[m.of])
    name, doc, least = name[m.of[at]], m.doc[at], m.least[m.of[at]]
    keep = np.unique(np.stack([name, doc.view(U)]), axis=1, return_index=True)[1] if len(at) else at
    return _meeting_rows(name[keep], doc[keep], least[keep])


def _documents(b: Batch, k: int, bands: Bands, buckets: int, got: dict) -> pa.Table:
    sets = shingle_sets(b, k)
    rep = _representatives(b, sets, buckets, got)
    met, word, doc, least = Sketches(b, sets, rep, bands, buckets).heard(got)
    here = [i in met and i == r for i, r in zip(b.ids.tolist(), rep.tolist(), strict=True)]
    held = [planes(s >> U(64 - 8 * SET_BYTES), SET_BYTES) if x else None for x, s in zip(here, sets, strict=True)]
    sketch = [bit_sketch(s) if x else None for x, s in zip(here, sets, strict=True)]
    n = len(sets)
    rows = [pa.array(["document"] * n, pa.string()), b.table.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(rep, pa.int64(), mask=b.ids == NULL_ID), pa.array(sketch, pa.binary()), pa.array(held, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
    return pa.concat_tables([pa.table(rows, schema=MEETING_ARROW), _meeting_rows(word, doc, least)])


def bit_sketch(s: np.ndarray) -> bytes:
    """SKETCH_BITS bits, each the parity of the shingles dealt to it: two sketches differ in no more bits than their sets in shingles."""
    count = np.bincount((mix(s ^ K1) % U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def verify(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of pairs whose sets reach the similarity. Sketches are compared first; the sets follow only where those are near enough."""

    def both(p: DataFrame, *columns: str) -> DataFrame:  # of docs as they are by then
        one = docs.select("doc_id", *columns)
        x = p.join(one, p["a"] == one["doc_id"]).select("a", "b", *[F.col(c).alias(f"a_{c}") for c in columns])
        return x.join(one, x["b"] == one["doc_id"]).select("a", "b", *[f"a_{c}" for c in columns], *[F.col(c).alias(f"b_{c}") for c in columns])

    def near(bs):
        for t in bs:
            n, m = (t.column(c).to_numpy().astype(np.int64) for c in (2, 4))
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(len(n), SKETCH_BITS // 8) for c in (3, 5))
            apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            yield t.select([0, 1]).filter(pa.array(((100 + percent) * apart <= (100 - percent) * (n + m)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))))

    def linked(bs):
        for t in bs:
            ok = np.zeros(t.num_rows, bool)
            n, m = t.column(2).to_pylist(), t.column(4).to_pylist()
            for i, (x, y) in enumerate(zip(t.column(3), t.column(5), strict=True)):
                x, y = unplanes(x.as_buffer(), n[i], SET_BYTES), unplanes(y.as_buffer(), m[i], SET_BYTES)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                ok[i] = 100 * common >= percent * (n[i] + m[i] - common)
            yield t.select([0, 1]).filter(pa.array(ok))

    close = settled(both(pairs, "n", "sketch").mapInArrow(near, "a long, b long").distinct(), "parity")
    # Few of the documents are in a pair that is near enough: only their sets are shuffled.
    ends = settled(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "parity")
    docs = docs.join(F.broadcast(ends) if ends.count() <= MOST_SENT else ends, "doc_id", "left_semi")
    return both(close, "n", "shingles").mapInArrow(linked, "a long, b long").distinct()


def near_in_meetings(members: DataFrame, docs: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """The (a, b) with a < b of members (meeting, doc_id, c, size) of different c in one meeting whose sketches are near enough.

    nearest: of each two c in a block only the pair whose sketches are nearest.

    Sketches are compared in blocks of about BLOCK members, so no pair that is too far apart becomes a row and no meeting, however
    large, is one task: its members are dealt to blocks, and each pair of blocks is a group of its own.
    """
    x = members.join(docs.select("doc_id", "n", "sketch"), "doc_id").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    x = x.withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.select("meeting", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "doc_id", "c", "n", "sketch")

    def run(t: pa.Table) -> pa.Table:
        i, c, n, mine = (t.column(k).to_numpy() for k in ("doc_id", "c", "n", "mine"))
        s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), U).reshape(len(i), SKETCH_BITS // 64)
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        rows, cols = (np.flatnonzero(mine == k) for k in (p, q))
        found = [np.zeros((5, 0), np.int64)]

        def one_each(x: np.ndarray) -> np.ndarray:
            x = x[:, np.lexsort((x[4], x[3], x[2]))]
            new = np.ones(x.shape[1], bool)
            new[1:] = (x[2:4, 1:] != x[2:4, :-1]).any(0)
            return x[:, new]

        for at in range(0, len(rows), 32):
            r = rows[at : at + 32, None]
            ok = (c[r] != c[cols]) & (100 * np.minimum(n[r], n[cols]) >= percent * np.maximum(n[r], n[cols]))
            ok &= (i[r] < i[cols]) if p == q else True
            k, j = np.nonzero(ok)
            u, v = r[k, 0], cols[j]
            apart = np.bitwise_count(s[u] ^ s[v]).sum(1, dtype=np.int64)
            near = (100 + percent) * apart <= (100 - percent) * (n[u] + n[v])
            x = np.stack([np.minimum(i[u], i[v]), np.maximum(i[u], i[v]), np.minimum(c[u], c[v]), np.maximum(c[u], c[v]), apart])[:, near]
            found.append(one_each(x) if nearest else x)
        pairs = np.concatenate(found, axis=1)
        pairs = one_each(pairs) if nearest else pairs
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    return x.groupBy("meeting", "p", "q").applyInArrow(run, "a long, b long").distinct()


def prefix_of(s: np.ndarray, n: int, percent: int, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set of n, as many as it may lack and one more, in an order of all shingles: those that are not frequent first.

    frequent: the frequent ones in order, the rarest first. Sets that reach the similarity have one of these in common, whatever the order.
    """
    by_value = np.argsort(frequent)
    at = np.minimum(np.searchsorted(frequent[by_value], s), max(0, len(frequent) - 1))
    known = frequent[by_value][at] == s if len(frequent) else np.zeros(len(s), bool)
    place = np.where(known, by_value[at] + 1 if len(frequent) else 0, 0)
    return s[np.lexsort((s, place))][: n - -(-n * percent // 100) + 1]


def split_meetings(members: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """members (meeting, doc_id, c, size), those of meetings over SPLIT dealt to a meeting for each shingle of their prefix.

    Frequent are the shingles that more than one in MOST_SHINGLES of all is, so their number, and what is sent of them, is bounded.
    """
    big = members.where(F.col("size") > SPLIT)
    if big.isEmpty():
        return members
    x = settled(big.join(docs.select("doc_id", "n", "shingles"), "doc_id").select("meeting", "doc_id", "c", "n", "shingles"), "parity")

    def shingles(bs):
        for t in bs:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*[unplanes(y.as_buffer(), n, SET_BYTES) for n, y in zip(t.column(0).to_pylist(), t.column(1), strict=True)], np.zeros(0, U)]).view(np.int64))], ["s"])

    counts = x.dropDuplicates(["doc_id"]).select("n", "shingles").mapInArrow(shingles, "s long").groupBy("s").count()
    total = x.agg(F.sum("n")).collect()[0][0]
    hot = counts.where(F.col("count") > total / MOST_SHINGLES).orderBy("count", "s").collect()
    frequent = docs.sparkSession.sparkContext.broadcast(np.array([r["s"] for r in hot], np.int64).view(U))

    def deal(bs):
        for t in bs:
            keys = [prefix_of(unplanes(y.as_buffer(), n, SET_BYTES), n, percent, frequent.value) for n, y in zip(t.column(3).to_pylist(), t.column(4), strict=True)]
            times = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            meeting = mix(np.asarray(t.column(0).take(times)).view(U) * K1 + np.concatenate([*keys, np.zeros(0, U)]))
            yield pa.RecordBatch.from_arrays([pa.array(meeting.view(np.int64)), t.column(1).take(times), t.column(2).take(times)], ["meeting", "doc_id", "c"])

    dealt = settled(x.mapInArrow(deal, "meeting long, doc_id long, c long"), "parity")
    mixed = dealt.groupBy("meeting").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("size")).where("lo <> hi").select("meeting", "size")
    return members.where(F.col("size") <= SPLIT).select("meeting", "doc_id", "c", "size").unionByName(dealt.join(mixed, "meeting").select("meeting", "doc_id", "c", "size"))


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of all ends of links: the least doc_id that is reachable.

    Labels begin as the vertices themselves. In each round a label that meets a lesser one across a link hooks onto the least
    such, and onto where that one hooks; rounds end when both ends of every link agree, and are written and read again.
    """
    edges = settled(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "parity")
    label = edges.select(F.explode(F.array("lo", "hi")).alias("doc_id")).distinct().withColumn("component", F.col("doc_id"))

    def unequal(label: DataFrame) -> DataFrame:
        ends = [label.select(F.col("doc_id").alias(e), F.col("component").alias(f"c_{e}")) for e in ("lo", "hi")]
        return edges.join(ends[0], "lo").join(ends[1], "hi").where("c_lo <> c_hi").select(F.greatest("c_lo", "c_hi").alias("root"), F.least("c_lo", "c_hi").alias("to"))

    while True:
        hook = unequal(label).groupBy("root").agg(F.min("to").alias("to"))
        up = hook.select(F.col("root").alias("to"), F.col("to").alias("top"))
        hook = hook.join(up, "to", "left").select(F.col("root").alias("component"), F.coalesce("top", "to").alias("_to"))
        label = settled(label.join(hook, "component", "left").select("doc_id", F.coalesce("_to", "component").alias("component")), "parity")
        if unequal(label).isEmpty():
            return label


def link_components(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", n_batches: int | None = None, n_buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (the least doc_id of the same set) of each row; a table in the shared folder."""
    kept: list[str] = []
    with scratch(kept):
        out = _link(docs, k, percent, id_col, text_col, n_batches, n_buckets)
        kept.append(scratch_path(docs.sparkSession, "components"))
        with shuffles_dropped(docs.sparkSession):
            out.write.parquet(kept[0])
    return docs.sparkSession.read.schema(out.schema).parquet(kept[0])


def _link(docs, k, percent, id_col, text_col, n_batches, n_buckets) -> DataFrame:
    spark = docs.sparkSession
    if not (n_batches and n_buckets):
        n_batches, n_buckets = sizes(docs, text_col)
    bands, folder = Bands(percent), scratch_path(spark, "parity")
    rows = batches(docs, id_col, text_col, n_batches)

    def classes(b: Batch, _):
        p, q, _, _, one, parts = _classes(b, shingle_sets(b, k), n_buckets)
        for t, i, j in parts:
            yield t, planes(p[one[i:j]]) + planes(q[one[i:j]]) + planes(b.ids[one[i:j]])

    def words(b: Batch, got: dict):
        sets = shingle_sets(b, k)
        return Sketches(b, sets, _representatives(b, sets, n_buckets, got), bands, n_buckets).messages()

    first = answer(ask(rows, classes), 1, _least)
    sent = ask(rows, words, first)
    second = answer(sent, 2, _meet)
    out = finish(rows, first.unionByName(second), lambda b, got: _documents(b, k, bands, n_buckets, got), MEETING)
    with shuffles_dropped(spark):
        out.unionByName(sent.groupBy("bucket").applyInArrow(_lists, MEETING)).write.partitionBy("kind").parquet(folder)
    found = spark.read.schema(MEETING).parquet(folder)
    documents = found.where("kind = 'document'").select("doc_id", "n", "rep", "sketch", "shingles")
    sets = documents.where("shingles is not null").select("doc_id", "n", "sketch", "shingles")
    held = settled(found.where("kind = 'meeting'").select("meeting", "doc_id", "least").distinct(), "parity")

    star = held.where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    tested = settled(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "parity")
    # Rows of one doc_id are one document: their classes are linked.
    several = documents.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("hi")).where("a < hi").select("doc_id", "a")
    links = settled(verify(tested, sets, percent).unionByName(documents.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()), "parity")
    label = components(links)

    def apart(pairs: DataFrame) -> DataFrame:
        x = pairs.join(label.select(F.col("doc_id").alias("a"), F.col("component").alias("ca")), "a", "left").join(label.select(F.col("doc_id").alias("b"), F.col("component").alias("cb")), "b", "left")
        return x.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    more = settled(apart(star.distinct()).join(tested, ["a", "b"], "left_anti"), "parity")
    if not more.isEmpty():
        tested = settled(tested.unionByName(more), "parity")
        links = settled(links.unionByName(verify(more, sets, percent)), "parity")
        label = components(links)
    # What is left: pairs of different components that share a word and were not compared. First the nearest pair of each two
    # components, which joins most of those that belong together; then all pairs of components that are still apart.
    for nearest in (True, False):
        labelled = held.join(label, "doc_id", "left").select("meeting", "doc_id", F.coalesce("component", "doc_id").alias("c"))
        mixed = labelled.groupBy("meeting").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("size")).where("lo <> hi and size > 2").select("meeting", "size")
        members = split_meetings(settled(labelled.join(mixed, "meeting"), "parity"), sets, percent)
        rest = settled(near_in_meetings(members, sets, percent, nearest).join(tested, ["a", "b"], "left_anti"), "parity")
        if not rest.isEmpty():
            tested = settled(tested.unionByName(rest), "parity")
            links = settled(links.unionByName(verify(rest, sets, percent)), "parity")
            label = components(links)
    return documents.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id")).join(label.select(F.col("doc_id").alias("class_id"), "component"), "class_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"), "class_id")


def one_of_each(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are the least doc_id of their component, all columns as they are; rows of null doc_id stay."""
    keep = link_components(docs, k, percent, id_col, text_col).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_linked")).distinct()
    keep = F.broadcast(keep) if keep.count() <= MOST_SENT else keep  # ids alone, so the texts need not be shuffled
    return docs.join(keep, named(docs, id_col).cast("long") == keep["_linked"], "left_anti")
