"""Tokens of two tokenizers over the same bytes: groups between common ends, and links of tokens that overlap.

Each tokenizer's token ends are events. Events of both sides are put in one table, repartitioned by document and sorted by byte
offset within partitions; a machine then streams through them. Each offset where a token ends is one link, that of the tokens
that are open there; an offset where tokens of both sides end closes a group. What the machine keeps between two steps is
the document's totals, its open group and the distinct links that it has seen, whatever the number of documents. Events travel as
runs: a row holds those of one side that end within SPAN bytes of a document, so that a row costs about as much as its tokens.

How many documents hold an id pair linked is counted in two steps: each batch of about BATCH_LINKS distinct links sends its pairs once,
with their number of documents, to hash buckets of pairs, which answer with the sums; so a pair that every document holds costs one
entry a batch. The highest count of each A id is kept in blocks of ids; there is one number for each id of the vocabulary.

A reads space + text, B reads text and adds the space itself. A text that is null or empty, or for which the joined bytes of B are not
space + text (U+2581 in it, or what a normaliser changes), has no tokens. Strings of special tokens are plain text. Rows are kept as they
are: repeated doc_ids, null ones and copies of a row are further documents; an empty table gives an empty one; a text longer than a
slab is one by itself; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import U, memo, mix, planes, slabs, text_buffer, tidy, unplanes
from .frames import settled, slim
from .rank_bpe import CACHE_WORDS, RankBPE, distinct_runs
from .rounds import bucket_of, sizes

SPACE_PIECE = "▁"
#: Bytes of a document whose events travel in one row.
SPAN = 1 << 14
#: Tokens that the machine takes in one step, and distinct links of documents in a batch.
STEP, BATCH_LINKS = 1 << 19, 1 << 22
#: A ids in a block of highest counts.
PEAKS = 1024
EVENTS = "doc_id long, h long, origin int, start long, side byte, n int, events binary"
SWEPT = "bucket int, batch long, docs binary, message binary"
REPLY = "batch long, bucket int, reply binary, block int, peaks binary"
DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PieceBPE:
    """A SentencePiece model behind a cache of parts of texts.

    A text is cut between two characters that stand next to each other in no piece: no merge crosses such a place, so parts are
    encoded by themselves. Pairs with a character beyond ASCII are only cut before a space.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
        plain = [p.replace(SPACE_PIECE, " ") for i, p in enumerate(pieces) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        self.together = np.zeros((128, 128), bool)
        before_space = set()
        for p in plain:
            for a, b in zip(p, p[1:], strict=False):
                if a < "\x80" and b < "\x80":
                    self.together[ord(a), ord(b)] = True
                if b == " ":
                    before_space.add(a)
        self.cut_spaces = before_space <= {" "}
        used = set("".join(plain))
        self.mark = next(c for c in "\n\t\x01\x02" if c not in used)  # stands before a part, so that the model's own space is not the part's
        self.skip = len(self.model.encode(self.mark))
        self.parts: dict[bytes, bytes] = {}

    def _learn(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts, none where they do not spell the part."""
        out = []
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            for part, ids in zip(some, self.model.encode([self.mark + p.decode(errors="replace") for p in some], num_threads=1), strict=True):
                ids = ids[self.skip :]
                out.append(np.array(ids, "<u4").tobytes() if b"".join([self.bytes[i] for i in ids]) == part else b"")
        return out

    def encode_flat(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of texts that begin with a space, none of them empty."""
        mark = np.zeros(len(buf), bool)
        mark[offs[:-1]] = True
        if len(buf) and self.cut_spaces:
            a, b = buf[:-1], buf[1:]
            mark[1:] |= ((a < 128) & (b < 128) & ~self.together[a & 127, b & 127]) | ((b == 0x20) & (a != 0x20))
        start = np.flatnonzero(mark)
        end = np.r_[start[1:], len(buf)] if len(start) else start
        row = np.searchsorted(offs, start, "right") - 1
        code, first = distinct_runs(buf, start, end)
        raw = buf.tobytes()
        parts = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        found = list(map(self.parts.get, parts))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            for i, ids in zip(new, self._learn([parts[i] for i in new]), strict=True):
                found[i] = ids
            if len(self.parts) + len(new) > CACHE_WORDS:
                self.parts = {}
            self.parts.update((parts[i], found[i]) for i in new[-CACHE_WORDS:] if len(parts[i]) <= 64)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, begin, each = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size, size[code]
        after = np.cumsum(each)
        ids = pool[np.repeat(begin[code] - (after - each), each) + np.arange(int(each.sum()))]
        return ids, np.r_[0, np.cumsum(np.bincount(row, each, len(offs) - 1).astype(np.int64))]


class Pair:
    """Both tokenizers of a worker."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = RankBPE(a_path), PieceBPE(b_path)
        self.a.special, self.a.split_special = {}, None  # plain text
        self.size = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        self.length_width = [1 + (int(s.max()) > 255) for s in self.size]
        self.id_width = [max(1, -(-len(s).bit_length() // 8)) for s in self.size]


def pair(a_path: str, b_path: str) -> Pair:
    return memo(f"pair {a_path} {b_path}", lambda: Pair(a_path, b_path))


class Vocabularies(NamedTuple):
    a_path: str
    b_path: str


def _codec() -> pa.Codec:
    return memo("zstd", lambda: pa.Codec("zstd", compression_level=1))


def _squeezed(*parts: bytes) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + _codec().compress(raw, asbytes=True)


def _opened(b: bytes) -> memoryview:
    return memoryview(_codec().decompress(b[8:], int.from_bytes(b[:8], "little"), asbytes=True))


def events(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """EVENTS of both sides of all rows, each document whole: a row without events stands for one without tokens. h tells texts of one doc_id apart, origin the tasks that read copies of a row."""

    def run(batches):
        both, origin = pair(*vocabularies), TaskContext.get().partitionId()
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for x, y in slabs(offs):
                yield from _slab(both, origin, batch.slice(x, y - x), buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])

    return slim(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, EVENTS)


def _slab(both: Pair, origin: int, rows: pa.RecordBatch, buf: np.ndarray, offs: np.ndarray):
    size = np.diff(offs)
    full = np.flatnonzero(size)
    at = np.r_[0, np.cumsum(size[full] + 1)]
    spaced = np.full(int(at[-1]), 0x20, np.uint8)
    keep = np.ones(len(spaced), bool)
    keep[at[:-1]] = False
    spaced[keep] = buf
    sides = []
    ok = np.ones(len(full), bool)
    for k, side in enumerate((both.a, both.b)):
        ids, cut = side.encode_flat(spaced, at) if len(full) else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        ends = np.cumsum(both.size[k][ids])
        total = np.r_[0, ends][cut]
        ok &= np.diff(total) == np.diff(at)
        sides.append((ids, cut, both.size[k][ids], ends, total))
    row, start, name, count, payload = [], [], [], [], []
    for k, (ids, cut, length, ends, total) in enumerate(sides):
        for i in np.flatnonzero(ok).tolist():
            a, z = int(cut[i]), int(cut[i + 1])
            spans = [a, *(a + np.searchsorted(ends[a:z], total[i] + np.arange(SPAN, at[i + 1] - at[i], SPAN), "right")).tolist(), z]
            for s, (f, t) in enumerate(zip(spans, spans[1:], strict=False)):
                if f < t:
                    row.append(full[i])
                    start.append(s * SPAN)
                    name.append(k)
                    count.append(t - f)
                    payload.append(_codec().compress(planes(length[f:t], both.length_width[k]) + planes(ids[f:t], both.id_width[k]), asbytes=True))
    bare = np.setdiff1d(np.arange(len(size)), full[ok])
    n = len(bare)
    take = pa.array(np.r_[np.array(row, np.int64), bare])
    yield pa.RecordBatch.from_arrays([
        rows.column(0).take(take), rows.column(2).take(take), pa.array(np.full(len(take), origin, np.int32)), pa.array(np.r_[start, np.zeros(n)].astype(np.int64)),
        pa.array(np.r_[name, np.zeros(n)].astype(np.int8)), pa.array(np.r_[count, np.zeros(n)].astype(np.int32)), pa.array([*payload, *[b""] * n], pa.binary()),
    ], ["doc_id", "h", "origin", "start", "side", "n", "events"])


def in_order(found: DataFrame) -> DataFrame:
    """EVENTS with each document in one partition, in order of offset."""
    key = ["doc_id", "h", "origin"]
    return found.repartition(*key).sortWithinPartitions(*key, "start", "side")


class Step(NamedTuple):
    """Whole groups of one or more documents, whose bytes follow each other as if they were one.

    documents: (key, copies, bytes before this step, whether it begins here) of each; to: byte where each ends.
    ends, ids: of each side. link_a, link_b: places of linked tokens; link_to: links before the end of each document. shared: common ends.
    """

    documents: list
    to: np.ndarray
    ends: list
    ids: list
    link_a: np.ndarray
    link_b: np.ndarray
    link_to: np.ndarray
    shared: np.ndarray


def sweep(batches, both: Pair):
    """Steps over sorted EVENTS. A document without tokens is one of no bytes; a document may go on in the next step."""
    last, held, tokens, carried = None, [], 0, None

    def step(final: bool):
        nonlocal held, tokens, carried
        docs, parts = [], []
        for key, copies, k, n, payload in held:
            if not docs or docs[-1][0] != key:
                more = carried if carried and carried[0] == key else None
                docs.append([key, copies, more[2] if more else 0, not more])
                parts.append([[x] for x in more[1]] if more else [[], []])
            docs[-1][1] = copies
            if n:
                raw, w = memoryview(_codec().decompress(payload, n * (both.length_width[k] + both.id_width[k]), asbytes=True)), both.length_width[k]
                parts[-1][k].append(np.stack([unplanes(raw, n, w), unplanes(raw[n * w :], n, both.id_width[k])]).astype(np.int64))
        flat = [[np.concatenate(p[k], axis=1) if p[k] else np.zeros((2, 0), np.int64) for k in (0, 1)] for p in parts]
        carried = None
        if flat and not final:  # of the last document only whole groups are taken
            (a, b), (key, _, before, _) = flat[-1], docs[-1]
            common = np.intersect1d(ea := np.cumsum(a[0]), eb := np.cumsum(b[0]), assume_unique=True)
            end = int(common[-1]) if len(common) else 0
            i, j = np.searchsorted(ea, end, "right"), np.searchsorted(eb, end, "right")
            flat[-1] = [a[:, :i], b[:, :j]]
            carried = (key, [a[:, i:], b[:, j:]], before + end)
        held, tokens = [], sum(x.shape[1] for x in carried[1]) if carried else 0
        size = [np.concatenate([f[k][0] for f in flat]) for k in (0, 1)]
        ids = [np.concatenate([f[k][1] for f in flat]) for k in (0, 1)]
        ends = [np.cumsum(s) for s in size]
        to = np.cumsum([int(f[0][0].sum()) for f in flat])
        ended = np.zeros((2, int(to[-1]) + 1), bool)
        ended[0][ends[0]] = True
        ended[1][ends[1]] = True
        event = np.flatnonzero(ended[0] | ended[1])
        here = ended[:, event]
        link = np.cumsum(here, axis=1) - here
        return Step(docs, to, ends, ids, link[0], link[1], np.searchsorted(event, to, "right"), event[here[0] & here[1]])

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(6)]
        for i, (doc, h, origin, start, side, n) in enumerate(zip(*cols, strict=True)):
            place = ((doc, h, origin), start, side)
            if place == last:
                if start == 0 and side == 0:
                    held[-1][1] += 1
                continue
            if tokens >= STEP and tokens >= 2 * (sum(x.shape[1] for x in carried[1]) if carried else 0):
                copies = held[-1][1]
                yield step(False)
            copies = 1 if last is None or last[0] != place[0] else held[-1][1] if held else copies
            held.append([place[0], copies, side, n, batch.column(6)[i].as_py()])
            last, tokens = place, tokens + n
    if held:
        yield step(True)


def _decimals(both: Pair) -> tuple[np.ndarray, np.ndarray]:
    """Each id in decimal, left-bound, with room for a separator; number of digits."""
    n = max(len(s) for s in both.size)
    digits = np.array([len(str(i)) for i in range(n)])
    table = np.zeros((n, int(digits.max()) + 1), np.uint8)
    for i in range(n):
        table[i, : digits[i]] = list(str(i).encode())
    return table, digits


def group_texts(step: Step, both: Pair) -> list[bytes]:
    """Groups of each document of a step, as `a1,a2|b1;a3|b2,b3`."""
    table, digits = memo("decimals", lambda: _decimals(both))
    (ea, eb), (na, nb) = step.ends, (len(step.ids[0]), len(step.ids[1]))
    if not na:
        return [b""] * len(step.to)
    la, lb = np.searchsorted(ea, step.shared), np.searchsorted(eb, step.shared)  # last token of each group
    ga, gb = np.searchsorted(step.shared, ea), np.searchsorted(step.shared, eb)
    ids, mark = np.empty(na + nb, np.int64), np.full(na + nb, ord(","), np.uint8)
    at_a, at_b = np.arange(na) + np.r_[0, lb + 1][ga], np.arange(nb) + (la + 1)[gb]
    ids[at_a], ids[at_b] = step.ids
    mark[at_a[la]], mark[at_b[lb]] = ord("|"), ord(";")
    n = digits[ids]
    rows = table[ids]
    rows[np.arange(len(ids)), n] = mark
    raw = rows[np.arange(table.shape[1]) <= n[:, None]].tobytes()
    size = np.r_[0, np.cumsum(n + 1)]
    to = size[np.searchsorted(ea, step.to, "right") + np.searchsorted(eb, step.to, "right")].tolist()
    return [raw[s : max(s, e - 1)] for s, e in zip([0, *to], to, strict=False)]


class _Document:
    """What is known of the document that may go on."""

    def __init__(self, key, copies: int):
        self.key, self.copies, self.n = key, copies, np.zeros(4, np.int64)
        self.sha, self.codes, self.times = hashlib.sha256(), [], []

    def add(self, n: np.ndarray, text: bytes, codes: np.ndarray, times: np.ndarray) -> None:
        if text:
            self.sha.update(b";" + text if self.n[2] else text)
        self.n += n
        self.codes.append(codes)
        self.times.append(times)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) == 1:
            return self.codes[0], self.times[0]
        codes, place = np.unique(np.concatenate(self.codes), return_inverse=True)
        return codes, np.bincount(place, np.concatenate(self.times), len(codes)).astype(np.int64)


def documents(batches, both: Pair, texts: bool = True):
    """_Documents in order of their events, each with its distinct links by code (A id x size of B + B id)."""
    width, now = len(both.size[1]), None
    for step in sweep(batches, both):
        count = np.stack([*(np.diff(np.r_[0, np.searchsorted(x, step.to, "right")]) for x in (*step.ends, step.shared)), np.diff(np.r_[0, step.link_to])], axis=1)
        whose = np.repeat(np.arange(len(step.to)), count[:, 3])
        code = np.sort(whose * (len(both.size[0]) * width) + step.ids[0][step.link_a] * width + step.ids[1][step.link_b])
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        times = np.diff(np.r_[first, len(code)])
        code = code[first]
        cut = np.r_[0, np.cumsum(np.bincount(code // (len(both.size[0]) * width), minlength=len(step.to)))]
        code %= len(both.size[0]) * width
        text = group_texts(step, both) if texts else [b""] * len(step.to)
        for i, (key, copies, _, begins) in enumerate(step.documents):
            if begins:
                if now:
                    yield now
                now = _Document(key, copies)
            now.copies = copies
            now.add(count[i], text[i], code[cut[i] : cut[i + 1]], times[cut[i] : cut[i + 1]])
    if now:
        yield now


def token_groups(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each group of each document: bytes [start, end) of space + text, and the ids of either side."""

    def run(batches):
        both = pair(*vocabularies)
        for step in sweep(batches, both):
            lists = []
            for ends, ids in zip(step.ends, step.ids, strict=True):
                lists.append((np.r_[0, np.searchsorted(ends, step.shared, "right")], ids.astype(np.int32)))
            whose = np.searchsorted(step.to, step.shared)
            base = np.r_[0, step.to][whose] - np.array([d[2] for d in step.documents], np.int64)[whose]
            start = np.maximum(np.r_[0, step.shared[:-1]], np.r_[0, step.to][whose]) if len(step.shared) else step.shared
            copy = np.repeat(np.arange(len(whose)), np.array([d[1] for d in step.documents], np.int64)[whose])
            if len(copy):
                columns = [pa.array([d[0][0] for d in step.documents], pa.int64()).take(pa.array(whose)), pa.array(start - base), pa.array(step.shared - base)]
                columns += [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids)) for cut, ids in lists]
                yield pa.RecordBatch.from_arrays([c.take(pa.array(copy)) for c in columns], ["doc_id", "start", "end", "a_ids", "b_ids"])

    return in_order(events(docs, vocabularies, id_col, text_col)).mapInArrow(run, "doc_id long, start long, end long, a_ids array<int>, b_ids array<int>")


def token_links(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a_id, b_id and how often the two are linked in the document."""

    def run(batches):
        both = pair(*vocabularies)
        for d in documents(batches, both, texts=False):
            codes, times = d.links()
            for _ in range(d.copies):
                yield pa.RecordBatch.from_arrays([pa.array([d.key[0]] * len(codes), pa.int64()), pa.array((codes // len(both.size[1])).astype(np.int32)), pa.array((codes % len(both.size[1])).astype(np.int32)), pa.array(times)], ["doc_id", "a_id", "b_id", "times"])

    return in_order(events(docs, vocabularies, id_col, text_col)).mapInArrow(run, "doc_id long, a_id int, b_id int, times long")


HEAD = np.dtype([("doc", "<i8"), ("null", "u1"), ("copies", "<u4"), ("n", "<i8", 4), ("links", "<u4"), ("sha", "S64")])


def _batch(found: list[_Document], number: int, n_buckets: int) -> pa.RecordBatch:
    """A row with what is known of documents, and a message for each bucket that has pairs of theirs."""
    links = [d.links() for d in found]
    head = np.array([(d.key[0] or 0, d.key[0] is None, d.copies, d.n, len(c), d.sha.hexdigest().encode() if d.n[0] else b"") for d, (c, _) in zip(found, links, strict=True)], HEAD)
    codes, times = (np.concatenate([x[k] for x in links]) for k in (0, 1))
    distinct, place = np.unique(codes, return_inverse=True)
    n_docs = np.bincount(place, np.repeat(head["copies"], head["links"]), len(distinct)).astype(np.int64)
    step = np.diff(place, prepend=0)
    first = np.cumsum(head["links"]) - head["links"]
    step[first[head["links"] > 0]] = place[first[head["links"] > 0]]
    docs = _squeezed(np.array([len(head), len(codes), len(distinct)], "<i8").tobytes(), head.tobytes(), planes(step, 4), planes(times, 4), planes(np.diff(distinct, prepend=0), 5))
    bucket = bucket_of(mix(distinct.astype(U)), n_buckets)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    to = np.flatnonzero(np.diff(cut)).tolist()
    sent = [_squeezed(len(x := order[cut[b] : cut[b + 1]]).to_bytes(8, "little"), planes(np.diff(distinct[x], prepend=0), 5), planes(n_docs[x], 5)) for b in to]
    n = 1 + len(to)
    return pa.RecordBatch.from_arrays([pa.array([-1, *to], pa.int32()), pa.array([number] * n, pa.int64()), pa.array([docs, *[None] * len(to)], pa.binary()), pa.array([None, *sent], pa.binary())], ["bucket", "batch", "docs", "message"])


def _sum_up(t: pa.Table, width: int) -> pa.Table:
    """Answers of a bucket, a number for each pair of each message, and the highest count of A ids here."""
    seen = []
    for m in t.column("message"):
        raw = _opened(m.as_py())
        n = int.from_bytes(raw[:8], "little")
        seen.append((np.cumsum(unplanes(raw[8:], n, 5, np.int64)), unplanes(raw[8 + 5 * n :], n, 5, np.int64)))
    codes, place = np.unique(np.concatenate([c for c, _ in seen]), return_inverse=True)
    total = np.bincount(place, np.concatenate([c for _, c in seen]), len(codes)).astype(np.int64)
    cut = np.cumsum([0, *(len(c) for c, _ in seen)]).tolist()
    replies = [_squeezed(planes(total[place[a:z]], 5)) for a, z in zip(cut, cut[1:], strict=False)]
    a_id, at = np.unique(codes // width, return_index=True)
    peak = np.maximum.reduceat(total, at)
    block, where = np.unique(a_id // PEAKS, return_index=True)
    ends = [*where[1:].tolist(), len(a_id)]
    peaks = [_peaks(a_id[x:y], peak[x:y]) for x, y in zip(where.tolist(), ends, strict=True)]
    r, p = len(replies), len(peaks)
    bucket = t.column("bucket")[0].as_py()
    tidy()
    return pa.table({"batch": pa.array([*t.column("batch").to_pylist(), *[None] * p], pa.int64()), "bucket": pa.array([bucket] * (r + p), pa.int32()), "reply": pa.array([*replies, *[None] * p], pa.binary()), "block": pa.array([*[None] * r, *block.tolist()], pa.int32()), "peaks": pa.array([*[None] * r, *peaks], pa.binary())})


def _peaks(a_id: np.ndarray, peak: np.ndarray) -> bytes:
    full = np.zeros(PEAKS, np.int64)
    full[a_id % PEAKS] = peak
    return full.tobytes()


def _highest(t: pa.Table) -> pa.Table:
    full = np.maximum.reduce([np.frombuffer(x.as_py(), np.int64) for x in t.column("peaks")])
    return pa.table({"block": t.column("block").slice(0, 1), "peaks": pa.array([full.tobytes()], pa.binary())})


def _judged(docs: bytes, replies: dict[int, bytes], highest: np.ndarray, width: int, n_buckets: int) -> pa.Table:
    raw = _opened(docs)
    n_docs, n_links, n_pairs = np.frombuffer(raw, "<i8", 3).tolist()
    head = np.frombuffer(raw, HEAD, n_docs, 24)
    at = 24 + head.nbytes
    step, times = unplanes(raw[at:], n_links, 4, np.int64), unplanes(raw[at + 4 * n_links :], n_links, 4, np.int64)
    distinct = np.cumsum(unplanes(raw[at + 8 * n_links :], n_pairs, 5, np.int64))
    bucket = bucket_of(mix(distinct.astype(U)), n_buckets)
    order = np.argsort(bucket, kind="stable")
    count = np.zeros(n_pairs, np.int64)
    cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(cut)).tolist():
        count[order[cut[b] : cut[b + 1]]] = unplanes(_opened(replies[b]), int(cut[b + 1] - cut[b]), 5, np.int64)
    best = count == highest[distinct // width]
    ends = np.cumsum(head["links"].astype(np.int64))
    place = np.cumsum(step)
    begin = ends - head["links"]
    before = np.r_[0, place][begin]  # steps begin anew with each document
    place -= np.repeat(before, head["links"])
    sums = [np.r_[0, np.cumsum(x)] for x in (times * best[place], times * count[place])]
    columns = [head["n"][:, 0], head["n"][:, 1], head["n"][:, 2], head["n"][:, 3], *(s[ends] - s[begin] for s in sums)]
    table = pa.table({"doc_id": pa.array(head["doc"], pa.int64(), mask=head["null"] > 0)} | {k: pa.array(np.ascontiguousarray(c), pa.int64()) for k, c in zip(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), columns, strict=True)} | {"groups_sha256": pa.array([x.decode() for x in head["sha"].tolist()], pa.string())})
    tidy()
    return table.take(pa.array(np.repeat(np.arange(n_docs), head["copies"])))


def alignment(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: numbers of tokens, groups and links, links whose pair is the most frequent of its A id, the sum of pair counts over links, a digest of the groups."""
    n_buckets = sizes(docs, text_col)[1]

    def swept(batches):
        both, found, links, number = pair(*vocabularies), [], 0, TaskContext.get().partitionId() << 32
        for d in documents(batches, both):
            found.append(d)
            links += sum(map(len, d.codes)) + 64
            if links >= BATCH_LINKS:
                yield _batch(found, number, n_buckets)
                found, links, number = [], 0, number + 1
                tidy()
        if found:
            yield _batch(found, number, n_buckets)

    held = settled(in_order(events(docs, vocabularies, id_col, text_col)).mapInArrow(swept, SWEPT), "swept")

    def total(t: pa.Table) -> pa.Table:
        return _sum_up(t, len(pair(*vocabularies).size[1]))

    told = settled(held.where("bucket >= 0").select("bucket", "batch", "message").groupBy("bucket").applyInArrow(total, REPLY), "pair_counts")
    peaks = told.where("block is not null").select("block", "peaks").groupBy("block").applyInArrow(_highest, "block int, peaks binary").collect()  # a number for each id of A
    highest = np.zeros((max([r["block"] for r in peaks], default=0) + 1) * PEAKS, np.int64)
    for r in peaks:
        highest[r["block"] * PEAKS : (r["block"] + 1) * PEAKS] = np.frombuffer(r["peaks"], np.int64)

    def judge(t: pa.Table, r: pa.Table) -> pa.Table:
        replies = dict(zip(r.column("bucket").to_pylist(), r.column("reply").to_pylist(), strict=True))
        width = len(pair(*vocabularies).size[1])
        return _judged(t.column("docs")[0].as_py(), replies, highest, width, n_buckets)

    whole = held.where("bucket < 0").select("batch", "docs").groupBy("batch")
    return whole.cogroup(told.where("batch is not null").select("batch", "bucket", "reply").groupBy("batch")).applyInArrow(judge, DIGEST)
