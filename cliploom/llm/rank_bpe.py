"""Byte-level BPE by contiguous rank arrays.

A short word is a row of parts with the rank of each adjacent pair beside it. The lowest rank is found by a
scan, its right boundary is deleted, and the two neighbouring ranks are refreshed, until no pair has a rank.
Many distinct words are held as rows of one matrix, so each step works on all of them at once. Parts of texts are told
apart by their bytes, in a slab and in the worker's cache, so each distinct part is encoded once.

Nulls are empty texts; an empty text has no tokens; an empty table gives none. A text longer than a slab is a slab by itself. Extra
columns, whatever their names, are ignored; rows are kept as they are, repeated ids included. Ranks are distinct, so equal ranks are
those of one pair, and the leftmost is merged first.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import U, lanes_of, memo, runs_equal, slabs, span_hash, text_buffer
from .frames import slim

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.int32(2**31 - 1)
#: Entries of a worker's word cache; it starts anew when full, so memory is bounded and results do not change.
CACHE_WORDS = 200_000
#: Longer words go through the scan one by one.
MATRIX_WIDTH = 48


LETTER, DIGIT, SPACE, WHITE, MARK, OTHER = range(6)


def _byte_kinds() -> np.ndarray:
    kind = np.full(256, MARK, np.uint8)
    kind[0x80:] = OTHER
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
    kind[0x30:0x3A] = DIGIT
    kind[0x20], kind[0x09:0x0E], kind[0x27] = SPACE, WHITE, OTHER
    return kind


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file: itself if printable in Latin-1, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    out.update({chr(0x100 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


class RankBPE:
    """Encoder and decoder for one vocabulary file in the JSON form of the tokenizers library."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if spec.get("normalizer") or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model["type"] != "BPE" or model.get("ignore_merges") or spec["decoder"]["type"] != "ByteLevel":
            raise ValueError("only byte-level BPE without normaliser is supported")
        chars, vocab = byte_alphabet(), model["vocab"]
        self.bytes = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(chars[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.of_byte[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[m[s]] for m in merges], np.int64) for s in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self._table(left * len(self.bytes) + right)
        self.split = regex.compile(PATTERN)
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}
        self.flat = None

    def _table(self, keys: np.ndarray) -> None:
        """Open-addressed table from a pair of ids to its rank."""
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        size = 1 << self.bits
        self.slot_key, self.slot_rank = np.full(size, -1, np.int64), np.full(size, NO_RANK, np.int32)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = keys[left[free]]
            mine = self.slot_key[at] == keys[left]
            self.slot_rank[at[mine]] = np.minimum(self.slot_rank[at[mine]], left[mine])
            left, at = left[~mine], (at[~mine] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_RANK where it has none or an id is below 0."""
        keys = np.where((left < 0) | (right < 0), -2, left.astype(np.int64) * len(self.bytes) + right).ravel()
        at = self._slot(keys)
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.flatnonzero(keys >= 0)
        at = at[todo]
        while len(todo):
            found = self.slot_key[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.slot_rank[at[hit]]
            on = ~hit & (found >= 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.slot_key) - 1)
        return out.reshape(left.shape)

    def _merge_long(self, word: bytes) -> bytes:
        """A word beyond the matrix: a list of parts, the lowest rank first by a heap so that very long words stay near-linear."""
        import heapq

        ids = self.of_byte[np.frombuffer(word, np.uint8)]
        rank = self.rank(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(rank[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(rank != NO_RANK).tolist()]
        heapq.heapify(heap)
        known = memo(f"pair_rank_{id(self)}", dict)

        def push(i: int) -> None:
            j = after[i]
            if i < 0 or j >= n:
                return
            pair = (ids[i], ids[j])
            if pair not in known:
                if len(known) > CACHE_WORDS:
                    known.clear()
                known[pair] = int(self.rank(np.array([pair[0]]), np.array([pair[1]]))[0])
            if known[pair] != NO_RANK:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(self.merged[r]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(size > MATRIX_WIDTH).tolist():
            out[i] = self._merge_long(words[i])
        order = np.argsort(size, kind="stable")
        order = order[(size[order] > 0) & (size[order] <= MATRIX_WIDTH)]
        for at in range(0, len(order), 20_000):
            some = order[at : at + 20_000]
            for i, ids in zip(some.tolist(), self._merge_rows([words[i] for i in some.tolist()], size[some]), strict=True):
                out[i] = ids
        return out

    def _merge_rows(self, words: list[bytes], size: np.ndarray) -> list[bytes]:
        n, width = len(words), int(size.max())
        flat = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        parts = np.full((n, width + 1), -1, np.int32)
        parts[np.arange(width + 1) < size[:, None]] = flat
        ranks = np.full((n, width + 1), NO_RANK, np.int32)
        ranks[:, :-1] = self.rank(parts[:, :-1], parts[:, 1:])
        live = np.flatnonzero(ranks.min(1) != NO_RANK)
        P, R, done = parts[live], ranks[live], parts
        col = np.arange(width + 1)
        while len(live):
            k = R.argmin(1)
            row = np.arange(len(live))
            P[row, k] = self.merged[R[row, k]]
            past = col[None, :-1] > k[:, None]  # delete boundary k + 1
            np.copyto(P[:, :-1], P[:, 1:].copy(), where=past)
            P[:, -1] = -1
            np.copyto(R[:, :-1], R[:, 1:].copy(), where=past)
            R[:, -1] = NO_RANK
            R[row, k] = self.rank(P[row, k], P[row, np.minimum(k + 1, width)])
            prev = np.flatnonzero(k > 0)
            R[prev, k[prev] - 1] = self.rank(P[prev, k[prev] - 1], P[prev, k[prev]])
            on = R.min(1) != NO_RANK
            if not on.all():
                done[live[~on]] = P[~on]
                live, P, R = live[on], P[on], R[on]
        held = done >= 0
        flat = done[held].astype("<u4").tobytes()
        ends = np.cumsum(held.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of texts that are split on their own."""
        out: list[bytes] = [b""] * len(chunks)
        text = [c.decode() for c in chunks]
        word = [i for i, t in enumerate(text) if t[1:].isalpha() and (t[0] == " " or t[0].isalpha())]  # letters, or a space and letters, are one piece
        for i, ids in zip(word, self.merge([chunks[i] for i in word]), strict=True):
            out[i] = ids
        whole = set(word)
        rest = [i for i in range(len(chunks)) if i not in whole]
        split = [self.split.findall(text[i]) for i in rest]
        new = list({p for ps in split for p in ps} - self.pieces.keys())
        if len(self.pieces) + len(new) > CACHE_WORDS:
            self.pieces = {}
            new = list({p for ps in split for p in ps})
        self.pieces.update(zip(new, self.merge([p.encode() for p in new]), strict=True))
        get = self.pieces.__getitem__
        for i, ps in zip(rest, split, strict=True):
            out[i] = b"".join(map(get, ps))
        return out

    def encode_flat(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of texts in one UTF-8 buffer, as the library gives them with add_special_tokens=False.

        A space before another character always begins a piece, so a text without two spaces in a row is cut
        before each space and then where the kind of character changes, and each distinct part is encoded once;
        other texts go through the pattern whole.
        """
        n = len(offs) - 1
        raw = buf.tobytes()
        space = buf == 0x20
        odd = np.zeros(n, bool)
        odd[np.searchsorted(offs, np.flatnonzero(space[:-1] & space[1:]), "right") - 1] = True
        for s in self.special:
            at = raw.find(s.encode())
            while at >= 0:
                odd[np.searchsorted(offs, at, "right") - 1] = True
                at = raw.find(s.encode(), at + 1)
        mark = space
        mark[offs[:-1][np.diff(offs) > 0]] = True
        hard = self._cut_words(buf, mark)
        start = np.flatnonzero(mark)
        row = np.searchsorted(offs, start, "right") - 1
        end = np.r_[start[1:], len(buf)] if len(start) else start
        use = ~odd[row]
        start, end, row = start[use], end[use], row[use]
        code, first = distinct_runs(buf, start, end)
        words = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        found = list(map(self.chunks.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            whole = hard[start[first[new]]]
            plain, mixed = [i for i, h in zip(new, whole.tolist(), strict=True) if not h], [i for i, h in zip(new, whole.tolist(), strict=True) if h]
            for i, x in zip(plain + mixed, [*self.merge([words[i] for i in plain]), *self._learn([words[i] for i in mixed])], strict=True):
                found[i] = x
            if len(self.chunks) + len(new) > CACHE_WORDS:
                self.chunks = {}
            self.chunks.update((words[i], found[i]) for i in new[-CACHE_WORDS:])
        pool = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        each = size[code]
        after = np.cumsum(each)
        ids = pool[np.repeat(begin[code] - (after - each), each) + np.arange(int(each.sum()))]
        count = np.bincount(row, each, n).astype(np.int64)
        cut = np.r_[0, np.cumsum(count)]
        if not odd.any():
            return ids, cut
        parts = []
        for i in range(n):
            x = ids[cut[i] : cut[i + 1]]
            if odd[i]:
                x = np.frombuffer(self._encode_odd(raw[offs[i] : offs[i + 1]].decode()), "<u4")
                count[i] = len(x)
            parts.append(x)
        return np.concatenate(parts), np.r_[0, np.cumsum(count)]

    @staticmethod
    def _cut_words(buf: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Adds to mark (starts of parts) the places where the pattern surely cuts a part: letters, digits and other marks apart, each
        white character alone. Gives the bytes of parts that are left whole, for the pattern itself: those with an apostrophe, two white
        characters in a row, or letters beyond Latin-1.
        """
        kind = memo("bpe_kinds", _byte_kinds)[buf]
        if not len(buf):
            return np.zeros(0, bool)
        unsure = kind == OTHER
        lead = np.flatnonzero(buf == 0xC3)  # U+00C0 to U+00FF: all letters but the signs of multiplication and division
        after = buf[np.minimum(lead + 1, len(buf) - 1)]
        good = lead[(after != 0x97) & (after != 0xB7)]
        unsure[good] = False
        unsure[np.minimum(good + 1, len(buf) - 1)] = False
        kind[buf >= 0x80] = LETTER
        white = (kind == SPACE) | (kind == WHITE)
        unsure[1:] |= white[1:] & white[:-1] & ~(mark[1:] & (kind[1:] == SPACE))
        part = np.cumsum(mark) - 1
        hard = np.zeros(int(part[-1]) + 1, bool)
        hard[part[unsure]] = True
        hard = hard[part]
        cut = np.zeros(len(buf), bool)
        cut[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)
        mark |= cut & ~hard
        return hard

    def _encode_odd(self, text: str) -> bytes:
        parts = self.split_special.split(text) if self.split_special else [text]
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else b"".join(self._learn([p.encode()])) for p in parts if p)

    def decode_flat(self, ids: np.ndarray, cut: np.ndarray) -> list[bytes]:
        """UTF-8 of the text of each run of ids; bytes that are no UTF-8 become U+FFFD."""
        if self.flat is None:
            size = np.array([len(b) for b in self.bytes], np.int64)
            self.flat = np.frombuffer(b"".join(self.bytes), np.uint8), np.cumsum(size) - size, size
        pool, begin, size = self.flat
        each = size[ids]
        after = np.r_[0, np.cumsum(each)]
        raw = pool[np.repeat(begin[ids] - after[:-1], each) + np.arange(int(after[-1]))].tobytes()
        ends = after[cut].tolist()
        out = [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for i, x in enumerate(out):
            try:
                x.decode()
            except UnicodeDecodeError:
                out[i] = x.decode(errors="replace").encode()
        return out


def distinct_runs(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each run among the distinct ones, a place of each distinct one).

    A run of up to seven bytes is its own key; of longer ones a hash is the key, and their bytes are compared with those of the
    first that has it, so that two different runs are never taken for one.
    """
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lanes, size = lanes_of(buf), end - start
    key = (lanes[start] & ~(U(0xFF) << U(56))) & ((U(1) << (U(8) * np.minimum(size, 7).astype(U))) - U(1)) | size.astype(U) << U(56)
    big = np.flatnonzero(size > 7)
    key[big] = span_hash(buf, start[big], end[big], lanes) | U(0xFF) << U(56)
    code, distinct = pd.factorize(key)
    first = np.empty(len(distinct), np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    one = first[code[big]]
    same = size[big] == size[one]
    same[same] = runs_equal(buf, start[big][same], start[one][same], size[big][same], lanes)
    if not same.all():
        more: dict[bytes, int] = {}
        places = first.tolist()
        for i in big[~same].tolist():
            run = buf[start[i] : end[i]].tobytes()
            if run not in more:
                more[run] = len(places)
                places.append(i)
            code[i] = more[run]
        first = np.array(places, np.int64)
    return code, first


def tokenizer(path: str) -> RankBPE:
    """One encoder per worker and file."""
    return memo(f"bpe {path}", lambda: RankBPE(path))


def encoded(bpe: RankBPE, batch: pa.RecordBatch, size: int = 1 << 20):
    """(doc_id column, ids, offsets) of the rows of a batch of (doc_id, text), some at a time."""
    buf, offs = text_buffer(batch.column(1))
    for x, y in slabs(offs, size):
        yield batch.column(0).slice(x, y - x), *bpe.encode_flat(buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x])


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded text of each row of docs. No shuffle."""

    def run(batches):
        bpe = tokenizer(vocab_path)
        for b in batches:
            for doc, ids, cut in encoded(bpe, b):
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([doc, lists, pa.array([x.decode() for x in bpe.decode_flat(ids, cut)], pa.string())], ["doc_id", "ids", "decoded"])

    return slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of docs. No shuffle."""

    def run(batches):
        bpe = tokenizer(vocab_path)
        for b in batches:
            for doc, ids, cut in encoded(bpe, b):
                raw, ends = memoryview(ids.astype("<u4", copy=False).tobytes()), (4 * cut).tolist()
                digest = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([doc, pa.array(np.diff(cut), pa.int64()), pa.array(digest, pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in bpe.decode_flat(ids, cut)], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
