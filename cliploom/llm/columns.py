"""Arrow text columns as flat byte arrays: slabs, words and rolling hashes, without a Python loop per row.

Everything here takes whole texts. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX1, _MIX2 = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)
#: Items that one polynomial hash may span.
MOST_GRAM = 256
SPACE_LIKE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def memo(name: str, make):
    """A value kept for the life of a Python worker (code that travels by value has no lasting globals)."""
    kept = sys.__dict__.setdefault("_cliploom_memo", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def tidy() -> None:
    """Gives free memory back to the system, so that a long-lived worker holds no more than its task needs."""
    trim = memo("malloc_trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", None))
    if trim:
        trim(0)
    pa.default_memory_pool().release_unused()


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, in place."""
    h ^= h >> U(33)
    h *= _MIX1
    h ^= h >> U(33)
    h *= _MIX2
    h ^= h >> U(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    kept = memo("powers", dict)
    if kept.get("n", 0) < n:
        n = 1 << max(19, n.bit_length())
        kept["n"] = n
        for k, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(n, base, U)
            x[0] = 1
            kept[k] = np.multiply.accumulate(x)
    return kept["up"], kept["down"]


def byte_codes() -> np.ndarray:
    return memo("byte_codes", lambda: mix((np.arange(256, dtype=U) + U(1)) * U(_BASE)))


class Rolling:
    """Prefix sums of a polynomial hash modulo 2^64: the hash of any run in constant time."""

    def __init__(self, values: np.ndarray):
        up, down = _powers(len(values) + 1)
        self.down = down
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def fixed(self, k: int) -> np.ndarray:
        """Unmixed hashes of all runs of k."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, U)
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def lanes_of(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of buf as one number, the first lowest; beyond the end are zeros."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    return np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))


#: By number of bytes: the mask of those of a lane. Runs beyond LONG_RUN bytes are taken one by one.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
LONG_RUN = 512


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lanes: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each run of bytes. Its lanes of eight bytes are mixed with their place before they are added, so
    that no algebra of bytes carries over; up to eight bytes, runs of one length never collide."""
    lanes = lanes_of(buf) if lanes is None else lanes
    size = end - start
    h = mix((lanes[start] & _MASKS[np.minimum(size, 8)]) + U(_BASE))
    todo, j = np.flatnonzero((size > 8) & (size <= LONG_RUN)), 1
    while len(todo):
        h[todo] += mix((lanes[start[todo] + 8 * j] & _MASKS[np.minimum(size[todo] - 8 * j, 8)]) + U((j + 1) * _BASE % 2**64))
        j += 1
        todo = todo[size[todo] > 8 * j]
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        x = lanes[start[i] + 8 : end[i] : 8].copy()
        x[-1:] &= _MASKS[(int(size[i]) - 1) % 8 + 1]
        h[i : i + 1] += np.add.reduce(mix(x + np.arange(2, len(x) + 2, dtype=U) * U(_BASE)))
    return mix(h + size.astype(U) * _MIX2)


def runs_equal(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, lanes: np.ndarray | None = None) -> np.ndarray:
    """Whether the size bytes from a are those from b, byte by byte."""
    lanes = lanes_of(buf) if lanes is None else lanes
    ok, todo, j = np.ones(len(a), bool), np.flatnonzero((a != b) & (size <= LONG_RUN)), 0
    while len(todo):
        ok[todo] &= (lanes[a[todo] + 8 * j] ^ lanes[b[todo] + 8 * j]) & _MASKS[np.minimum(size[todo] - 8 * j, 8)] == 0
        j += 1
        todo = todo[size[todo] > 8 * j]
    for i in np.flatnonzero((a != b) & (size > LONG_RUN)).tolist():
        ok[i] = np.array_equal(buf[a[i] : a[i] + size[i]], buf[b[i] : b[i] + size[i]])
    return ok


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1 rows) of a string or binary column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64, len(col) + 1, col.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def slabs(offs: np.ndarray, target: int = 1 << 20):
    """Ranges of whole rows of about target bytes; a longer row is alone in its range."""
    d, n = 0, len(offs) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(offs, offs[d] + target, "right")) - 1)
        yield d, min(e, n)
        d = e


def separators(codes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(codes)] = True
    return table


def fold_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


class Words:
    """Words of the rows of a slab: start and end bytes, first word of each row, a 64-bit hash of each."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, sep: np.ndarray, fold: bool = False):
        """buf, offs: bytes and offsets of the slab alone (offs[0] is 0)."""
        if fold:
            buf = fold_table()[buf]
        self.buf, self.offs = buf, offs
        edge = np.zeros(len(buf) + 1, bool)
        edge[offs] = True
        inside = ~sep[buf]
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offs)  # of each row, and the total
        self.count = np.diff(self.first)
        self.hash = span_hash(buf, self.start, self.end) if len(self.start) else np.zeros(0, U)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the k words from each word, whether they are of one row)."""
        roll, piece = Rolling(self.hash), min(k, MOST_GRAM)
        g = mix(roll.fixed(piece))
        for at in range(piece, k, MOST_GRAM):  # longer ones piece by piece: the sum modulo 2^64 alone is weak for those
            more = mix(roll.fixed(min(MOST_GRAM, k - at)))[at:]
            g = mix(g[: len(more)] * U(_BASE) + more)
        g = g[: max(0, len(self.hash) - k + 1)]
        ok = np.arange(len(g)) + k <= np.repeat(self.first[1:], self.count)[: len(g)]
        return g, ok


def starts_of_runs(sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of the positions in any [start, end)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0


def planes(a: np.ndarray, width: int = 8) -> bytes:
    """Little-endian integers as byte planes, which compress well when high bytes agree."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)[:, :width].T.tobytes()


def unplanes(b: bytes | memoryview, n: int, width: int = 8, dtype=np.uint64) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8, n * width).reshape(width, n).T
    return out.view(dtype).ravel()
