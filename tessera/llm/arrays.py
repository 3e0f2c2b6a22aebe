"""Arrow text columns as numpy arrays, and vectorised hashing over them.

Long rows never need memory in proportion to their length times the width of a hash: callers take texts in blocks, and rows above a block
in pieces (see spans_of), and words are hashed some at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_A, _B = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)  # odd


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose result looks random (an xor-shift-multiply finalizer)."""
    x = x ^ (x >> U(31))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


BYTE = mix(np.arange(1, 257, dtype=U))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order: a bijection in either, and linear in neither."""
    x = a * _A
    x ^= x >> U(33)
    x += b
    x *= _B
    x ^= x >> U(29)
    return x


class Rolling:
    """Hashes of runs of the units whose 64-bit codes are given.

    Level j has a hash of every run of 2**j units, made of two of level j - 1. A run of n units is known by its first and its last
    2**j units, the most that fit, and by n. So no algebra of the text survives, as it would in a polynomial modulo 2**64,
    under which the two Thue-Morse words of any length from 1,024 on agree. One level is held at a time.
    """

    def __init__(self, codes: np.ndarray):
        self.codes, self.low, self.level = codes, codes, 0

    def _at(self, level: int) -> np.ndarray:
        if level < self.level:
            self.low, self.level = self.codes, 0
        while self.level < level:
            half = 1 << self.level
            self.low, self.level = _paired(self.low[:-half], self.low[half:]), self.level + 1
        return self.low

    def grams(self, k: int) -> np.ndarray:
        """Of every run of k units."""
        n = len(self.codes) - k + 1
        if n <= 0:
            return np.zeros(0, U)
        level = k.bit_length() - 1
        low = self._at(level)
        return mix(_paired(low[:n], low[k - (1 << level) :]) + U(k))

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the runs [start, end); 0 for empty ones."""
        n = end - start
        out = np.zeros(len(n), U)
        levels = np.frexp(n.astype(np.float64))[1] - 1
        for level in np.unique(levels[n > 0]).tolist():
            low, some = self._at(level), np.flatnonzero((levels == level) & (n > 0))
            out[some] = mix(_paired(low[start[some]], low[end[some] - (1 << level)]) + n[some].astype(U))
        return out


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts (one more than rows). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, at - at[0]


def blocks(at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` units together, or one row."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def spans_of(at: np.ndarray, most: int = 1 << 20, overlap: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, from, to): rows of at most ``most`` units together, or a piece of one row, from and to in its own units.

    A piece has ``most`` units and the next ``overlap`` ones, so every run of overlap + 1 units lies in some piece whole.
    """
    for i, j in blocks(at, most):
        size = int(at[j] - at[i])
        if j == i + 1 and size > most + overlap:
            for a in range(0, size - overlap, most):
                yield i, j, a, min(a + most + overlap, size)
        else:
            yield i, j, 0, size


def text_blocks(column, most: int = 1 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """The same with the rows' texts, nulls as empty ones."""
    _, at = utf8(column)
    for i, j in blocks(at, most):
        yield i, j, [x or "" for x in column.slice(i, j - i).to_pylist()]


def codepoints(texts: list[str], gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each behind ``gap`` zeros, and where each text (with its zeros) starts; zeros end it all."""
    sep = "\0" * gap
    flat = np.frombuffer((sep + sep.join(texts) + sep).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + gap for t in texts], out=at[1:])
    return flat, at


def words(flat: np.ndarray, at: np.ndarray, inside: np.ndarray, most: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes for which inside[byte], never across rows: starts, ends, and each row's first word (one more than rows). ``most`` bytes at a time."""
    n, before = len(flat), False
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cuts = at[:-1][at[:-1] < n]
    for a in range(0, n, most):
        on = inside[flat[a : a + most]]
        was = np.concatenate([[before], on[:-1]])
        first = on & ~was
        cut = cuts[np.searchsorted(cuts, a) : np.searchsorted(cuts, a + most)] - a
        first[cut] = on[cut]
        starts.append(np.flatnonzero(first) + a)
        ends.append(np.flatnonzero(was & (~on | first)) + a)
        before = bool(on[-1])
    start, end = np.concatenate(starts), np.concatenate([*ends, [n] * before]).astype(np.int64)
    return start, end, np.searchsorted(start, at)


#: Words of more bytes are hashed by a digest of their own.
LONG_WORD = 1 << 12


def word_codes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word from its bytes, some words at a time."""
    out = np.zeros(len(start), U)
    long = np.flatnonzero(end - start > LONG_WORD)
    for i in long.tolist():
        out[i] = int.from_bytes(hashlib.blake2b(flat[start[i] : end[i]].data, digest_size=8).digest(), "little")
    edges = [0, *(x for i in long.tolist() for x in (i, i + 1)), len(start)]
    for first, last in zip(edges[::2], edges[1::2]):
        a = first
        while a < last:
            b = min(last, max(a + 1, int(np.searchsorted(end[:last], start[a] + (1 << 19), "right"))))
            out[a:b] = Rolling(BYTE[flat[start[a] : end[b - 1]]]).runs(start[a:b] - start[a], end[a:b] - start[a])
            a = b
    return out


#: Bytes of words: all but space, tab, LF, VT, FF and CR.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words: ASCII digits, a-z, and whatever isn't ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
