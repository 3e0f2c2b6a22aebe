"""Words and shingles of many texts at once, as 64-bit hashes in arrays.

The same words as text.tokens(text.plain_words(text)): a lambda of the JVM's costs about a microsecond a word where several tasks share it.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .text import STOPWORDS

#: What can be had of each text, as lists of 64-bit numbers.
LISTS = ("words", "title_set", "shingle_set", "word_set")
#: Bytes of texts that are worked on at once; a longer text is taken whole.
PIECE = 1 << 22
#: Bytes of a word that are hashed in arrays; a longer word is hashed alone.
SHORT = 64
_BLANK = 32
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b == 95 else _BLANK for b in range(256))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def plain(text: str | None, compose: bool = True) -> bytes:
    """Compatibility form, lower case, a blank for each byte that is none of a-z, 0-9 and _."""
    if not text:
        return b""
    if not text.isascii():
        text = (text if not compose or unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text)).lower()
    return text.encode().translate(_LOWER)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of 64 depends on all; no two numbers become one."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _hashes(buffer: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of words in a buffer that goes on for 8 bytes behind the last."""
    eights = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    out = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = np.arange(len(starts))
    for k in range(0, SHORT, 8):
        rows = rows[sizes[rows] > k]
        if not len(rows):
            break
        out[rows] = _mixed(out[rows] ^ (eights[starts[rows] + k] & _MASKS[np.minimum(sizes[rows] - k, 8)]))
    for i in np.flatnonzero(sizes > SHORT):
        out[i] = int.from_bytes(hashlib.blake2b(buffer[starts[i] : starts[i] + sizes[i]], digest_size=8).digest(), "little")
    return out


def _words(texts: list[bytes], stop: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of plain texts, one text after the other, and where each text's begin; without words of one character and stop words if these are given."""
    buffer = b" ".join([b"", *texts, b" " * 9])
    is_word = np.frombuffer(buffer, np.uint8) != _BLANK
    starts, ends = np.flatnonzero(~is_word[:-1] & is_word[1:]) + 1, np.flatnonzero(is_word[:-1] & ~is_word[1:]) + 1
    sizes = ends - starts
    if stop is not None:
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    hashes = _hashes(buffer, starts, sizes)
    if stop is not None:
        keep = stop[np.minimum(np.searchsorted(stop, hashes), len(stop) - 1)] != hashes
        starts, hashes = starts[keep], hashes[keep]
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, begins)


_STOP = np.sort(_words([w.encode() for w in STOPWORDS])[0])


def _chained(parts: list[np.ndarray]) -> np.ndarray:
    out = _mixed(parts[0])
    for x in parts[1:]:
        out = _mixed(out + x)
    return out


def _shingles(words: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """The distinct runs of ``size`` words of each text; all words as one where there are fewer."""
    n = max(0, len(words) - size + 1)
    runs = _chained([words[k : k + n] for k in range(size)]) if n else words[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        some = runs[a : b - size + 1] if b - a >= size else _chained([words[k : k + 1] for k in range(a, b)]) + np.uint64(b - a) if b > a else words[:0]
        out.append(np.unique(some))
    return out


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*parts, np.empty(0, np.uint64)]).view(np.int64)))


def _cut(words: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    return [words[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def schema(lists: tuple[str, ...] = LISTS) -> str:
    return ", ".join(["problem_id string", *(f"{x} array<bigint>" for x in lists)])


def sets(ids: pa.Array, bodies: list[bytes], titles: list[bytes], size: int, lists: tuple[str, ...] = LISTS) -> pa.RecordBatch:
    words, at = _words(bodies, _STOP)
    make = {
        "words": lambda: _cut(words, at), "title_set": lambda: list(map(np.unique, _cut(*_words(titles, _STOP)))),
        "shingle_set": lambda: _shingles(words, at, size), "word_set": lambda: list(map(np.unique, _cut(words, at))),
    }
    return pa.RecordBatch.from_arrays([ids, *(_lists(make[x]()) for x in lists)], names=["problem_id", *lists])


def word_sets(compose: bool = True, size: int = 5, lists: tuple[str, ...] = LISTS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: rows of (problem_id, body, title) to those of schema(lists)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, bodies = 0, 0, []
            for i in range(batch.num_rows):
                bodies.append(plain(batch.column(1)[i].as_py(), compose))
                held += len(bodies[-1])
                if held >= PIECE or i + 1 == batch.num_rows:
                    titles = [plain(t.as_py(), compose) for t in batch.column(2)[begin : i + 1]]
                    yield sets(batch.column(0)[begin : i + 1], bodies, titles, size, lists)
                    begin, held, bodies = i + 1, 0, []

    return run
