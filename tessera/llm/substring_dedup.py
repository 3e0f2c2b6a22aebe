"""Substring dedup by seed and extend: words covered by a window of 50 words that also starts in an earlier document are removed.

Seeds are winnowed anchors: the least hash of eight words in each window of 50. The occurrences of one anchor are extended word by word, to the
right and to the left, all at once: a class of occurrences is parted as soon as their next words differ, and one left alone goes no further.
Occurrences in one class o words to the left and 50 - o to the right share a window, without a pair for each two of them;
neighbouring windows make up the maximal repeats. Segments equal as a whole are aggregated before the shuffle (see repeats).
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import SPACED, Rolling, U, word_codes, words
from .common import id_of, pieces
from .repeats import Finder, dealt, hot, marked, spans

WINDOW = 50
K = 8


def _units(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = words(flat, at, SPACED)
    return word_codes(flat, start, end), first


def _codes(units: np.ndarray) -> np.ndarray:
    return units


def _extended(codes: np.ndarray, seed: np.ndarray, step: int, room: np.ndarray, most: int) -> np.ndarray:
    """The class of each seed after 0, 1, .. most words in one direction, -1 where it is alone or has no room: seeds are in one class if those words agree."""
    out = np.full((most + 1, len(seed)), -1, np.int64)
    out[0] = 0
    on = np.arange(len(seed))
    for t in range(1, most + 1):
        on = on[room[on] >= t]
        word = codes[seed[on] + (t - 1 if step > 0 else -t)]
        order = np.lexsort((word, out[t - 1, on]))
        on, word = on[order], word[order]
        new = np.ones(len(on) + 1, bool)
        new[1:-1] = (word[1:] != word[:-1]) | (out[t - 1, on[1:]] != out[t - 1, on[:-1]])
        several = ~(new[:-1] & new[1:])
        out[t, on[several]] = np.cumsum(new[:-1])[several]
        on = on[several]
        if not len(on):
            break
    return out


def _repeated(codes_of, content: bytes, size: np.ndarray, number: np.ndarray, offset: np.ndarray, rank: np.ndarray, document: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(content, U)
    size = size // 8
    base = np.cumsum(size) - size
    grams = Rolling(codes_of(codes)).grams(K)
    own = np.repeat(np.arange(len(size)), size)[: len(grams)]
    inside = np.arange(len(grams)) <= (base + size - K)[own]
    anchor = np.full(len(size), U(2**64 - 1))
    np.minimum.at(anchor, own[inside], grams[inside])
    seeds = np.flatnonzero(inside & (grams == anchor[own]))
    left = _extended(codes, seeds, -1, seeds - base[own[seeds]], WINDOW - K)
    right = _extended(codes, seeds, 1, (base + size)[own[seeds]] - seeds, WINDOW)
    window = base[number] + offset
    nth = np.searchsorted(seeds, window)
    before = seeds[nth] - window
    a, b = left[before, nth], right[WINDOW - before, nth]
    some = np.flatnonzero((a >= 0) & (b >= 0))
    key, document = [c[some] for c in (b, a, before)], document[some]
    order = np.lexsort((document, *key))
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in key], axis=0)
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    again = np.zeros(len(number), bool)
    again[some[order]] = document[order] > document[order[head]]
    return again


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    n = pieces(docs)
    rows = dealt(docs, n)
    finder = Finder(K, WINDOW, False, 4 * n, _units, _codes, functools.partial(_repeated, _codes))
    finder.hot = hot(docs, finder)
    return rows, marked(rows, finder, n)


def dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text): one row for each row.

    Words are runs of anything but ASCII white space; a null text has none. A word is removed if a window of 50 words which covers it also
    starts in a document with a smaller id; null is the smallest id, and rows of one id don't remove from each other. The words kept are joined by one space.
    """

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        gone_by, out = spans(found, WINDOW), []
        for rid, th, text in zip(*(table.column(c).to_pylist() for c in ("rid", "th", "text"))):
            all_words = text.encode("utf-8", "surrogatepass").split()
            gone = gone_by.get((rid, th), [])
            kept = all_words
            if gone:
                at, kept = 0, []
                for a, b in gone:
                    kept += all_words[at:a]
                    at = b
                kept += all_words[at:]
            data = b" ".join(kept)
            out.append((rid, len(all_words), len(all_words) - len(kept), hashlib.sha256(data).hexdigest(), data.decode("utf-8", "surrogatepass") if with_text else None))
        columns = list(zip(*out)) or [[]] * 5
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, [pa.int64()] * 3 + [pa.string()] * 2)})

    names = ["rid", "n_words", "n_removed", "kept_sha256", "kept_text"]
    rows, found = _plan(docs)
    out = rows.groupBy("pid").cogroup(found.groupBy("pid")).applyInArrow(finish, "rid long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.select(id_of(F.col("rid")), *(names[1:] if with_text else names[1:-1]))
