"""Suffix-array dedup: bytes covered by a window of 100 bytes that also starts earlier are removed.

Suffixes that can share 100 bytes are brought together by the minimizer of their first window (see repeats); equal segments are
aggregated before the shuffle. The suffixes of what is left are then put in order by deep-shallow sorting, each bucket on its own:
three-way multikey quicksort, with eight bytes as one character, to a shallow depth; groups that still agree are ordered by blind
tries, which know a suffix by the depth and the byte at which it leaves another's path. In that order suffixes that share
100 bytes are neighbours; of each such run all but the first in place are repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE, U
from .common import id_of, pieces
from .repeats import Finder, dealt, hot, marked, spans

WINDOW = 100
K = 32
#: Bytes by which multikey quicksort sorts.
SHALLOW = 24


def _units(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return flat, at


def _codes(units: np.ndarray) -> np.ndarray:
    return BYTE[units]


def _slots(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges: all their members, and the number of the range of each."""
    group = np.repeat(np.arange(len(first)), size)
    return np.arange(len(group)) + np.repeat(first - (np.cumsum(size) - size), size), group


def _quicksort(x: np.ndarray, position: np.ndarray, order: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of order in place, by eight bytes at a time to the depth ``shallow``; first and size of the groups that agree to there.

    All groups are parted in one pass: below, at and above the median of three of their members' next characters. The middle part goes on at
    the next character, the others at the same.
    """
    first, size, depth = np.zeros(1, np.int64), np.array([len(order)]), np.zeros(1, np.int64)
    deep: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        done = depth >= shallow
        deep.append((first[done], size[done]))
        first, size, depth = first[~done], size[~done], depth[~done]
        if not len(first):
            break
        slot, group = _slots(first, size)
        own = order[slot]
        char = x[position[own] + depth[group]]
        start = np.cumsum(size) - size
        three = np.sort(np.stack([char[start], char[start + size // 2], char[start + size - 1]]), axis=0)
        pivot = three[1][group]
        side = group * 3 + (char >= pivot) + (char > pivot)
        order[slot] = own[np.argsort(side, kind="stable")]
        parts = np.bincount(side, minlength=3 * len(size))
        at = np.cumsum(parts.reshape(-1, 3), axis=1) - parts.reshape(-1, 3) + first[:, None]
        next_ = np.repeat(depth, 3) + np.tile([0, 8, 0], len(size))
        many = parts > 1
        first, size, depth = at.ravel()[many], parts[many], next_[many]
    return np.concatenate([f for f, _ in deep]), np.concatenate([n for _, n in deep])


def _leading_zeros(x: np.ndarray) -> np.ndarray:
    """Of words that aren't zero, the number of leading bytes that are."""
    out = np.zeros(len(x), np.int64)
    for bits in (32, 16, 8):
        high = (x >> U(64 - bits)) == 0
        out[high] += bits // 8
        x = np.where(high, x << U(bits), x)
    return out


def _tries(data: np.ndarray, x: np.ndarray, position: np.ndarray, order: np.ndarray, first: np.ndarray, size: np.ndarray, shallow: int, window: int) -> np.ndarray:
    """Blind tries over all groups at once, which puts order in order; whether a suffix (in that order) agrees with the one before it to the window's end.

    The first suffix of a group is a path. Each other one is compared with it and leaves it at a branching depth, by a byte: smaller
    ones leave to the left, the higher up the earlier, greater ones to the right. Those that leave at one node by one byte make up
    the group below it; those that never leave are equal.
    """
    same = np.zeros(len(order) + 1, bool)
    while len(first):
        slot, group = _slots(first, size)
        own = order[slot]
        path, at = position[order[first]][group], position[own]
        shared, below = np.full(len(own), window), np.zeros(len(own), bool)
        open_ = np.arange(len(own))
        for depth in [*range(shallow, window - 8, 8), window - 8]:
            a, b = x[at[open_] + depth], x[path[open_] + depth]
            apart = a != b
            some = open_[apart]
            shared[some], below[some] = depth + _leading_zeros((a ^ b)[apart]), (a < b)[apart]
            open_ = open_[~apart]
        leaves = shared == window
        where = np.where(leaves | below, shared, 2 * window - shared)
        byte = np.where(leaves, 0, data[at + np.where(leaves, 0, shared)])
        by = np.lexsort((byte, where, group))
        order[slot] = own[by]
        group, where, byte, leaves = group[by], where[by], byte[by], leaves[by]
        new = np.ones(len(by) + 1, bool)
        new[1:-1] = (group[1:] != group[:-1]) | (where[1:] != where[:-1]) | (byte[1:] != byte[:-1])
        same[slot[leaves & ~new[:-1]]] = True
        edge = np.flatnonzero(new)
        n = np.diff(edge)
        edge = edge[:-1]
        on = (n > 1) & ~leaves[edge]
        first, size = slot[edge[on]], n[on]
    return same[:-1]


def suffix_order(data: np.ndarray, position: np.ndarray, window: int = WINDOW, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``position`` in the order of their first ``window`` bytes, and whether each agrees in them with the one before it.

    ``shallow`` is a multiple of 8 below window - 8; there are window bytes after every position.
    """
    x = np.append(data, np.zeros(8, np.uint8)).astype(U)
    x = x[:-1] << U(8) | x[1:]
    x = x[:-2] << U(16) | x[2:]
    x = x[:-4] << U(32) | x[4:]
    order = np.arange(len(position))
    if len(order) < 2:
        return order, np.zeros(len(order), bool)
    first, size = _quicksort(x, position, order, shallow)
    return order, _tries(data, x, position, order, first, size, shallow, window)


def _repeated(content: bytes, size: np.ndarray, number: np.ndarray, offset: np.ndarray, rank: np.ndarray, document: np.ndarray) -> np.ndarray:
    base = np.cumsum(size) - size
    order, same = suffix_order(np.frombuffer(content, np.uint8), base[number] + offset)
    run = np.cumsum(~same)
    by = np.lexsort((rank[order], run))
    again = np.zeros(len(order), bool)
    again[order[by[1:][run[by[1:]] == run[by[:-1]]]]] = True
    return again


def _kept(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in gone:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def _to_characters(data: bytes, gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters of which they cover a part only."""
    inner = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    out = []
    for a, b in gone:
        while a < b and inner(a):
            a += 1
        while b > a and inner(b):
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    n = pieces(docs)
    rows = dealt(docs, n)
    finder = Finder(K, WINDOW, True, 4 * n, _units, _codes, _repeated)
    finder.hot = hot(docs, finder)
    return rows, marked(rows, finder, n)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row.

    Texts are UTF-8 bytes, a null text is empty; a byte is removed if a string of 100 bytes which covers it also starts in a row before
    or earlier in the same text. Rows go by id, null first, rows of one id by the hash of their text; rows equal in both have
    equal results and don't remove each other. Texts under 100 bytes stay whole.
    """

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        gone_by, out = spans(found, WINDOW), []
        for rid, th, text in zip(*(table.column(c).to_pylist() for c in ("rid", "th", "text"))):
            data, gone = text.encode("utf-8", "surrogatepass"), gone_by.get((rid, th), [])
            out.append((rid, len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(_kept(data, gone)).hexdigest()))
        columns = list(zip(*out)) or [[]] * 5
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, [pa.int64()] * 4 + [pa.string()])})

    names = ["rid", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows, found = _plan(docs)
    out = rows.groupBy("pid").cogroup(found.groupBy("pid")).applyInArrow(finish, "rid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(id_of(F.col("rid")), *names[1:])


def dedup(docs: DataFrame, removed: str | None = None) -> DataFrame:
    """docs with what repeats cut out of the texts, in docs' columns; a null text becomes empty. removed: a name for a column of bytes cut out.

    Characters that would be cut in two stay whole. See digests() for what is removed.
    """
    others = [c for c in docs.columns if c != "text"]

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        gone_by, texts, sizes = spans(found, WINDOW), [], []
        for rid, th, text in zip(*(table.column(c).to_pylist() for c in ("rid", "th", "text"))):
            data = text.encode("utf-8", "surrogatepass")
            gone = _to_characters(data, gone_by.get((rid, th), []))
            texts.append(_kept(data, gone).decode("utf-8", "surrogatepass") if gone else text)
            sizes.append(sum(b - a for a, b in gone))
        return pa.table({**{f"x{i}": table.column(f"x{i}") for i in range(len(others))}, "text": pa.array(texts, pa.string()), "removed": pa.array(sizes, pa.int64())})

    rows, found = _plan(docs)
    schema = ", ".join(f"x{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(others))
    out = rows.groupBy("pid").cogroup(found.groupBy("pid")).applyInArrow(finish, f"{schema}, text string, removed long")
    at = {c: f"x{i}" for i, c in enumerate(others)} | {"text": "text"}
    return out.select(*[F.col(at[c]).alias(c) for c in docs.columns], *([F.col("removed").alias(removed)] if removed else []))
