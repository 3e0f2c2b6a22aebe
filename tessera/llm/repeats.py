"""What the two substring operators share: windows that occur twice, found without sending every window.

A window is W consecutive units (bytes, or words). Its minimizer is the least hash of its K-grams. Neighbouring windows
mostly share one, so a text falls into segments, runs of windows with one minimizer; windows with equal content have
equal minimizers, so they can meet at the minimizer's hash alone. Segments equal as a whole are aggregated before they are
sent, known by a 128-bit digest of their contents; where segments of one minimizer differ, the operator's own matching gets their contents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Rolling, U, blocks, spans_of, utf8
from .common import NO_ID, texts

#: Windows of a segment at most; runs of one minimizer (periodic text) are cut from their starts.
MOST = 256
#: Units of a text looked at in one piece.
PIECE = 1 << 20


def segments(grams: np.ndarray, n: int, at: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """minimizer, first window, number of windows: of the segments of texts of n units that begin at ``at``. grams: hashes of every run of k units."""
    if n < window:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, wide, have = grams, window - k + 1, 1
    while 2 * have <= wide:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < wide:
        low = np.minimum(low[: len(low) - (wide - have)], low[wide - have :])
    ok = np.zeros(n + 1, np.int8)  # windows that don't leave their text
    full = at[1:] - at[:-1] >= window
    ok[at[:-1][full]] = 1
    ok[at[1:][full] - window + 1] -= 1
    ok = np.cumsum(ok[: len(low)], dtype=np.int8).astype(bool)
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (low[1:] != low[:-1])
    start = np.flatnonzero(new)
    last = ok.copy()
    last[:-1] &= ~ok[1:] | new[1:]
    count = np.flatnonzero(last) + 1 - start
    if len(count) and count.max() > MOST:
        parts = (count + MOST - 1) // MOST
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + nth * MOST
        count = np.minimum(np.repeat(count, parts) - nth * MOST, MOST)
    return low[start], start, count


def digests_of(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit digests of the runs [start, end) of units, as two columns."""
    data, each, new = memoryview(np.ascontiguousarray(units)).cast("B"), units.itemsize, hashlib.blake2b
    found = b"".join([new(data[a:b], digest_size=16).digest() for a, b in zip((start * each).tolist(), (end * each).tolist())])
    return np.frombuffer(found, U).reshape(-1, 2)


def inner_repeats(grams: np.ndarray, k: int, window: int, minimizer: np.ndarray) -> np.ndarray:
    """Whether a segment may hold one window twice (periodic text): its minimizer then has two places close to each other."""
    if len(grams) < window - k + 1:
        return np.zeros(len(minimizer), bool)
    slot = (minimizer >> U(44)).astype(np.int64)
    seen = np.zeros(1 << 20, bool)
    seen[slot] = True
    place = np.flatnonzero(seen[(grams >> U(44)).astype(np.int64)])
    value = grams[place]
    by = np.lexsort((place, value))
    value, place = value[by], place[by]
    twice = np.unique(value[1:][(value[1:] == value[:-1]) & (np.diff(place) < MOST + window)])
    return np.isin(minimizer, twice)


def pack(*columns: np.ndarray) -> bytes:
    return len(columns[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack(data: bytes, kinds: tuple) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in map(np.dtype, kinds):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * kind.itemsize
    return out


def gather(blobs: list[bytes], kinds: tuple) -> list[np.ndarray]:
    parts = [unpack(b, kinds) for b in blobs]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, k) for i, k in enumerate(kinds)]


#: minimizer, digest of content, rid, th, pid, first window, number of windows, may repeat within
SEGMENT = (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int32, np.int32, np.uint16, np.bool_)
#: rid, th, first window, number of windows: all of them to be removed
MARK = (np.int64, np.int64, np.int32, np.int32)
#: minimizer, rid, th, first window, number of windows: content is asked for
REQUEST = (np.uint64, np.int64, np.int64, np.int32, np.uint16)
#: rid, th, pid, first window, number of windows, and size of the content, which follows
CANDIDATE = (np.int64, np.int64, np.int32, np.int32, np.uint16, np.int32)
ROW = "kind int, key int, pid int, data binary"
IS_SEGMENT, IS_MARK, IS_REQUEST, IS_CANDIDATE = range(4)
FLUSH = 1_000_000


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.binary())], ["kind", "key", "pid", "data"])


def _ranges(key: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of the runs of a sorted key."""
    cut = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else []
    return [(int(key[a]), int(a), int(b)) for a, b in zip(cut, [*cut[1:], len(key)])]


def merged(rid, th, first, count) -> list[np.ndarray]:
    """The same windows as fewer, longer runs."""
    if not len(rid):
        return [np.zeros(0, k) for k in MARK]
    order = np.lexsort((first, th, rid))
    rid, th, first, count = rid[order], th[order], first[order].astype(np.int64), count[order].astype(np.int64)
    end = first + count
    row = np.concatenate([[0], np.cumsum((rid[1:] != rid[:-1]) | (th[1:] != th[:-1]))])
    far = np.maximum.accumulate(end + (row << 34))
    new = np.ones(len(rid), bool)
    new[1:] = first[1:] + (row[1:] << 34) > far[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(rid)) - 1
    return [rid[at], th[at], first[at].astype(np.int32), (far[last] - (row[last] << 34) - first[at]).astype(np.int32)]


def mark_rows(pid, rid, th, first, count, keys: int) -> list[tuple[int, int, int, bytes]]:
    order = np.argsort(pid, kind="stable")
    pid, rid, th, first, count = (x[order] for x in (pid, rid, th, first, count))
    return [(IS_MARK, p % keys, p, pack(*merged(rid[a:b], th[a:b], first[a:b], count[a:b]))) for p, a, b in _ranges(pid)]


def by_key(batches: Iterator[pa.RecordBatch], kind: int, one) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: those of ``kind`` go to one(blobs), a key at a time, the others go on."""
    key, blobs = None, []
    for batch in batches:
        other = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if row[0] != kind:
                other.append(row)
                continue
            if blobs and row[1] != key:
                other += one(blobs)
                blobs = []
            key = row[1]
            blobs.append(row[3])
        if other:
            yield _rows(other)
    if blobs and (rows := one(blobs)):
        yield _rows(rows)


class Finder:
    """Stages that find repeated windows. ``within``: a window may repeat one of its own document.

    units(flat, at) gives the units of texts of bytes, and where texts begin among them; codes(units) their 64-bit codes;
    repeated(contents, sizes, number, offset, rank, document) is the operator's own matching: it tells of windows, each given
    by its segment's number and its offset in it, which repeat one of a lower rank (or, not ``within``, of a lower document).
    """

    def __init__(self, k: int, window: int, within: bool, keys: int, units, codes, repeated):
        #: Minimizers whose segments are too many to meet in one task: see hot().
        self.hot = np.zeros(0, U)
        self.k, self.window, self.within, self.keys = k, window, within, keys
        self.units, self.codes, self.repeated = units, codes, repeated

    def _bucket(self, minimizer: np.ndarray) -> np.ndarray:
        return ((minimizer >> U(20)) % U(self.keys)).astype(np.int64)

    def _first(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """SEGMENT's columns in order by content and place; whether a row (in this order) is known to repeat one before it.

        With ``within``, each place stays once: equal rows have the same places, which aren't repeats of themselves.
        """
        h, s, t, rid, th, _, first, *_ = columns
        order = np.lexsort((first, th, rid, t, s, h))
        if self.within:
            once = np.ones(len(order), bool)
            once[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in (h, s, t, rid, th, first)], axis=0)
            order = order[once]
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in (h, s, t)], axis=0)
        if self.within:
            return order, ~new
        rid = rid[order]
        return order, rid > rid[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]

    def _found(self, flat: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Of some texts: row, minimizer, digest in two, first window, number of windows, whether it may repeat within; in pieces."""
        units, first = self.units(flat, at)
        for i, j, lo, hi in spans_of(first, PIECE, self.window - 1):
            part = units[first[i] + lo : first[i] + hi]
            begin = first[i : j + 1] - first[i] if hi - lo == first[j] - first[i] else np.array([0, hi - lo])
            grams = Rolling(self.codes(part)).grams(self.k)
            h, start, count = segments(grams, len(part), begin, self.k, self.window)
            twice = inner_repeats(grams, self.k, self.window, h) if self.within else np.zeros(len(h), bool)
            if len(self.hot) and (hot := np.isin(h, self.hot)).any():
                h, start, count, twice = self._opened(part, hot, h, start, count, twice)
            digest = digests_of(part, start, start + count + self.window - 1)
            row = np.searchsorted(begin, start, "right") - 1
            yield i + row, h, digest[:, 0], digest[:, 1], start - begin[row] + lo, count, twice

    def _opened(self, part, hot, h, start, count, twice) -> tuple[np.ndarray, ...]:
        """Segments of hot minimizers as windows of their own, dealt by their content's hash: equal windows still meet, others part."""
        n = count[hot]
        at = np.repeat(start[hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own = Rolling(self.codes(part)).runs(at, at + self.window)
        both = lambda a, b: np.concatenate([a[~hot], b])
        return both(h, own), both(start, at), both(count, np.ones(len(at), count.dtype)), both(twice, np.zeros(len(at), bool))

    def segments(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts to segments by bucket of their minimizer; of equal segments of a task only the first goes on, the others are marked."""
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            pid, rid, th = (batch.column(c).to_numpy() for c in ("pid", "rid", "th"))
            flat, at = utf8(batch.column("text"))
            for i, j in blocks(at):
                for row, h, s, t, place, count, twice in self._found(flat[at[i] : at[j]], at[i : j + 1] - at[i]):
                    held.append([h, s, t, rid[i + row], th[i + row], pid[i + row], place.astype(np.int32), count.astype(np.uint16), twice])
                    size += len(h)
                    if size > FLUSH:
                        yield self._send(held)
                        held, size = [], 0
        if size:
            yield self._send(held)

    def minimizers(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a task's texts: each minimizer with the number of its distinct segments, if more than one."""
        held = [np.zeros((2, 0), U)]
        for batch in batches:
            flat, at = utf8(batch.column("text"))
            for i, j in blocks(at):
                held += [np.stack([h, s]) for _, h, s, *_ in self._found(flat[at[i] : at[j]], at[i : j + 1] - at[i])]
        h, s = np.concatenate(held, 1)
        order = np.lexsort((s, h))
        h, s = h[order], s[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        h, n = np.unique(h[once], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], ["h", "n"])

    def _send(self, held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held)]
        order, again = self._first(columns)
        columns = [c[order] for c in columns]
        rows = mark_rows(*(columns[i][again] for i in (5, 3, 4, 6, 7)), self.keys)
        columns = [c[~again] for c in columns]
        bucket = self._bucket(columns[0])
        order = np.argsort(bucket, kind="stable")
        columns = [c[order] for c in columns]
        return _rows(rows + [(IS_SEGMENT, k, -1, pack(*(c[a:b] for c in columns))) for k, a, b in _ranges(bucket[order])])

    def resolve(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal segments of all tasks: the first stays, others are marked. Content is asked for where segments with one minimizer differ."""
        return by_key(batches, IS_SEGMENT, self._resolved)

    def _resolved(self, blobs: list[bytes]) -> list[tuple[int, int, int, bytes]]:
        columns = gather(blobs, SEGMENT)
        h = columns[0]
        order = np.argsort(h, kind="stable")
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[order][1:] == h[order][:-1]
        use = order[same[:-1] | same[1:] | columns[8][order]]
        columns = [c[use] for c in columns]
        order, again = self._first(columns)
        columns = [c[order] for c in columns]
        rows = mark_rows(*(columns[i][again] for i in (5, 3, 4, 6, 7)), self.keys)
        h, s, t, rid, th, pid, first, count, twice = (c[~again] for c in columns)
        if not len(h):
            return rows
        group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
        unlike = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        if not self.within:
            unlike |= rid[1:] != rid[:-1]
        differ = np.bincount(group[1:], unlike & (group[1:] == group[:-1]), group[-1] + 1)[group]
        ask = (differ > 0) | twice
        order = np.argsort(pid[ask], kind="stable")
        asked = [c[ask][order] for c in (h, rid, th, first, count)]
        return rows + [(IS_REQUEST, 0, p, pack(*(c[a:b] for c in asked))) for p, a, b in _ranges(pid[ask][order])]

    def contents(self, docs: pa.Table, asked: pa.Table) -> pa.Table:
        """Of the documents of one pid: the contents that were asked for, by bucket of the minimizer."""
        kinds, data = asked.column("kind").to_pylist(), asked.column("data").to_pylist()
        pid = asked.column("pid")[0].as_py() if len(kinds) else 0
        rows = [(IS_MARK, pid % self.keys, pid, pack(*merged(*gather([d for k, d in zip(kinds, data) if k == IS_MARK], MARK))))] if IS_MARK in kinds else []
        h, rid, th, first, count = gather([d for k, d in zip(kinds, data) if k == IS_REQUEST], REQUEST)
        if len(h):
            order = np.lexsort((first, th, rid))
            h, rid, th, first, count = (c[order] for c in (h, rid, th, first, count))
            where = {key: i for i, key in enumerate(zip(docs.column("rid").to_pylist(), docs.column("th").to_pylist()))}
            texts = docs.column("text")
            cut = np.flatnonzero((np.diff(rid, prepend=rid[0] - 1) != 0) | (np.diff(th, prepend=th[0] - 1) != 0))
            content: list[bytes] = []
            for a, b in zip(cut, [*cut[1:], len(rid)]):
                row = where[int(rid[a]), int(th[a])]
                units, _ = self.units(*utf8(texts.slice(row, 1)))
                content += [units[x : x + n].tobytes() for x, n in zip(first[a:b].tolist(), (count[a:b].astype(np.int64) + self.window - 1).tolist())]
            bucket = self._bucket(h)
            order = np.argsort(bucket, kind="stable")
            content = [content[i] for i in order]
            size = np.array([len(c) for c in content], np.int32)
            columns = [rid[order], th[order], np.full(len(h), pid, np.int32), first[order], count[order], size]
            rows += [(IS_CANDIDATE, k, pid, pack(*(c[a:b] for c in columns)) + b"".join(content[a:b])) for k, a, b in _ranges(bucket[order])]
        return pa.Table.from_batches([_rows(rows)])

    def match(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of the candidates that repeat an earlier one are marked."""
        return by_key(batches, IS_CANDIDATE, self._matched)

    def _matched(self, blobs: list[bytes]) -> list[tuple[int, int, int, bytes]]:
        rid, th, pid, first, count, size = gather(blobs, CANDIDATE)
        each = sum(np.dtype(k).itemsize for k in CANDIDATE)
        content = b"".join([b[8 + int.from_bytes(b[:8], "little") * each :] for b in blobs])
        number = np.repeat(np.arange(len(rid)), count)
        offset = np.arange(len(number)) - np.repeat(np.cumsum(count, dtype=np.int64) - count, count)
        place = first[number] + offset
        # the rank of a window's place: by document, and within it
        order = np.lexsort((place, th[number], rid[number]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        document = np.unique(rid, return_inverse=True)[1][number]
        again = self.repeated(content, size.astype(np.int64), number, offset, rank, document)
        return mark_rows(pid[number[again]], rid[number[again]], th[number[again]], place[again], np.ones(int(again.sum()), np.int32), self.keys)


def dealt(docs: DataFrame, n: int) -> DataFrame:
    """pid, rid, th, text and the other columns of docs as x0, x1...: documents dealt by a hash of id and text."""
    others = [docs[f"`{c}`"].alias(f"x{i}") for i, c in enumerate(x for x in docs.columns if x != "text")]
    rid, text = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)), F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(rid.alias("rid"), F.xxhash64(text).alias("th"), text.alias("text"), *others)
    return rows.select(F.pmod(F.hash("rid", "th"), F.lit(4 * n)).alias("pid"), "*").repartition(n, "pid")


#: One document of so many is looked at for hot minimizers, those with so many distinct segments by that sample. There are no more of
#: them than all segments by HOT, so of 100 TB (3e12 segments) at most 6e7 numbers are sent, if every segment had a hot one.
SAMPLE, HOT = 64, 50_000


def hot(docs: DataFrame, finder: Finder) -> np.ndarray:
    """Minimizers that very many different segments share, as where a passage stands in a third of all documents.

    Equal segments are aggregated within each task, so only the surroundings of such a passage are many. Which minimizers are
    taken as hot changes no result: it says only which windows are dealt by themselves.
    """
    some = texts(docs).where(F.pmod(F.xxhash64("rid", "th"), F.lit(SAMPLE)) == 0)
    found = some.mapInArrow(finder.minimizers, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") * SAMPLE > HOT)
    return np.sort(np.array([r[0] for r in found.select("h").collect()], np.int64).view(U))


def marked(rows: DataFrame, finder: Finder, n: int) -> DataFrame:
    """(kind, key, pid, data) of the windows of ``rows`` that repeat another: rows is from dealt(). Buckets are placed by their numbers, so tasks get equally many."""
    placed = lambda df: df.repartitionById(n, F.pmod("key", F.lit(n)).cast("int")).sortWithinPartitions("key")
    found = placed(rows.mapInArrow(finder.segments, ROW)).mapInArrow(finder.resolve, ROW)
    found = rows.groupBy("pid").cogroup(found.groupBy("pid")).applyInArrow(lambda docs, asked: finder.contents(docs, asked), ROW)
    return placed(found).mapInArrow(finder.match, ROW)


def spans(found: pa.Table, window: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """By (rid, th): the units covered by repeated windows, as maximal runs [from, to)."""
    rid, th, first, count = gather(found.column("data").to_pylist(), MARK)
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r, t, a, c in zip(*(x.tolist() for x in merged(rid, th, first, count + window - 1))):
        out.setdefault((r, t), []).append((a, a + c))
    return out
