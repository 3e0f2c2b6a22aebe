"""Benchmark decontamination by q-gram lemma filtering.

A passage within e edits of an item of m characters shares at least m - q + 1 - e * q of its q-grams, and they lie on diagonals
(document position less item position) at most e apart. Shared q-grams are counted in diagonal bands 2 * (e + 1) wide which
overlap by half, so any such passage has a band that reaches the bound; the regions of these bands are verified by banded alignment
of the whole item against the region, both ends of the region free. Items too short for a q-gram are looked for as they are, as whole words.

Memory is bounded whatever texts and items share: long texts go in pieces that overlap by more than any passage, pieces are halved while
they meet too many postings at once, equal regions are aligned once, and alignments beyond their edits are dropped as they go.

The items are a stated query set: they are read in blocks of bounded size, each block's index is broadcast and all documents
pass by it. Documents are neither shuffled nor collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, codepoints, text_blocks

Q = 8
#: Edits allowed, as a share of an item's characters.
EDITS = 0.1
#: Items and characters of a block of the benchmark at most, which bounds what is broadcast.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000
#: Items and characters of one index at most: a block has several.
INDEX_ITEMS, INDEX_CHARS = 4_000, 1_000_000
#: Characters of a piece of text, besides what overlaps; postings met at once; cells of a row of alignments at once.
PIECE, POSTINGS, CELLS = 1 << 18, 1 << 20, 1 << 18
_BITMAP = 20


def normal(text: str) -> str:
    """Lower case, white space squeezed, a piece at a time."""
    text = text.lower()
    out: list[str] = []
    for a in range(0, len(text), PIECE):
        part = text[a : a + PIECE]
        if words := " ".join(part.split()):
            if out and (part[0].isspace() or text[a - 1].isspace()):
                out.append(" ")
            out.append(words)
    return "".join(out)


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points behind a zero each, one byte for each of them (0 for gaps alone), and where texts begin."""
    c, at = codepoints(texts, 1)
    folded = ((c ^ (c >> np.uint32(8))) & np.uint32(0xFF)).astype(np.uint8)
    folded[(folded == 0) & (c != 0)] = 1
    return c, folded, at


def _packed(folded: np.ndarray) -> np.ndarray:
    """Every run of Q = 8 bytes as one number."""
    x = np.append(folded, np.zeros(Q, np.uint8)).astype(U)
    x = x[:-1] | x[1:] << U(8)
    x = x[:-2] | x[2:] << U(16)
    return (x[:-4] | x[4:] << U(32))[: len(folded)]


class Index:
    """Of some items: sorted q-grams, their postings, and a bitmap that tells most absent q-grams."""

    def __init__(self, items: list[tuple[int, str]], edits: float):
        """items: (number, normal text) of Q characters or more."""
        self.ids, self.texts = [k for k, _ in items], [t for _, t in items]
        self.m = np.array([len(t) for t in self.texts], np.int64)
        self.e = np.minimum((self.m * edits).astype(np.int64), (self.m - Q) // Q)
        self.need = self.m - Q + 1 - self.e * Q
        #: More than any passage and its band.
        self.overlap = int((self.m + 6 * self.e).max()) + 8
        c, folded, at = _folded(self.texts)
        self.chars, self.at = c, at[:-1] + 1
        keys = _packed(folded)
        item = np.repeat(np.arange(len(items)), self.m - Q + 1)
        pos = np.arange(len(item)) - np.repeat(np.cumsum(self.m - Q + 1) - (self.m - Q + 1), self.m - Q + 1)
        keys = keys[self.at[item] + pos]
        order = np.argsort(keys, kind="stable")
        self.item, self.pos = item[order].astype(np.int32), pos[order].astype(np.int32)
        self.keys, first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.first = first
        self.bitmap = np.zeros(1 << _BITMAP, bool)
        self.bitmap[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * U(0x9E3779B97F4A7C15)) >> U(64 - _BITMAP)

    def hits(self, folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of q-grams that items have, and the q-grams' numbers."""
        x = _packed(folded)
        p = np.flatnonzero(self.bitmap[self._slot(x)])
        k = np.searchsorted(self.keys, x[p])
        k[k == len(self.keys)] = 0
        same = self.keys[k] == x[p]
        return p[same], k[same]

    def candidates(self, p: np.ndarray, k: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """text, item, lowest diagonal of each band whose count reaches the item's bound."""
        n = self.count[k]
        at_posting = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        p = np.repeat(p, n)
        item, pos = self.item[at_posting].astype(np.int64), self.pos[at_posting]
        text = np.searchsorted(at, p, "right") - 1
        longest = int(self.m.max())
        diagonal = p - at[text] - 1 - pos + longest
        cell = diagonal // (self.e[item] + 1)
        key, votes = np.unique(((text * len(self.m) + item) << 32) | cell, return_counts=True)
        both = votes.copy()
        both[:-1] += np.where(key[1:] == key[:-1] + 1, votes[1:], 0)
        alone = np.ones(len(key), bool)  # a band whose lower cell is empty has no key of its own
        alone[1:] = key[1:] != key[:-1] + 1
        item = (key >> 32) % max(1, len(self.m))
        ok = both >= self.need[item]
        low = np.where(ok, key, key - 1)
        ok |= alone & (votes >= self.need[item])
        item, text, cell = item[ok], (key[ok] >> 32) // max(1, len(self.m)), low[ok] & 0xFFFFFFFF
        return text, item, cell * (self.e[item] + 1) - longest

    def align(self, regions: list[np.ndarray], item: np.ndarray, clipped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of the whole item against any part of each region in its band, and where that part ends, counted from the band's first diagonal.

        clipped: how many characters of the region before the text's begin are missing. Beyond the item's edits nothing is told apart.
        """
        m, e = self.m[item], self.e[item]
        far = 1 << 20
        best, end = np.full(len(item), far), np.zeros(len(item), np.int64)
        wide = int((4 * e + 3).max())
        columns = np.arange(wide)
        size = np.array([len(r) for r in regions])
        c, at = np.concatenate(regions), np.cumsum(size) - size
        on = np.arange(len(item))
        j = columns[None, :] - clipped[:, None]
        row = np.where((j >= 0) & (j <= size[:, None]), 0, far)
        for i in range(1, int(m.max(initial=0)) + 1):
            j = j + 1  # after i characters of the item, j of the region
            ok = (j >= 0) & (j <= size[on][:, None])
            char = c[np.clip(at[on][:, None] + j - 1, 0, len(c) - 1)]
            new = row + (char != self.chars[np.minimum(self.at[item[on]] + i - 1, len(self.chars) - 1)][:, None])
            new[j < 1] = far
            new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
            new[~ok] = far
            new = np.minimum.accumulate(new - columns, 1) + columns
            new[~ok] = far
            row = new
            last = m[on] == i
            if last.any():
                best[on[last]], end[on[last]] = row[last].min(1), i + row[last].argmin(1)
            if last.any() or i % 8 == 0:
                go = ~last & (row.min(1) <= e[on])
                on, row, j = on[go], row[go], j[go]
                if not len(on):
                    break
        return best, end

    def _pieces(self, text: int, begin: int, part: str, most: int) -> list[tuple[int, int, str]]:
        step = max(most, self.overlap)
        return [(text, begin + a, part[a : a + step + self.overlap]) for a in range(0, max(1, len(part) - self.overlap), step)]

    def search(self, texts: list[str]) -> dict[tuple[int, int], tuple[int, int]]:
        """(edits, end) of the best region by (text, item's number), of those that have one within the item's edits. texts are normal."""
        found: dict[tuple[int, int], tuple[int, int]] = {}
        waiting: list[list[tuple[int, int, str]]] = []
        size = 2 * PIECE + 1
        for p in (p for k, t in enumerate(texts) for p in self._pieces(k, 0, t, PIECE)):
            if size + len(p[2]) > 2 * PIECE:
                waiting.append([])
                size = 0
            waiting[-1].append(p)
            size += len(p[2])
        while waiting:
            part = waiting.pop()
            c, folded, at = _folded([t for *_, t in part])
            p, k = self.hits(folded)
            if int(self.count[k].sum()) > POSTINGS:
                if len(part) > 1:
                    waiting += [part[: len(part) // 2], part[len(part) // 2 :]]
                    continue
                if len(part[0][2]) > 4 * self.overlap:
                    waiting += [[x] for x in self._pieces(*part[0], len(part[0][2]) // 2)]
                    continue
            text, item, low = self.candidates(p, k, at)
            seen: dict[tuple, int] = {}
            each, regions, clips = np.zeros(len(text), np.int64), [], []
            shift = low - self.e[item]  # the band's first diagonal, and where its regions begin
            until = shift + self.m[item] + 4 * self.e[item] + 3
            for n, (t, i, a, b) in enumerate(zip(text.tolist(), item.tolist(), shift.tolist(), until.tolist())):
                own = c[at[t] + 1 + max(0, a) : min(at[t + 1], at[t] + 1 + b)]
                key = i, max(0, -a), own.tobytes()
                if (known := seen.setdefault(key, len(seen))) == len(regions):
                    regions.append(own)
                    clips.append(max(0, -a))
                each[n] = known
            of = np.fromiter((i for i, *_ in seen), np.int64, len(seen))
            best, end = np.zeros(len(seen), np.int64), np.zeros(len(seen), np.int64)
            order, clip = np.argsort(self.e[of], kind="stable"), np.array(clips, np.int64)
            a = 0
            while a < len(order):
                b = min(len(order), a + 256)
                b = max(a + 1, min(b, a + CELLS // int(4 * self.e[of[order[b - 1]]] + 3)))
                some = order[a:b]
                best[some], end[some] = self.align([regions[x] for x in some.tolist()], of[some], clip[some])
                a = b
            for n in np.flatnonzero(best[each] <= self.e[item]).tolist():
                own, begin, _ = part[int(text[n])]
                new = int(best[each[n]]), begin + int(shift[n] + end[each[n]])
                pair = own, self.ids[int(item[n])]
                found[pair] = min(found.get(pair, new), new)
        return found


class Block:
    """Items of the benchmark in several indexes; those under Q characters as whole words."""

    def __init__(self, items: list[tuple[int, str]], edits: float):
        self.ids = [i for i, _ in items]
        normals = [(k, normal(t)) for k, (_, t) in enumerate(items)]
        self.indexes: list[Index] = []
        some: list[tuple[int, str]] = []
        for k, t in sorted((x for x in normals if len(x[1]) >= Q), key=lambda x: (len(x[1]), x[0])):
            if some and (len(some) >= INDEX_ITEMS or len(t) * len(some) > INDEX_CHARS):
                self.indexes.append(Index(some, edits))
                some = []
            some.append((k, t))
        if some:
            self.indexes.append(Index(some, edits))
        self.short: dict[int, dict[str, list[int]]] = {}
        for k, t in normals:
            if 0 < len(t) < Q:
                self.short.setdefault(t.count(" ") + 1, {}).setdefault(t, []).append(k)

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, end) of the best region of each pair of a text and an item that has one within the item's edits."""
        texts = [normal(t) for t in texts]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for index in self.indexes:
            found |= index.search(texts)
        for n, known in self.short.items():
            for t, text in enumerate(texts):
                words = text.split(" ")
                for run in set(words if n == 1 else map(" ".join, zip(*(words[a:] for a in range(n))))) & known.keys():
                    end = f" {text} ".index(f" {run} ") + len(run)
                    found |= {(t, k): (0, end) for k in known[run]}
        return [(t, i, d, x) for (t, i), (d, x) in sorted(found.items())]


def _blocks(benchmark: DataFrame, edits: float) -> Iterator[Block]:
    block: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or size + len(text) > BLOCK_CHARS):
            yield Block(block, edits)
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    yield Block(block, edits)


def leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """doc_id, item_id, edits, region_end: one row for each row of docs and item which it holds within the item's edits.

    Texts are compared in lower case with white space squeezed; edits are of the best region, region_end is where it ends, in characters
    of the text so normalised (of several, the first). An item of m characters has floor(m * edits) edits, or fewer so that
    the lemma's bound stays positive; items of less than 8 characters match as they are, as whole words; empty and null items match nothing.
    Null and empty texts have no rows.
    Repeated rows and repeated items give rows each.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in _blocks(benchmark, edits):
        sent = sc.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for i, _, texts in text_blocks(batch.column("text"), 1 << 19):
                    found = sent.value.search(texts)
                    columns = [[ids[i + t] for t, *_ in found], [sent.value.ids[k] for _, k, *_ in found], [x[2] for x in found], [x[3] for x in found]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["doc_id", "item_id", "edits", "region_end"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, edits long, region_end long")
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """Rows of docs that hold no item, in docs' columns, without a shuffle; see leaks() for what holding one means."""
    sc, columns = docs.sparkSession.sparkContext, docs.schema
    for index in _blocks(benchmark, edits):
        sent = sc.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = np.ones(batch.num_rows, bool)
                for i, _, texts in text_blocks(batch.column("text"), 1 << 19):
                    ok[[i + t for t, *_ in sent.value.search(texts)]] = False
                yield batch.filter(pa.array(ok))

        docs = docs.mapInArrow(run, columns)
    return docs
