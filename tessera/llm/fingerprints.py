"""Document fingerprints by locally consistent parsing.

A text's bytes are the symbols of level 0. At each level runs of one symbol are collapsed, deterministic coin tossing gives
each symbol one of six labels from itself and a few neighbours to its left, local maxima of the labels begin phrases, and a phrase's
name, a hash of its symbols, is a symbol of the next level. So the names inside a substring, but for a few at its
ends, are the same wherever it stands. The fingerprint has the one name left at a text's top level and a one-permutation
sketch of the names of levels 2 and 3 (phrases of about 10 and 40 bytes).

The text after a document is found in one shuffle of the texts: rows are dealt into blocks of consecutive ids, the
head of each block also into the one before it, and each block is read in order, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE, Rolling, U, mix
from .common import id_of, pieces, texts

BINS = 128
#: Blocks at most: beyond 2 TB their rows grow in number, each block still being read as a stream. Ids sampled for each block's bounds.
MAX_BLOCKS, IDS_A_BLOCK = 1 << 18, 20
#: Bytes of a text parsed as one; a longer one is cut at its multiples, and the pieces' names are taken together.
PIECE = 1 << 20
_LOW64 = np.zeros(64, np.uint8)
_DEBRUIJN = U(0x03F79D71B4CB0A89)
_LOW64[((U(1) << np.arange(64, dtype=U)) * _DEBRUIJN) >> U(58)] = np.arange(64)
_LOW8 = np.array([(i & -i).bit_length() - 1 if i else 0 for i in range(256)], np.uint8)


def _lowest(x: np.ndarray) -> np.ndarray:
    """Index of the lowest bit that is set."""
    return _LOW8[x] if x.dtype == np.uint8 else _LOW64[((x & (~x + U(1))) * _DEBRUIJN) >> U(58)]


def labels(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of symbols of which no two neighbours are equal: labels below 6 with the same property, by deterministic coin tossing."""
    first = at[:-1][np.diff(at) > 0]
    rounds = 3 if x.dtype == np.uint8 else 4
    for _ in range(rounds):
        i = np.zeros(len(x), np.uint8)
        i[1:] = _lowest(x[1:] ^ x[:-1])
        i[first] = 0
        x = (i << 1) | ((x >> i) & x.dtype.type(1)).astype(np.uint8)
    return x


def collapse(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of one symbol begin, the runs' lengths, and where texts begin among the runs."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    new[at[:-1][at[:-1] < len(x)]] = True
    start = np.flatnonzero(new)
    return start, np.diff(start, append=len(x)), np.searchsorted(start, at)


def parse(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the next level and where texts begin among them. x: bytes, or names of 64 bits."""
    if not len(x):
        return np.zeros(0, U), at
    start, length, at = collapse(x, at)
    x = x[start]
    label = labels(x, at)
    top = np.zeros(len(x), bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    inner = at[:-1][np.diff(at) > 0]
    top[inner[1:] - 1] = False  # the last of a text begins no phrase
    top[inner] = True
    begin = np.flatnonzero(top)
    codes = BYTE[x] if x.dtype == np.uint8 else x
    names = Rolling(mix(codes + (length - 1).astype(U) * U(0x9E3779B97F4A7C15))).runs(begin, np.append(begin[1:], len(x)))
    return names, np.searchsorted(begin, at)


def sketches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the hash of its parse, and BINS bytes, of which 0 is an empty bin. Some texts, or pieces of one, are parsed at a time."""
    low = np.full(len(texts) * BINS, 0xFFFFFFFF, np.uint32)
    root = np.zeros(len(texts), U)
    parts: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        own = np.array(owner)
        for k, r in zip(owner, _parsed(parts, own, low).tolist()):
            root[k] = r if texts[k] is parts[owner.index(k)] else mix(root[k : k + 1] * BYTE[7] + U(r))[0]
        parts.clear()
        owner.clear()

    for k, t in enumerate(texts):
        for part in [t] if len(t) <= PIECE else [t[a : a + PIECE] for a in range(0, len(t), PIECE)]:
            parts.append(part)
            owner.append(k)
            size += len(part)
            if size > PIECE:
                flush()
                size = 0
    flush()
    sketch = np.where(low == 0xFFFFFFFF, 0, (mix(low.astype(U)) % U(255)).astype(np.uint8) + 1).astype(np.uint8)
    return root, sketch.reshape(-1, BINS)


def phrases(parts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, names, where each part's begin) from level 1 to the top, where each part that isn't empty has one name."""
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=at[1:])
    x: np.ndarray = np.frombuffer(b"".join(parts), np.uint8)
    level = 0
    while level < 3 or np.diff(at).max(initial=0) > 1:
        x, at = parse(x, at)
        level += 1
        yield level, x, at


def _parsed(parts: list[bytes], owner: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Each part's one name at its top; low gets the least hashes of the names of levels 2 and 3, by the parts' owner and bin."""
    root, open_ = np.zeros(len(parts), U), np.ones(len(parts), bool)
    for level, x, at in phrases(parts):
        done = open_ & (np.diff(at) == 1)
        root[done] = x[at[:-1][done]]
        open_ &= ~done
        if level in (2, 3) and len(x):
            h = mix(x + U(level))
            np.minimum.at(low, np.repeat(owner, np.diff(at)) * BINS + (h >> U(57)).astype(np.int64), (h & U(0xFFFFFFFE)).astype(np.uint32))
    return root


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of phrases in common (Dice's), as two sketches show it; 1 for two empty ones."""
    some = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1) / np.maximum(some, 1)
    return np.where(some > 0, 2 * same / (1 + same), 1.0)


def _block(rid: Column, th: Column, heads: list[tuple[int, int]]) -> tuple[Column, Column]:
    """Index of the last of the sorted heads (rid, th) that is at most the row's, by binary search, and whether it is the row's own."""
    ids, hashes = (F.lit(np.array([h[k] for h in heads], np.int64)) for k in (0, 1))
    steps = [1 << k for k in reversed(range(max(1, (len(heads) - 1).bit_length())))]
    above = lambda i: (F.get(ids, i) < rid) | ((F.get(ids, i) == rid) & (F.get(hashes, i) <= th))
    own = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, s: F.when((low + s < len(heads)) & above(low + s), low + s).otherwise(low))
    return own, (F.get(ids, F.col("own")) == rid) & (F.get(hashes, F.col("own")) == th)


def in_order(docs: DataFrame) -> DataFrame:
    """(block, copy, rid, th, text): every row once with copy false and, if it heads a block, once more for the block before.

    Blocks are runs of rows in order of id and, for rows of one id, of their texts' hashes; each is placed by its number.
    """
    rows = texts(docs)
    ids = rows.select("rid", "th")
    n = min(MAX_BLOCKS, pieces(docs))
    total, least = ids.agg(F.count("*"), F.min(F.struct("rid", "th"))).first()
    if not total:
        return rows.select(F.lit(0).alias("block"), F.lit(False).alias("copy"), "rid", "th", "text")
    sample = sorted(map(tuple, ids.sample(min(1.0, IDS_A_BLOCK * n / total), seed=7).collect()))
    heads = sorted({tuple(least), *(sample[len(sample) * i // n] for i in range(1, n) if sample)})
    own, is_head = _block(F.col("rid"), F.col("th"), heads)
    rows = rows.withColumn("own", own)
    dealt = F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("copy")), F.when(is_head, F.struct(F.pmod(F.col("own") - 1, F.lit(len(heads))).alias("block"), F.lit(True).alias("copy"))))
    rows = rows.withColumn("to", F.explode(F.filter(dealt, lambda x: x.isNotNull())))
    return rows.select("to.block", "to.copy", "rid", "th", "text").repartitionById(len(heads), F.col("block")).sortWithinPartitions("block", "copy", "rid", "th")


OUT = "rid long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rids: list[int], texts_: list[str], next_: list[str]) -> pa.RecordBatch:
    edited = []
    for text, after in zip(texts_, next_):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    as_bytes = [[x.encode("utf-8", "surrogatepass") for x in xs] for xs in (texts_, edited, next_)]
    root, sketch = sketches(as_bytes[0] + as_bytes[1] + as_bytes[2])
    k = len(rids)
    name = [f"{r:016x}{s.tobytes().hex()}" for r, s in zip(root[: 2 * k].tolist(), sketch[: 2 * k])]
    a, b, c = sketch[:k], sketch[k : 2 * k], sketch[2 * k :]
    columns = [pa.array(rids, pa.int64()), pa.array([len(t) for t in texts_], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in as_bytes[1]], pa.string()), pa.array(name[:k], pa.string()), pa.array(name[k:], pa.string()), pa.array(likeness(a, b)), pa.array(likeness(a, c))]
    return pa.RecordBatch.from_arrays(columns, ["rid", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row with the one after it, some at a time."""
    rids, these, after, size = [], [], [], 0
    last = None  # block, rid, text
    for batch in batches:
        for block, copy, rid, text in zip(*(batch.column(c).to_pylist() for c in ("block", "copy", "rid", "text"))):
            if last and last[0] == block:
                rids.append(last[1])
                these.append(last[2])
                after.append(text)
                size += len(last[2])
                if size > 1 << 20:
                    yield _compare(rids, these, after)
                    rids, these, after, size = [], [], [], 0
            last = None if copy else (block, rid, text)
    if rids:
        yield _compare(rids, these, after)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row for each row.

    The next document is that with the next larger id; after the last comes the first, and a lone one comes after itself. A null id is the
    smallest; rows of one id follow each other by their texts' hashes. A null text is empty; two empty texts have likeness 1.
    """
    return in_order(docs).select("block", "copy", "rid", "text").mapInArrow(_pairs, OUT).select(id_of(F.col("rid")), *[x.split()[0] for x in OUT.split(", ")[1:]])


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint: one row for each row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .arrays import text_blocks

        for batch in batches:
            for i, j, part in text_blocks(batch.column("text")):
                root, sketch = sketches([t.encode("utf-8", "surrogatepass") for t in part])
                yield pa.RecordBatch.from_arrays([batch.column("rid").slice(i, j - i), pa.array([f"{r:016x}{s.tobytes().hex()}" for r, s in zip(root.tolist(), sketch)], pa.string())], ["rid", "fingerprint"])

    return texts(docs).select("rid", "text").mapInArrow(run, "rid long, fingerprint string").select(id_of(F.col("rid")), "fingerprint")
