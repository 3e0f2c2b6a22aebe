"""Token counts under a unigram model, by dynamic programming shared along a trie.

The distinct pre-tokens that a block of texts has go, in order, into a trie of bytes. A node's forward score, the best log probability of
any segmentation of the bytes that lead to it, and the number of tokens of that segmentation are computed once, when the node is
made, for all nodes of a depth together; whatever shares the prefix reuses them. Terminals keep the counts for later blocks, so a
pre-token seen again costs one lookup. The operator is narrow: no shuffle. Terminals that reach ``max_nodes`` are begun anew, which changes no
count, and what a pre-token has beyond ``DEPTH`` bytes makes no nodes: its scores are kept as far back as the longest piece reaches.
Texts are split in arrays as ``PATTERN`` does; other patterns are left to the regex module.
"""

from __future__ import annotations

import base64
import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import blocks, utf8

#: Fixed value: the pattern by which the public byte-level vocabularies split text before their merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of a pre-token that make nodes of the trie.
DEPTH = 256

#: Bytes of texts whose pre-tokens are counted together (longer rows alone); and of what is split or put into the trie at a time.
BLOCK, PIECE = 1 << 22, 1 << 20
#: Bytes before and after a piece that decide about its splits: four code points.
AROUND = 16

OTHER, LETTER, NUMBER, SPACE = range(4)


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, as the regex module has it."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def _starts(flat: np.ndarray, at: np.ndarray, a: int, b: int) -> np.ndarray:
    """The bytes in [a, b) with which PATTERN's matches begin, in rows that start at ``at``.

    The matches leave no gap. Runs of a class begin one, but for a run behind a blank, which the blank begins; so does the last space before
    what is none; and behind a contraction one begins, not in it. A contraction's apostrophe begins a match itself.
    """
    lo, hi = max(0, a - AROUND), min(len(flat), b + AROUND)
    while lo > 0 and flat[lo] & 0xC0 == 0x80:
        lo -= 1
    while hi < len(flat) and flat[hi] & 0xC0 == 0x80:
        hi += 1
    window = flat[lo:hi]
    place = np.flatnonzero(window & 0xC0 != 0x80) + lo
    point = np.frombuffer(window.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = classes()[point]
    first = np.zeros(len(point) + 1, bool)
    first[np.searchsorted(place, at[np.searchsorted(at, lo) : np.searchsorted(at, hi, "right")])] = True
    first[-1] = True
    space, other = kind == SPACE, np.empty(len(kind), bool)
    other[0], other[1:] = True, kind[1:] != kind[:-1]
    other |= first[:-1]
    behind = np.zeros(len(kind), bool)
    behind[1:] = point[:-1] == 0x20
    behind &= ~first[:-1]
    ends = np.zeros(len(kind), bool)
    ends[:-1] = ~space[1:] & ~first[1:-1]
    start = np.where(space, other | ends, other & ~behind)
    q = np.flatnonzero((point == 0x27) & start)
    if len(q):
        padded = np.concatenate([point, np.zeros(2, np.uint32)])
        one = np.where(first[q + 1], 0, padded[q + 1])
        two = np.where((one == 0) | first[np.minimum(q + 2, len(point))], 0, padded[q + 2])
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[q[short | long] + 1] = False
        after = np.concatenate([q[short] + 2, q[long] + 3])
        start[after[after < len(start)]] = True
    place = place[start]
    return place[np.searchsorted(place, a) : np.searchsorted(place, b)]


def _runs(flat: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Where PATTERN's matches begin, and where the last ends, for about PIECE bytes at a time: the next ones begin there."""
    n, last = len(flat), np.zeros(0, np.int64)
    for a in range(0, n, PIECE):
        start = np.concatenate([last, _starts(flat, at, a, min(a + PIECE, n)), [n] * (a + PIECE >= n)]).astype(np.int64)
        if len(start) > 1:
            yield start
        last = start[-1:]


def _between(flat: np.ndarray, start: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(start) - 1, [None, pa.py_buffer(start), pa.py_buffer(flat)])


def _found(flat: np.ndarray, pattern: str) -> Iterator[bytes]:
    return (m.group().encode() for m in regex.finditer(pattern, flat.tobytes().decode("utf-8")))


def pretokens(flat: np.ndarray, at: np.ndarray, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """The matches of the pattern in rows of UTF-8 bytes, one after the other, and how many each row has."""
    if pattern != PATTERN:
        found = [[*_found(flat[a:b], pattern)] for a, b in zip(at[:-1], at[1:])]
        return pa.array([x for row in found for x in row], pa.large_binary()), np.array([len(row) for row in found], np.int64)
    start = np.concatenate([*(x[:-1] for x in _runs(flat, at)), [len(flat)]]).astype(np.int64)
    return _between(flat, start), np.diff(np.searchsorted(start[:-1], at))


def distinct_pretokens(flat: np.ndarray, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """The distinct matches in one row and how often each is there; all matches are never held together."""
    if pattern != PATTERN:
        pieces = (pa.array(x, pa.large_binary()) for x in itertools.batched(_found(flat, pattern), PIECE >> 4))
    else:
        pieces = (_between(flat, x) for x in _runs(flat, np.array([0, len(flat)])))
    found, times = [pa.array([], pa.large_binary())], [np.zeros(0, np.int64)]
    for piece in pieces:
        coded = piece.dictionary_encode()
        found.append(coded.dictionary)
        times.append(np.bincount(coded.indices.to_numpy()))
    coded = pa.concat_arrays(found).dictionary_encode()
    return coded.dictionary, np.bincount(coded.indices.to_numpy(), np.concatenate(times)).astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """Log probabilities of pieces (bytes); every single byte is a piece."""

    logp: dict[bytes, float]
    pattern: str = PATTERN

    @staticmethod
    def from_ranks(path: str) -> Vocabulary:
        """From a file of base64 pieces and ranks. The files have no probabilities, so a piece's is by Zipf's law on its rank."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        whole = math.log(sum(1 / (r + 1) for r in ranks.values()))
        logp = {piece: -math.log(r + 1) - whole for piece, r in ranks.items()}
        least = min(logp.values()) - 1
        return Vocabulary({bytes([b]): least for b in range(256)} | logp)


class Endings:
    """The trie of the pieces read from their ends: the bytes before a place are followed while they can still be the end of a piece."""

    def __init__(self, logp: dict[bytes, float]):
        ends = sorted({p[i:] for p in logp for i in range(len(p))}, key=len)
        ids, self.keys, self.logp = {b"": 0}, np.zeros(len(ends), np.int64), np.full(len(ends) + 1, -np.inf)
        a = 0
        while a < len(ends):  # numbered by length, then parent and byte: keys ascend
            b = a
            while b < len(ends) and len(ends[b]) == len(ends[a]):
                b += 1
            for key, e in sorted((ids[e[1:]] << 8 | e[0], e) for e in ends[a:b]):
                self.keys[len(ids) - 1] = key
                self.logp[len(ids)] = logp.get(e, -np.inf)
                ids[e] = len(ids)
            a = b

    def before(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node with one more byte before, 0 if there is none."""
        key = node << 8 | byte
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, i + 1, 0)


class Trie:
    """children: (node, byte) to node, of pre-tokens inserted alone. Terminals: pre-token to (tokens, log probability)."""

    def __init__(self, vocabulary: Vocabulary, endings: Endings | None = None):
        self.logp = vocabulary.logp
        self.endings = endings or Endings(vocabulary.logp)
        #: Ends of pieces: a segmentation's last piece can be found by growing to the left while this holds.
        self.ends = {p[i:] for p in vocabulary.logp for i in range(len(p))}
        self.longest = max(map(len, vocabulary.logp))
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminals: dict[bytes, tuple[int, float]] = {}

    def insert(self, pretoken: str | bytes) -> tuple[int, float]:
        data = pretoken.encode("utf-8", "surrogatepass") if isinstance(pretoken, str) else pretoken
        logp, ends, children, score, tokens = self.logp, self.ends, self.children, self.score, self.tokens
        path = [0]
        node = 0
        for i, byte in enumerate(data[:DEPTH], 1):
            key = node << 8 | byte
            node = children.get(key, -1)
            if node < 0:
                best, count, j = -math.inf, 0, i - 1
                while j >= 0 and (piece := data[j:i]) in ends:
                    if (p := logp.get(piece)) is not None and (s := score[path[j]] + p) > best:
                        best, count = s, tokens[path[j]] + 1
                    j -= 1
                children[key] = node = len(score)
                score.append(best)
                tokens.append(count)
            path.append(node)
        if len(data) > DEPTH:
            return self._beyond(data, [(score[n], tokens[n]) for n in path])
        out = self.terminals[data] = tokens[node], score[node]
        return out

    def look_up(self, sorted_pretokens: pa.Array, max_nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and log probability of distinct pre-tokens in ascending order; those not known are inserted, about PIECE bytes at a time."""
        n, logp = np.zeros(len(sorted_pretokens), np.int64), np.zeros(len(sorted_pretokens))
        for i, j in blocks(np.frombuffer(sorted_pretokens.buffers()[1], np.int64)[sorted_pretokens.offset :][: len(sorted_pretokens) + 1], PIECE):
            some = sorted_pretokens.slice(i, j - i).to_pylist()
            known = list(map(self.terminals.get, some))
            new = [x for x, k in zip(some, known) if k is None]
            if new:
                short = [x for x in new if len(x) <= DEPTH]
                if len(self.terminals) + len(short) + len(self.score) > max_nodes:
                    self.clear()
                made = dict(zip(short, zip(*(x.tolist() for x in self._insert_all(short)))))
                self.terminals |= made
                for x in new if len(short) < len(new) else ():
                    if len(x) > DEPTH:
                        if len(self.score) > max_nodes:
                            self.clear()
                        made[x] = self.insert(x)
                known = [k or made[x] for x, k in zip(some, known)]
            n[i:j], logp[i:j] = zip(*known)
        return n, logp

    def _insert_all(self, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As insert does, for distinct pre-tokens in ascending order: the nodes of a depth are made together, from those above."""
        size = np.array([len(x) for x in pretokens], np.int64)
        flat = np.frombuffer(b"\0".join([*pretokens, b""]), np.uint8).astype(np.int64)
        # at: where a pre-token's bytes begin. The score and tokens after its first k bytes are at this + k.
        at = np.cumsum(size + 1) - size - 1
        score, tokens = np.zeros(len(flat)), np.zeros(len(flat), np.int64)
        deep, shared = np.arange(len(size)), np.ones(len(size), bool)  # shared: the bytes so far are those of the pre-token before
        shared[:1] = False
        for k in range(1, int(size.max(initial=0)) + 1):
            deep = deep[size[deep] >= k]
            here, above = at[deep] + k, np.maximum(deep - 1, 0)
            shared[deep] &= (size[above] >= k) & (flat[np.minimum(at[above] + k, len(flat)) - 1] == flat[here - 1])
            made = ~shared[deep]
            whose = here[made]
            best, count = np.full(len(whose), -np.inf), np.zeros(len(whose), np.int64)
            on, node = np.arange(len(whose)), np.zeros(len(whose), np.int64)
            for back in range(1, min(k, self.longest) + 1):
                from_ = whose[on] - back
                node = self.endings.before(node, flat[from_])
                some = node > 0
                on, node, from_ = on[some], node[some], from_[some]
                if not len(on):
                    break
                s = score[from_] + self.endings.logp[node]
                more = s > best[on]
                best[on[more]], count[on[more]] = s[more], tokens[from_[more]] + 1
            of = np.cumsum(made) - 1
            score[here], tokens[here] = best[of], count[of]
        return tokens[at + size], score[at + size]

    def _beyond(self, data: bytes, known: list[tuple[float, int]]) -> tuple[int, float]:
        """From the scores up to DEPTH bytes to those at the end, by the same recurrence over a window of the last ones."""
        logp, ends, window = self.logp, self.ends, known[-self.longest :]
        begin = len(known) - len(window)  # the bytes before which window begins
        for i in range(len(known), len(data) + 1):
            best, count, j = -math.inf, 0, i - 1
            while j >= begin and (piece := data[j:i]) in ends:
                if (p := logp.get(piece)) is not None and (s := window[j - begin][0] + p) > best:
                    best, count = s, window[j - begin][1] + 1
                j -= 1
            window.append((best, count))
            if len(window) > 4 * self.longest:
                begin += len(window) - self.longest
                del window[: -self.longest]
        return window[-1][1], window[-1][0]


def _counted(trie: Trie, flat: np.ndarray, at: np.ndarray, pattern: str, max_nodes: int) -> tuple[np.ndarray, ...]:
    """Of each row: pre-tokens, distinct ones, tokens and log probability, summed in ascending order of pre-tokens."""
    rows, long = len(at) - 1, len(at) == 2 and len(flat) > BLOCK
    if long:
        words, times = distinct_pretokens(flat, pattern)
        each = np.array([times.sum()])
    else:
        found, each = pretokens(flat, at, pattern)
        coded = found.dictionary_encode()
        words = coded.dictionary
    if not len(words):
        return each, each, each, np.zeros(rows)
    order = pc.array_sort_indices(words)
    n, logp = trie.look_up(words.take(order), max_nodes)
    order = order.to_numpy()
    if long:
        row, code, times = np.zeros(len(order), np.int64), np.arange(len(order)), times[order]
    else:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        keys, times = np.unique(np.repeat(np.arange(rows) * len(order), each) + rank[coded.indices.to_numpy()], return_counts=True)
        row, code = np.divmod(keys, len(order))
    tokens = np.bincount(row, n[code] * times, rows)
    return each, np.bincount(row, minlength=rows), tokens.astype(np.int64), np.bincount(row, logp[code] * times, rows)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, max_nodes: int = 400_000) -> DataFrame:
    """doc_id, n_pretokens, n_distinct, n_tokens long, logp double: one row for each row.

    n_tokens is that of the most probable segmentation of every pre-token, logp the sum of their log probabilities. Of equally
    probable segmentations the one with the shortest last piece counts. A null or empty text has zeros.
    """
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, Endings(vocabulary.logp)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, pattern = Trie(*sent.value), sent.value[0].pattern
        for batch in batches:
            flat, at = utf8(batch.column("text"))
            out = [_counted(trie, flat[at[i] : at[j]], at[i : j + 1] - at[i], pattern, max_nodes) for i, j in blocks(at, BLOCK)]
            columns = [np.concatenate(x) for x in zip(*out)] or [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in columns[:3]), pa.array(columns[3], pa.float64())], ["doc_id", "n_pretokens", "n_distinct", "n_tokens", "logp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_distinct long, n_tokens long, logp double")
