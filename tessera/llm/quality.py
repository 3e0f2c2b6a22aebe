"""Quality classifier: ordinal regression with cumulative links on graded ratings.

P(grade <= k) = 1 / (1 + exp(-(threshold[k] - w.x))): one weight vector over hashed words, shared by all grades, and ordered
thresholds. It is fitted on the driver from a bounded sample of labelled rows (``FIT_ROWS``, the first by a hash of the id), of
which only feature numbers are collected. Scoring is narrow: 2**18 weights are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, LOWER, U, blocks, utf8, word_codes, words

BITS = 18
#: Labelled rows the model is fitted on, at most.
FIT_ROWS = 20_000
#: Words in fewer of the rows it is fitted on have no weight.
LEAST_ROWS = 15
GRADES = 3
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def grade(labels: DataFrame) -> Column:
    """0 for toxic rows, 1 for those of low quality, 2 for good ones; null if either rating is null."""
    return F.when(labels["toxic"].isNull() | labels["quality"].isNull(), None).when(labels["toxic"] == 1, 0).when(labels["quality"] == 0, 1).otherwise(2)


def features(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text, hashed: its words in lower case, and its length, variety, symbols and capitals in coarse steps."""
    n = len(at) - 1
    low = LOWER[flat]
    start, end, first = words(low, at, ALNUM)
    text = np.repeat(np.arange(n), np.diff(first))
    slot = (word_codes(low, start, end) * U(0x9E3779B97F4A7C15)) >> U(64 - BITS)
    key = np.unique((text.astype(U) << U(BITS)) | slot)
    distinct = np.bincount((key >> U(BITS)).astype(np.int64), minlength=n)
    full = np.flatnonzero(np.diff(at))

    def total(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        out[full] = np.add.reduceat(mask[flat], at[full], dtype=np.int64) if len(full) else 0
        return out

    size = np.maximum(np.diff(at), 1)
    steps = [np.log2(np.diff(first) + 1), 10 * distinct / np.maximum(np.diff(first), 1), np.minimum(40 * total(_SYMBOL) / size, 20), np.minimum(10 * total(_UPPER) / size, 9)]
    shape = np.stack([(k << 8 | s.astype(np.int64)).astype(U) for k, s in enumerate(steps)])
    own = (np.arange(n, dtype=U) << U(BITS)) | ((shape + U(1)) * U(0xC2B2AE3D27D4EB4F)) >> U(64 - BITS)
    key = np.unique(np.concatenate([key, own.ravel()]))
    return (key & U((1 << BITS) - 1)).astype(np.int32), np.searchsorted(key >> U(BITS), np.arange(n + 1, dtype=U))


class Model:
    """weights, float32; thresholds, ascending. Without any rows to fit on, thresholds are None."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray | None):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, f: np.ndarray, at: np.ndarray) -> np.ndarray:
        """P(grade > k) of each text for each threshold k."""
        s = np.add.reduceat(self.weights[f].astype(np.float64), at[:-1])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - s[:, None], -40, 40)))


def fit_arrays(f: np.ndarray, at: np.ndarray, y: np.ndarray, l2: float = 3e-5, steps: int = 400, rate: float = 0.1) -> Model:
    """Maximum likelihood with a ridge, by Adam over all rows at once. The first gap between thresholds and later ones stay positive."""
    n = len(y)
    seen = np.bincount(f, minlength=1 << BITS)
    used = np.flatnonzero(seen >= LEAST_ROWS)
    number = np.full(1 << BITS, -1)
    number[used] = np.arange(len(used))
    row = np.repeat(np.arange(n), np.diff(at))
    f = number[f]
    row, f = row[f >= 0], f[f >= 0]
    k = GRADES - 1
    p = np.zeros(len(used) + k)
    p[len(used) :] = -2.0
    p[len(used) + 1 :] = 0.0
    m1, m2 = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, steps + 1):
        w, first, gaps = p[: len(used)], p[len(used)], np.exp(p[len(used) + 1 :])
        edges = np.concatenate([[-np.inf], first + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        s = np.bincount(row, w[f], n)
        up, lo = sigmoid(edges[y + 1] - s), sigmoid(edges[y] - s)
        up[y == k], lo[y == 0] = 1, 0
        like = np.maximum(up - lo, 1e-12)
        d_up, d_lo = up * (1 - up) / like, lo * (1 - lo) / like
        g = np.zeros_like(p)
        g[: len(used)] = np.bincount(f, (d_up - d_lo)[row], len(used)) / n + l2 * w
        edge = np.bincount(y, -d_up, k + 1)[:k] + np.bincount(y, d_lo, k + 1)[1:]
        g[len(used)] = edge.sum() / n
        g[len(used) + 1 :] = np.cumsum(edge[::-1])[::-1][1:] * gaps / n
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = p[: len(used)]
    return Model(weights, p[len(used)] + np.concatenate([[0], np.cumsum(np.exp(p[len(used) + 1 :]))]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, at = utf8(batch.column("text"))
        for i, j in blocks(at):
            f, first = features(flat[at[i] : at[j]], at[i : j + 1] - at[i])
            yield pa.RecordBatch.from_arrays([batch.column("grade").slice(i, j - i), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(f))], ["grade", "features"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """From at most ``rows`` labelled documents. Rows of labels with a null are left out; of several for one id the lowest grade counts."""
    graded = labels.select(labels["doc_id"].cast("long").alias("id"), grade(labels).alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL").groupBy("id").agg(F.min("grade").alias("grade"))
    graded = graded.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    got = texts.join(F.broadcast(graded), "id").select("grade", "text").mapInArrow(_features, "grade int, features array<int>").toArrow()
    if not len(got):
        return Model(np.zeros(1 << BITS, np.float32), None)
    lists = got.column("features").combine_chunks()
    f, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    return fit_arrays(f, at, got.column("grade").to_numpy().astype(np.int64))


def _tails(model: Model, batch: pa.RecordBatch, text: int) -> np.ndarray:
    """P(grade > k) of each row for each k."""
    flat, at = utf8(batch.column(text))
    out = np.zeros((batch.num_rows, GRADES - 1))
    for i, j in blocks(at):
        out[i:j] = model.tails(*features(flat[at[i] : at[j]], at[i : j + 1] - at[i]))
    return out


def classify(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_above_0, p_above_1 double, kept boolean: one row for each row.

    kept: the top grade has a probability of ``least`` or more. Null and empty texts have the features of no words. If nothing could be fitted,
    the figures are null and every row is kept. Extra columns are passed over.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in batches:
            none = np.full(batch.num_rows, fitted.thresholds is None)
            tails = np.zeros((batch.num_rows, GRADES - 1)) if none.any() else _tails(fitted, batch, 1)
            figures = [pa.array(np.round(x, 6), mask=none) for x in (tails.sum(1), *tails.T)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *figures, pa.array(none | (tails[:, -1] >= least))], ["doc_id", *names])

    names = ["expected_grade", *(f"p_above_{k}" for k in range(GRADES - 1)), "kept"]
    schema = ", ".join(f"{x} {'boolean' if x == 'kept' else 'double'}" for x in names)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {schema}")


def select(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows that classify() keeps, in docs' columns whatever their names, all rows if nothing could be fitted."""
    sent, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch if sent.value.thresholds is None else batch.filter(pa.array(_tails(sent.value, batch, text)[:, -1] >= least))

    return docs.mapInArrow(run, docs.schema)
