"""Language identification: multinomial naive Bayes over hashed character trigrams.

Counts of every learnable document are summed per task in numpy, then by language and range of features. Log probabilities are
broadcast as matrices of ``LANGUAGES`` languages x 2**16 features each (16 MB); rows pass by one matrix after the other and carry the best so
far, so any number of languages is scored without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import codepoints, text_blocks
from .common import shared_folder, written

N = 3
BITS = 16
#: Languages of one matrix; features of one row of counts; characters of a text counted at once.
LANGUAGES, RANGE, PIECE = 64, 1 << 12, 1 << 20
UNDETERMINED = "und"
#: A character of Unicode's categories L.
LETTER = regex.compile(r"\p{L}")


def _hashed(c: np.ndarray, n: int) -> np.ndarray:
    h = c[:n] * np.uint32(0x9E3779B1) + c[1 : n + 1] * np.uint32(0x85EBCA77) + c[2 : n + 2] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - BITS)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed trigrams of the lower-cased texts, with those that reach over the ends, and where each text's begin: of all texts at once, or of a long one in pieces."""
    texts = [t.lower() for t in texts]
    if len(texts) == 1 and (size := len(text := texts[0])) > PIECE:
        for a in range(0, size + N - 1, PIECE):
            b = min(a + PIECE, size + N - 1)
            c, _ = codepoints(["\0" * max(0, N - 1 - a) + text[max(0, a - N + 1) : b] + "\0" * max(0, b - size)])
            yield _hashed(c, b - a), np.array([0, b - a])
    else:
        c, at = codepoints(texts, N - 1)
        yield _hashed(c, int(at[-1])), at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, range, counts): range -1 has the number of documents."""
    grams: dict[str, np.ndarray] = {}
    seen: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for i, j, texts in text_blocks(batch.column("text")):
            for lang in langs[i:j]:
                seen[lang] = seen.get(lang, 0) + 1
            for f, at in features(texts):
                for lang in set(langs[i:j]):
                    rows = [k - i for k in range(i, j) if langs[k] == lang]
                    found = np.bincount(np.concatenate([f[at[k] : at[k + 1]] for k in rows]), minlength=1 << BITS)
                    grams[lang] = grams[lang] + found if lang in grams else found
            if len(grams) > LANGUAGES:
                yield from _rows(grams, seen)
                grams, seen = {}, {}
    yield from _rows(grams, seen)


def _rows(grams: dict[str, np.ndarray], seen: dict[str, int]) -> Iterator[pa.RecordBatch]:
    rows = [(lang, -1, np.array([n])) for lang, n in seen.items()]
    rows += [(lang, r, part) for lang, counts in grams.items() for r, part in enumerate(counts.reshape(-1, RANGE)) if part.any()]
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.int32()), pa.array([x[2] for x in rows], pa.list_(pa.int64()))], ["lang", "range", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, range): one row each, with the counts added up."""
    key, total = None, None
    out: list[tuple] = []
    for batch in batches:
        for lang, r, counts in zip(batch.column("lang").to_pylist(), batch.column("range").to_pylist(), batch.column("counts")):
            own = counts.values.to_numpy()
            if (lang, r) == key:
                total = total + own
                continue
            if key:
                out.append((*key, total))
            key, total = (lang, r), own
    if key:
        out.append((*key, total))
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.list_(pa.int64()))], ["lang", "range", "counts"])


class Model:
    """langs, in order of code points; log probabilities by language and feature; log shares of documents."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray, all_docs: float, smoothing: float):
        self.langs = langs
        self.logp = (np.log(counts + smoothing) - np.log(counts.sum(1, keepdims=True) + smoothing * counts.shape[1])).astype(np.float32)
        self.prior = np.log(docs / all_docs)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log probability of each text with each language."""
        score = np.zeros((len(texts), len(self.langs))) + self.prior
        for f, at in features(texts):
            for k in range(len(self.langs)):
                score[:, k] += np.add.reduceat(self.logp[k][f].astype(np.float64), at[:-1])
        return score


def fit(docs: DataFrame, smoothing: float = 0.1, languages: int = LANGUAGES) -> list[Model]:
    """Models of so many languages each, from text and lang of all rows in which neither is null; none if there are no such rows.

    The driver gets 2**16 counts a language, for ``languages`` of them at a time.
    """
    counted = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    kind = "lang string, range int, counts array<long>"
    counted = counted.mapInArrow(_count, kind).repartition("lang", "range").sortWithinPartitions("lang", "range").mapInArrow(_summed, kind)
    counted = written(counted, f"{shared_folder(docs.sparkSession)}/counts")
    seen = dict(counted.where("range < 0").select("lang", F.get("counts", F.lit(0))).collect())
    names, models = sorted(seen), []
    for i in range(0, len(names), languages):
        own = names[i : i + languages]
        counts = np.zeros((len(own), (1 << BITS) // RANGE, RANGE))
        rows = counted.where((F.col("range") >= 0) & F.col("lang").isin(own)).toArrow()
        for lang, r, part in zip(rows.column("lang").to_pylist(), rows.column("range").to_pylist(), rows.column("counts")):
            counts[own.index(lang), r] = part.values.to_numpy()
        models.append(Model(own, counts.reshape(len(own), -1), np.array([seen[x] for x in own], float), sum(seen.values()), smoothing))
    return models


def held_out(docs: DataFrame):
    """Of three folds by crc32 of the id as text, the one numbered 1."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 3 == 1, F.lit(False))


def _scored(sent):
    """Rows with the best language so far, its log probability, and that of all so far: better ones by one model's languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            lang, best, total = batch.column("lang").to_pylist(), batch.column("best").to_numpy().copy(), batch.column("total").to_numpy().copy()
            for i, j, texts in text_blocks(batch.column("text")):
                known = [k for k, t in enumerate(texts) if LETTER.search(t)]
                if not known:
                    continue
                score = model.scores([texts[k] for k in known])
                top = score.argmax(1)
                for k, b, row in zip(known, top.tolist(), score):
                    if row[b] > best[i + k]:
                        best[i + k], lang[i + k] = row[b], model.langs[b]
                    total[i + k] = np.logaddexp(total[i + k], row[b] + np.log(np.exp(row - row[b]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), batch.column("text"), pa.array(lang, pa.string()), pa.array(best), pa.array(total)], batch.schema.names)

    return run


def identify(docs: DataFrame, models: list[Model]) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row.

    score is the posterior share of the language named. A null text or one without a letter (Unicode's L) gives ``und`` and 0, and so does
    every row if nothing was learned. Ties go to the first language by code point. Repeated rows give equal rows.
    """
    none = F.lit(float("-inf"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(docs).alias("held_out"), F.col("text").cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), none.alias("best"), none.alias("total"))
    for model in models:
        rows = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), rows.schema)
    score = F.when(F.col("lang").isNull(), 0.0).otherwise(F.least(F.lit(1.0), F.exp(F.col("best") - F.col("total"))))
    return rows.select("doc_id", "held_out", F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang_pred"), score.alias("score"))
