"""Corpus pipeline: quality classifier, near-dedup, suffix-array dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents. Stages pass rows to Python in small batches, which bounds an executor's memory over all of them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, mixing, near_dedup, quality, suffix_dedup
from tessera.llm.common import shared_folder, small_batches, table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. It is fitted on the labels of this stage's documents."""
    return quality.select(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (0.8 of their 5-word shingles), the one with the least id; all documents without words."""
    return near_dedup.dedup(docs, k=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat 100 bytes found before; n_chars is that of what is left."""
    return suffix_dedup.dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target, finish (of the first pass) and taken."""
    return mixing.mix(docs).where("taken > 0")


def _stage(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, in a session whose batches are small."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(docs.sparkSession)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality classifier", _stage(classify)),
    ("MinHash near-dedup", _stage(drop_near_duplicates)),
    ("suffix-array dedup", _stage(cut_repeats)),
    ("benchmark decontamination", _stage(drop_leaks)),
    ("mixing sources to target weights", _stage(mix)),
]

#: The first stage is a fitted model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
