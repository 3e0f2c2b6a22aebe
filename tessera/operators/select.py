"""Ranking within groups: diverse top k, first of a key."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import language_rank
from ..functions.text import language_family


def diverse_top_k(df: DataFrame, group: str, kind: Column, order: list[Column], k: int) -> DataFrame:
    """At most k rows of each group: the best of each kind come first, then the others, both in order.

    Ids are unique within a group. Both windows use the group's partitioning; Spark keeps rows beyond k out of the shuffle's
    output by its group limit where it can.
    """
    df = df.withColumn("kind_", kind)
    nth = F.row_number().over(Window.partitionBy(group, "kind_").orderBy(*order))
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col("nth_") > 1, *order))
    return df.withColumn("nth_", nth).withColumn("place_", place).where(F.col("place_") <= k).drop("kind_", "nth_")


def of_candidates(submissions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Submissions to candidate problems: a semi join on the ids, which is broadcast where it is small enough."""
    return submissions.join(candidates.select(F.col("id").alias("problem_id")).distinct(), "problem_id", "left_semi")


def selected_solutions(submissions: DataFrame, most: int) -> DataFrame:
    """By preferred language, then shorter source, then id as text, every language once before any twice."""
    order = [language_rank(F.coalesce("programmingLanguage", F.lit(""))), F.length(F.coalesce("source", F.lit(""))), F.col("submission_id").cast("string")]
    return diverse_top_k(submissions, "problem_id", F.coalesce("programmingLanguage", F.lit("")), order, most).drop("place_")


def solutions_to_verify(solutions: DataFrame, most: int = 2, pypy: bool = False) -> DataFrame:
    """Of solutions with a compiler: one of each in alphabetical order, then by compiler and id."""
    family = language_family(F.col("language"))
    rows = solutions.withColumn("compiler", family).where(F.col("compiler").isNotNull() & (F.lit(pypy) | (F.col("compiler") != "pypy")))
    order = [F.col("compiler"), F.col("source_id").cast("string")]
    return diverse_top_k(rows, "problem_id", F.col("compiler"), order, most).drop("place_")


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("nth_", nth).where("nth_ = 1").drop("nth_")


def shuffled_first(df: DataFrame, key: str, n: int, seed: int = 42, mode: str = "hash", order: str | None = None) -> DataFrame:
    """n rows in an order drawn by a keyed hash: the scalable form of a seeded shuffle.

    mode "exact" takes the first n of CPython's shuffle of the keys in the order of a column, on the driver: for small sets alone.
    """
    if mode == "exact":
        keys = [r[0] for r in df.select(key, *([order] if order else [])).orderBy(order or key).select(key).collect()]
        random.Random(seed).shuffle(keys)
        return df.where(F.col(key).isin(keys[:n]))
    return df.orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)
