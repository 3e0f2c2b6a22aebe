"""Connected components by alternating large and small stars; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, folder: str, rows: int | None = None) -> DataFrame:
    """(node, label) of all nodes but the least of each component, whose label is the least node; edges: (u, v) of any type in order, either way round.

    rows: how many edges there are at most, if that is known. Loops are passed over. The number of rounds grows with the logarithm of a component's size.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, last, step = written(edges, f"{folder}/0", rows), None, 0
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        last, step = now, step + 1
        edges = written(_small_star(_large_star(edges).distinct()), f"{folder}/{step}", now[0])
