"""Candidates, code signals and the evidence of independent solutions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scoring as K
from ..functions.text import barrier, flat_code


def candidates(problems: DataFrame, rejects: bool = False) -> DataFrame:
    """Problems with evidence from tags and editorials, their scores and tiers; rejects are left out."""
    df = problems.withColumn("dp_tag", F.coalesce(F.array_contains("tags", "dp"), F.lit(False)))
    df = df.withColumn("editorial_dp_evidence", P.editorial_evidence(F.col("editorial"))).withColumn("metadata_evidence", P.tag_evidence(F.col("tags")))
    df = df.withColumn("heuristic_score", K.candidate_score(F.col("dp_tag"), F.col("editorial_dp_evidence"), F.col("metadata_evidence")))
    df = df.withColumn("tier", K.candidate_tier(F.col("dp_tag"), F.col("editorial_dp_evidence"), F.col("heuristic_score")))
    df = df.withColumn("has_editorial", F.coalesce(F.col("editorial") != "", F.lit(False)))
    keep = ["id", "title", "description", "tags", "rating", "has_editorial", "executable", "official_tests_complete", "dp_tag", "editorial_dp_evidence", "metadata_evidence", "heuristic_score", "tier", "source", "source_split"]
    return df.select(*keep) if rejects else df.where("tier <> 'reject'").select(*keep)


def candidate_totals(all_candidates: DataFrame) -> DataFrame:
    """From candidates(rejects=True): total, candidates, seeds."""
    return all_candidates.agg(F.count("*").alias("total"), F.count_if(F.col("tier") != "reject").alias("candidates"), F.count_if(F.col("tier") == "seed").alias("seeds"))


def solution_signals(solutions: DataFrame) -> DataFrame:
    """Accepted solutions with their signals and score. The flattened code is computed once."""
    df = solutions.where(F.coalesce("is_accepted", F.lit(False))).withColumn("flat_", flat_code(F.coalesce("source_code", F.lit(""))))
    df = barrier(df, "flat_").withColumn("signals", P.code_signals(F.col("flat_"))).drop("flat_")
    df = barrier(df, "signals")
    return df.withColumn("score", K.signal_score(F.col("signals")))


def problem_signals(signalled: DataFrame, order: str = "source_id") -> DataFrame:
    """One row a problem. signal_counts has the number of solutions with each signal; solutions are in order."""
    per = signalled.groupBy("problem_id").agg(
        F.count("*").alias("accepted_solution_count"), F.max("score").alias("best_solution_score"),
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("order_"), "source_id", "language", "signals", "score"))).alias("solutions"),
    )
    per = per.withColumn("solutions", F.transform("solutions", lambda s: F.struct(s["source_id"].alias("source_id"), s["language"].alias("language"), s["signals"].alias("signals"), s["score"].alias("score"))))
    counts = signal_counts(signalled).groupBy("problem_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("signal", "n")))).alias("signal_counts"))
    empty = F.create_map().cast("map<string, bigint>")
    return per.join(counts, "problem_id", "left").select("problem_id", "accepted_solution_count", "best_solution_score", F.coalesce("signal_counts", empty).alias("signal_counts"), "solutions")


def signal_counts(signalled: DataFrame) -> DataFrame:
    """(problem_id, signal, n)."""
    return signalled.select("problem_id", F.explode("signals").alias("signal")).groupBy("problem_id", "signal").agg(F.count("*").alias("n"))


def class_counts(signalled: DataFrame) -> DataFrame:
    """Of each problem: solutions, and those that are strong, moderate and weak."""
    kind = signalled.withColumn("class", K.solution_class(F.col("signals"), F.col("score")))
    return kind.groupBy("problem_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("class") == c).alias(c) for c in ("strong", "moderate", "weak")])


def evidence(candidates: DataFrame, signals: DataFrame) -> DataFrame:
    """Candidates with what their accepted solutions agree on. signals: from problem_signals()."""
    kind = lambda s: K.solution_class(s["signals"], s["score"])
    s = signals.select("problem_id", "accepted_solution_count", "best_solution_score", "signal_counts", F.transform("solutions", kind).alias("classes"))
    n = lambda c: F.size(F.filter("classes", lambda x: x == c)).cast("long")
    df = candidates.withColumnRenamed("id", "problem_id").join(s, "problem_id", "left")
    df = df.withColumn("classes", F.coalesce("classes", F.array().cast("array<string>")))
    df = df.select("*", F.size("classes").alias("total_"), *[n(c).alias(f"{c}_solution_count") for c in ("strong", "moderate", "weak")])
    df = df.withColumn("consensus_", F.when(F.col("total_") > 0, F.col("strong_solution_count") / F.col("total_")).otherwise(0.0))
    hinted = F.coalesce("dp_tag", F.lit(False)) | (F.size(F.coalesce("editorial_dp_evidence", F.array().cast("array<string>"))) > 0)
    level = K.evidence_level(F.col("total_"), F.col("strong_solution_count"), F.col("moderate_solution_count"), F.col("weak_solution_count"), F.col("consensus_"), hinted)
    return df.select(
        "problem_id", "title", "rating", F.coalesce("dp_tag", F.lit(False)).alias("dp_tag"), F.col("editorial_dp_evidence").alias("editorial_evidence"), "metadata_evidence",
        F.coalesce("accepted_solution_count", F.lit(0)).cast("long").alias("accepted_solution_count"), "strong_solution_count", "moderate_solution_count", "weak_solution_count",
        F.round("consensus_", 3).alias("dp_consensus"), F.coalesce("signal_counts", F.create_map().cast("map<string, bigint>")).alias("signal_counts"),
        F.coalesce("best_solution_score", F.lit(0.0)).alias("best_solution_score"), level.alias("evidence_level"),
    )


def counts_of(df: DataFrame, column: str) -> DataFrame:
    """(column, count), the most frequent first."""
    return df.groupBy(column).count().orderBy(F.desc("count"), column)
