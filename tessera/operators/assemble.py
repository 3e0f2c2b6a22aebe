"""Verified solutions, the problem pool, gold seeds, code concepts and training examples."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scoring as K
from ..functions import text as X
from ..sources.tables import require
from .select import keep_first

HIGH = ["very_strong", "strong", "moderate"]
#: Fixed value: the question of an example, which datasets made before share.
PROMPT = "Solve the following dynamic programming problem. Provide a correct and efficient solution.\n\n"
_NONE = "array<string>"


def _none() -> Column:
    return F.array().cast(_NONE)


def verified(results: DataFrame, taxonomy: DataFrame, order: str | None = None) -> DataFrame:
    """Solutions that passed, the first of each (problem, id) in the order of a column, with what the taxonomy says."""
    rows = keep_first(results.where(F.col("status").isin(K.PASSED)), ["problem_id", "source_id"], [order or "source_id"])
    tax = taxonomy.select("problem_id", "dp_evidence_level", F.col("dp_consensus").alias("consensus_"), "primary_family", "families")
    rows = rows.join(tax, "problem_id", "left")
    verification = F.struct("status", K.quality(F.col("status")).alias("quality"), "execution_time_ms", K.verification_method(F.col("status")).alias("verification_method"))
    dp = F.struct(F.col("dp_evidence_level").alias("evidence"), F.col("consensus_").alias("consensus"), "primary_family", F.coalesce("families", _none()).alias("families"))
    split = F.col("source_split") if "source_split" in results.columns else F.lit(None).cast("string").alias("source_split")
    return rows.select("problem_id", "source_id", "language", "source", split, "source_code", verification.alias("verification"), dp.alias("dp"))


def failures(results: DataFrame) -> DataFrame:
    rows = results.where(F.col("status").isin(K.FAILED))
    return rows.select("problem_id", "source_id", "language", "source", "source_code", "status", "execution_time_ms", "stderr", "stdout", K.quality(F.col("status")).alias("failure_type"))


def verified_summary(results: DataFrame, verified: DataFrame) -> DataFrame:
    """One row: rows and problems verified, failures."""
    failed = results.agg(F.count_if(F.col("status").isin(K.FAILED)).alias("failure_solutions"))
    return verified.agg(F.count("*").alias("verified_solutions"), F.count_distinct("problem_id").alias("verified_problems")).crossJoin(F.broadcast(failed))


def _edges(relationships: DataFrame) -> DataFrame:
    """Each relationship from both of its ends."""
    ends = F.explode(F.array(F.struct(F.col("problem_a").alias("problem_id"), F.col("problem_b").alias("other")), F.struct(F.col("problem_b").alias("problem_id"), F.col("problem_a").alias("other"))))
    return relationships.select("relationship", ends.alias("e")).select("e.problem_id", "e.other", "relationship")


def problem_pool(taxonomy: DataFrame, groups: DataFrame, canonical: DataFrame, verified: DataFrame, relationships: DataFrame, strict: bool = True) -> DataFrame:
    """One row a problem of the taxonomy. strict: reading the pool raises if one has no group or no canonical record."""
    if strict:
        taxonomy = require(taxonomy, taxonomy.join(groups, "problem_id", "left_anti"), lambda _: "no problem group: ", "problem_id")
        taxonomy = require(taxonomy, taxonomy.join(canonical, "problem_id", "left_anti"), lambda _: "no canonical record: ", "problem_id")
    tests = verified.groupBy("problem_id").agg(F.count("*").alias("n_"), F.sort_array(F.collect_set(F.when(F.col("verification.status") != "", F.col("verification.status")))).alias("statuses_"))
    edges = _edges(relationships).groupBy("problem_id").agg(
        F.sort_array(F.collect_set("relationship")).alias("flags_"), F.count("*").alias("edges_"),
        F.sort_array(F.collect_set(F.when(F.col("relationship") == "version_family", F.col("other")))).alias("versions_"),
    )
    record = canonical.select("problem_id", F.col("canonical.exact_hash").alias("canonical_hash"), F.col("title").alias("title_"), F.col("rating").alias("rating_"), "contest_id", "index", F.col("source").alias("source_"), "source_split")
    df = taxonomy.join(groups, "problem_id").join(record, "problem_id").join(tests, "problem_id", "left").join(edges, "problem_id", "left")
    n = F.coalesce("n_", F.lit(0)).cast("long")
    lists = ["families", "dimensions", "transition_style", "optimizations", "state_signals"]
    return df.select(
        "problem_id", "canonical_group_id", "group_type", "base_problem_id", "canonical_hash", F.col("title_").alias("title"), F.col("rating_").alias("rating"), "contest_id", "index",
        "primary_family", *[F.coalesce(c, _none()).alias(c) for c in lists], "dp_evidence_level", "dp_consensus", n.alias("verified_solution_count"),
        F.coalesce("statuses_", _none()).alias("verification_statuses"), (n > 0).alias("has_verified_solution"), F.coalesce("flags_", _none()).alias("relationship_flags"),
        F.coalesce("versions_", _none()).alias("version_family_members"), F.coalesce("edges_", F.lit(0)).cast("long").alias("relationship_count"), F.col("source_").alias("source"), "source_split",
    )


def pool_summary(pool: DataFrame) -> DataFrame:
    """One row of totals."""
    groups = pool.groupBy("canonical_group_id").count().agg(
        F.count("*").alias("unique_canonical_groups"), F.count_if(F.col("count") > 1).alias("exact_duplicate_groups_inside_dp_pool"),
        F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("dp_problems_inside_exact_duplicate_groups"),
    )
    has = F.col("has_verified_solution")
    totals = pool.agg(F.count("*").alias("total_dp_candidates"), F.count_if(has).alias("dp_candidates_with_verified_solution"), F.count_if(~has).alias("dp_candidates_without_verified_solution"))
    return totals.crossJoin(F.broadcast(groups))


def pool_counts(pool: DataFrame) -> DataFrame:
    """(what, value, count): primary families, evidence levels, relationship flags. Nulls aren't counted."""
    what = lambda name, c: pool.select(F.lit(name).alias("what"), c.alias("value")).where("value IS NOT NULL")
    rows = what("primary_family", F.col("primary_family")).unionByName(what("evidence_level", F.col("dp_evidence_level"))).unionByName(what("relationship_flag", F.explode("relationship_flags")))
    return rows.groupBy("what", "value").count()


def gold_seeds(pool: DataFrame) -> DataFrame:
    """Problems with moderate evidence or better and a verified solution; those without a family are for training only."""
    rows = pool.where(F.col("dp_evidence_level").isin(HIGH) & F.coalesce("has_verified_solution", F.lit(False)))
    return rows.select(
        "problem_id", "canonical_group_id", "canonical_hash", "title", "rating", "primary_family", "families", "dimensions", "transition_style", "optimizations", "state_signals",
        "dp_evidence_level", "dp_consensus", "verified_solution_count", "verification_statuses", K.quality_tier(F.col("dp_evidence_level")).alias("quality_tier"),
        K.seed_role(F.col("primary_family")).alias("role"), "relationship_flags", "version_family_members", "source", "source_split",
    )


def gold_counts(seeds: DataFrame) -> DataFrame:
    """(what, value, count) of roles, tiers and families."""
    cols = {"role": F.col("role"), "quality_tier": F.col("quality_tier"), "family": F.coalesce("primary_family", F.lit("unresolved"))}
    return seeds.select(F.explode(F.array(*[F.struct(F.lit(k).alias("what"), c.alias("value")) for k, c in cols.items()])).alias("x")).select("x.*").groupBy("what", "value").count()


def code_rows(solutions: DataFrame) -> DataFrame:
    """Solutions with code, the counts of each category and what they are built as."""
    df = solutions.where(F.coalesce("source_code", F.lit("")) != "").withColumn("code_", X.unix_lines(F.col("source_code")))
    counts = P.code_counts(F.col("code_"))
    df = X.barrier(df.withColumn("counts", F.struct(*[c.alias(n) for n, c in counts.items()])), "counts")
    return df.withColumn("implementations", K.implementations({n: F.col(f"counts.{n}") for n in counts})).drop("code_")


def code_analysis(solutions: DataFrame) -> DataFrame:
    """Per problem: sums and shares of the categories, and the implementations of at least half of the solutions, most frequent first.

    The sums run over columns, so nothing is exploded but the few implementations.
    """
    names = sorted(P.CODE_COUNTS)
    rows = code_rows(solutions)
    per = rows.groupBy("problem_id").agg(
        F.count("*").alias("solutions_with_code"),
        F.create_map(*[x for n in names for x in (F.lit(n), F.sum(f"counts.{n}"))]).alias("signal_counts"),
        F.create_map(*[x for n in names for x in (F.lit(n), F.avg((F.col(f"counts.{n}") > 0).cast("double")))]).alias("signal_consensus"),
    )
    built = rows.select("problem_id", F.explode("implementations").alias("pattern")).groupBy("problem_id", "pattern").count()
    built = built.groupBy("problem_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("n"), "pattern"))).alias("built_"))
    total = solutions.groupBy("problem_id").agg(F.count("*").alias("solution_count"))
    df = total.join(per, "problem_id", "left").join(built, "problem_id", "left")
    half = F.transform(F.filter("built_", lambda b: -b["n"] / F.col("solutions_with_code") >= 0.5), lambda b: b["pattern"])
    empty = lambda kind: F.create_map().cast(f"map<string, {kind}>")
    analysis = F.struct(
        "solution_count", F.coalesce("solutions_with_code", F.lit(0)).alias("solutions_with_code"), F.coalesce("signal_counts", empty("bigint")).alias("signal_counts"),
        F.coalesce("signal_consensus", empty("double")).alias("signal_consensus"), F.coalesce(half, _none()).alias("implementation_patterns"),
    )
    return df.select("problem_id", analysis.alias("code_analysis"))


def concepts(pool: DataFrame, verified: DataFrame) -> DataFrame:
    """Pool problems with the analysis of their verified code."""
    df = pool.join(code_analysis(verified), "problem_id", "left")
    kind = "struct<solution_count: bigint, solutions_with_code: bigint, signal_counts: map<string, bigint>, signal_consensus: map<string, double>, implementation_patterns: array<string>>"
    zero = F.struct(F.lit(0), F.lit(0), F.create_map(), F.create_map(), F.array()).cast(kind)
    family = F.struct(F.col("primary_family").alias("primary"), "families", F.col("dp_evidence_level").alias("evidence_level"), F.col("dp_consensus").alias("consensus"))
    return df.select(
        "problem_id", "title", "rating", "canonical_group_id", "canonical_hash", family.alias("family"), "dimensions", "transition_style", "optimizations", "state_signals",
        F.struct("verified_solution_count", "has_verified_solution").alias("verification"), F.coalesce(F.col("code_analysis").cast(kind), zero).alias("code_analysis"),
    )


def concepts_summary(concepts: DataFrame) -> DataFrame:
    return concepts.agg(F.count("*").alias("total_dp_problems"), F.count_if("verification.has_verified_solution").alias("problems_with_verified_solutions"), F.count_if(F.col("code_analysis.solutions_with_code") > 0).alias("problems_with_code_analysis"))


def concept_counts(concepts: DataFrame) -> DataFrame:
    """(what, value, count) of primary families, which null ones aren't among, and of implementation patterns."""
    family = concepts.select(F.lit("primary_family").alias("what"), F.col("family.primary").alias("value")).where("value IS NOT NULL")
    pattern = concepts.select(F.lit("implementation_pattern").alias("what"), F.explode("code_analysis.implementation_patterns").alias("value"))
    return family.unionByName(pattern).groupBy("what", "value").count()


def usable(results: DataFrame, pool: DataFrame, problems: DataFrame) -> DataFrame:
    """Accepted and passed solutions with code, of pool problems that have a statement, with the statement. It has one if a field isn't empty, as fields have headings."""
    ok = (F.col("verdict") == "OK") & F.col("status").isin(K.PASSED) & (X.strip(F.coalesce("source_code", F.lit(""))) != "")
    some = reduce(lambda a, b: a | b, [X.empty_if_null(F.col(f)) != "" for f in X.TEXT_FIELDS])
    told = problems.where(some).select(F.col("id").alias("problem_id"), X.statement(*map(F.col, X.TEXT_FIELDS)).alias("statement"))
    return results.where(ok).join(pool.select("problem_id").distinct(), "problem_id", "left_semi").join(told, "problem_id")


def split_ids(ids: DataFrame, key: str, seed: int = 42, mode: str = "hash", order: str | None = None, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """(key, split): floor(train * n) and floor(val * n) keys, the rest test; whole problems go to one split.

    mode "hash" orders by a keyed hash: the rank of a key is that within its bin of hashes, with the sizes of the bins before, so no
    task orders all keys. mode "exact" draws CPython's shuffle over the keys in the order of a column on the driver: for small sets alone.
    """
    ids = ids.select(key, *([order] if order else [])).dropDuplicates([key])
    if mode == "exact":
        keys = [r[0] for r in ids.orderBy(order or key).select(key).collect()]
        random.Random(seed).shuffle(keys)
        a, b = int(len(keys) * train), int(len(keys) * val)
        rows = [(k, "train" if i < a else "val" if i < a + b else "test") for i, k in enumerate(keys)]
        return ids.sparkSession.createDataFrame(rows, f"{key} string, split string")
    ids = ids.select(key, F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256).alias("draw_"))
    ids = ids.withColumn("bin_", F.substring("draw_", 1, 3))
    before = Window.orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)
    bins = ids.groupBy("bin_").count().select("bin_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before_"), F.sum("count").over(Window.partitionBy()).alias("total_"))
    rank = F.row_number().over(Window.partitionBy("bin_").orderBy("draw_", key)) + F.col("before_")
    df = ids.join(F.broadcast(bins), "bin_").withColumn("rank_", rank)
    a, b = F.floor(F.col("total_") * train), F.floor(F.col("total_") * val)
    return df.select(key, F.when(F.col("rank_") <= a, "train").when(F.col("rank_") <= a + b, "val").otherwise("test").alias("split"))


def examples(usable: DataFrame, pool: DataFrame, splits: DataFrame) -> DataFrame:
    """(split, messages, metadata): a question and an answer for each solution."""
    facts = pool.select("problem_id", F.coalesce(F.when(F.col("primary_family") != "", F.col("primary_family")), F.get("families", F.lit(0))).alias("family"), "rating")
    df = usable.select("problem_id", "language", "source_id", "source_code", "statement").join(facts, "problem_id").join(splits, "problem_id")
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    messages = F.array(say("user", F.concat(F.lit(PROMPT), "statement")), say("assistant", F.col("source_code")))
    return df.select("split", messages.alias("messages"), F.struct("problem_id", "family", "rating", "language", "source_id").alias("metadata"))


def shuffled(examples: DataFrame, seed: int = 42, mode: str = "hash") -> DataFrame:
    """Examples with ``place``, their place in their split's shuffled order, for sinks to sort by.

    mode "hash" draws a keyed hash for each: places are texts in no other order. mode "exact" is CPython's shuffle of each split, one after the other in the order
    train, val, test, from the state in which the seed's shuffle of the problems left the generator; on the driver, for small sets alone.
    """
    key = F.concat_ws("|", F.lit(str(seed)), "metadata.problem_id", "metadata.source_id", F.sha2(F.get("messages", F.lit(1))["content"], 256))
    if mode == "hash":
        return examples.withColumn("place", F.sha2(key, 256))
    rows = examples.select("split", "metadata.problem_id", "metadata.source_id", F.sha2(key, 256).alias("key")).orderBy("problem_id", "source_id", "key").collect()
    rng, out = random.Random(seed), []
    rng.shuffle([*range(len({r.problem_id for r in rows}))])
    for split in ("train", "val", "test"):
        own = [r.key for r in rows if r.split == split]
        rng.shuffle(own)
        out += [(k, f"{i:012}") for i, k in enumerate(own)]
    places = examples.sparkSession.createDataFrame(out, "key_ string, place string")
    return examples.withColumn("key_", F.sha2(key, 256)).join(places.dropDuplicates(["key_"]), "key_").drop("key_")


def split_sizes(examples: DataFrame) -> DataFrame:
    return examples.groupBy("split").agg(F.count_distinct("metadata.problem_id").alias("problems"), F.count("*").alias("examples"))


def chat_text(examples: DataFrame, start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """One text an example, its messages between markers."""
    turn = lambda m: F.concat(F.lit(start), m["role"], F.lit("\n"), m["content"], F.lit(f"{end}\n"))
    return examples.select("split", F.array_join(F.transform("messages", turn), "").alias("text"))
