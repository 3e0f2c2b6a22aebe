"""Canonical records, exact duplicates, near duplicates and relationships between problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring as K
from ..functions import text as X
from ..functions.word_sets import LISTS, schema, word_sets
from ..sources.tables import dealt, numbered, staged

THRESHOLD = 0.62
MAX_POSTINGS = 40
MIN_SHARED = 2
LEAST_TOKENS = 0.08


def canonical_records(problems: DataFrame, taxonomy: DataFrame | None = None, compose: bool = True) -> DataFrame:
    """Hash and length of the canonical text, with what the taxonomy says of the problem."""
    df = dealt(problems, "id").withColumn("text_", X.canonical_problem(compose, **{f: F.col(f) for f in X.TEXT_FIELDS if f in problems.columns}))
    df = X.barrier(df.select(*[c for c in ("id", "title", "rating", "contest_id", "index", "source", "source_split") if c in df.columns], "text_"), "text_")
    have = lambda c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c)
    fields = F.array(*map(F.lit, X.TEXT_FIELDS))
    canonical = F.struct(F.sha2("text_", 256).alias("exact_hash"), F.length("text_").cast("long").alias("text_length"), fields.alias("fields"))
    df = df.select(F.col("id").cast("string").alias("problem_id"), "title", have("rating", "int"), have("contest_id", "string"), have("index", "string"), canonical.alias("canonical"), have("source", "string"), have("source_split", "string"))
    none = F.array().cast("array<string>")
    if taxonomy is None:
        dp = F.struct(F.lit(None).cast("string").alias("primary_family"), none.alias("families"), F.lit(None).cast("string").alias("evidence"), F.lit(None).cast("double").alias("consensus"))
        return df.withColumn("dp", dp).select("problem_id", "title", "rating", "contest_id", "index", "canonical", "dp", "source", "source_split")
    tax = taxonomy.select("problem_id", F.struct("primary_family", F.coalesce("families", none).alias("families"), F.col("dp_evidence_level").alias("evidence"), F.col("dp_consensus").alias("consensus")).alias("tax_"))
    dp = F.coalesce("tax_", F.struct(F.lit(None).cast("string"), none, F.lit(None).cast("string"), F.lit(None).cast("double")).cast("struct<primary_family: string, families: array<string>, evidence: string, consensus: double>"))
    return df.join(tax, "problem_id", "left").select("problem_id", "title", "rating", "contest_id", "index", "canonical", dp.alias("dp"), "source", "source_split")


def exact_groups(canonical: DataFrame) -> DataFrame:
    """(exact_hash, problem_ids, count) of hashes with several problems."""
    per = canonical.groupBy(F.col("canonical.exact_hash").alias("exact_hash")).agg(F.sort_array(F.collect_list("problem_id")).alias("problem_ids"), F.count("*").alias("count"))
    return per.where("count > 1")


def exact_summary(canonical: DataFrame) -> DataFrame:
    per = canonical.groupBy("canonical.exact_hash").count()
    return per.agg(F.sum("count").alias("records"), F.count("*").alias("unique_hashes"), F.count_if(F.col("count") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count") - 1)), F.lit(0)).alias("duplicates"))


def prepared(problems: DataFrame, compose: bool = True, known: DataFrame | None = None, lists: tuple[str, ...] = LISTS) -> DataFrame:
    """(problem_id, words, title_set, shingle_set, word_set), or those asked for: all as 64-bit hashes. The title is no part of the statement. known: the canonical records that problems are limited to."""
    fields = [f for f in X.TEXT_FIELDS if f != "title" and f in problems.columns]
    df = dealt(problems.select("id", "title", *fields), "id")
    df = df if known is None else df.join(known.select(F.col("problem_id").alias("id")), "id", "left_semi")
    return df.select(F.col("id").cast("string").alias("problem_id"), X.joined_fields(*map(F.col, fields)).alias("body"), "title").mapInArrow(word_sets(compose, lists=lists), schema(lists))


def postings(prepared: DataFrame) -> DataFrame:
    """(shingle, problem_id, count) of shingles that several problems have, with their number: most shingles are alone and gone before any list is made."""
    rows = prepared.select(F.explode("shingle_set").alias("shingle"), "problem_id")
    return rows.withColumn("count", F.count("*").over(Window.partitionBy("shingle"))).where("count >= 2")


def candidate_pairs(postings: DataFrame, max_postings: int = MAX_POSTINGS, min_shared: int = MIN_SHARED) -> DataFrame:
    """(a, b, shared), a < b: problems that share shingles, but for those in more than max_postings problems.

    Frequent shingles are known by a count with partial sums and are gone before any list is made, so no list is longer than
    max_postings and no shingle makes more than max_postings**2 / 2 pairs.
    """
    lists = postings.where(F.col("count") <= max_postings).groupBy("shingle").agg(F.sort_array(F.collect_set("problem_id")).alias("ids"))
    lists = X.barrier(lists, "ids")
    firsts = lists.select("ids", F.posexplode("ids").alias("i", "a"))
    pairs = firsts.select("a", F.explode(F.slice("ids", F.col("i") + 2, F.greatest(F.size("ids") - F.col("i") - 1, F.lit(0)))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= min_shared)


def possible_pairs(facts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs that could reach the threshold by the sizes of their sets, so that the sets needn't travel with the others.

    Two problems have no more shingles in common than those counted and the fewer of their frequent ones.
    """
    sizes = facts.select("problem_id", "shingles", *[F.size(f"{x}_set").alias(x) for x in ("word", "title", "often")])
    df = pairs
    for s in "ab":
        df = df.join(sizes.select(F.col("problem_id").alias(s), *[F.col(x).alias(f"{x}_{s}") for x in ("shingles", "word", "title", "often")]), s)
    least, most = (lambda x: F.least(f"{x}_a", f"{x}_b")), (lambda x: F.greatest(f"{x}_a", f"{x}_b"))
    common = F.least(F.col("shared") + least("often"), least("shingles"))
    ratio = lambda x: F.when(most(x) == 0, 1.0).otherwise(least(x) / most(x))
    best = K.blended(common / (F.col("shingles_a") + F.col("shingles_b") - common), F.lit(1.0), ratio("word"), ratio("title"))
    return df.where(best >= threshold - 1e-6).select("a", "b", "shared")


def _common(x: str) -> Column:
    return F.size(F.array_intersect(f"a_.{x}", f"b_.{x}"))


def near_duplicates(problems: DataFrame, canonical: DataFrame, threshold: float = THRESHOLD, max_postings: int = MAX_POSTINGS, min_shared: int = MIN_SHARED, compose: bool = True) -> DataFrame:
    """Pairs whose blended similarity, rounded, reaches the threshold; equal hashes are left to exact_groups().

    Shingles in common are the shared ones that are counted already and the frequent ones that both have, so sets of shingles don't travel.
    The cosine is the costly part: pairs that can't reach the threshold with a cosine of 1 are gone before it is computed, and
    only documents of such pairs have their words counted, which are made again for that: all words in order, as 64-bit numbers, take more room than the texts.
    What is read several times is staged.
    """
    ready = staged(prepared(problems, compose, canonical, ("title_set", "shingle_set", "word_set")))
    shared = staged(postings(ready))
    often = shared.where(F.col("count") > max_postings).groupBy("problem_id").agg(F.collect_set("shingle").alias("often_set"))
    known = canonical.select("problem_id", "title", "rating", F.col("canonical.exact_hash").alias("exact_hash"), F.col("dp.primary_family").alias("family"))
    facts = ready.select("problem_id", "title_set", "word_set", F.size("shingle_set").alias("shingles")).join(often, "problem_id", "left").join(known, "problem_id")
    facts = staged(facts.withColumn("often_set", F.coalesce("often_set", F.array().cast("array<bigint>"))))
    sets = facts.select("problem_id", F.struct("title", "rating", "exact_hash", "family", "title_set", "word_set", "often_set", "shingles").alias("x_"))
    pairs = possible_pairs(facts, candidate_pairs(shared, max_postings, min_shared), threshold)
    df = pairs.join(sets.select(F.col("problem_id").alias("a"), F.col("x_").alias("a_")), "a").join(sets.select(F.col("problem_id").alias("b"), F.col("x_").alias("b_")), "b")
    df = df.where(F.col("a_.exact_hash") != F.col("b_.exact_hash"))
    sizes = lambda x: (F.size(f"a_.{x}"), F.size(f"b_.{x}"))
    shingle = K.jaccard(F.col("shared") + _common("often_set"), F.col("a_.shingles"), F.col("b_.shingles"))
    df = df.select("a", "b", shingle.alias("shingle"), *[K.jaccard(_common(f"{x}_set"), *sizes(f"{x}_set")).alias(x) for x in ("title", "word")], *[F.struct(*[F.col(f"{s}_.{c}") for c in ("title", "rating", "family")]).alias(f"{s}_") for s in "ab"])
    df = X.barrier(df, "title", "word", "shingle").where(F.col("word") >= LEAST_TOKENS)
    df = df.where(K.blended(F.col("shingle"), F.lit(1.0), F.col("word"), F.col("title")) >= threshold - 1e-6)
    df = staged(df)
    ends = df.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    some = prepared(problems.join(ends, problems["id"].cast("string") == ends["id"], "left_semi"), compose, lists=("words",))
    tf = staged(some.select("problem_id", F.explode("words").alias("word_")).groupBy("problem_id", "word_").agg(F.count("*").alias("tf")))
    norm = tf.groupBy("problem_id").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))
    side = lambda s: tf.select(F.col("problem_id").alias(s), "word_", F.col("tf").alias(f"tf_{s}"))
    dot = df.select("a", "b").join(side("a"), "a").join(side("b"), ["b", "word_"]).groupBy("a", "b").agg(F.sum(F.col("tf_a") * F.col("tf_b")).alias("dot"))
    df = df.join(dot, ["a", "b"], "left")
    for s in "ab":
        df = df.join(norm.select(F.col("problem_id").alias(s), F.col("norm").alias(f"norm_{s}")), s, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    df = df.withColumn("cosine", K.cosine(zero("dot"), zero("norm_a"), zero("norm_b")))
    score = F.round(K.blended(F.col("shingle"), F.col("cosine"), F.col("word"), F.col("title")), 6)
    similarity = F.struct(
        score.alias("score"), *[F.round(c, 6).alias(n) for c, n in (("title", "title_similarity"), ("word", "statement_jaccard"), ("shingle", "shingle_jaccard"), ("cosine", "token_cosine"))],
        K.same_known(F.col("a_.rating"), F.col("b_.rating")).alias("same_rating"), K.same_known(F.col("a_.family"), F.col("b_.family")).alias("same_dp_family"),
        F.col("a_.family").alias("dp_family_a"), F.col("b_.family").alias("dp_family_b"),
    )
    out = df.select(F.col("a").alias("problem_a"), F.col("b").alias("problem_b"), similarity.alias("similarity"), F.col("a_.title").alias("title_a"), F.col("b_.title").alias("title_b"))
    return out.where(F.col("similarity.score") >= threshold)


def exact_ids(canonical: DataFrame) -> DataFrame:
    """(problem_id, group_id) of problems in exact groups, numbered by hash."""
    per = canonical.select("problem_id", X.first_hash(canonical).alias("hash_"))
    groups = per.groupBy("hash_").count().where("count > 1")
    named = numbered(groups.select("hash_"), "hash_", "nth_").select("hash_", F.format_string("exact_%04d", "nth_").alias("group_id"))
    return per.join(named, "hash_").select("problem_id", "group_id")


def relationships(near: DataFrame, canonical: DataFrame) -> DataFrame:
    """Near-duplicate edges by kind, with the exact groups of both ends."""
    ends = canonical.select("problem_id", X.first_hash(canonical).alias("hash_")).join(exact_ids(canonical), "problem_id", "left")
    df = near
    for s in "ab":
        df = df.join(ends.select(F.col("problem_id").alias(f"problem_{s}"), F.col("hash_").alias(f"hash_{s}"), F.col("group_id").alias(f"canonical_group_{s}")), f"problem_{s}")
    score = F.col("similarity.score")
    same_hash, same_base = F.col("hash_a") == F.col("hash_b"), X.base_id(F.col("problem_a")) == X.base_id(F.col("problem_b"))
    return df.select("problem_a", "problem_b", score.alias("similarity_score"), K.relationship(same_hash, same_base, score).alias("relationship"), same_base.alias("same_base_id"), same_hash.alias("same_canonical_hash"), "canonical_group_a", "canonical_group_b", "title_a", "title_b")


def problem_groups(canonical: DataFrame) -> DataFrame:
    """One row a problem: its exact group, or one of its own."""
    df = canonical.select("problem_id").join(exact_ids(canonical), "problem_id", "left")
    kind = F.when(F.col("group_id").isNotNull(), "exact_duplicate_group").otherwise("independent_problem")
    gid = F.coalesce("group_id", F.concat(F.lit("problem_"), "problem_id"))
    return df.select("problem_id", gid.alias("canonical_group_id"), kind.alias("group_type"), X.base_id(F.col("problem_id")).alias("base_problem_id"))
