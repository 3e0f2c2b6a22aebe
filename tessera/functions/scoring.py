"""Scores and decisions as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .patterns import labels

#: The preference of languages; others come after all.
LANGUAGE_RANKS = {
    "C++20 (GCC 13-64)": 0, "C++20 (GCC 11-64)": 1, "C++17 (GCC 9-64)": 2, "C++17 (GCC 7-32)": 3,
    "GNU C++17": 4, "GNU C++14": 5, "GNU C++11": 6, "GNU C++": 7,
    "Python 3": 10, "PyPy 3": 11, "Python 2": 12,
    "Java 21": 20, "Java 17": 21, "Java 11": 22, "Java 8": 23, "Go": 30,
}
OTHER_LANGUAGE = 100
#: Outcomes of the judge, and what a solution with one is called.
QUALITY = {
    "PASSED_EXACT": "exact",
    "PASSED_CHECKER": "checker",
    "PASSED_AVAILABLE_TESTS": "available_tests",
    "WRONG_ANSWER": "wrong_answer",
    "TLE": "tle",
    "RE": "runtime_error",
    "CE": "compile_error",
}
PASSED = ["PASSED_AVAILABLE_TESTS", "PASSED_EXACT", "PASSED_CHECKER"]
FAILED = ["WRONG_ANSWER", "RE", "TLE", "CHECKER_TLE", "CHECKER_ERROR", "CE"]


def _size(c: Column) -> Column:
    return F.size(F.coalesce(c, F.array().cast("array<string>")))


def _among(signals: Column, names: list[str]) -> Column:
    return F.size(F.filter(signals, lambda s: s.isin(names)))


def count_of(counts: Column, name: str) -> Column:
    """A map's value, or 0."""
    return F.coalesce(F.try_element_at(counts, F.lit(name)), F.lit(0))


def lookup(c: Column, table: dict, default) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), F.lit(default))


def language_rank(language: Column) -> Column:
    return lookup(language, LANGUAGE_RANKS, OTHER_LANGUAGE)


# The weights, caps and thresholds in the functions from here on, which results must have in common with datasets made before.


def candidate_score(dp_tag: Column, editorial: Column, metadata: Column) -> Column:
    score = F.when(dp_tag, 1.0).otherwise(0.0) + F.least(F.lit(0.45), 0.15 * _size(editorial)) + F.least(F.lit(0.15), 0.03 * _size(metadata))
    return F.least(score, F.lit(1.5))


def candidate_tier(dp_tag: Column, editorial: Column, score: Column) -> Column:
    return F.when(dp_tag, "seed").when(_size(editorial) > 0, "editorial_candidate").when(score >= 0.15, "weak_candidate").otherwise("reject")


def signal_score(signals: Column) -> Column:
    return F.least(_among(signals, P.STRONG) * 1.0 + _among(signals, P.STRUCTURAL) * 0.5 + _among(signals, P.WEAK) * 0.25, F.lit(5.0))


def solution_class(signals: Column, score: Column) -> Column:
    """strong, moderate, weak or none."""
    strong = _among(signals, P.STRONG)
    return (
        F.when((strong >= 2) | ((strong == 1) & (score >= 1)), "strong")
        .when(_among(signals, P.STRUCTURAL) > 0, "moderate")
        .when(_among(signals, P.WEAK) > 0, "weak")
        .otherwise("none")
    )


def evidence_level(total: Column, strong: Column, moderate: Column, weak: Column, consensus: Column, hinted: Column) -> Column:
    """consensus: strong / total, not rounded. hinted: by the tag or the editorial."""
    return (
        F.when(total == 0, F.when(hinted, "metadata_only").otherwise("uncertain"))
        .when((strong >= 3) & (consensus >= 0.5), "very_strong")
        .when((strong >= 2) & (consensus >= 0.4), "strong")
        .when((strong >= 1) & ((moderate >= 1) | hinted), "moderate")
        .when(moderate >= 2, "moderate")
        .when(weak >= 2, "weak")
        .when(hinted, "metadata_only")
        .otherwise("uncertain")
    )


def code_families(counts: Column) -> Column:
    """Families that accepted code shows, from the number of solutions with each signal."""
    n = lambda name: count_of(counts, name)
    return labels([
        ("knapsack", n("knapsack_pattern") >= 1),
        ("sequence", n("lis_pattern") >= 1),
        ("string", n("lcs_pattern") >= 1),
        ("interval", (n("interval_pattern") >= 3) & ((n("dp_2d") >= 1) | (n("previous_state") >= 1))),
        ("tree", n("tree_dp_pattern") >= 1),
        ("digit", n("digit_dp_pattern") >= 1),
        ("bitmask", n("bitmask_pattern") >= 2),
    ])


def code_optimizations(counts: Column) -> Column:
    return labels([("bitmask", count_of(counts, "bitmask_pattern") >= 2)])


def _or_else(found: Column, name: str) -> Column:
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(name)))


def dimensions(counts: Column, families: Column) -> Column:
    has = lambda f: F.array_contains(families, f)
    return _or_else(labels([("2d", count_of(counts, "dp_2d") >= 1), ("grid", has("grid")), ("mask", has("bitmask")), ("digit", has("digit"))]), "1d_or_unknown")


def transition_style(counts: Column) -> Column:
    kinds = {"explicit_transition": "transition", "previous_state_dependency": "previous_state", "recursive": "recursion", "memoized": "memoization"}
    return _or_else(labels([(k, count_of(counts, s) > 0) for k, s in kinds.items()]), "unknown")


def family_confidence(text: Column, code: Column, count: Column, consensus: Column, level: Column) -> Column:
    by_count = F.when(count >= 5, 0.20).when(count >= 3, 0.15).when(count >= 1, 0.08).otherwise(0.0)
    score = F.when(code, 0.45 + by_count).otherwise(0.0) + F.when(text, 0.30).otherwise(0.0)
    score = score + 0.20 * F.least(consensus, F.lit(1.0)) + F.when(level == "very_strong", 0.05).when(level == "strong", 0.03).otherwise(0.0)
    return F.round(F.least(score, F.lit(0.99)), 3)


def jaccard(common: Column, a: Column, b: Column) -> Column:
    """From the sizes of the intersection and the two sets; 1 for two empty sets."""
    return F.when((a == 0) & (b == 0), 1.0).when((a == 0) | (b == 0), 0.0).otherwise(common / (a + b - common))


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    return F.when((norm_a == 0) | (norm_b == 0), 0.0).otherwise(dot / (norm_a * norm_b))


def blended(shingle: Column, cos: Column, statement: Column, title: Column) -> Column:
    return 0.45 * shingle + 0.30 * cos + 0.15 * statement + 0.10 * title


def same_known(a: Column, b: Column) -> Column:
    """Equal and neither null."""
    return F.coalesce(a == b, F.lit(False))


def relationship(same_hash: Column, same_base: Column, score: Column) -> Column:
    return F.when(same_hash, "exact_duplicate").when(same_base, "version_family").when(score >= 0.95, "reissue_candidate").when(score >= 0.90, "related_candidate").otherwise("low_confidence_candidate")


def quality(status: Column) -> Column:
    return lookup(status, QUALITY, "other")


def verification_method(status: Column) -> Column:
    return F.when(status == "PASSED_CHECKER", "checker").when(status == "PASSED_EXACT", "exact").otherwise("available_tests")


def quality_tier(level: Column) -> Column:
    return F.when(level == "very_strong", "A").when(level == "strong", "B").otherwise("C")


def seed_role(primary_family: Column) -> Column:
    return F.when(primary_family.isNull(), "training_only_unresolved_family").otherwise("generation_seed")


def implementations(counts: dict[str, Column]) -> Column:
    has = lambda n: counts[n] > 0
    return labels([
        ("2d_table", has("two_dimensional_dp")),
        ("memoization", has("memoization")),
        ("top_down", has("recursive_dp") & has("memoization")),
        ("bottom_up_candidate", has("array_dp") & ~has("recursive_dp")),
        ("bitmask", has("bitmask")),
    ])


#: What two extractions that both use dynamic programming are compared by: name and path.
CHECKS = {
    "family": "family",
    "state_dimensions": "state.dimensions",
    "state_representation": "state.representation",
    "iteration_style": "iteration.style",
    "transition_operation": "transition.operation",
}


def agreement(a: Column, b: Column) -> Column:
    """struct(level, score, checks map, dp_classification) of two concept structs; null if either is. Two nulls in a check are equal."""

    def field(c: Column, path: str) -> Column:
        return reduce(lambda x, name: x.getField(name), path.split("."), c)

    a_dp, b_dp = F.coalesce(a["dp_used"], F.lit(False)), F.coalesce(b["dp_used"], F.lit(False))
    same = {k: field(a, p).eqNullSafe(field(b, p)) for k, p in CHECKS.items()}
    score = (reduce(lambda x, y: x + y, [c.cast("int") for c in same.values()]) + 1) / (len(same) + 1)
    level = F.when(score >= 0.83, "high").when(score >= 0.50, "medium").otherwise("low")
    checks = lambda **kw: F.create_map(*[x for k, v in kw.items() for x in (F.lit(k), v)])
    whole = lambda lv, sc, ch, kind: F.struct(lv.alias("level"), sc.alias("score"), ch.alias("checks"), F.lit(kind).alias("dp_classification"))
    true, false = F.lit(True), F.lit(False)
    return (
        F.when(a.isNull() | b.isNull(), None)
        .when(~a_dp & ~b_dp, whole(F.lit("high"), F.lit(1.0), checks(dp_used=true, family=true), "non_dp"))
        .when(a_dp != b_dp, whole(F.lit("low"), F.lit(0.0), checks(dp_used=false), "disagreement"))
        .otherwise(whole(level, score, checks(dp_used=true, **same), "dp"))
    )


def extraction_status(n: Column, level: Column) -> Column:
    """n: extractions that came out."""
    return F.when(n >= 2, F.when(level == "high", "high_confidence").when(level == "medium", "medium_confidence").otherwise("disagreement")).when(n == 1, "single_extraction").otherwise("error")
