"""Raw rows to problems and solutions; the audit of raw problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_if_null

PROBLEM_SOURCE = "open-r1/codeforces"
SOLUTION_SOURCE = "open-r1/codeforces-submissions"
_STRINGS = ["id", "contest_id", "contest_name", "contest_type", "index", "title", "description", "input_format", "output_format", "input_mode"]
_MAYBE = ["interaction_format", "note", "editorial", "generated_checker"]
_KNOWN = [*_STRINGS, *_MAYBE, "aliases", "contest_start", "contest_start_year", "time_limit", "memory_limit", "examples", "rating", "tags", "testset_size", "official_tests", "official_tests_complete", "executable", "generated_tests"]


def _has(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def pairs_of_text(tests: Column) -> Column:
    """Tests or examples: null is none, null items are dropped, null texts are empty."""
    kind = "array<struct<input: string, output: string>>"
    return F.coalesce(F.transform(F.filter(tests.cast(kind), lambda t: t.isNotNull()), lambda t: F.struct(empty_if_null(t["input"]).alias("input"), empty_if_null(t["output"]).alias("output"))), F.array().cast(kind))


def texts_of(c: Column) -> Column:
    return F.coalesce(F.transform(c.cast("array<string>"), empty_if_null), F.array().cast("array<string>"))


def problems(raw: DataFrame, split: str = "train") -> DataFrame:
    """Typed problems. Columns that have no place go into ``extra``, JSON, with the examples and generated tests."""
    tests = "array<struct<input: string, output: string>>"
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in _KNOWN]
    extra += [pairs_of_text(_has(raw, "examples", tests)).alias("examples"), _has(raw, "generated_tests", "string").alias("generated_tests")]
    flag = lambda n: F.coalesce(_has(raw, n, "boolean").cast("boolean"), F.lit(False)).alias(n)
    text = lambda n: empty_if_null(_has(raw, n, "string")).alias(n)
    maybe = lambda n: _has(raw, n, "string").cast("string").alias(n)
    limit = lambda n: F.coalesce(_has(raw, n, "double").cast("double"), F.lit(0.0)).alias(n)
    return raw.select(
        text("id"), texts_of(_has(raw, "aliases", "array<string>")).alias("aliases"), text("contest_id"), text("contest_name"), text("contest_type"),
        F.coalesce(_has(raw, "contest_start_year", "int").cast("int"), F.lit(0)).alias("contest_start_year"), text("index"), text("title"), text("description"),
        text("input_format"), text("output_format"), maybe("interaction_format"), maybe("note"), _has(raw, "rating", "int").cast("int").alias("rating"),
        texts_of(_has(raw, "tags", "array<string>")).alias("tags"), maybe("editorial"), limit("time_limit"), limit("memory_limit"), text("input_mode"),
        _has(raw, "testset_size", "int").cast("int").alias("testset_size"), pairs_of_text(_has(raw, "official_tests", tests)).alias("official_tests"),
        flag("official_tests_complete"), maybe("generated_checker"), flag("executable"), F.lit(PROBLEM_SOURCE).alias("source"), F.lit(split).alias("source_split"),
        F.to_json(F.struct(*extra), {"ignoreNullFields": "false"}).alias("extra"),
    )


def solutions(submissions: DataFrame, failure: bool) -> DataFrame:
    """Submissions as solutions, accepted or failure examples."""
    s = submissions
    extra = F.struct(*[_has(s, a, "string").alias(b) for a, b in (("contestId", "contest_id"), ("problem_index", "problem_index"), ("testset", "testset"), ("passedTestCount", "passed_test_count"), ("creationTimeSeconds", "creation_time_seconds"))])
    return s.select(
        F.col("problem_id").cast("string").alias("problem_id"), empty_if_null(_has(s, "programmingLanguage", "string")).alias("language"),
        empty_if_null(_has(s, "source", "string")).alias("source_code"), empty_if_null(_has(s, "verdict", "string")).alias("verdict"),
        _has(s, "timeConsumedMillis", "double").cast("double").alias("execution_time_ms"), _has(s, "memoryConsumedBytes", "long").cast("long").alias("memory_bytes"),
        F.lit(SOLUTION_SOURCE).alias("source"), empty_if_null(_has(s, "submission_id", "string")).alias("source_id"),
        F.lit(not failure).alias("is_accepted"), F.lit(failure).alias("is_failure_example"), F.to_json(extra, {"ignoreNullFields": "false"}).alias("extra"),
    )


def audit_totals(problems: DataFrame) -> DataFrame:
    p = problems
    return p.agg(
        F.count("*").alias("total"), F.count_if(F.coalesce(p["executable"], F.lit(False))).alias("executable"), F.count_if(F.coalesce(p["editorial"], F.lit("")) != "").alias("with_editorial"),
        F.count_if(F.coalesce(p["official_tests_complete"], F.lit(False))).alias("complete_tests"), F.count_if(F.coalesce(F.array_contains("tags", "dp"), F.lit(False))).alias("dp_tagged"),
    )


def audit_tags(problems: DataFrame, most: int = 40) -> DataFrame:
    """The most frequent tags: a top-k report. Ties by tag."""
    return problems.select(F.explode("tags").alias("tag")).groupBy("tag").count().orderBy(F.desc("count"), "tag").limit(most)


def audit_ratings(problems: DataFrame) -> DataFrame:
    return problems.groupBy("rating").count().orderBy(F.asc_nulls_last("rating"))


def audit_dp_ids(problems: DataFrame, order: str, most: int = 30) -> DataFrame:
    """The first problems tagged dp in the order of the file, which a column gives."""
    return problems.where(F.array_contains("tags", "dp")).orderBy(order).limit(most).select("id")
