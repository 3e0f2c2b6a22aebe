"""Families, their confidences and the primary one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scoring as K
from ..functions.text import barrier
from ..sources.tables import dealt

#: A family below has too little evidence to be named.
NAMED = 0.45
_NONE = "array<string>"


def taxonomy(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row a candidate. Texts are the title, description, tags and the labels of the editorial's evidence, not its body.

    Candidates are dealt by their ids, since one file with all of them as one row group would be one task's work.
    """
    ev = evidence.select("problem_id", "editorial_evidence", "dp_consensus", "evidence_level", "accepted_solution_count", "strong_solution_count", "signal_counts")
    df = dealt(candidates.withColumnRenamed("id", "problem_id"), "problem_id").join(ev, "problem_id", "left")
    words = lambda c: F.array_join(F.coalesce(c, F.array().cast(_NONE)), " ")
    df = df.withColumn("text_", F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")), words("tags"), words("editorial_evidence")))
    df = df.withColumn("signal_counts", F.coalesce("signal_counts", F.create_map().cast("map<string, bigint>")))
    df = df.withColumn("dp_consensus", F.coalesce("dp_consensus", F.lit(0.0))).withColumn("dp_evidence_level", F.coalesce("evidence_level", F.lit("uncertain")))
    df = barrier(df, "text_", "signal_counts")
    df = barrier(df.withColumn("plain_", P.folded(F.col("text_"))), "plain_")
    counts = F.col("signal_counts")
    for name, patterns in (("text_families", P.FAMILIES), ("text_optimizations", P.OPTIMIZATIONS), ("state_signals", P.STATES)):
        df = df.withColumn(name, P.categories(F.col("text_"), patterns, F.col("plain_")))
    df = df.withColumn("code_families", K.code_families(counts)).drop("text_", "plain_")
    df = barrier(df, "text_families", "text_optimizations", "state_signals", "code_families")
    df = df.withColumn("families", F.sort_array(F.array_union("text_families", "code_families"))).withColumn("optimizations", F.sort_array(F.array_union("text_optimizations", K.code_optimizations(counts))))

    def of(family):
        text, code = F.array_contains(F.col("text_families"), family), F.array_contains(F.col("code_families"), family)
        count = F.coalesce(F.try_element_at(F.col("signal_counts"), F.concat(family, F.lit("_pattern"))), F.lit(0)).cast("long")
        confidence = K.family_confidence(text, code, count, F.col("dp_consensus"), F.col("dp_evidence_level"))
        return F.struct(family.alias("family"), text.alias("text"), code.alias("accepted_code"), count.alias("code_signal_count"), confidence.alias("confidence"))

    df = barrier(df.withColumn("rows_", F.transform("families", of)), "rows_")
    ranked = F.array_sort(F.transform("rows_", lambda r: F.struct((-r["confidence"]).alias("a"), (-r["code_signal_count"]).alias("b"), r["family"].alias("family"))))
    df = barrier(df.withColumn("ranked_", ranked), "ranked_")
    best = F.get("ranked_", F.lit(0))
    df = df.withColumn("primary_family", F.when(-best["a"] >= NAMED, best["family"]))
    named = F.filter("ranked_", lambda r: (-r["a"] >= NAMED) & ~r["family"].eqNullSafe(F.col("primary_family")))
    value = lambda r: F.struct(r["text"].alias("text"), r["accepted_code"].alias("accepted_code"), r["code_signal_count"].alias("code_signal_count"), r["confidence"].alias("confidence"))
    return df.select(
        "problem_id", "title", "rating", "primary_family", F.transform(named, lambda r: r["family"]).alias("secondary_families"), "families",
        K.dimensions(counts, F.col("families")).alias("dimensions"), K.transition_style(counts).alias("transition_style"), "optimizations", "state_signals",
        F.map_from_entries(F.transform("rows_", lambda r: F.struct(r["family"], value(r)))).alias("family_evidence"), "dp_evidence_level", "dp_consensus",
        F.coalesce("accepted_solution_count", F.lit(0)).alias("accepted_solution_count"), F.coalesce("strong_solution_count", F.lit(0)).alias("strong_solution_count"), "tags", "source",
    )


def family_counts(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.select(F.explode("families").alias("family")).groupBy("family").count()
