"""Queries by name over the driver's tables, and the SQL that says the same.

Results have scalars only: lists and maps are joined to text or exploded, so rows can be compared as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import concept_json, patterns as P, scoring as K, text as X
from ..operators import assemble, canonical, collect, judge, select, semantic, signals, taxonomy
from ..sources import schemas, tables
from ..sources.tables import staged
from . import standins as S
from .oracle import COMPILER, sql
from .standins import quoted as q

FLAGSHIP = "exact_dup_groups"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(select_sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if select_sql:
            ORACLES[f.__name__] = sql(select_sql)
        return f

    return add


def joined(c: Column | str) -> Column:
    return F.array_join(c, ",")


def rows(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(values, schema)


def literal(values: list[tuple]) -> str:
    cell = lambda v: "NULL" if v is None else q(v) if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, v)) + ")" for v in values) + ")"


# --- chains that several queries share ---------------------------------------------------------------------------------


def canonicals(spark: SparkSession, d: str, tax: DataFrame | None = None) -> DataFrame:
    return canonical.canonical_records(S.problems(spark, d), tax)


def near(spark: SparkSession, d: str, records: DataFrame | None = None) -> DataFrame:
    return canonical.near_duplicates(S.problems(spark, d), staged(canonicals(spark, d)) if records is None else records)


def related(spark: SparkSession, d: str, records: DataFrame | None = None) -> DataFrame:
    records = staged(canonicals(spark, d)) if records is None else records
    return canonical.relationships(near(spark, d, records), records)


def candidates_of(spark: SparkSession, d: str, rejects: bool = False) -> DataFrame:
    return signals.candidates(S.titled(spark, d), rejects)


def signalled(spark: SparkSession, d: str) -> DataFrame:
    return signals.solution_signals(collect.solutions(S.submissions(spark, d, True), failure=False))


def evidence_of(spark: SparkSession, d: str) -> DataFrame:
    return signals.evidence(candidates_of(spark, d), signals.problem_signals(signalled(spark, d)))


def taxonomy_of(spark: SparkSession, d: str) -> DataFrame:
    """Candidates are made twice, since evidence takes no texts: a table of them would hold nearly all texts once more."""
    return taxonomy.taxonomy(candidates_of(spark, d), evidence_of(spark, d))


def verified_of(spark: SparkSession, d: str, tax: DataFrame | None = None) -> DataFrame:
    return assemble.verified(S.results(spark, d), taxonomy_of(spark, d) if tax is None else tax, order="event_id")


def pool_and_verified(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Tables that several steps read are staged, as the flow does between its stages."""
    c, tax = staged(canonicals(spark, d)), staged(taxonomy_of(spark, d))
    verified = staged(verified_of(spark, d, tax))
    return assemble.problem_pool(tax, canonical.problem_groups(c), c, verified, related(spark, d, c)), verified


def pool_of(spark: SparkSession, d: str) -> DataFrame:
    return pool_and_verified(spark, d)[0]


def examples_of(spark: SparkSession, d: str) -> DataFrame:
    """The ids of usable problems are staged, not the solutions: each of those has its problem's whole statement."""
    pool = staged(pool_of(spark, d))
    ok = assemble.usable(S.results(spark, d), pool, S.problems(spark, d))
    return assemble.examples(ok, pool, assemble.split_ids(staged(ok.select("problem_id").distinct()), "problem_id"))


# --- canonical form and duplicates -------------------------------------------------------------------------------------


@query("SELECT exact_hash, string_agg(problem_id, ',' ORDER BY problem_id) AS problem_ids, count(*) AS count FROM canonical GROUP BY exact_hash HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return canonical.exact_groups(canonicals(spark, d)).select("exact_hash", joined("problem_ids").alias("problem_ids"), "count")


@query("SELECT problem_id, title, rating, contest_id, idx AS index_name, exact_hash, text_length, source FROM canonical")
def canonical_records(spark, d):
    return canonicals(spark, d).select("problem_id", "title", "rating", "contest_id", F.col("index").alias("index_name"), "canonical.exact_hash", "canonical.text_length", "source")


@query("SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS unique_hashes, count(*) FILTER (n > 1) AS duplicate_groups, CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM canonical GROUP BY exact_hash)")
def exact_dup_summary(spark, d):
    return canonical.exact_summary(canonicals(spark, d))


@query("SELECT a, b, shared FROM pairs")
def shingle_pairs(spark, d):
    return canonical.candidate_pairs(staged(canonical.postings(staged(canonical.prepared(S.problems(spark, d), lists=("shingle_set",))))))


@query("SELECT * FROM near")
def near_dup_pairs(spark, d):
    flat = ["score", "title_similarity", "statement_jaccard", "shingle_jaccard", "token_cosine", "same_rating"]
    return near(spark, d).select("problem_a", "problem_b", *[f"similarity.{c}" for c in flat], "title_a", "title_b")


@query("SELECT problem_a, problem_b, similarity_score, relationship, same_base_id, canonical_group_a, canonical_group_b FROM rel")
def relationships(spark, d):
    return related(spark, d).drop("same_canonical_hash", "title_a", "title_b")


@query("SELECT problem_id, exact_hash, primary_family, coalesce(array_to_string(families, ','), '') AS families, evidence_level AS evidence, dp_consensus AS consensus FROM canonical LEFT JOIN taxonomy USING (problem_id)")
def canonical_taxonomy(spark, d):
    c = canonicals(spark, d, taxonomy_of(spark, d))
    return c.select("problem_id", "canonical.exact_hash", "dp.primary_family", joined("dp.families").alias("families"), "dp.evidence", "dp.consensus")


@query("SELECT problem_a, problem_b, score, coalesce(x.primary_family = y.primary_family, false) AS same_dp_family, x.primary_family AS dp_family_a, y.primary_family AS dp_family_b FROM near LEFT JOIN taxonomy x ON x.problem_id = problem_a LEFT JOIN taxonomy y ON y.problem_id = problem_b")
def near_dup_families(spark, d):
    pairs = near(spark, d, staged(canonicals(spark, d, taxonomy_of(spark, d))))
    return pairs.select("problem_a", "problem_b", *[f"similarity.{c}" for c in ("score", "same_dp_family", "dp_family_a", "dp_family_b")])


@query("SELECT relationship, count(*) AS count FROM rel GROUP BY relationship")
def relationship_counts(spark, d):
    return signals.counts_of(related(spark, d), "relationship")


@query("SELECT * FROM groups")
def problem_groups(spark, d):
    return canonical.problem_groups(canonicals(spark, d))


# --- selection ---------------------------------------------------------------------------------------------------------

_RANK = "CASE lang " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in K.LANGUAGE_RANKS.items()) + f" ELSE {K.OTHER_LANGUAGE} END"


def _top(accepted: str, k: int) -> str:
    order = f"{_RANK}, len(code), submission_id"
    return f"""SELECT problem_id, submission_id, lang AS language FROM (SELECT *, row_number() OVER (PARTITION BY problem_id ORDER BY nth > 1, {order}) AS place FROM (
        SELECT *, row_number() OVER (PARTITION BY problem_id, lang ORDER BY {order}) AS nth FROM submissions WHERE {accepted} AND problem_id IN (SELECT id FROM candidates))) WHERE place <= {k}"""


def _selected(spark, d, accepted: bool, most: int) -> DataFrame:
    subs = select.of_candidates(S.submissions(spark, d, accepted), candidates_of(spark, d))
    return select.selected_solutions(subs, most).select("problem_id", "submission_id", F.col("programmingLanguage").alias("language"))


@query(_top("accepted", 5))
def diverse_top_k_accepted(spark, d):
    return _selected(spark, d, True, 5)


@query(_top("NOT accepted", 3))
def diverse_top_k_rejected(spark, d):
    return _selected(spark, d, False, 3)


@query(_top("accepted", 5).replace("SELECT problem_id, submission_id, lang AS language", "SELECT problem_id, submission_id AS source_id, lang AS language, true AS is_accepted", 1) + " UNION ALL " + _top("NOT accepted", 3).replace("SELECT problem_id, submission_id, lang AS language", "SELECT problem_id, submission_id, lang, false", 1))
def collected_solutions(spark, d):
    out = None
    for accepted, most in ((True, 5), (False, 3)):
        subs = select.selected_solutions(select.of_candidates(S.submissions(spark, d, accepted), candidates_of(spark, d)), most)
        part = collect.solutions(subs, failure=not accepted)
        out = part if out is None else out.unionByName(part)
    return out.select("problem_id", "source_id", "language", "is_accepted")


@query(f"""SELECT problem_id, source_id, compiler FROM (SELECT *, row_number() OVER (PARTITION BY problem_id ORDER BY nth > 1, compiler, source_id) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY problem_id, compiler ORDER BY source_id) AS nth FROM (SELECT problem_id, submission_id AS source_id, {COMPILER} AS compiler FROM submissions WHERE accepted)
    WHERE compiler IS NOT NULL AND compiler <> 'pypy')) WHERE place <= 2""")
def verify_choice(spark, d):
    return select.solutions_to_verify(collect.solutions(S.submissions(spark, d, True), failure=False)).select("problem_id", "source_id", "compiler")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def keep_first(spark, d):
    return select.keep_first(S.table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT id FROM problems ORDER BY sha256('42|' || id), id LIMIT 100")
def shuffled_first(spark, d):
    return select.shuffled_first(S.problems(spark, d).select("id"), "id", 100)


# --- candidates, signals, evidence, taxonomy ---------------------------------------------------------------------------


@query("SELECT id, title, rating, dp_tag, array_to_string(editorial_ev, ',') AS editorial, array_to_string(metadata_ev, ',') AS metadata, heuristic_score, tier, editorial <> '' AS has_editorial FROM candidates")
def candidates(spark, d):
    return candidates_of(spark, d).select("id", "title", "rating", "dp_tag", joined("editorial_dp_evidence").alias("editorial"), joined("metadata_evidence").alias("metadata"), "heuristic_score", "tier", "has_editorial")


@query("SELECT count(*) AS total, count(*) FILTER (tier <> 'reject') AS candidates, count(*) FILTER (tier = 'seed') AS seeds FROM tiered")
def candidate_totals(spark, d):
    return signals.candidate_totals(candidates_of(spark, d, rejects=True))


@query("SELECT problem_id, source_id, array_to_string(signals, ',') AS signals, score FROM rated")
def code_signals(spark, d):
    return signalled(spark, d).select("problem_id", "source_id", joined("signals").alias("signals"), "score")


@query("SELECT problem_id, signal, n FROM sigcounts")
def signal_counts(spark, d):
    return signals.signal_counts(signalled(spark, d))


@query("SELECT problem_id, total AS accepted_solution_count, best AS best_solution_score, (SELECT string_agg(source_id, ',' ORDER BY source_id) FROM rated r WHERE r.problem_id = c.problem_id) AS source_ids FROM classes c")
def problem_signals(spark, d):
    return signals.problem_signals(signalled(spark, d)).select("problem_id", "accepted_solution_count", "best_solution_score", joined(F.transform("solutions", lambda s: s["source_id"])).alias("source_ids"))


@query("SELECT problem_id, total, strong, moderate, weak FROM classes")
def solution_classes(spark, d):
    return signals.class_counts(signalled(spark, d))


@query("SELECT problem_id, title, rating, dp_tag, array_to_string(editorial_ev, ',') AS editorial, total AS accepted_solution_count, strong AS strong_solution_count, moderate AS moderate_solution_count, weak AS weak_solution_count, dp_consensus, best AS best_solution_score, evidence_level FROM evidence")
def problem_evidence(spark, d):
    e = evidence_of(spark, d)
    return e.select("problem_id", "title", "rating", "dp_tag", joined("editorial_evidence").alias("editorial"), "accepted_solution_count", "strong_solution_count", "moderate_solution_count", "weak_solution_count", "dp_consensus", "best_solution_score", "evidence_level")


@query("SELECT evidence_level, count(*) AS count FROM evidence GROUP BY evidence_level")
def evidence_levels(spark, d):
    return signals.counts_of(evidence_of(spark, d), "evidence_level")


@query("""SELECT problem_id, primary_family, coalesce(secondary, '') AS secondary_families, array_to_string(families, ',') AS families, array_to_string(dimensions, ',') AS dimensions, array_to_string(transition_style, ',') AS transition_style,
    array_to_string(optimizations, ',') AS optimizations, array_to_string(states, ',') AS state_signals, evidence_level AS dp_evidence_level, dp_consensus FROM taxonomy""")
def taxonomy_primary(spark, d):
    lists = ["secondary_families", "families", "dimensions", "transition_style", "optimizations", "state_signals"]
    return taxonomy_of(spark, d).select("problem_id", "primary_family", *[joined(c).alias(c) for c in lists], "dp_evidence_level", "dp_consensus")


@query("SELECT problem_id, family, in_text, in_code, cnt AS code_signal_count, confidence FROM fams")
def taxonomy_families(spark, d):
    one = taxonomy_of(spark, d).select("problem_id", F.explode("family_evidence").alias("family", "e"))
    return one.select("problem_id", "family", F.col("e.text").alias("in_text"), F.col("e.accepted_code").alias("in_code"), "e.code_signal_count", "e.confidence")


@query("SELECT family, count(*) AS count FROM fams GROUP BY family")
def family_counts(spark, d):
    return taxonomy.family_counts(taxonomy_of(spark, d))


# --- verified solutions, pool, seeds, concepts, examples ---------------------------------------------------------------


@query("SELECT problem_id, source_id, language, status, quality, method, primary_family FROM verified")
def verified_split(spark, d):
    return verified_of(spark, d).select("problem_id", "source_id", "language", "verification.status", "verification.quality", F.col("verification.verification_method").alias("method"), "dp.primary_family")


@query("SELECT problem_id, source_id, language, status, failure_type FROM failures")
def failure_split(spark, d):
    return assemble.failures(S.results(spark, d)).select("problem_id", "source_id", "language", "status", "failure_type")


@query("SELECT (SELECT count(*) FROM verified) AS verified_solutions, (SELECT count(DISTINCT problem_id) FROM verified) AS verified_problems, (SELECT count(*) FROM failures) AS failure_solutions")
def verified_summary(spark, d):
    return assemble.verified_summary(S.results(spark, d), verified_of(spark, d))


@query("SELECT id, n_tests FROM runnable WHERE input_mode = 'stdio' AND n_tests > 0 AND executable AND id IN (SELECT problem_id FROM submissions WHERE accepted)")
def eligible_problems(spark, d):
    sols = collect.solutions(S.submissions(spark, d, True), failure=False)
    return judge.eligible_problems(S.runnable(spark, d), sols).select("id", F.size("official_tests").alias("n_tests"))


@query("SELECT status, count(*) AS count FROM results GROUP BY status")
def result_counts(spark, d):
    return judge.result_counts(S.results(spark, d))


@query("SELECT problem_id, canonical_group_id, group_type, base_problem_id, canonical_hash, rating, primary_family, array_to_string(families, ',') AS families, dp_evidence_level, dp_consensus, verified_solution_count, verification_statuses, has_verified_solution, relationship_flags, version_family_members, relationship_count FROM pool")
def problem_pool(spark, d):
    p = pool_of(spark, d)
    lists = ["families", "verification_statuses", "relationship_flags", "version_family_members"]
    same = ["problem_id", "canonical_group_id", "group_type", "base_problem_id", "canonical_hash", "rating", "primary_family", "dp_evidence_level", "dp_consensus", "verified_solution_count", "has_verified_solution", "relationship_count"]
    return p.select(*same, *[joined(c).alias(c) for c in lists])


@query("""SELECT (SELECT count(*) FROM pool) AS total_dp_candidates, (SELECT count(*) FROM pool WHERE has_verified_solution) AS dp_candidates_with_verified_solution, (SELECT count(*) FROM pool WHERE NOT has_verified_solution) AS dp_candidates_without_verified_solution,
    count(*) AS unique_canonical_groups, count(*) FILTER (n > 1) AS exact_duplicate_groups_inside_dp_pool, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS dp_problems_inside_exact_duplicate_groups FROM (SELECT count(*) AS n FROM pool GROUP BY canonical_group_id)""")
def pool_summary(spark, d):
    return assemble.pool_summary(staged(pool_of(spark, d)))


@query("""SELECT what, value, count(*) AS count FROM (SELECT 'primary_family' AS what, primary_family AS value FROM pool UNION ALL SELECT 'evidence_level', dp_evidence_level FROM pool
    UNION ALL SELECT 'relationship_flag', unnest(string_split(relationship_flags, ',')) FROM pool WHERE relationship_flags <> '') WHERE value IS NOT NULL GROUP BY what, value""")
def pool_counts(spark, d):
    return assemble.pool_counts(staged(pool_of(spark, d)))


@query("SELECT problem_id, rating, primary_family, dp_evidence_level, verified_solution_count, quality_tier, role FROM gold")
def gold_seeds(spark, d):
    return assemble.gold_seeds(pool_of(spark, d)).select("problem_id", "rating", "primary_family", "dp_evidence_level", "verified_solution_count", "quality_tier", "role")


@query("SELECT what, value, count(*) AS count FROM (SELECT 'role' AS what, role AS value FROM gold UNION ALL SELECT 'quality_tier', quality_tier FROM gold UNION ALL SELECT 'family', coalesce(primary_family, 'unresolved') FROM gold) GROUP BY what, value")
def gold_counts(spark, d):
    return assemble.gold_counts(assemble.gold_seeds(staged(pool_of(spark, d))))


@query("SELECT problem_id, source_id, " + ", ".join(P.CODE_COUNTS) + ", array_to_string(impl, ',') AS implementations FROM built")
def code_pattern_counts(spark, d):
    return assemble.code_rows(verified_of(spark, d)).select("problem_id", "source_id", "counts.*", joined("implementations").alias("implementations"))


@query("SELECT s.problem_id, (SELECT count(*) FROM verified v WHERE v.problem_id = s.problem_id) AS solution_count, with_code, transition, bitmask, round(share_transition, 6) AS share_transition, round(share_bitmask, 6) AS share_bitmask, coalesce(implementation_patterns, '') AS implementation_patterns FROM code_sums s LEFT JOIN half h ON h.problem_id = s.problem_id")
def code_consensus(spark, d):
    a = assemble.code_analysis(verified_of(spark, d)).select("problem_id", "code_analysis.*").where("solutions_with_code > 0")
    value = lambda m, k: F.try_element_at(m, F.lit(k))
    return a.select(
        "problem_id", "solution_count", F.col("solutions_with_code").alias("with_code"), *[value(F.col("signal_counts"), k).alias(k) for k in ("transition", "bitmask")],
        *[F.round(value(F.col("signal_consensus"), k), 6).alias(f"share_{k}") for k in ("transition", "bitmask")], joined("implementation_patterns").alias("implementation_patterns"),
    )


@query("SELECT p.problem_id, p.primary_family, p.verified_solution_count, coalesce(s.with_code, 0) AS solutions_with_code, coalesce(h.implementation_patterns, '') AS implementation_patterns FROM pool p LEFT JOIN code_sums s ON s.problem_id = p.problem_id LEFT JOIN half h ON h.problem_id = p.problem_id")
def concepts(spark, d):
    c = assemble.concepts(*pool_and_verified(spark, d))
    return c.select("problem_id", F.col("family.primary").alias("primary_family"), "verification.verified_solution_count", "code_analysis.solutions_with_code", joined("code_analysis.implementation_patterns").alias("implementation_patterns"))


@query("SELECT count(*) AS total_dp_problems, count(*) FILTER (has_verified_solution) AS problems_with_verified_solutions, count(*) FILTER (problem_id IN (SELECT problem_id FROM code_sums)) AS problems_with_code_analysis FROM pool")
def concepts_summary(spark, d):
    return assemble.concepts_summary(assemble.concepts(*pool_and_verified(spark, d)))


@query("SELECT what, value, count(*) AS count FROM (SELECT 'primary_family' AS what, primary_family AS value FROM pool WHERE primary_family IS NOT NULL UNION ALL SELECT 'implementation_pattern', unnest(string_split(implementation_patterns, ',')) FROM half WHERE problem_id IN (SELECT problem_id FROM pool)) GROUP BY what, value")
def concept_counts(spark, d):
    return assemble.concept_counts(assemble.concepts(*pool_and_verified(spark, d)))


_ASKED = """SELECT i.problem_id, nth, solutions, sha256(text) AS prompt_hash, sha256(source_code) AS code_hash, coalesce(primary_family, '') AS primary_family
    FROM (SELECT problem_id, primary_family FROM pool WHERE has_verified_solution ORDER BY problem_id LIMIT 60 OFFSET 5) i JOIN prompts p ON p.id = i.problem_id JOIN nths v ON v.problem_id = i.problem_id WHERE nth <= 2"""


@query(_ASKED)
def semantic_slice(spark, d):
    """The slice from the sixth problem on, 60 long, with the first two solutions of each: what a model is asked about."""
    pool, verified = pool_and_verified(spark, d)
    asked = semantic.asked(pool, verified, S.problems(spark, d), start=5, limit=60)
    return asked.select("problem_id", "nth", F.col("verified_solution_count").alias("solutions"), F.sha2("problem_text", 256).alias("prompt_hash"), F.sha2("source_code", 256).alias("code_hash"), F.coalesce("family_evidence.primary", F.lit("")).alias("primary_family"))


@query(f"SELECT status, level, count(*) AS count FROM (SELECT problem_id, CASE WHEN count(*) = 2 THEN CASE WHEN count(DISTINCT length(source_code) % 2) = 1 THEN 'high_confidence' ELSE 'disagreement' END ELSE 'single_extraction' END AS status, CASE WHEN count(*) = 2 THEN CASE WHEN count(DISTINCT length(source_code) % 2) = 1 THEN 'high' ELSE 'low' END ELSE '' END AS level FROM ({_ASKED.replace('sha256(source_code) AS code_hash', 'source_code')}) GROUP BY problem_id) GROUP BY status, level")
def semantic_agreement(spark, d):
    """Answers of a stub: code of even length uses the method, other code doesn't."""
    pool, verified = pool_and_verified(spark, d)
    asked = staged(semantic.asked(pool, verified, S.problems(spark, d), start=5, limit=60))
    rows = semantic.agreed(semantic.extract(asked, _stub, with_code=True), asked)
    return rows.groupBy("status", F.coalesce("agreement.level", F.lit("")).alias("level")).count()


def _stub(prompt: str) -> str:
    code = prompt.split("An accepted solution:\n", 1)[1].split("\n\nIf no subproblems", 1)[0]
    return '{"dp_used": true, "family": "tree"}' if len(code) % 2 == 0 else '{"dp_used": false}'


@query(f"""SELECT s.split, u.problem_id, u.source_id, u.lang AS language, p.rating, coalesce(p.primary_family, p.families[1]) AS family, sha256({q(assemble.PROMPT)} || statement) AS question, sha256(source_code) AS answer
    FROM usable u JOIN pool p ON p.problem_id = u.problem_id JOIN splits s ON s.problem_id = u.problem_id""")
def sft_examples(spark, d):
    content = lambda i: F.sha2(F.get("messages", F.lit(i))["content"], 256)
    return examples_of(spark, d).select("split", "metadata.*", content(0).alias("question"), content(1).alias("answer"))


@query("SELECT split, count(DISTINCT u.problem_id) AS problems, count(*) AS examples FROM usable u JOIN splits s ON s.problem_id = u.problem_id GROUP BY split")
def sft_split_sizes(spark, d):
    return assemble.split_sizes(examples_of(spark, d))


@query(f"SELECT split, sha256('<|im_start|>user' || chr(10) || {q(assemble.PROMPT)} || statement || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || source_code || '<|im_end|>' || chr(10)) AS text_hash FROM usable u JOIN splits s ON s.problem_id = u.problem_id")
def chat_text(spark, d):
    return assemble.chat_text(examples_of(spark, d)).select("split", F.sha2("text", 256).alias("text_hash"))


# --- audit of raw problems ---------------------------------------------------------------------------------------------


@query("SELECT count(*) AS total, count(*) FILTER (executable) AS executable, count(*) FILTER (editorial <> '') AS with_editorial, count(*) FILTER (official_tests_complete) AS complete_tests, count(*) FILTER (list_contains(tags, 'dp')) AS dp_tagged FROM problems")
def raw_audit_totals(spark, d):
    return collect.audit_totals(S.problems(spark, d))


@query("SELECT tag, count(*) AS count FROM (SELECT unnest(tags) AS tag FROM problems) GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 40")
def raw_audit_tags(spark, d):
    return collect.audit_tags(S.problems(spark, d))


@query("SELECT rating, count(*) AS count FROM problems GROUP BY rating")
def raw_audit_ratings(spark, d):
    return collect.audit_ratings(S.problems(spark, d))


@query("SELECT id FROM problems WHERE list_contains(tags, 'dp') ORDER BY doc_id LIMIT 30")
def raw_audit_dp_ids(spark, d):
    return collect.audit_dp_ids(S.problems(spark, d), "doc_id")


# --- functions on fixed rows -------------------------------------------------------------------------------------------

_LANGUAGES = [(x,) for x in [*S.LANGUAGES, "PyPy 2", "C++17 (GCC 7-32)", "GNU C++14", "GNU C++11", "Kotlin"]]


@query(f"SELECT lang AS language, {COMPILER} AS compiler, {_RANK} AS language_rank FROM {literal(_LANGUAGES)} t(lang)")
def language_map(spark, d):
    df = rows(spark, _LANGUAGES, "language string")
    return df.select("language", X.language_family(F.col("language")).alias("compiler"), K.language_rank(F.col("language")).alias("language_rank"))


_IDS = [("1356/A1",), ("1356/A",), ("1/B12",), ("7/a1",), ("9/AB3",), ("x",)]


@query(rf"SELECT id, regexp_replace(id, '([A-Z])\d+$', '\1') AS base FROM {literal(_IDS)} t(id)")
def base_ids(spark, d):
    return rows(spark, _IDS, "id string").select("id", X.base_id(F.col("id")).alias("base"))


_FOLD = "(" + " OR ".join(f"contains(lower(format), {q(p)})" for p in X.ANY_CASE) + ")"
_SPLIT = r"list_filter(string_split_regex(CASE WHEN fold THEN lower({c}) ELSE {c} END, '\s+'), lambda x: x <> '')"


@query(f"SELECT actual, expected, fold AS any_case, {_SPLIT.format(c='actual')} = {_SPLIT.format(c='expected')} AS same FROM (SELECT *, {_FOLD} AS fold FROM {literal(S.OUTPUTS)} t(actual, expected, format))")
def output_match(spark, d):
    fold = X.any_case(F.col("format"))
    return rows(spark, S.OUTPUTS, "actual string, expected string, format string").select("actual", "expected", fold.alias("any_case"), X.outputs_match(F.col("actual"), F.col("expected"), fold).alias("same"))


_TEXTS = [("T", "D", "I", "", None, " n "), (None, "only\r\nthis", None, None, None, None), ("", "", "", "", "", ""), ("t", None, None, "o", "x", None)]
_FIELDS = "title, description, input_format, output_format, interaction_format, note"


def _headed(headings: list[str], clean: str) -> str:
    parts = ", ".join(f"CASE WHEN coalesce({clean.format(c=c)}, '') <> '' THEN {q(h + ':')} || chr(10) || {clean.format(c=c)} END" for h, c in zip(headings, _FIELDS.split(", ")))
    return rf"regexp_replace(concat_ws(chr(10) || chr(10), {parts}), '^\s+|\s+$', '', 'g')"


_CLEAN = r"regexp_replace(replace({c}, chr(13) || chr(10), chr(10)), '^\s+|\s+$', '', 'g')"


@query(f"SELECT {_headed(X.STATEMENT_HEADINGS, '{c}')} AS statement, {_headed(X.PROMPT_HEADINGS, _CLEAN)} AS prompt_text FROM {literal(_TEXTS)} t({_FIELDS})")
def statements(spark, d):
    df = rows(spark, _TEXTS, ", ".join(f"{c} string" for c in _FIELDS.split(", ")))
    columns = [F.col(c) for c in X.TEXT_FIELDS]
    return df.select(X.statement(*columns).alias("statement"), X.prompt_text(*columns).alias("prompt_text"))


_RAW = [("1/A", "2013", "7", None, "1.5", ["dp", None]), ("2/B", None, None, "", None, None), (None, "0", "900", "e", "2", [])]


@query("""SELECT * FROM (VALUES ('1/A', 2013, 7, NULL, 1.5::DOUBLE, 'dp,', 'open-r1/codeforces', 'train', '{"odd":"x","examples":[],"generated_tests":null}'),
    ('2/B', 0, NULL, '', 0.0, '', 'open-r1/codeforces', 'train', '{"odd":"x","examples":[],"generated_tests":null}'),
    ('', 0, 900, 'e', 2.0, '', 'open-r1/codeforces', 'train', '{"odd":"x","examples":[],"generated_tests":null}')) t(id, contest_start_year, rating, editorial, time_limit, tags, source, source_split, extra)""")
def collect_problems(spark, d):
    raw = rows(spark, [(*r, "x") for r in _RAW], "id string, contest_start_year string, rating string, editorial string, time_limit string, tags array<string>, odd string")
    return collect.problems(raw).select("id", "contest_start_year", "rating", "editorial", "time_limit", joined("tags").alias("tags"), "source", "source_split", "extra")


_TESTS = [("1/A", [("2", "4"), (None, "5"), None]), ("2/B", []), ("3/C", None), ("4/D", [("", None)])]


@query("SELECT * FROM (VALUES ('1/A', 0, '2', '4', '{\"examples\":[{\"input\":\"2\",\"output\":\"4\"},{\"input\":\"\",\"output\":\"5\"}],\"generated_tests\":null}'), ('1/A', 1, '', '5', '{\"examples\":[{\"input\":\"2\",\"output\":\"4\"},{\"input\":\"\",\"output\":\"5\"}],\"generated_tests\":null}'), ('4/D', 0, '', '', '{\"examples\":[{\"input\":\"\",\"output\":\"\"}],\"generated_tests\":null}')) t(id, nth, input, output, extra)")
def collect_tests(spark, d):
    """Tests and examples: null items are dropped, null texts are empty."""
    kind = "array<struct<input: string, output: string>>"
    raw = rows(spark, [(i, t, t) for i, t in _TESTS], f"id string, official_tests {kind}, examples {kind}")
    return collect.problems(raw).select("id", F.posexplode("official_tests").alias("nth", "t"), "extra").select("id", "nth", "t.input", "t.output", "extra")


# --- files: rows written as JSON lines and read again -------------------------------------------------------------------


def _lines(spark: SparkSession, df: DataFrame) -> str:
    path = f"{tables.shared_folder(spark)}/rows.jsonl"
    tables.write_jsonl(df, path)
    return path


_RAW_FIELDS = "id, title, description, note, rating, tags, editorial, executable, official_tests_complete, contest_id"


@query(f"SELECT {_RAW_FIELDS.replace('tags', 'array_to_string(tags, chr(44)) AS tags').replace(' note', ' note')}, idx AS index_name FROM problems")
def jsonl_problems(spark, d):
    """Raw problems as JSON lines, whole texts, read with their schema and collected."""
    raw = S.problems(spark, d).select(*_RAW_FIELDS.split(", "), "index")
    got = collect.problems(tables.read_jsonl(spark, _lines(spark, raw), schemas.RAW_PROBLEM))
    return got.select("id", "title", "description", "note", "rating", joined("tags").alias("tags"), "editorial", "executable", "official_tests_complete", "contest_id", F.col("index").alias("index_name"))


@query("SELECT problem_id, submission_id AS source_id, lang AS language, sha256(code) AS code, 'OK' AS verdict, accepted AS is_accepted FROM submissions")
def jsonl_submissions(spark, d):
    """Accepted and other submissions, read from two files."""
    out = None
    for accepted in (True, False):
        part = collect.solutions(tables.read_jsonl(spark, _lines(spark, S.submissions(spark, d, accepted)), schemas.SUBMISSION), failure=not accepted)
        out = part if out is None else out.unionByName(part)
    return out.select("problem_id", "source_id", "language", F.sha2("source_code", 256).alias("code"), "verdict", "is_accepted")


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids, CAST(sum(event_id) AS BIGINT) AS total FROM events")
def jsonl_append(spark, d):
    """All events appended in two parts that overlap: each key is there once."""
    events, path, schema = S.table(spark, d, "events").select("event_id", "event_type"), f"{tables.shared_folder(spark)}/appended.jsonl", "event_id long, event_type string"
    for part in (events.where("event_id % 3 <> 0"), events.where("event_id % 3 <> 1")):
        tables.append_new(part, path, "event_id", schema)
    return tables.read_jsonl(spark, path, schema).agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.sum("event_id").alias("total"))


@query(f"SELECT s.split, u.problem_id, u.source_id, sha256({q(assemble.PROMPT)} || statement) AS question, sha256(source_code) AS answer FROM usable u JOIN splits s ON s.problem_id = u.problem_id")
def jsonl_examples(spark, d):
    """Examples written as JSON lines, in their shuffled order, and loaded for training."""
    made = assemble.shuffled(examples_of(spark, d)).orderBy("split", "place").drop("place")
    got = tables.read_table(spark, _lines(spark, made), f"split string, {schemas.EXAMPLE}")
    content = lambda i: F.sha2(F.get("messages", F.lit(i))["content"], 256)
    return got.select("split", "metadata.problem_id", "metadata.source_id", content(0).alias("question"), content(1).alias("answer"))


@query("SELECT doc_id, right(text, 40) AS tail FROM documents")
def text_tails(spark, d):
    return S.table(spark, d, "documents").select("doc_id", X.tail(F.col("text"), 40).alias("tail"))


_ANSWERS = list(enumerate(S.ANSWERS))
_PAIRS = [(i, j) for i in range(len(S.ANSWERS)) for j in range(len(S.ANSWERS)) if i < j]
_CONCEPT = """SELECT i, CASE WHEN j IS NULL THEN NULL ELSE coalesce(CAST(j->'$.dp_used' AS BOOLEAN), false) END AS dp,
    CASE WHEN coalesce(CAST(j->'$.dp_used' AS BOOLEAN), false) THEN coalesce(j->>'$.family', 'unknown') END AS family,
    CASE WHEN NOT coalesce(CAST(j->'$.dp_used' AS BOOLEAN), false) THEN 0 WHEN json_type(j, '$.state.dimensions') IN ('UBIGINT', 'BIGINT') THEN CAST(j->>'$.state.dimensions' AS INTEGER) END AS dims,
    CASE WHEN coalesce(CAST(j->'$.dp_used' AS BOOLEAN), false) THEN coalesce(j->>'$.state.representation', 'other') ELSE 'other' END AS rep,
    coalesce(j->>'$.iteration.style', 'other') AS style, CASE WHEN coalesce(CAST(j->'$.dp_used' AS BOOLEAN), false) THEN coalesce(j->>'$.transition.operation', 'unknown') ELSE 'unknown' END AS op
    FROM (SELECT i, CASE WHEN json_valid(o) THEN CAST(o AS JSON) END AS j FROM (SELECT i, regexp_extract(a, '\\{.*\\}', 0, 's') AS o FROM """ + literal(_ANSWERS) + """ t(i, a)))"""
_SHARE = "(1 + " + " + ".join(f"CAST(a.{c} IS NOT DISTINCT FROM b.{c} AS INTEGER)" for c in ("family", "dims", "rep", "style", "op")) + ") / 6"


@query(f"""SELECT i, j, level, round(score, 6) AS score, CASE WHEN level IS NULL THEN CASE WHEN given = 1 THEN 'single_extraction' ELSE 'error' END WHEN level = 'high' THEN 'high_confidence' WHEN level = 'medium' THEN 'medium_confidence' ELSE 'disagreement' END AS status
    FROM (SELECT *, CASE WHEN score >= 0.83 THEN 'high' WHEN score >= 0.5 THEN 'medium' WHEN score IS NOT NULL THEN 'low' END AS level FROM (
    SELECT p.i, p.j, CAST(a.dp IS NOT NULL AS INTEGER) + CAST(b.dp IS NOT NULL AS INTEGER) AS given, CASE WHEN a.dp IS NULL OR b.dp IS NULL THEN NULL WHEN NOT a.dp AND NOT b.dp THEN 1.0::DOUBLE WHEN a.dp <> b.dp THEN 0.0 ELSE {_SHARE} END AS score
    FROM {literal(_PAIRS)} p(i, j) JOIN ({_CONCEPT}) a ON a.i = p.i JOIN ({_CONCEPT}) b ON b.i = p.j))""")
def concept_agreement(spark, d):
    c = rows(spark, _ANSWERS, "i int, a string").select("i", concept_json.concept(F.col("a")).alias("c"))
    df = rows(spark, _PAIRS, "i int, j int").join(c.withColumnRenamed("c", "x"), "i").join(c.select(F.col("i").alias("j"), F.col("c").alias("y")), "j")
    df = df.withColumn("agreement", K.agreement(F.col("x"), F.col("y")))
    some = F.col("x").isNotNull().cast("int") + F.col("y").isNotNull().cast("int")
    return df.select("i", "j", "agreement.level", F.round("agreement.score", 6).alias("score"), K.extraction_status(some, F.col("agreement.level")).alias("status"))


_UNICODE = [("Ａ Å  x \r\n\r\n\r\n y\t z",), ("plain",), ("ﬁn",), (None,)]


@query()
def compatibility_form(spark, d):
    """SQL has no compatibility form: tests hold this against Python's."""
    df = rows(spark, _UNICODE, "t string")
    return df.select("t", X.canonical(F.col("t")).alias("canonical"), X.plain_words(F.col("t")).alias("plain"))


_PROGRAMS = [("p", "1", "Python 3", "print(int(input()) * 2)"), ("p", "2", "Python 3", "print(7)"), ("p", "3", "Python 3", "raise ValueError"), ("p", "4", "Rust", "")]


@query()
def judged(spark, d):
    """Our own trivial programs, run by the judge: tests hold the outcomes."""
    sols = rows(spark, [(*p[:3], "OK", "own", p[3]) for p in _PROGRAMS], "problem_id string, source_id string, language string, verdict string, source string, source_code string")
    probs = rows(spark, [("p", [("2", "4"), ("5", "10")], 1.0, None, "", True)], "id string, official_tests array<struct<input: string, output: string>>, time_limit double, generated_checker string, output_format string, official_tests_complete boolean")
    return judge.verify(sols, probs, tasks=2).select("problem_id", "source_id", "status", "tests_passed", "tests_total")


__all__ = ["FLAGSHIP", "ORACLES", "QUERIES", "schemas"]
