"""SQL for the catalogue: named steps, put together with the select of a query."""

from __future__ import annotations

import re

from ..functions import patterns as P
from ..functions import scoring as K
from ..functions import text as X
from . import standins as S
from .standins import listed, quoted, sql_labels

q = quoted
STEPS = dict(S.SQL)


def has(text: str, patterns: list[str], flags: str = "") -> str:
    return f"regexp_matches({text}, {q('|'.join(f'(?:{p})' for p in patterns))}{', ' + q(flags) if flags else ''})"


def case(c: str, table: dict, default: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}" for k, v in table.items()) + f" ELSE {default} END"


def flat(c: str) -> str:
    return rf"regexp_replace(lower({c}), '\s+', ' ', 'g')"


def among(c: str, names: list[str]) -> str:
    return f"len(list_filter({c}, lambda s: list_contains({listed(names)}, s)))"


def canonical(c: str) -> str:
    blanks = f"regexp_replace({c}, '[ \t]+', ' ', 'g')"
    lines = f"regexp_replace({blanks}, '(?m)^ +| +$', '', 'g')"
    return rf"trim(regexp_replace({lines}, '\n{{3,}}', '{chr(10)}{chr(10)}', 'g'), ' ' || chr(10))"


def tokens(c: str) -> str:
    words = f"string_split(trim(regexp_replace(lower({c}), '[^a-z0-9_]+', ' ', 'g')), ' ')"
    return f"list_filter({words}, lambda w: len(w) > 1 AND NOT list_contains({listed(X.STOPWORDS)}, w))"


N = "coalesce({m}['{k}'], 0)"
CLASS = f"CASE WHEN {among('signals', P.STRONG)} >= 2 OR ({among('signals', P.STRONG)} = 1 AND score >= 1) THEN 'strong' WHEN {among('signals', P.STRUCTURAL)} > 0 THEN 'moderate' WHEN {among('signals', P.WEAK)} > 0 THEN 'weak' ELSE 'none' END"
COMPILER = "CASE " + " ".join(f"WHEN contains(lower(lang), {q(p)}) THEN {q(n)}" for p, n in (("pypy", "pypy"), ("python", "python"), ("c++20", "cpp20"), ("c++17", "cpp17"), ("c++14", "cpp14"), ("c++11", "cpp11"), ("c++", "cpp"))) + " END"
BASE_ID = r"regexp_replace({c}, '([A-Z])\d+$', '\1')"
TRIMMED = r"regexp_replace(replace({c}, chr(13) || chr(10), chr(10)), '^\s+|\s+$', '', 'g')"
STATEMENT = "'Title:' || chr(10) || title || chr(10) || chr(10) || 'Problem:' || chr(10) || description || CASE WHEN note IS NOT NULL THEN chr(10) || chr(10) || 'Note:' || chr(10) || note ELSE '' END"

STEPS |= {
    "canon": f"""SELECT id AS problem_id, title, rating, contest_id, idx, source,
        '[title]' || chr(10) || {canonical('title')} || chr(10) || chr(10) || '[description]' || chr(10) || {canonical('description')} || chr(10) || chr(10) || '[input_format]' || chr(10) || chr(10) || chr(10)
        || '[output_format]' || chr(10) || chr(10) || chr(10) || '[interaction_format]' || chr(10) || chr(10) || chr(10) || '[note]' || chr(10) || coalesce(note, '') AS body FROM problems""",
    "canonical": "SELECT * EXCLUDE (body), sha256(body) AS exact_hash, CAST(len(body) AS BIGINT) AS text_length FROM canon",
    "words": f"SELECT id, {tokens('title')} AS title_words, {tokens('description || chr(10) || coalesce(note, chr(32))')} AS w FROM problems",
    "sets": """SELECT id, list_distinct(title_words) AS title_set, w, list_distinct(w) AS word_set,
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS shingle_set FROM words""",
    "postings": "SELECT id, unnest(shingle_set) AS shingle FROM sets",
    "useful": "SELECT shingle FROM postings GROUP BY shingle HAVING count(*) BETWEEN 2 AND 40",
    "few": "SELECT id, shingle FROM postings JOIN useful USING (shingle)",
    "pairs": "SELECT x.id AS a, y.id AS b, count(*) AS shared FROM few x JOIN few y ON x.shingle = y.shingle AND x.id < y.id GROUP BY x.id, y.id HAVING count(*) >= 2",
    "tf": "SELECT id, word, count(*) AS tf FROM (SELECT id, unnest(w) AS word FROM sets) GROUP BY id, word",
    "norms": "SELECT id, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS norm FROM tf GROUP BY id",
    "jac": """SELECT p.a, p.b, len(list_intersect(x.title_set, y.title_set)) AS ct, len(x.title_set) AS t1, len(y.title_set) AS t2,
        len(list_intersect(x.word_set, y.word_set)) AS cw, len(x.word_set) AS w1, len(y.word_set) AS w2, len(list_intersect(x.shingle_set, y.shingle_set)) AS cs, len(x.shingle_set) AS s1, len(y.shingle_set) AS s2
        FROM pairs p JOIN sets x ON x.id = p.a JOIN sets y ON y.id = p.b""",
    "jaccards": "SELECT a, b, " + ", ".join(f"CASE WHEN {x}1 = 0 AND {x}2 = 0 THEN 1.0::DOUBLE WHEN {x}1 = 0 OR {x}2 = 0 THEN 0.0 ELSE c{x}::DOUBLE / ({x}1 + {x}2 - c{x}) END AS {n}" for x, n in (("t", "title"), ("w", "word"), ("s", "shingle"))) + " FROM jac",
    "maybe": "SELECT * FROM jaccards WHERE word >= 0.08 AND 0.45 * shingle + 0.30 + 0.15 * word + 0.10 * title >= 0.61",
    "dots": "SELECT m.a, m.b, sum(x.tf * y.tf) AS dot FROM maybe m JOIN tf x ON x.id = m.a JOIN tf y ON y.id = m.b AND y.word = x.word GROUP BY m.a, m.b",
    "scored": """SELECT m.*, coalesce(dot / (x.norm * y.norm), 0.0) AS cosine, round(0.45::DOUBLE * shingle + 0.30::DOUBLE * coalesce(dot / (x.norm * y.norm), 0.0) + 0.15::DOUBLE * word + 0.10::DOUBLE * title, 6) AS score
        FROM maybe m LEFT JOIN dots d ON d.a = m.a AND d.b = m.b LEFT JOIN norms x ON x.id = m.a LEFT JOIN norms y ON y.id = m.b""",
    "near": """SELECT s.a AS problem_a, s.b AS problem_b, score, round(s.title, 6) AS title_similarity, round(word, 6) AS statement_jaccard, round(shingle, 6) AS shingle_jaccard, round(cosine, 6) AS token_cosine,
        coalesce(x.rating = y.rating, false) AS same_rating, x.title AS title_a, y.title AS title_b
        FROM scored s JOIN canonical x ON x.problem_id = s.a JOIN canonical y ON y.problem_id = s.b WHERE score >= 0.62 AND x.exact_hash <> y.exact_hash""",
    "grouped": "SELECT exact_hash, format('exact_{:04d}', row_number() OVER (ORDER BY exact_hash)) AS gid FROM (SELECT exact_hash FROM canonical GROUP BY exact_hash HAVING count(*) > 1)",
    "rel": f"""SELECT n.problem_a, n.problem_b, score AS similarity_score, {BASE_ID.format(c='n.problem_a')} = {BASE_ID.format(c='n.problem_b')} AS same_base_id,
        CASE WHEN x.exact_hash = y.exact_hash THEN 'exact_duplicate' WHEN {BASE_ID.format(c='n.problem_a')} = {BASE_ID.format(c='n.problem_b')} THEN 'version_family'
             WHEN score >= 0.95 THEN 'reissue_candidate' WHEN score >= 0.90 THEN 'related_candidate' ELSE 'low_confidence_candidate' END AS relationship,
        gx.gid AS canonical_group_a, gy.gid AS canonical_group_b
        FROM near n JOIN canonical x ON x.problem_id = n.problem_a JOIN canonical y ON y.problem_id = n.problem_b LEFT JOIN grouped gx ON gx.exact_hash = x.exact_hash LEFT JOIN grouped gy ON gy.exact_hash = y.exact_hash""",
    "groups": f"""SELECT problem_id, coalesce(gid, 'problem_' || problem_id) AS canonical_group_id, CASE WHEN gid IS NULL THEN 'independent_problem' ELSE 'exact_duplicate_group' END AS group_type,
        {BASE_ID.format(c='problem_id')} AS base_problem_id FROM canonical LEFT JOIN grouped USING (exact_hash)""",
    "evidenced": rf"""SELECT *, list_contains(tags, 'dp') AS dp_tag, list_filter({listed(P.EDITORIAL_PHRASES)}, lambda p: contains(trim({flat('editorial')}), p)) AS editorial_ev,
        list_transform(list_filter(tags, lambda t: list_contains({listed(P.WEAK_TAGS)}, t)), lambda t: 'tag:' || t) AS metadata_ev FROM titled""",
    "weighed": "SELECT *, least(CASE WHEN dp_tag THEN 1.0::DOUBLE ELSE 0.0 END + least(0.45::DOUBLE, 0.15::DOUBLE * len(editorial_ev)) + least(0.15::DOUBLE, 0.03::DOUBLE * len(metadata_ev)), 1.5::DOUBLE) AS heuristic_score FROM evidenced",
    "tiered": "SELECT *, CASE WHEN dp_tag THEN 'seed' WHEN len(editorial_ev) > 0 THEN 'editorial_candidate' WHEN heuristic_score >= 0.15::DOUBLE THEN 'weak_candidate' ELSE 'reject' END AS tier FROM weighed",
    "candidates": "SELECT * FROM tiered WHERE tier <> 'reject'",
    "signalled": "SELECT problem_id, submission_id AS source_id, lang, " + sql_labels([(n, f"regexp_matches({flat('code')}, {q(p)})") for n, p in P.CODE_SIGNALS.items()]) + " AS signals FROM submissions WHERE accepted",
    "rated": f"SELECT *, least({among('signals', P.STRONG)} * 1.0::DOUBLE + {among('signals', P.STRUCTURAL)} * 0.5::DOUBLE + {among('signals', P.WEAK)} * 0.25::DOUBLE, 5.0::DOUBLE) AS score FROM signalled",
    "sigcounts": "SELECT problem_id, signal, count(*) AS n FROM (SELECT problem_id, unnest(signals) AS signal FROM rated) GROUP BY problem_id, signal",
    "classes": f"SELECT problem_id, count(*) AS total, count(*) FILTER ({CLASS} = 'strong') AS strong, count(*) FILTER ({CLASS} = 'moderate') AS moderate, count(*) FILTER ({CLASS} = 'weak') AS weak, max(score) AS best FROM rated GROUP BY problem_id",
    "joined": """SELECT c.id AS problem_id, c.title, c.description, c.rating, c.dp_tag, c.editorial_ev, c.metadata_ev, c.tags, coalesce(total, 0) AS total, coalesce(strong, 0) AS strong, coalesce(moderate, 0) AS moderate,
        coalesce(weak, 0) AS weak, coalesce(best, 0.0) AS best, CASE WHEN coalesce(total, 0) > 0 THEN strong / total ELSE 0.0 END AS consensus, c.dp_tag OR len(c.editorial_ev) > 0 AS hinted
        FROM candidates c LEFT JOIN classes k ON k.problem_id = c.id""",
    "evidence": """SELECT *, round(consensus, 3) AS dp_consensus, CASE WHEN total = 0 THEN CASE WHEN hinted THEN 'metadata_only' ELSE 'uncertain' END
        WHEN strong >= 3 AND consensus >= 0.5 THEN 'very_strong' WHEN strong >= 2 AND consensus >= 0.4 THEN 'strong' WHEN strong >= 1 AND (moderate >= 1 OR hinted) THEN 'moderate'
        WHEN moderate >= 2 THEN 'moderate' WHEN weak >= 2 THEN 'weak' WHEN hinted THEN 'metadata_only' ELSE 'uncertain' END AS evidence_level FROM joined""",
    "sigmaps": "SELECT problem_id, map_from_entries(list((signal, n))) AS m FROM sigcounts GROUP BY problem_id",
}


def n(k: str) -> str:
    return f"coalesce(m[{q(k)}], 0)"


TEXT = "title || ' ' || description || ' ' || array_to_string(tags, ' ') || ' ' || array_to_string(editorial_ev, ' ')"
CODE_FAMILIES = sql_labels([
    ("knapsack", f"{n('knapsack_pattern')} >= 1"), ("sequence", f"{n('lis_pattern')} >= 1"), ("string", f"{n('lcs_pattern')} >= 1"),
    ("interval", f"{n('interval_pattern')} >= 3 AND ({n('dp_2d')} >= 1 OR {n('previous_state')} >= 1)"), ("tree", f"{n('tree_dp_pattern')} >= 1"),
    ("digit", f"{n('digit_dp_pattern')} >= 1"), ("bitmask", f"{n('bitmask_pattern')} >= 2"),
])


def or_else(found: str, name: str) -> str:
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE [{q(name)}] END"


STEPS |= {
    "texts": f"SELECT e.*, m, {TEXT} AS body FROM evidence e LEFT JOIN sigmaps USING (problem_id)",
    "found": "SELECT *, " + ", ".join(f"{sql_labels([(k, has('body', p, 'i')) for k, p in d.items()])} AS {a}" for a, d in (("text_families", P.FAMILIES), ("text_opts", P.OPTIMIZATIONS), ("states", P.STATES))) + f", {CODE_FAMILIES} AS code_families FROM texts",
    "united": f"SELECT *, list_sort(list_distinct(list_concat(text_families, code_families))) AS families, list_sort(list_distinct(list_concat(text_opts, {sql_labels([('bitmask', n('bitmask_pattern') + ' >= 2')])}))) AS optimizations FROM found",
    "fam": """SELECT problem_id, family, list_contains(text_families, family) AS in_text, list_contains(code_families, family) AS in_code, CAST(coalesce(m[family || '_pattern'], 0) AS BIGINT) AS cnt, dp_consensus, evidence_level
        FROM (SELECT *, unnest(families) AS family FROM united)""",
    "fams": """SELECT *, round(least(CASE WHEN in_code THEN 0.45::DOUBLE + CASE WHEN cnt >= 5 THEN 0.20::DOUBLE WHEN cnt >= 3 THEN 0.15::DOUBLE WHEN cnt >= 1 THEN 0.08::DOUBLE ELSE 0.0 END ELSE 0.0 END + CASE WHEN in_text THEN 0.30::DOUBLE ELSE 0.0 END
        + 0.20::DOUBLE * least(dp_consensus, 1.0) + CASE evidence_level WHEN 'very_strong' THEN 0.05::DOUBLE WHEN 'strong' THEN 0.03::DOUBLE ELSE 0.0 END, 0.99::DOUBLE), 3) AS confidence FROM fam""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY problem_id ORDER BY confidence DESC, cnt DESC, family) AS r FROM fams",
    "primaries": "SELECT problem_id, max(CASE WHEN r = 1 AND confidence >= 0.45 THEN family END) AS primary_family, string_agg(CASE WHEN confidence >= 0.45 AND r > 1 THEN family END, ',' ORDER BY r) AS secondary FROM ranked GROUP BY problem_id",
    "taxonomy": "SELECT u.*, p.primary_family, p.secondary, "
    + or_else(sql_labels([("2d", f"{n('dp_2d')} >= 1"), ("grid", "list_contains(families, 'grid')"), ("mask", "list_contains(families, 'bitmask')"), ("digit", "list_contains(families, 'digit')")]), "1d_or_unknown") + " AS dimensions, "
    + or_else(sql_labels([(k, f"{n(s)} > 0") for k, s in (("explicit_transition", "transition"), ("previous_state_dependency", "previous_state"), ("recursive", "recursion"), ("memoized", "memoization"))]), "unknown")
    + " AS transition_style FROM united u LEFT JOIN primaries p USING (problem_id)",
    "passed": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY problem_id, source_id ORDER BY event_id) AS r FROM results WHERE list_contains({listed(K.PASSED)}, status)) WHERE r = 1",
    "verified": f"SELECT p.problem_id, source_id, lang AS language, source_code, status, {case('status', K.QUALITY, q('other'))} AS quality, CASE status WHEN 'PASSED_CHECKER' THEN 'checker' WHEN 'PASSED_EXACT' THEN 'exact' ELSE 'available_tests' END AS method, t.primary_family FROM passed p LEFT JOIN taxonomy t USING (problem_id)",
    "failures": f"SELECT problem_id, source_id, lang AS language, status, {case('status', K.QUALITY, q('other'))} AS failure_type FROM results WHERE list_contains({listed(K.FAILED)}, status)",
    "nths": "SELECT problem_id, source_code, row_number() OVER (PARTITION BY problem_id ORDER BY source_id) AS nth, count(*) OVER (PARTITION BY problem_id) AS solutions FROM verified",
    "prompts": f"SELECT id, 'Title:' || chr(10) || {TRIMMED.format(c='title')} || chr(10) || chr(10) || 'Problem statement:' || chr(10) || {TRIMMED.format(c='description')} || CASE WHEN note IS NOT NULL THEN chr(10) || chr(10) || 'Note:' || chr(10) || note ELSE '' END AS text FROM problems",
    "tests": "SELECT problem_id, count(*) AS n, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses FROM verified GROUP BY problem_id",
    "edges": "SELECT problem_a AS problem_id, problem_b AS other, relationship FROM rel UNION ALL SELECT problem_b, problem_a, relationship FROM rel",
    "edge_sums": "SELECT problem_id, count(*) AS n, string_agg(DISTINCT relationship, ',' ORDER BY relationship) AS flags, string_agg(DISTINCT CASE WHEN relationship = 'version_family' THEN other END, ',' ORDER BY CASE WHEN relationship = 'version_family' THEN other END) AS versions FROM edges GROUP BY problem_id",
    "pool": """SELECT t.problem_id, canonical_group_id, group_type, base_problem_id, exact_hash AS canonical_hash, c.rating, t.primary_family, t.families, t.evidence_level AS dp_evidence_level, t.dp_consensus,
        CAST(coalesce(s.n, 0) AS BIGINT) AS verified_solution_count, coalesce(s.statuses, '') AS verification_statuses, coalesce(s.n, 0) > 0 AS has_verified_solution, coalesce(e.flags, '') AS relationship_flags,
        coalesce(e.versions, '') AS version_family_members, CAST(coalesce(e.n, 0) AS BIGINT) AS relationship_count
        FROM taxonomy t JOIN groups g USING (problem_id) JOIN canonical c USING (problem_id) LEFT JOIN tests s USING (problem_id) LEFT JOIN edge_sums e USING (problem_id)""",
    "gold": "SELECT *, CASE dp_evidence_level WHEN 'very_strong' THEN 'A' WHEN 'strong' THEN 'B' ELSE 'C' END AS quality_tier, CASE WHEN primary_family IS NULL THEN 'training_only_unresolved_family' ELSE 'generation_seed' END AS role FROM pool WHERE dp_evidence_level IN ('very_strong', 'strong', 'moderate') AND has_verified_solution",
    "counted": "SELECT problem_id, source_id, " + ", ".join(f"CAST({' + '.join(f'len(regexp_extract_all(source_code, {q(p)}))' for p in ps)} AS BIGINT) AS {k}" for k, ps in P.CODE_COUNTS.items()) + " FROM verified WHERE source_code <> ''",
    "built": "SELECT *, " + sql_labels([("2d_table", "two_dimensional_dp > 0"), ("memoization", "memoization > 0"), ("top_down", "recursive_dp > 0 AND memoization > 0"), ("bottom_up_candidate", "array_dp > 0 AND recursive_dp = 0"), ("bitmask", "bitmask > 0")]) + " AS impl FROM counted",
    "code_sums": "SELECT problem_id, count(*) AS with_code, " + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}, avg(CASE WHEN {k} > 0 THEN 1.0 ELSE 0.0 END) AS share_{k}" for k in P.CODE_COUNTS) + " FROM built GROUP BY problem_id",
    "impls": "SELECT problem_id, pattern, count(*) AS n FROM (SELECT problem_id, unnest(impl) AS pattern FROM built) GROUP BY problem_id, pattern",
    "half": "SELECT problem_id, string_agg(pattern, ',' ORDER BY n DESC, pattern) AS implementation_patterns FROM impls JOIN code_sums USING (problem_id) WHERE n / with_code >= 0.5 GROUP BY problem_id",
    "usable": rf"SELECT r.*, {STATEMENT} AS statement FROM results r JOIN pool p USING (problem_id) JOIN problems b ON b.id = r.problem_id WHERE r.verdict = 'OK' AND list_contains({listed(K.PASSED)}, r.status) AND r.source_code <> ''",
    "split_keys": "SELECT problem_id, row_number() OVER (ORDER BY sha256('42|' || problem_id), problem_id) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT problem_id FROM usable)",
    "splits": "SELECT problem_id, CASE WHEN r <= floor(n * 0.8) THEN 'train' WHEN r <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM split_keys",
}


def sql(select: str) -> str:
    """The select behind the steps that it needs, directly or not."""
    need: list[str] = []

    def add(text: str) -> None:
        for word in re.findall(r"(?:FROM|JOIN) (\w+)", text):
            if word in STEPS and word not in need:
                add(STEPS[word])
                need.append(word)

    add(select)
    return "WITH " + ",\n".join(f"{k} AS ({STEPS[k]})" for k in need) + f"\n{select}" if need else select
