"""Text rules, patterns and scores against plain Python and values worked out by hand."""

import re
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tessera.functions import concept_json, patterns as P, scoring as K, text as X, word_sets as W


def values(spark, columns, rows, schema):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def py_canonical(text):
    text = unicodedata.normalize("NFKC", text or "").replace("\r\n", "\n").replace("\r", "\n")
    lines = [re.sub(r"[ \t]+", " ", line).strip() for line in text.split("\n")]
    kept = [x for k, x in enumerate(lines) if x or not k or lines[k - 1]]
    return "\n".join(kept).strip()


TRICKY = st.text(st.sampled_from("aB1_ \t\n\r 　ﬁＡé\x0b\x0c\x1c\u0085 Ⅷ"), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TRICKY, min_size=30, max_size=60))
def test_normal_forms_as_python(spark, texts):
    got = values(spark, [F.col("t"), X.canonical(F.col("t")), X.plain_words(F.col("t")), X.one_line(F.col("t")), X.output_tokens(F.col("t"))], [(t,) for t in texts], "t string")
    for t, canonical, plain, line, tokens in got:
        assert canonical == py_canonical(t)
        assert plain == re.sub(r"[^a-z0-9_]+", " ", unicodedata.normalize("NFKC", t).lower()).strip()
        assert line == re.sub(r"\s+", " ", t.lower()).strip() and tokens == t.split()
        assert py_canonical(canonical) == canonical


def test_ends_are_stripped_as_by_python(spark):
    texts = ["", " ", "a", " a", "a\u3000", "\x1ca b\x1f", "a" + " " * 9 + "b", "\n\U0001f600 ", "\u200ba", None]
    assert values(spark, [X.strip(F.col("t"))], [(t,) for t in texts], "t string") == [(t if t is None else t.strip(),) for t in texts]


def test_tokens_and_shingles(spark):
    p = X.plain_words(F.col("t"), compose=False)
    rows = [("The DP of a Tree, in_place! x y2",), ("",), (None,), ("aa bb cc dd ee",), ("aa bb cc dd ee ff aa bb cc dd ee",)]
    got = values(spark, [X.tokens(p), X.shingles(X.tokens(p)), F.size(X.shingle_hashes(X.tokens(p)))], rows, "t string")
    assert got[0][0] == ["dp", "tree", "in_place", "y2"] and got[0][1] == ["dp tree in_place y2"]
    assert got[1] == ([], [], 0) and got[2] == ([], [], 0) and got[3][1] == ["aa bb cc dd ee"]
    assert len(got[4][1]) == 6 == got[4][2]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(TRICKY, st.lists(st.sampled_from("the DP tree_2 x aa bb ﬀi \u212an \u0130n é".split()), max_size=12).map(" ".join), st.just("q" * 63 + "Z é " + "q" * 70), st.none()), min_size=20, max_size=40))
def test_word_sets_are_those_of_tokens(spark, texts):
    """Equal hashes for equal words and runs alone, over all texts, whatever piece they are in."""
    df = spark.createDataFrame([(str(i), t, t) for i, t in enumerate(texts)], "problem_id string, body string, title string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(W, "PIECE", 100)
        batch = pa.Table.from_pandas(df.toPandas()).combine_chunks().to_batches()[0]
        got = [r for b in W.word_sets()(iter([batch])) for r in b.to_pylist()]
    plain = df.select(F.col("problem_id").cast("int").alias("i"), X.plain_words(F.col("body")).alias("p"))
    rows = X.barrier(plain, "p").select("i", X.tokens(F.col("p")).alias("w"), X.shingles(X.tokens(F.col("p"))).alias("s")).orderBy("i").collect()
    assert [r["problem_id"] for r in got] == [str(i) for i in range(len(texts))]
    known = {}
    for g, r in zip(got, rows):
        assert len(g["words"]) == len(r.w) and set(g["title_set"]) == set(g["word_set"]) == set(g["words"]) and len(g["word_set"]) == len(set(r.w)) and len(g["shingle_set"]) == len(r.s)
        assert all(known.setdefault(w, h) == h for w, h in zip(r.w, g["words"]))
    assert len({*known.values()}) == len(known)
    for g, r in zip(got, rows):
        for h, o in zip(got, rows):
            assert len({*g["shingle_set"]} & {*h["shingle_set"]}) == len({*r.s} & {*o.s})


def test_barrier_computes_once(spark):
    df = spark.createDataFrame([("a b",)], "t string").select(F.regexp_replace("t", "b", "c").alias("t"))
    df = X.barrier(df, "t").select(F.concat("t", "t", "t"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_code_signals_have_their_quirks(spark):
    cases = {"1<<n": True, "1 << n": False, "1LL<<n": False, "mask": True, "int f(int x) {": None}
    got = dict(values(spark, [F.col("c"), P.code_signals(X.flat_code(F.col("c")))], [(c,) for c in cases], "c string"))
    for code, bit in cases.items():
        assert bit is None or ("bitmask_pattern" in got[code]) == bit
    assert "dp_array_name" in got["int f(int x) {"]
    got = values(spark, [P.code_signals(X.flat_code(F.col("c"))), K.signal_score(P.code_signals(X.flat_code(F.col("c"))))], [("dp[i][j] = dp[i-1][j];\ndp[0] = 1;",), ("",), (None,)], "c string")
    assert got[0] == (["dp_array_name", "dp_2d", "transition", "previous_state"], 4.0) and got[1] == ([], 0.0)


def test_patterns_as_python(spark):
    texts = ["étight tight", "weight\r capacity", "grid of dp", "Longest  increasing subsequence", "dp [ l ] [ r ]", "SOS dp", "1 << k", "rows and columns then dp", "knapsacks", "d&c optimization", "NIM"]
    for table in (P.FAMILIES, P.OPTIMIZATIONS, P.STATES):
        got = dict(values(spark, [F.col("t"), P.categories(F.col("t"), table)], [(t,) for t in texts], "t string"))
        assert got == {t: [k for k, ps in table.items() if any(re.search(p, t, re.I) for p in ps)] for t in texts}
    code = "int dp[5]; dp[i] = max(dp[i-1], 2); memo memo 1LL << 3 __builtin_popcount(x)\nl to r"
    got = values(spark, [F.struct(*P.code_counts(F.col("c")).values())], [(code,)], "c string")[0][0]
    assert list(got) == [sum(len(re.findall(p, code)) for p in ps) for ps in P.CODE_COUNTS.values()]


def test_patterns_are_tried_where_their_literals_are(spark):
    """What is needed is in whatever a pattern matches, so a search for it loses nothing; without it a category costs no regular expression."""
    assert P.needed(r"\bweight\b.{0,80}\bcapacity\b") == [["capacity"], ["weight"]] and P.needed(r"\breroot(?:ing)?\b") == [["reroot"]] and P.needed(r"\w+|x") == []
    assert P.needed(r"\b(?:memo|cache)\s*(?:\[|\()") == [["cache", "memo"]] or P.needed(r"\b(?:memo|cache)\s*(?:\[|\()") == [["memo", "cache"]]
    tables = [*P.FAMILIES.values(), *P.OPTIMIZATIONS.values(), *P.STATES.values(), *P.CODE_COUNTS.values()]
    assert all(P.needed(p) for ps in [*tables, list(P.CODE_SIGNALS.values())] for p in ps)
    assert [P.longest_word(p) for p in (r"\bsubset sum\b", r"\bSOS DP\b", r"\b0[/ -]?1 knapsack\b", r"\breroot(?:ing)?\b", r"(?:a|b)c ef", r"(?:ab|cd)")] == ["subset", "sos", "knapsack", "reroot", "ef", None]
    # every character that a pattern in any case takes for a letter of ASCII is one in the folded text
    df = spark.range(0x80, 0x110000).where("id < 55296 OR id > 57343").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    got = {r.c: r.f for r in df.where(F.col("c").rlike(P.FLAGS_ANY_CASE + "[a-z]") | F.col("c").rlike(P.FLAGS_ANY_CASE + "s|k|i")).select("c", P.folded(F.col("c")).alias("f")).collect()}
    assert got == {"\u017f": "s", "\u0131": "i", "\u0130": "i", "\u212a": "k"}
    texts = ["\u212aNAPSACK", "INDE\u0130X", "\u0130NDEX", "po\u017fition", "nımx nım", "DAG", "Sos dp", "english lists", "édp tree dp", "tree-dp\tTREE DP", "state transitions, state transition", "dp[l][r]", "[dp [ l ][r ]]", "1<<x", "a1<<x", "grid and\ndp, grid dp", "0/1 KNAPSACK", None, ""]
    for table in (P.FAMILIES, P.STATES):
        plain = [(n, F.col("t").rlike(P.FLAGS_ANY_CASE + "|".join(f"(?:{p})" for p in ps))) for n, ps in table.items()]
        got = values(spark, [P.categories(F.col("t"), table), P.labels(plain)], [(t,) for t in texts], "t string")
        assert all(a == b for a, b in got) and sum(len(a) for a, _ in got) >= 2
    codes = ["int dp[5]; dp[i] = max(dp[i-1], 2);", "l to r", "l\nr", "1LL << 3", "", None]
    plain = {n: sum(F.regexp_count(F.col("t"), F.lit(P.FLAGS + p)) for p in ps) for n, ps in P.CODE_COUNTS.items()}
    got = values(spark, [F.struct(*P.code_counts(F.col("t")).values()), F.struct(*plain.values())], [(t,) for t in codes], "t string")
    assert all(tuple(a) == tuple(b) for a, b in got)


def test_candidates_scores_and_tiers(spark):
    rows = [(True, ["a"] * 5, ["t"] * 9), (False, ["a"], []), (False, [], ["t"] * 5), (False, [], ["t"] * 4), (False, None, None)]
    score = K.candidate_score(F.col("d"), F.col("e"), F.col("m"))
    got = values(spark, [F.round(score, 6), K.candidate_tier(F.col("d"), F.col("e"), score)], rows, "d boolean, e array<string>, m array<string>")
    assert got == [(1.5, "seed"), (0.15, "editorial_candidate"), (0.15, "weak_candidate"), (0.12, "reject"), (0.0, "reject")]
    got = values(spark, [P.editorial_evidence(F.col("e"))], [("A Dynamic\nProgramming approach",), ("dp recurrence",), (None,)], "e string")
    assert got == [(["dynamic programming", "dynamic programming approach"],), (["dp recurrence", "recurrence"],), ([],)]


@pytest.mark.parametrize(
    ("total", "strong", "moderate", "weak", "hinted", "level"),
    [(0, 0, 0, 0, True, "metadata_only"), (0, 0, 0, 0, False, "uncertain"), (6, 3, 0, 0, False, "very_strong"), (5, 2, 0, 0, False, "strong"), (7, 3, 0, 0, False, "strong"), (6, 2, 0, 0, True, "moderate"), (3, 1, 0, 0, True, "moderate"), (3, 1, 0, 0, False, "uncertain"), (3, 0, 2, 0, False, "moderate"), (3, 0, 1, 2, False, "weak"), (1, 0, 0, 1, True, "metadata_only"), (1, 0, 0, 0, False, "uncertain")],
)
def test_evidence_levels(spark, total, strong, moderate, weak, hinted, level):
    share = F.when(F.col("t") > 0, F.col("s") / F.col("t")).otherwise(0.0)
    got = values(spark, [K.evidence_level(F.col("t"), F.col("s"), F.col("m"), F.col("w"), share, F.col("h"))], [(total, strong, moderate, weak, hinted)], "t int, s int, m int, w int, h boolean")
    assert got == [(level,)]


def test_confidence_jaccard_and_relationship(spark):
    rows = [(False, True, 5, 1.0, "very_strong"), (True, False, 0, 0.75, "weak"), (True, True, 3, 2.0, "strong"), (True, True, 9, 1.0, "very_strong")]
    got = values(spark, [K.family_confidence(F.col("t"), F.col("c"), F.col("n"), F.col("s"), F.col("l"))], rows, "t boolean, c boolean, n int, s double, l string")
    assert [x[0] for x in got] == [0.9, 0.45, 0.99, 0.99]
    got = values(spark, [K.jaccard(F.col("c"), F.col("a"), F.col("b"))], [(0, 0, 0), (0, 0, 2), (1, 2, 2)], "c int, a int, b int")
    assert [round(x[0], 6) for x in got] == [1.0, 0.0, 0.333333]
    got = values(spark, [K.relationship(F.col("h"), F.col("b"), F.col("s"))], [(True, True, 1.0), (False, True, 0.7), (False, False, 0.95), (False, False, 0.9), (False, False, 0.8)], "h boolean, b boolean, s double")
    assert [x[0] for x in got] == ["exact_duplicate", "version_family", "reissue_candidate", "related_candidate", "low_confidence_candidate"]
    got = values(spark, [K.same_known(F.col("a"), F.col("b"))], [(1, 1), (None, None), (1, None), (1, 2)], "a int, b int")
    assert [x[0] for x in got] == [True, False, False, False]


def test_concepts_from_answers(spark):
    one = concept_json.concept_of
    assert one('{"dp_used": true, "state": {"dimensions": true, "variables": "i"}, "base_cases": [1]}')["state"] == {"variables": [], "meaning": "", "dimensions": 1, "representation": "other"}
    assert one('so: {"dp_used": 0, "family": "tree"} end') | {"state": 0, "transition": 0} == concept_json.shaped({}, concept_json.DEFAULTS) | {"family": None, "state": 0, "transition": 0}
    assert one('```json\n{"family": 3, "dp_used": 1}\n```')["family"] == "3"
    for bad in ("", "[1]", "{", "no"):
        with pytest.raises(ValueError, match="JSON"):
            one(bad)
    got = values(spark, [concept_json.concept(F.col("a"))], [('{"dp_used": true}',), ("x",), (None,)], "a string")
    assert got[0][0].dp_used and got[0][0].family == "unknown" and got[1][0] is None and got[2][0] is None
    assert values(spark, [X.unfenced(F.col("a"))], [("```json\n{}\n```",), (" {} ",)], "a string") == [("{}",), ("{}",)]
