"""Operators on small rows whose results are worked out by hand, and the flow over files."""

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tessera.operators import assemble, canonical, collect, judge, select, semantic, signals, taxonomy
from tessera.plans.flow import Flow, in_order
from tessera.sources import schemas, tables
from tessera.streaming import stateless

PROBLEM = "id string, title string, description string, input_format string, output_format string, interaction_format string, note string, rating int, tags array<string>, editorial string, executable boolean, official_tests_complete boolean, contest_id string, `index` string, source string, source_split string"
STATEMENT = "You are given n items, each of some weight and value. Choose items of total weight at most the capacity so that the total value is as large as possible, and report that value modulo 998244353."


def problem(pid, title="T", text="", rating=None, tags=(), editorial=None):
    return (pid, title, text, "", "", None, None, rating, list(tags), editorial, True, True, pid.split("/")[0], pid.split("/")[-1], "s", "train")


@pytest.fixture(scope="module")
def near(spark):
    texts = {"1/A1": STATEMENT, "1/A2": STATEMENT.replace("large", "small"), "2/B": STATEMENT, "2/C": STATEMENT.replace("  ", " ") + " ", "3/D": "Something else entirely about graphs and paths with many edges"}
    df = spark.createDataFrame([problem(p, "Knapsack", t, 1000 if p < "2" else None) for p, t in texts.items()], PROBLEM)
    return df, canonical.canonical_records(df)


def test_canonical_forms_meet(spark):
    texts = ["a b\r\n\r\n\r\nc ", "a  b\n\nc", "ａ b\n \n\nc", "a b\nc"]
    df = canonical.canonical_records(spark.createDataFrame([problem(f"1/{k}", "T", t) for k, t in enumerate(texts)], PROBLEM))
    assert [(r.problem_ids, r["count"]) for r in canonical.exact_groups(df).collect()] == [(["1/0", "1/1", "1/2"], 3)]
    assert canonical.exact_summary(df).first().asDict() == {"records": 4, "unique_hashes": 2, "duplicate_groups": 1, "duplicates": 2}
    assert df.first().canonical.fields == ["title", "description", "input_format", "output_format", "interaction_format", "note"]


def test_near_duplicates_and_relationships(spark, near):
    df, canon = near
    pairs = in_order("near", canonical.near_duplicates(df, canon)).collect()
    assert [(p.problem_a, p.problem_b) for p in pairs] == [("1/A1", "1/A2"), ("1/A2", "2/B"), ("1/A2", "2/C")]
    s = pairs[0].similarity
    assert s.same_rating and not pairs[1].similarity.same_rating and s.title_similarity == 1 and not s.same_dp_family
    assert math.isclose(s.score, round(0.45 * s.shingle_jaccard + 0.3 * s.token_cosine + 0.15 * s.statement_jaccard + 0.1, 6), abs_tol=2e-6)
    rel = canonical.relationships(canonical.near_duplicates(df, canon), canon).collect()
    kinds = {(r.problem_a, r.problem_b): r for r in rel}
    assert kinds["1/A1", "1/A2"].relationship == "version_family" and kinds["1/A1", "1/A2"].same_base_id
    assert kinds["1/A2", "2/B"].canonical_group_b == "exact_0001" and kinds["1/A2", "2/B"].canonical_group_a is None
    groups = {r.problem_id: (r.canonical_group_id, r.group_type) for r in canonical.problem_groups(canon).collect()}
    assert groups["2/C"] == ("exact_0001", "exact_duplicate_group") and groups["3/D"] == ("problem_3/D", "independent_problem")


def test_words_in_order_are_not_staged(near, monkeypatch):
    """All words of all problems would take more room than their texts, and only those of likely pairs are counted."""
    seen = []
    monkeypatch.setattr(canonical, "staged", lambda df: seen.append(df.columns) or tables.staged(df))
    assert canonical.near_duplicates(*near).count() == 3
    assert ["problem_id", "title_set", "shingle_set", "word_set"] in seen and not any("words" in columns for columns in seen)


def test_postings_cut(spark):
    shared = "alpha beta gamma delta epsilon zeta"
    rows = [problem(f"{k:03}/A", "", f"{shared} unique{k}") for k in range(41)]
    ready = canonical.postings(canonical.prepared(spark.createDataFrame(rows, PROBLEM)))
    assert canonical.candidate_pairs(ready, 40, 1).count() == 0
    assert canonical.candidate_pairs(ready, 41, 2).count() == 41 * 40 // 2
    assert canonical.candidate_pairs(ready, 41, 3).count() == 0


def greedy(rows, k):
    rows = sorted(rows)
    first, seen = [], set()
    for key, kind in rows:
        if kind not in seen:
            seen.add(kind)
            first.append((key, kind))
    return (first + [r for r in rows if r not in first])[:k]


@pytest.mark.parametrize("k", [3, 5])
def test_diverse_top_k_is_the_greedy_choice(spark, k):
    r = random.Random(k)
    rows = [(g, i, r.choice("abcd")) for g in range(40) for i in r.sample(range(100), r.randint(1, 9))]
    got = select.diverse_top_k(spark.createDataFrame(rows, "g int, i int, l string"), "g", F.col("l"), [F.col("i")], k).collect()
    for g in range(40):
        assert sorted((x.i, x.l) for x in got if x.g == g) == sorted(greedy([(i, x) for h, i, x in rows if h == g], k))


def test_selection_orders_ids_as_text(spark):
    rows = [("p", "9", "Rust", "xx"), ("p", "10", "Rust", "xx"), ("p", "8", "Go", "x"), ("p", "7", "GNU C++17", "long source")]
    got = select.selected_solutions(spark.createDataFrame(rows, "problem_id string, submission_id string, programmingLanguage string, source string"), 3)
    assert {r.submission_id for r in got.collect()} == {"7", "8", "10"}
    rows = [("p", "1", "PyPy 3"), ("p", "2", "Rust"), ("p", "3", "Python 3"), ("p", "4", "C++20"), ("p", "5", "C++20")]
    df = spark.createDataFrame(rows, "problem_id string, source_id string, language string")
    assert {r.source_id for r in select.solutions_to_verify(df).collect()} == {"4", "3"}
    assert {r.source_id for r in select.solutions_to_verify(df, 4, pypy=True).collect()} == {"4", "1", "3", "5"}


def test_taxonomy_ranks_and_names(spark):
    cands = signals.candidates(spark.createDataFrame([problem("1/A", "Tree DP and knapsack", "", 5, ["dp"]), problem("1/B", "Plain", "grid", 5, ["dp"]), problem("1/C", "Plain", "", 5, ["math"])], PROBLEM))
    assert {r.id for r in cands.collect()} == {"1/A", "1/B"}
    code = "weight capacity dp[i][j] = dp[i-1][j]; subtree"
    sols = spark.createDataFrame([("1/A", str(k), "C++", code, True) for k in range(3)] + [("1/A", "9", "C++", "", False)], "problem_id string, source_id string, language string, source_code string, is_accepted boolean")
    ev = signals.evidence(cands, signals.problem_signals(signals.solution_signals(sols)))
    tax = {r.problem_id: r for r in taxonomy.taxonomy(cands, ev).collect()}
    a, b = tax["1/A"], tax["1/B"]
    assert a.dp_evidence_level == "very_strong" and a.dp_consensus == 1.0 and a.accepted_solution_count == 3
    assert a.families == ["knapsack", "tree"] and a.primary_family == "knapsack" and a.secondary_families == ["tree"]
    assert a.family_evidence["knapsack"].asDict() == {"text": True, "accepted_code": True, "code_signal_count": 3, "confidence": 0.99}
    assert a.family_evidence["tree"].code_signal_count == 0 and "2d" in a.dimensions and a.transition_style == ["previous_state_dependency"]
    assert b.families == ["grid"] and b.primary_family is None and b.dimensions == ["grid"] and b.transition_style == ["unknown"] and b.dp_evidence_level == "metadata_only"


def test_texts_of_one_row_group_are_dealt_to_tasks(spark, tmp_path):
    """A file of one row group is read by one task, however many pieces Spark cuts it into: the work on texts isn't left to it."""
    rows = [problem(f"{k}/A", "Tree DP", f"text {k} " + "x" * 5000, 5, ["dp"]) for k in range(400)]
    spark.createDataFrame(rows, PROBLEM).coalesce(1).write.parquet(f"{tmp_path}/p")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        df = spark.read.parquet(f"{tmp_path}/p")
        assert df.rdd.getNumPartitions() >= 4
        tasks = lambda x: x.select(F.spark_partition_id().alias("p")).groupBy("p").count()
        assert tasks(df).count() == 1
        cands = signals.candidates(df)
        none = spark.createDataFrame([], "problem_id string, accepted_solution_count long, best_solution_score double, signal_counts map<string, bigint>, solutions array<struct<source_id: string, language: string, signals: array<string>, score: double>>")
        for made in (canonical.canonical_records(df), canonical.prepared(df), taxonomy.taxonomy(cands, signals.evidence(cands, none))):
            assert tasks(made).count() >= 4 and made.count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_pool_raises_where_a_group_is_missing(spark, near):
    df, canon = near
    cands = signals.candidates(df.withColumn("tags", F.array(F.lit("dp"))))
    none = spark.createDataFrame([], "problem_id string, accepted_solution_count long, best_solution_score double, signal_counts map<string, bigint>, solutions array<struct<source_id: string, language: string, signals: array<string>, score: double>>")
    tax = taxonomy.taxonomy(cands, signals.evidence(cands, none))
    results = spark.createDataFrame([("1/A1", "1", "C++", "OK", "s", "int dp[3];", "PASSED_EXACT", None, "", ""), ("1/A1", "1", "C++", "OK", "s", "again", "PASSED_CHECKER", None, "", ""), ("2/B", "1", "C++", "OK", "s", "x", "TLE", None, "", ""), ("2/B", "1", "C++", "OK", "s", "x", "TLE", None, "", ""), ("2/B", "3", "C++", "OK", "s", "x", "UNVERIFIED", None, "", "")], "problem_id string, source_id string, language string, verdict string, source string, source_code string, status string, execution_time_ms double, stdout string, stderr string")
    good, bad = assemble.verified(results, tax), assemble.failures(results)
    assert good.count() == 1 and bad.count() == 2
    groups, rel = canonical.problem_groups(canon), canonical.relationships(canonical.near_duplicates(df, canon), canon)
    pool = {r.problem_id: r for r in assemble.problem_pool(tax, groups, canon, good, rel).collect()}
    assert len(pool) == 5 and pool["1/A1"].has_verified_solution and pool["1/A1"].version_family_members == ["1/A2"] and pool["1/A2"].relationship_count == 3
    for lost in (groups, canon):
        args = [tax, groups, canon, good, rel]
        args[args.index(lost)] = lost.where("problem_id <> '2/B'")
        with pytest.raises(Exception, match="2/B"):
            assemble.problem_pool(*args).collect()


def test_split_is_by_problem_and_floors(spark):
    ids = spark.createDataFrame([(f"p{k}",) for k in range(7)] * 2, "problem_id string")
    for mode in ("hash", "exact"):
        rows = assemble.split_ids(ids, "problem_id", mode=mode).collect()
        assert Counter(r.split for r in rows) == {"train": 5, "test": 2} and len(rows) == 7
    keys = [f"p{k}" for k in range(7)]
    random.Random(42).shuffle(keys)
    assert {r.problem_id for r in rows if r.split == "train"} == set(keys[:5])


def test_gold_order_and_roles(spark):
    rows = [("a", "very_strong", "tree", 900, True), ("b", "strong", "tree", None, True), ("c", "moderate", None, 5, True), ("d", "weak", "tree", 5, True), ("e", "strong", "tree", 5, False), ("f", "moderate", "tree", 2000, True)]
    df = spark.createDataFrame(rows, "problem_id string, dp_evidence_level string, primary_family string, rating int, has_verified_solution boolean")
    for c in ("canonical_group_id", "canonical_hash", "title", "families", "dimensions", "transition_style", "optimizations", "state_signals", "dp_consensus", "verified_solution_count", "verification_statuses", "relationship_flags", "version_family_members", "source", "source_split"):
        df = df.withColumn(c, F.lit(""))
    got = in_order("gold", assemble.gold_seeds(df)).collect()
    assert [(r.problem_id, r.quality_tier) for r in got] == [("f", "C"), ("a", "A"), ("b", "B"), ("c", "C")]
    assert got[-1].role == "training_only_unresolved_family"


def test_judge_outcomes(spark):
    tests = [{"input": "2", "output": "4"}, {"input": "3", "output": "6"}]
    p = {"official_tests": tests, "time_limit": 0.5, "generated_checker": None, "output_format": "", "official_tests_complete": False}
    run = lambda code, language="Python 3", **kw: judge.judge({"language": language, "source_code": code}, p | kw)
    assert run("print(int(input()) * 2)")["status"] == "PASSED_AVAILABLE_TESTS"
    assert run("print(int(input()) * 2)", official_tests_complete=True)["status"] == "PASSED_EXACT"
    wrong = run("print(4)")
    assert wrong["status"] == "WRONG_ANSWER" and wrong["tests_passed"] == 1 and wrong["tests_total"] == 2
    assert run("1/0")["status"] == "RE" and run("while True: pass")["status"] == "TLE"
    assert run("x", "Rust")["status"] == "UNSUPPORTED_LANGUAGE" and run("x", official_tests=[])["status"] == "UNVERIFIED"
    yes, no = "import sys; print(1)", "print(0)"
    assert run("print(9)", generated_checker=yes)["status"] == "PASSED_CHECKER" and run("print(9)", generated_checker=no)["status"] == "WRONG_ANSWER"
    assert run("print(9)", generated_checker="print('?')")["status"] == "CHECKER_ERROR"
    endless = judge.run([__import__("sys").executable, "-c", "while True: print('x' * 1000)"], __import__("pathlib").Path("/tmp"), "", 20, None, most=1 << 20)
    assert endless.code == 1 and len(endless.out) < 3 << 20 and "Output limit" in endless.err
    wide = judge.run([__import__("sys").executable, "-c", "import sys; print(len(sys.stdin.read()))"], __import__("pathlib").Path("/tmp"), "é" * 300_000, 20, None)
    assert wide.code == 0 and wide.out.strip() == "300000"
    assert judge.run(["sleep", "9"], __import__("pathlib").Path("/tmp"), "", 0.3, None).code is None
    assert judge.same_tokens("YES", "yes", True) and not judge.same_tokens("YES", "yes", False)


def test_semantic_stage_with_a_stub(spark):
    pool = spark.createDataFrame([("1/A", "T", 5, "tree", ["tree"], "strong", 0.5, True), ("1/B", "T", 5, None, [], "weak", 0.0, False), ("1/C", "T", 5, None, [], "weak", 0.0, True)], "problem_id string, title string, rating int, primary_family string, families array<string>, dp_evidence_level string, dp_consensus double, has_verified_solution boolean")
    verified = spark.createDataFrame([("1/A", "1", "x"), ("1/A", "2", "y"), ("1/A", "3", "z"), ("1/C", "1", "x")], "problem_id string, source_id string, source_code string")
    probs = spark.createDataFrame([problem("1/A", "Title", "Text"), problem("1/C", "Broken", "Text")], PROBLEM)

    def ask(prompt):
        if "Broken" in prompt:
            raise ValueError("empty answer")
        return 'Yes: {"dp_used": true, "family": "tree"}'

    rows = semantic.asked(pool, verified, probs)
    got = {r.problem_id: r for r in semantic.agreed(semantic.extract(rows, ask), rows).collect()}
    assert got["1/A"].status == "high_confidence" and len(got["1/A"].extractions) == 2 and got["1/A"].verified_solution_count == 3 and got["1/A"].agreement.score == 1.0
    assert got["1/C"].status == "error" and got["1/C"].errors == ["solution_1: empty answer"]
    assert semantic.asked(pool, verified, probs, start=1, limit=1).first().problem_id == "1/C"
    assert {(r.what, r.value, r["count"]) for r in semantic.summary(semantic.agreed(semantic.extract(rows, ask), rows)).collect()} >= {("status", "error", 1), ("agreement_level", "high", 1), ("family", "tree", 1)}


def raw_rows():
    tests = [{"input": "2", "output": "4"}]
    base = {"input_format": "n", "output_format": "m", "tags": ["dp"], "executable": True, "input_mode": "stdio", "official_tests": tests, "time_limit": 1.0, "odd": [1]}
    return [base | {"id": f"{k}/A", "contest_id": str(k), "index": "A", "title": f"Knapsack {k}", "description": f"{STATEMENT} number {k} {'x' * k}", "rating": 1000 + k} for k in range(1, 9)]


def test_flow_from_files_to_examples(spark, tmp_path):
    lines = lambda rows: "\n\n".join(json.dumps(r) for r in rows)  # noqa: E731  blank lines are skipped
    code = "dp = [0] * 3\ndp[0] = 1\nprint(int(input()) * 2)"
    subs = [{"problem_id": f"{k}/A", "submission_id": s, "programmingLanguage": "Python 3", "source": code + "#" * s, "verdict": "OK"} for k in range(1, 10) for s in (1, 2)]
    (tmp_path / "raw.jsonl").write_text(lines(raw_rows()))
    (tmp_path / "subs.jsonl").write_text(lines(subs))
    flow = Flow(spark, str(tmp_path / "out"), settings={"problems": str(tmp_path / "raw.jsonl"), "accepted": str(tmp_path / "subs.jsonl"), "judge": True, "raw_schema": schemas.RAW_PROBLEM + ", odd array<int>"})
    flow.run()
    total = flow.report()
    assert json.loads("".join(p.read_text() for p in (tmp_path / "out/summaries/pool.json").glob("part-*")))["rows"] == json.loads(json.dumps(total["pool"], default=str))
    assert total["semantic"] == [] and {r["what"] for r in total["concept_counts"]} == {"primary_family"}
    assert total["audit"][0]["total"] == 8 and {r["split"]: r["problems"] for r in total["examples"]} == {"train": 6, "test": 2}
    assert json.loads(flow.table("problems").first().extra)["odd"] == [1]
    assert flow.table("solutions").count() == 16 and flow.table("results").where("status = 'PASSED_AVAILABLE_TESTS'").count() == 16
    assert flow.table("pool").where("has_verified_solution AND relationship_count > 0").count() == 8
    train = [json.loads(x) for p in (tmp_path / "out/train.jsonl").glob("*.json") for x in p.read_text().splitlines()]
    assert len(train) == 12 and train[0]["messages"][1]["content"].startswith("dp = ") and "family" in train[0]["metadata"]


def test_examples_are_shuffled(spark):
    made = spark.createDataFrame([(s, [("user", "q"), ("assistant", f"code {k}")], (f"p{k % 5}", None, 1, "C", str(k))) for k in range(30) for s in ["train" if k % 5 else "val"]], f"split string, {schemas.EXAMPLE}")
    for mode in ("hash", "exact"):
        rows = assemble.shuffled(made, 42, mode).collect()
        got = [r.metadata.source_id for r in sorted(rows, key=lambda r: (r.split, r.place))]
        assert len(rows) == 30 and got != sorted(got, key=int) and got[-6:] != sorted(got[-6:], key=int)
    rng, ids = random.Random(42), list(range(5))
    rng.shuffle(ids)
    train = sorted((f"p{k % 5}", str(k)) for k in range(30) if k % 5)
    rng.shuffle(train)
    assert [r.metadata.source_id for r in sorted(rows, key=lambda r: r.place) if r.split == "train"] == [s for _, s in train]
    keys = spark.createDataFrame([(f"p{k}", k) for k in range(20)], "id string, n int")
    want = [f"p{k}" for k in range(20)]
    random.Random(7).shuffle(want)
    assert {r.id for r in select.shuffled_first(keys, "id", 6, 7, "exact", "n").collect()} == set(want[:6])


def test_semantic_runs_are_taken_up(spark, tmp_path):
    """A run that breaks off has its rows; the next asks about the others only."""
    flow = Flow(spark, str(tmp_path), settings={"chunk": 1})
    put = lambda name, df: tables.write_table(df, flow.path(name))
    pool = [(f"{k}/A", "T", 5, "tree", ["tree"], "strong", 0.5, True) for k in range(4)]
    put("pool", spark.createDataFrame(pool, "problem_id string, title string, rating int, primary_family string, families array<string>, dp_evidence_level string, dp_consensus double, has_verified_solution boolean"))
    put("verified", spark.createDataFrame([(f"{k}/A", "1", "x") for k in range(4)], "problem_id string, source_id string, source_code string"))
    put("problems", spark.createDataFrame([problem(f"{k}/A", f"Title {k}", "Text") for k in range(4)], PROBLEM))

    def breaks(prompt):
        if "Title 2" in prompt:
            raise RuntimeError("the server is gone")
        return '{"dp_used": true}'

    flow.settings["ask"] = breaks
    with pytest.raises(Exception, match="server is gone"):
        flow.semantic()
    had = {r.problem_id for r in flow.table("semantic").collect()} if tables.exists(spark, flow.path("semantic")) else set()
    flow.settings["ask"] = lambda prompt: '{"dp_used": false}'
    flow.semantic()
    rows = {r.problem_id: r.extractions[0].dp_used for r in flow.table("semantic").collect()}
    assert "2/A" not in had and rows == {f"{k}/A": f"{k}/A" in had for k in range(4)} and flow.table("semantic").count() == 4


def test_shared_folder_is_asked_for_on_a_cluster():
    class Fake:
        master, conf, sparkContext = "yarn", property(lambda self: self), property(lambda self: self)
        getConf = lambda self: self
        get = lambda self, *a: None

    with pytest.raises(RuntimeError, match="checkpoint"):
        tables.shared_folder(Fake())
    Fake.master = "local[4]"
    assert tables.shared_folder(Fake()).startswith("file:///")


def test_numbers_are_ranks(spark):
    r = random.Random(1)
    keys = sorted({"".join(r.choice("ab0") for _ in range(6)) for _ in range(300)})
    got = {x.k: x.n for x in tables.numbered(spark.createDataFrame([(k,) for k in r.sample(keys, len(keys))], "k string"), "k", "n").collect()}
    assert got == {k: i for i, k in enumerate(keys, 1)}


def test_tables_append_and_stream(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string"
    for rows in ([(1, None), (2, "é")], [(2, "again"), (3, "c")]):
        tables.append_new(spark.createDataFrame(rows, schema), path, "k", schema)
    assert sorted(tuple(r) for r in tables.read_jsonl(spark, path, schema).collect()) == [(1, None), (2, "é"), (3, "c")]
    tables.write_jsonl(spark.createDataFrame([(1, None)], schema), str(tmp_path / "w"))
    assert '"v":null' in "".join(p.read_text() for p in (tmp_path / "w").glob("*.json"))
    last = tables.keep_last(spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 0)], "k int, v string, n int"), "k", "n")
    assert sorted((r.k, r.v) for r in last.collect()) == [(1, "b"), (2, "c")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(map(json.dumps, raw_rows())))
    stateless.append(stateless.candidates(spark, str(tmp_path / "in")), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "s")).where("tier = 'seed'").count() == 8


def test_collect_defaults(spark):
    raw = spark.createDataFrame([("1/A", None, [{"input": "1", "output": None}, None])], "id string, tags array<string>, official_tests array<struct<input: string, output: string>>")
    row = collect.problems(raw, "test").first()
    assert row.tags == [] and row.official_tests == [("1", "")] and row.rating is None and row.time_limit == 0 and not row.executable and row.source_split == "test"
    sub = collect.solutions(spark.createDataFrame([(5, 7, None)], "problem_id long, submission_id long, verdict string"), failure=True).first()
    assert (sub.problem_id, sub.source_id, sub.verdict, sub.is_accepted, sub.is_failure_example) == ("5", "7", "", False, True)
