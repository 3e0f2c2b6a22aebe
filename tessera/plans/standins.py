"""The driver's tables in the shape of problems, submissions and results, in Spark and in SQL.

Documents stand for problems, with their whole texts; conversations for submissions, whose code is one of a few programs and then the whole text
of the turn; events for results of the judge, spread over all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X

INDEXES = ["A1", "A2", "B", "C"]
TITLES = [
    "Knapsack with weight and capacity", "Grid walk", "Number of ways", "Tight digit limits", "Interval DP on strings", "Sums over a subtree",
    "Bitmask DP", "Expected value", "Nim heaps", "Longest increasing subsequence", "Matrix chain", "Convex hull trick and prefix sums", "Plain task",
]
EDITORIALS = ["A Dynamic  Programming approach with\tmemoization.", "Use the DP recurrence over each subproblem.", "", "Greedy works."]
LANGUAGES = ["GNU C++17", "Python 3", "C++20 (GCC 13-64)", "Java 17", "PyPy 3", "Rust", "GNU C++"]
STATUSES = ["PASSED_EXACT", "PASSED_CHECKER", "PASSED_AVAILABLE_TESTS", "WRONG_ANSWER", "TLE", "RE", "CE", "CHECKER_TLE", "CHECKER_ERROR", "UNVERIFIED", "PASSED_EXACT"]
CODE = [
    "int dp[100][100]; int main() { for (int i = 1; i < n; i++) dp[i][0] = dp[i-1][0] + max(a, b); }",
    "vector<int> dp(n); dp[0] = 1; dp[i] += dp[i-1]; int weight, capacity;",
    "map<int,int> memo; int solve(int x) { return memo[x]; } // tight leading_zero digit",
    "int f(int x) { return x; }",
    "for mask in range(1<<n): best = min(best, cost[mask])",
    "long long dp[1 << 20]; if (mask & (1LL << j)) dp[mask] = max(dp[mask], 1);",
    "vector<int> g[100]; void dfs(int v) { for (int u : adj[v]) dfs(u); } // subtree children parent",
    "print(input())",
    "vector<vector<int>> dp; string s1, s2; // lcs interval left right\ndp[l][r] = min(dp[l+1][r], dp[l][r-1]);",
    "",
    "cache = {}\ndef rec(l, r):\n    return cache[l, r]\n# longest increasing lis",
]
ANSWERS = [
    '{"dp_used": true, "family": "knapsack", "state": {"dimensions": 2, "representation": "2d_array"}, "iteration": {"style": "bottom_up"}, "transition": {"operation": "max"}}',
    '```json\n{"dp_used": true, "family": "knapsack", "state": {"dimensions": 1, "representation": "array"}, "iteration": {"style": "bottom_up"}, "transition": {"operation": "max"}}\n```',
    'The answer is {"dp_used": true, "family": "tree", "state": {"dimensions": "two"}, "transition": {"operation": "sum"}} as asked.',
    '{"dp_used": false, "family": "grid", "state": {"dimensions": 3}}',
    "no object here",
    '{"dp_used": true}',
]
OUTPUTS = [("1 2\n3", "1  2 3", "print it"), ("YES", "yes", "Print YES or NO in any case."), ("YES", "yes", "Print YES or NO."), (" a b ", "a b", ""), ("a", "a b", "Case Insensitive"), ("", "", "upper or lower case")]


def pick(values: list, at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(at, F.lit(len(values))).cast("int") + 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def problem_id(n: Column) -> Column:
    return F.concat(F.floor(n / 4).cast("string"), F.lit("/"), pick(INDEXES, n))


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    i = F.col("doc_id")
    many = F.array(*map(F.lit, ["bitmasks", "graphs", "combinatorics", "matrices", "probabilities"]))
    some = P.labels([("dp", F.col("quality") == 1), ("games", F.col("toxic") == 1), ("strings", i % 3 == 0), ("trees", i % 10 == 4)])
    none = F.lit(None).cast("string")
    return d.join(lab, "doc_id", "left").select(
        problem_id(i).alias("id"), i.alias("doc_id"), F.substring("text", 1, 40).alias("title"), F.col("text").alias("description"), F.lit("").alias("input_format"), F.lit("").alias("output_format"),
        none.alias("interaction_format"), F.when(i % 9 == 0, "See the note.").alias("note"), F.when(i % 7 != 0, (800 + 100 * (i % 28)).cast("int")).alias("rating"),
        F.when(i % 11 == 0, many).otherwise(some).alias("tags"), pick(EDITORIALS, i).alias("editorial"), (i % 2 == 0).alias("executable"), (i % 3 == 0).alias("official_tests_complete"),
        F.floor(i / 4).cast("string").alias("contest_id"), pick(INDEXES, i).alias("index"), "source", F.lit("train").alias("source_split"),
    )


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems with titles that name methods."""
    return problems(spark, sf_dir).withColumn("title", pick(TITLES, F.col("doc_id")))


def runnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems with an input mode and tests, some without either."""
    i = F.col("doc_id")
    tests = F.when(i % 5 == 4, F.array().cast("array<struct<input: string, output: string>>")).when(i % 7 != 6, F.array(F.struct(i.cast("string").alias("input"), F.lit("x").alias("output"))))
    return problems(spark, sf_dir).withColumn("input_mode", F.when(i % 11 == 3, "file").otherwise("stdio")).withColumn("official_tests", tests)


def submissions(spark: SparkSession, sf_dir: str, accepted: bool | None = None) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    c = c if accepted is None else c.where((F.col("role") == "assistant") == accepted)
    i, t = F.col("conv_id"), F.col("turn")
    return c.select(problem_id(F.floor(i / 3)).alias("problem_id"), (i * 100 + t).cast("string").alias("submission_id"), pick(LANGUAGES, i + t).alias("programmingLanguage"), F.concat(pick(CODE, i * 7 + t * 3), F.lit("\n"), F.coalesce("text", F.lit(""))).alias("source"), F.lit("OK").alias("verdict"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents").count()
    i, u = F.col("event_id"), F.col("user_id")
    return e.select(
        problem_id(F.pmod(F.floor(i / 3), F.lit(max(1, n)))).alias("problem_id"), F.floor(i / 2).cast("string").alias("source_id"), pick(LANGUAGES, i + u).alias("language"), F.when(i % 5 != 0, "OK").otherwise("FAIL").alias("verdict"),
        F.lit("events").alias("source"), F.concat(pick(CODE, i), F.when(i % 11 != 9, F.concat(F.lit("\n// "), F.coalesce("props", F.lit("")))).otherwise("")).alias("source_code"), pick(STATUSES, i).alias("status"), F.lit(None).cast("double").alias("execution_time_ms"), F.lit("").alias("stdout"), F.lit("").alias("stderr"), i.alias("event_id"),
    )


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def sql_pick(values: list[str], at: str) -> str:
    return f"{listed(values)}[CAST({at} AS BIGINT) % {len(values)} + 1]"


def sql_id(n: str) -> str:
    return f"(CAST(CAST(floor(({n}) / 4) AS BIGINT) AS VARCHAR) || '/' || {sql_pick(INDEXES, n)})"


def sql_labels(cases: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {quoted(n)} END" for n, c in cases) + "], lambda x: x IS NOT NULL)"


SQL = {
    "lab": "SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY doc_id",
    "problems": f"""SELECT {sql_id('d.doc_id')} AS id, d.doc_id, substring(text, 1, 40) AS title, text AS description, CASE WHEN d.doc_id % 9 = 0 THEN 'See the note.' END AS note,
        CASE WHEN d.doc_id % 7 <> 0 THEN CAST(800 + 100 * (d.doc_id % 28) AS INTEGER) END AS rating,
        CASE WHEN d.doc_id % 11 = 0 THEN ['bitmasks', 'graphs', 'combinatorics', 'matrices', 'probabilities']
             ELSE {sql_labels([("dp", "quality = 1"), ("games", "toxic = 1"), ("strings", "d.doc_id % 3 = 0"), ("trees", "d.doc_id % 10 = 4")])} END AS tags,
        {sql_pick(EDITORIALS, 'd.doc_id')} AS editorial, d.doc_id % 2 = 0 AS executable, d.doc_id % 3 = 0 AS official_tests_complete,
        CAST(CAST(floor(d.doc_id / 4) AS BIGINT) AS VARCHAR) AS contest_id, {sql_pick(INDEXES, 'd.doc_id')} AS idx, source
        FROM documents d LEFT JOIN lab USING (doc_id)""",
    "titled": f"SELECT * REPLACE ({sql_pick(TITLES, 'doc_id')} AS title) FROM problems",
    "runnable": "SELECT *, CASE WHEN doc_id % 11 = 3 THEN 'file' ELSE 'stdio' END AS input_mode, CASE WHEN doc_id % 5 = 4 THEN 0 WHEN doc_id % 7 <> 6 THEN 1 END AS n_tests FROM problems",
    "submissions": f"""SELECT {sql_id('CAST(floor(conv_id / 3) AS BIGINT)')} AS problem_id, CAST(conv_id * 100 + turn AS VARCHAR) AS submission_id, {sql_pick(LANGUAGES, 'conv_id + turn')} AS lang,
        {sql_pick(CODE, 'conv_id * 7 + turn * 3')} || chr(10) || coalesce(text, '') AS code, role = 'assistant' AS accepted FROM conversations""",
    "results": f"""SELECT {sql_id('CAST(floor(event_id / 3) AS BIGINT) % (SELECT count(*) FROM documents)')} AS problem_id, CAST(CAST(floor(event_id / 2) AS BIGINT) AS VARCHAR) AS source_id, {sql_pick(LANGUAGES, 'event_id + user_id')} AS lang,
        CASE WHEN event_id % 5 <> 0 THEN 'OK' ELSE 'FAIL' END AS verdict, {sql_pick(CODE, 'event_id')} || CASE WHEN event_id % 11 <> 9 THEN chr(10) || '// ' || coalesce(props, '') ELSE '' END AS source_code, {sql_pick(STATUSES, 'event_id')} AS status, event_id FROM events""",
}
__all__ = ["SQL", "X", "listed", "pick", "problem_id", "problems", "quoted", "results", "runnable", "sql_labels", "sql_pick", "submissions", "table", "titled"]
