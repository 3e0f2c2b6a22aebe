"""All stages from raw files to training examples, each dataset a table in a folder.

Run ``python -m tessera.plans.flow --help``. Each stage reads the tables before it, so a run can begin at any of them.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble, canonical, collect, judge, select, semantic, signals, taxonomy
from ..sources import schemas
from ..sources.tables import append, exists, read_jsonl, read_table, staged, write_jsonl, write_table

#: The order of a dataset's rows where it is written. Operators don't sort: the next one would lose it again.
ORDERS = {
    "exact_groups": lambda: [F.desc("count"), "problem_ids"], "near": lambda: [F.desc("similarity.score"), "problem_a", "problem_b"],
    "relationships": lambda: ["relationship", F.desc("similarity_score"), "problem_a", "problem_b"], "groups": lambda: ["problem_id"],
    "verified": lambda: ["problem_id", "verification.quality", "source_id"], "failures": lambda: ["problem_id", "failure_type", "source_id"], "pool": lambda: ["problem_id"],
    "gold": lambda: ["role", F.coalesce("primary_family", F.lit("unresolved")), F.coalesce(-F.col("rating"), F.lit(0)), "problem_id"],
}


def in_order(name: str, df: DataFrame) -> DataFrame:
    return df.orderBy(*ORDERS[name]()) if name in ORDERS else df


@dataclass
class Flow:
    """Tables by name under a folder. kind: parquet, or json for JSON lines."""

    spark: SparkSession
    folder: str
    kind: str = "parquet"
    settings: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.{self.kind}"

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), getattr(schemas, SCHEMAS[name], None) if self.kind == "json" else None)

    def put(self, name: str, df: DataFrame) -> None:
        write_table(in_order(name, df), self.path(name))

    # each stage: reads tables, puts tables

    def collect(self) -> None:
        raw = read_jsonl(self.spark, self.settings["problems"], self.settings.get("raw_schema", schemas.RAW_PROBLEM))
        self.put("problems", collect.problems(raw, self.settings.get("split", "train")))

    def candidates(self) -> None:
        self.put("candidates", signals.candidates(self.table("problems")))

    def solutions(self) -> None:
        out = None
        for name, failure, most in (("accepted", False, 5), ("incorrect", True, 3)):
            if self.settings.get(name):
                rows = select.of_candidates(read_jsonl(self.spark, self.settings[name], schemas.SUBMISSION), self.table("candidates"))
                part = collect.solutions(select.selected_solutions(rows, most), failure)
                out = part if out is None else out.unionByName(part)
        self.put("solutions", self.spark.createDataFrame([], schemas.SOLUTION) if out is None else out)

    def signals(self) -> None:
        self.put("signals", signals.problem_signals(signals.solution_signals(self.table("solutions"))))

    def evidence(self) -> None:
        self.put("evidence", signals.evidence(self.table("candidates"), self.table("signals")))

    def taxonomy(self) -> None:
        self.put("taxonomy", taxonomy.taxonomy(self.table("candidates"), self.table("evidence")))

    def canonical(self) -> None:
        self.put("canonical", canonical.canonical_records(self.table("problems"), self.table("taxonomy")))
        self.put("exact_groups", canonical.exact_groups(self.table("canonical")))

    def near(self) -> None:
        s = self.settings
        self.put("near", canonical.near_duplicates(self.table("problems"), self.table("canonical"), s.get("threshold", canonical.THRESHOLD), s.get("max_postings", canonical.MAX_POSTINGS), s.get("min_shared_shingles", canonical.MIN_SHARED)))

    def relate(self) -> None:
        self.put("relationships", canonical.relationships(self.table("near"), self.table("canonical")))
        self.put("groups", canonical.problem_groups(self.table("canonical")))

    def verify(self) -> None:
        """Runs untrusted programs: only with the setting ``judge``. Else results are taken from the setting ``results``."""
        if self.settings.get("judge"):
            chosen = select.solutions_to_verify(self.table("solutions").where("is_accepted"), pypy=self.settings.get("pypy", False))
            some = judge.eligible_problems(self.table("problems"), chosen)
            some = select.shuffled_first(some, "id", self.settings.get("max_problems", 1000), self.settings.get("seed", 42), self.settings.get("shuffle", "hash"))
            self.put("results", judge.verify(chosen.drop("compiler"), some))
        elif self.settings.get("results"):
            self.put("results", read_jsonl(self.spark, self.settings["results"], schemas.RESULT))
        else:
            self.put("results", self.spark.createDataFrame([], schemas.RESULT))

    def verified(self) -> None:
        self.put("verified", assemble.verified(self.table("results"), self.table("taxonomy")))
        self.put("failures", assemble.failures(self.table("results")))

    def pool(self) -> None:
        self.put("pool", assemble.problem_pool(self.table("taxonomy"), self.table("groups"), self.table("canonical"), self.table("verified"), self.table("relationships")))

    def gold(self) -> None:
        self.put("gold", assemble.gold_seeds(self.table("pool")))

    def concepts(self) -> None:
        self.put("concepts", assemble.concepts(self.table("pool"), self.table("verified")))

    def semantic(self) -> None:
        """Asks a model: only with the setting ``ask``, a function from prompt to answer.

        Rows are appended, ``chunk`` problems at a time, and problems that have a row already aren't asked about again: a run that breaks off is taken up where it was.
        """
        if not (ask := self.settings.get("ask")):
            return
        path = self.path("semantic")
        rows = semantic.asked(self.table("pool"), self.table("verified"), self.table("problems"), self.settings.get("start", 0), self.settings.get("limit"))
        if exists(self.spark, path):
            rows = rows.join(self.table("semantic").select("problem_id"), "problem_id", "left_anti")
        rows = staged(rows)
        chunks = -(-rows.select("problem_id").distinct().count() // self.settings.get("chunk", 1000))
        for k in range(chunks):
            some = rows.where(F.pmod(F.xxhash64("problem_id"), F.lit(chunks)) == k)
            append(semantic.agreed(semantic.extract(some, ask), some), path)

    def examples(self) -> None:
        pool = self.table("pool")
        ok = assemble.usable(self.table("results"), pool, self.table("problems"))
        if self.settings.get("strict", True) and ok.isEmpty():
            raise RuntimeError("no verified problem with a statement")
        made = assemble.examples(ok, pool, assemble.split_ids(ok, "problem_id", self.settings.get("seed", 42), self.settings.get("shuffle", "hash")))
        self.put("examples", made)
        placed = assemble.shuffled(self.table("examples"), self.settings.get("seed", 42), self.settings.get("shuffle", "hash"))
        for split in ("train", "val", "test"):
            write_jsonl(placed.where(F.col("split") == split).orderBy("place").drop("split", "place"), f"{self.folder}/{split}.jsonl")

    def summaries(self) -> dict:
        """Totals of what is there, each from one row or a small group-by."""
        asked = exists(self.spark, self.path("semantic"))
        of = lambda df: [r.asDict() for r in df.collect()]
        pool, verified = self.table("pool"), self.table("verified")
        return {
            "audit": of(collect.audit_totals(self.table("problems"))), "exact": of(canonical.exact_summary(self.table("canonical"))), "evidence": of(signals.counts_of(self.table("evidence"), "evidence_level")),
            "families": of(taxonomy.family_counts(self.table("taxonomy"))), "relationships": of(signals.counts_of(self.table("relationships"), "relationship")), "results": of(judge.result_counts(self.table("results"))),
            "verified": of(assemble.verified_summary(self.table("results"), verified)), "pool": of(assemble.pool_summary(pool)), "pool_counts": of(assemble.pool_counts(pool)),
            "gold": of(assemble.gold_counts(self.table("gold"))), "concepts": of(assemble.concepts_summary(self.table("concepts"))), "concept_counts": of(assemble.concept_counts(self.table("concepts"))),
            "semantic": of(semantic.summary(self.table("semantic"))) if asked else [], "examples": of(assemble.split_sizes(self.table("examples"))),
        }

    def report(self) -> dict:
        """The summaries, written as a JSON document each, one line of one file in a folder of its own."""
        found = self.summaries()
        for name, rows in found.items():
            line = self.spark.createDataFrame([(json.dumps({"summary": name, "rows": rows}, default=str, ensure_ascii=False),)], "value string")
            line.coalesce(1).write.mode("overwrite").text(f"{self.folder}/summaries/{name}.json")
        return found

    def run(self, stages: list[str] | None = None) -> None:
        for name in stages or STAGES:
            stage: Callable[[], None] = getattr(self, name)
            stage()


STAGES = ["collect", "candidates", "solutions", "signals", "evidence", "taxonomy", "canonical", "near", "relate", "verify", "verified", "pool", "gold", "concepts", "semantic", "examples"]
SCHEMAS = {
    "problems": "PROBLEM", "candidates": "CANDIDATE", "solutions": "SOLUTION", "signals": "SIGNALS", "evidence": "EVIDENCE", "taxonomy": "TAXONOMY", "canonical": "CANONICAL",
    "exact_groups": "DUPLICATES", "near": "NEAR", "relationships": "RELATIONSHIP", "groups": "GROUP", "results": "RESULT", "verified": "VERIFIED", "failures": "FAILURE", "pool": "POOL",
    "gold": "POOL", "concepts": "CONCEPTS", "semantic": "SEMANTIC", "examples": "EXAMPLE",
}


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("stages", nargs="*", help=f"of {' '.join(STAGES)}; all by default")
    p.add_argument("--folder", required=True)
    p.add_argument("--problems", help="raw problems, JSON lines")
    p.add_argument("--accepted", help="accepted submissions, JSON lines")
    p.add_argument("--incorrect", help="incorrect submissions, JSON lines")
    p.add_argument("--results", help="results of a judge, JSON lines, instead of running programs")
    p.add_argument("--judge", action="store_true", help="run the programs (untrusted code)")
    p.add_argument("--split", default="train")
    p.add_argument("--threshold", type=float, default=canonical.THRESHOLD)
    p.add_argument("--max-postings", type=int, default=canonical.MAX_POSTINGS)
    p.add_argument("--min-shared-shingles", type=int, default=canonical.MIN_SHARED)
    p.add_argument("--host", help="of the model's server; without one no model is asked")
    p.add_argument("--model", default="")
    p.add_argument("--timeout", type=int, default=180)
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--limit", type=int)
    p.add_argument("--chunk", type=int, default=1000, help="problems that a model is asked about before their rows are written")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--shuffle", choices=["hash", "exact"], default="hash", help="exact: CPython's shuffles, on the driver")
    a = p.parse_args(args)
    settings = {k: v for k, v in vars(a).items() if v is not None}
    if a.host:
        settings["ask"] = semantic.over_http(a.host, a.model, a.timeout)
    flow = Flow(SparkSession.builder.appName("tessera").getOrCreate(), a.folder, settings=settings)
    flow.run(a.stages)
    if not a.stages:
        print(json.dumps(flow.report(), indent=2, default=str))


if __name__ == "__main__":
    main()
