"""Concepts by a language model: opt-in, with a transport that the caller gives."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring as K
from ..functions.concept_json import CONCEPT, DEFAULTS, concept_of
from ..functions.text import TEXT_FIELDS, prompt_text

#: Takes a prompt, gives the model's answer; raises OSError or ValueError where there is none.
Ask = Callable[[str], str]
SYSTEM = "You analyse programming-contest problems. Say what the solution computes, not which words occur. Answer with one JSON object only."


def over_http(host: str, model: str, timeout: float = 180, pause: float = 0.05) -> Ask:
    """A transport to a generate endpoint: temperature 0, JSON answers. An empty answer is an error of its row."""

    def ask(prompt: str) -> str:
        body = {"model": model, "prompt": prompt, "system": SYSTEM, "stream": False, "format": "json", "think": False, "options": {"temperature": 0}}
        request = urllib.request.Request(f"{host.rstrip('/')}/api/generate", json.dumps(body).encode(), {"Content-Type": "application/json"}, method="POST")
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            text = json.load(answer).get("response", "")
        time.sleep(pause)
        if not text.strip():
            raise ValueError("empty answer")
        return text

    return ask


def prompt(problem: str, family: dict, code: str | None = None) -> str:
    """code: left out by default."""
    shape = json.dumps(DEFAULTS, default=lambda kind: kind.__name__, indent=1)
    parts = ["Describe the dynamic programming in this problem.", f"Labels found automatically, which may be wrong:\n{json.dumps(family)}", f"Problem:\n{problem}"]
    parts += [f"An accepted solution:\n{code}"] if code else []
    parts += ["If no subproblems are reused, dp_used is false, family is null, and state and transition are blank.", f"Use exactly these fields (here with their defaults):\n{shape}"]
    return "\n\n".join(parts)


def asked(pool: DataFrame, verified: DataFrame, problems: DataFrame, start: int = 0, limit: int | None = None, order: str = "source_id", each: int = 2) -> DataFrame:
    """The first solutions of pool problems with verified code and a raw problem, from the start-th problem on."""
    ids = pool.where("has_verified_solution").join(verified.select("problem_id").distinct(), "problem_id", "left_semi").orderBy("problem_id").offset(start)
    ids = ids if limit is None else ids.limit(limit)
    told = problems.select(F.col("id").alias("problem_id"), prompt_text(*map(F.col, TEXT_FIELDS)).alias("problem_text"))
    of = Window.partitionBy("problem_id")
    some = verified.select("problem_id", "source_code", F.row_number().over(of.orderBy(order)).alias("nth"), F.count("*").over(of).alias("verified_solution_count")).where(F.col("nth") <= each)
    family = F.struct(F.col("primary_family").alias("primary"), "families", F.col("dp_evidence_level").alias("evidence_level"), F.col("dp_consensus").alias("consensus"))
    return ids.select("problem_id", "title", "rating", family.alias("family_evidence")).join(told, "problem_id").join(some, "problem_id")


def extract(asked: DataFrame, ask: Ask, with_code: bool = False, tasks: int | None = None) -> DataFrame:
    """(problem_id, nth, concept, error): one answer a solution."""
    rows = asked.select("problem_id", "nth", "problem_text", "source_code", F.to_json("family_evidence").alias("family"))
    rows = rows.repartition(tasks) if tasks else rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                try:
                    found, error = json.dumps(concept_of(ask(prompt(r.problem_text, json.loads(r.family), r.source_code if with_code else None)))), None
                except (OSError, ValueError, KeyError) as e:
                    found, error = None, str(e)
                out.append((r.problem_id, r.nth, found, error))
            yield pd.DataFrame(out, columns=["problem_id", "nth", "concept", "error"])

    return rows.mapInPandas(run, "problem_id string, nth int, concept string, error string").withColumn("concept", F.from_json("concept", CONCEPT))


def agreed(extracted: DataFrame, asked: DataFrame) -> DataFrame:
    """One row a problem: its concepts in order, how far the first two agree, the status and the errors."""
    per = extracted.groupBy("problem_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("concept").isNotNull(), F.struct("nth", F.to_json("concept").alias("json"))))).alias("got"),
        F.sort_array(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("nth", F.concat(F.lit("solution_"), F.col("nth").cast("string"), F.lit(": "), "error").alias("text"))))).alias("bad"),
    )
    per = per.select("problem_id", F.transform("got", lambda g: F.from_json(g["json"], CONCEPT)).alias("extractions"), F.transform("bad", lambda b: b["text"]).alias("errors"))
    facts = asked.select("problem_id", "title", "rating", "family_evidence", "verified_solution_count").dropDuplicates(["problem_id"])
    df = facts.join(per, "problem_id").withColumn("agreement", K.agreement(F.get("extractions", F.lit(0)), F.get("extractions", F.lit(1))))
    return df.select("problem_id", "title", "rating", "family_evidence", "verified_solution_count", "extractions", "agreement", K.extraction_status(F.size("extractions"), F.col("agreement.level")).alias("status"), "errors")


def summary(rows: DataFrame) -> DataFrame:
    """(what, value, count) of rows, statuses, agreement levels and primary families."""
    cols = {"rows": F.lit("all"), "status": F.col("status"), "agreement_level": F.col("agreement.level"), "family": F.col("family_evidence.primary")}
    out = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("what"), c.alias("value")) for k, c in cols.items()])).alias("x")).select("x.*")
    return out.where("what <> 'agreement_level' OR value IS NOT NULL").groupBy("what", "value").count()
