"""From a model's answer to a concept of fixed shape."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONCEPT = (
    "family string, dp_used boolean, state struct<variables array<string>, meaning string, dimensions int, representation string>, "
    "transition struct<description string, dependencies array<string>, operation string>, base_cases array<string>, "
    "answer struct<state string, aggregation string>, iteration struct<style string, order string>, "
    "optimization struct<techniques array<string>, description string>, complexity struct<time string, space string>, "
    "confidence string, uncertainties array<string>"
)
#: What a field is where the answer lacks it. A list takes lists alone, a dict recurses, int takes integers alone.
DEFAULTS = {
    "family": "unknown",
    "dp_used": False,
    "state": {"variables": [], "meaning": "", "dimensions": int, "representation": "other"},
    "transition": {"description": "", "dependencies": [], "operation": "unknown"},
    "base_cases": [],
    "answer": {"state": "", "aggregation": ""},
    "iteration": {"style": "other", "order": ""},
    "optimization": {"techniques": [], "description": ""},
    "complexity": {"time": "", "space": ""},
    "confidence": "low",
    "uncertainties": [],
}
#: What a concept without dynamic programming has.
WITHOUT_DP = {
    "family": None,
    "state": {"variables": [], "meaning": "", "dimensions": 0, "representation": "other"},
    "transition": {"description": "", "dependencies": [], "operation": "unknown"},
}


def _text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def shaped(given, default):
    """A value in the shape of its default."""
    if isinstance(default, dict):
        given = given if isinstance(given, dict) else {}
        return {k: shaped(given.get(k, d if not isinstance(d, (dict, type)) else None), d) for k, d in default.items()}
    if default is int:
        return int(given) if isinstance(given, int) else None
    if isinstance(default, list):
        return [_text(x) for x in given] if isinstance(given, list) else []
    if isinstance(default, bool):
        return bool(given)
    return _text(given)


def find_object(text: str) -> dict:
    """The JSON object that a text is or holds, from its first to its last brace; ValueError without one."""
    text = text.strip()
    if text.startswith("```"):
        text = re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", text))
    for part in (text, text[text.find("{") : text.rfind("}") + 1] if "{" in text else ""):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    raise ValueError("no JSON object in the answer")


def concept_of(answer: str, gate: bool = True) -> dict:
    """gate: without dynamic programming, family, state and transition are blank."""
    concept = shaped(find_object(answer), DEFAULTS)
    return concept | WITHOUT_DP if gate and not concept["dp_used"] else concept


@F.pandas_udf(T.StringType())
def _concept_json(answers: pd.Series) -> pd.Series:
    def one(answer):
        try:
            return None if answer is None else json.dumps(concept_of(answer), ensure_ascii=False)
        except ValueError:
            return None

    return answers.map(one)


def concept(answer: Column) -> Column:
    """The concept as a struct; null where the answer is null or has no JSON object."""
    return F.from_json(_concept_json(answer), CONCEPT)
