"""The catalogue's queries against their SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest
from tessera.plans import catalog
from tessera.sources.tables import staged

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module", autouse=True)
def chains():
    """What many queries begin with is made once for all tests: the taxonomy, the pool with its verified solutions, the canonical records and their pairs."""
    patch, made = pytest.MonkeyPatch(), {}
    for name in ("taxonomy_of", "pool_and_verified", "canonicals", "near"):

        def once(spark, d, *more, name=name, make=getattr(catalog, name)):
            if more:
                return make(spark, d, *more)
            if name not in made:
                found = make(spark, d)
                made[name] = tuple(map(staged, found)) if isinstance(found, tuple) else staged(found)
            return made[name]

        patch.setattr(catalog, name, once)
    yield
    patch.undo()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    plain = lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_as_sql(spark, sql, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), sql.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_queries_without_sql(spark):
    form = {r.t: r.canonical for r in catalog.QUERIES["compatibility_form"](spark, SF).collect()}
    assert form["ﬁn"] == "fin" and form[None] == ""
    assert {r.source_id: r.status for r in catalog.QUERIES["judged"](spark, SF).collect()} == {"1": "PASSED_EXACT", "2": "WRONG_ANSWER", "3": "RE", "4": "UNSUPPORTED_LANGUAGE"}


def test_no_statements_are_staged(spark, monkeypatch):
    """A problem's statement, as long as its text, would be written once for each of its solutions."""
    seen = []
    monkeypatch.setattr(catalog, "staged", lambda df: seen.append(df.columns) or staged(df))
    assert catalog.examples_of(spark, SF).columns == ["split", "messages", "metadata"]
    assert seen and not any("statement" in columns for columns in seen)


def test_every_query_names_one_function():
    assert len(catalog.QUERIES) == len({*map(id, catalog.QUERIES.values())}) and set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["exact_hash", "problem_ids", "count"]
    assert set(entry.oracle_sql()) <= set(entry.queries()) and catalog.FLAGSHIP in entry.queries()
