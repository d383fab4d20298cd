"""Registered queries against their SQL oracles on the smallest tables.

All run by default (some minutes); PANELGRAIN_SOME_QUERIES=1 takes the headline queries and the first of
each operator family. check.py does the same on larger tables.
"""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from bench import HEADLINE
from check import TABLES, rows_of
from panelgrain.checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


# Its log holds one run id, so the other side of the join is a single row.
ONE_ROW = {"fct09_threshold_snapshot"}


def chosen():
    if not os.environ.get("PANELGRAIN_SOME_QUERIES"):
        return sorted(ORACLES)
    families = {}
    for name in sorted(ORACLES):
        families.setdefault(re.match(r"[a-z]+", name).group(), name)
    return sorted({*HEADLINE, *families.values()})


@pytest.mark.parametrize("name", chosen())
def test_query(spark, db, name):
    """Same rows as the oracle; no row pairs without an equality, no Python in the plan."""
    df = QUERIES[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text or name in ONE_ROW
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(ORACLES[name])
    assert got == rows_of([c[0] for c in cursor.description], cursor.fetchall())
