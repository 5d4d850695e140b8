"""Every registered query against its SQL on the smallest supplied tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
import checks.queries
from checks.compare import difference, oracle_connection

FOLDER = "/root/testdata/sf0.001"
QUERIES = {key: run for key, run in contract.queries().items() if key in checks.queries.QUERIES}
SQL = {key: sql for key, sql in contract.oracle_sql().items() if key in QUERIES}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


# Python runs on summary rows, for tails and quantiles, or on bounded cells.
MAY_USE_PYTHON = ("x1_confidence", "x2_compare", "x2_rank", "x3_", "x4_", "x5_timeseries_intervals", "x10_trend")


def check_plan(df, key):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text
    if not key.startswith(MAY_USE_PYTHON):
        assert not re.search(r"Python|Pandas", text)


@pytest.mark.parametrize("key", sorted(SQL))
def test_agrees_with_sql(spark, oracle, key):
    df = QUERIES[key](spark, FOLDER)
    check_plan(df, key)
    assert difference(oracle, df, SQL[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, key):
    df = QUERIES[key](spark, FOLDER)
    check_plan(df, key)
    assert df.count() > 0


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
