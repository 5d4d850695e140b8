"""Registered queries of the operators against the SQL given for them."""

from __future__ import annotations

import duckdb
import pytest

from clicklake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def _sorted(rows):
    return sorted(map(tuple, rows), key=lambda row: [(x is None, x) for x in row])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_returns_the_rows_of_its_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        database.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    answer = database.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert _sorted(found.select(*columns).collect()) == _sorted(answer.fetchall())
