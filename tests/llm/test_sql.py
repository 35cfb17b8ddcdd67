"""Queries with SQL against DuckDB on the small tables, exact values."""

from __future__ import annotations

import duckdb
import pytest
from compare import duck, rows_of

from storefront.llm import queries


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_matches_sql(spark, small_dir, con: duckdb.DuckDBPyConnection, key):
    found = queries.QUERIES[key](spark, small_dir)
    rows, columns = rows_of(found.columns, [tuple(r) for r in found.collect()])
    res = con.execute(queries.SQL[key])
    want, named = rows_of([d[0] for d in res.description], res.fetchall())
    assert columns == named and rows and rows == want


def test_every_operator_has_its_query():
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(queries.SQL) <= set(queries.QUERIES)
