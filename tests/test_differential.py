"""Every registered query against its DuckDB SQL on the sf0.001 tables:
same column names, same rows (order-insensitive, exact values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import duck, rows_of
from storefront.plans import registry

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, small_dir, con, key):
    sql = entry.oracle_sql()[key]
    sdf = entry.queries()[key](spark, small_dir)
    srows, scols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(sql)
    drows, dcols = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert len(srows) == len(drows)
    assert srows == drows
