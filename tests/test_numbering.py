"""Dense numbers, SERIAL appends and ordered texts in pieces."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from storefront.operators import append_numbered, compose_list, compose_pieces, number_rows
from storefront.operators.numbering import sorted_runs
from tests.conftest import rows


def test_numbers_are_dense_and_in_order(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, *range(40)]), rng.choice("abc")) for _ in range(500)]
    df = spark.createDataFrame(data, "k long, v string").repartition(7)
    want = [(*r, i) for i, r in enumerate(sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1])), 1)]
    for _ in range(2):  # a rerun gives the same numbers
        found = number_rows(df, ["k"], "id").collect()
        assert sorted(((r["k"], r["v"], r["id"]) for r in found), key=lambda r: r[2]) == want
    assert number_rows(df.limit(0), ["k"], "id").collect() == []
    assert [r["id"] for r in number_rows(df.limit(1), ["k"], "id", start=10).collect()] == [10]


def test_hot_order_key_is_spread(spark):
    """Rows with one order value are dealt by their other columns."""
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = sorted_runs(df, ["k"], "runs").groupBy("_task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sum(r["count"] for r in tasks) == 4000 and len(tasks) > 1 and max(r["count"] for r in tasks) < 3000


def test_no_single_task_and_no_window(spark):
    plan = number_rows(spark.range(100), ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    # The only single-partition exchange carries one row a task.
    assert plan.count("SinglePartition") <= 1


def test_serial_append(spark):
    table = number_rows(spark.createDataFrame([("b",), ("a",)], "v string"), ["v"], "id")
    more = append_numbered(table, spark.createDataFrame([("z",), ("c",)], "v string"), "id", ["v"])
    assert rows(more, "id", "v") == [(1, "a"), (2, "b"), (3, "c"), (4, "z")]
    empty = append_numbered(table.limit(0), spark.createDataFrame([("z",)], "v string"), "id", ["v"])
    assert rows(empty, "id", "v") == [(1, "z")]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pieces_join_to_the_aggregate(spark, size):
    rng = random.Random(size)
    data = [(rng.choice([None, "hot", "hot", "x"]), rng.choice([None, *range(30)]), rng.choice([None, "p", "q, r", ""])) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, o long, v string")
    whole = {r["g"]: r["t"] for r in compose_list(df.filter("v IS NOT NULL").select("g", F.struct(F.col("o").isNull().alias("n"), "o").alias("o"), "v"),
                                                  ["g"], "v", "t", order_by="o").collect()}
    parts = {}
    for r in sorted(compose_pieces(df, ["g"], "v", order_by=["o"], rows_a_piece=size).collect(), key=lambda r: r["piece"]):
        own = parts.setdefault(r["g"], [])
        assert r["items"] <= size and r["first_item"] == r["piece"] * size and len(own) == r["piece"]
        own.append(r["text"])
    assert {g: ", ".join(p) for g, p in parts.items()} == whole
