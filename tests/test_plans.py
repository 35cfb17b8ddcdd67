"""Plan shape: nothing that stops scaling, and scans read only what is used.

Size-based broadcasting is switched off here, so the plans are the ones a
large cluster would get for big tables."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from storefront.plans import fulfilment, mart, registry
from storefront.sources.bindings import Domain
from tests.conftest import rows

NOT_SCALABLE = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas")


@pytest.fixture(scope="module")
def big_plans(spark, small_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {k: fn(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
               for k, fn in registry.queries().items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_unscalable_nodes(big_plans):
    offenders = {k: [n for n in NOT_SCALABLE if n in p] for k, p in big_plans.items()}
    assert {k: v for k, v in offenders.items() if v} == {}


def test_no_cross_join_in_logical_plans(spark, small_dir):
    for key, fn in registry.queries().items():
        text = fn(spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join Cross" not in text, key


def _read_columns(plan: str, table: str) -> set[str]:
    cols: set[str] = set()
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*" + table + r"\.parquet", plan):
        cols |= {c.split("#")[0] for c in m.group(1).split(",")}
    return cols


def test_scans_are_pruned(big_plans):
    assert _read_columns(big_plans["spend_by_customer"], "lineitem") == {"l_orderkey", "l_partkey"}
    assert _read_columns(big_plans["spend_by_customer"], "part") == {"p_partkey", "p_retailprice"}
    assert _read_columns(big_plans["items_by_hour_asked"], "lineitem") == {"l_orderkey"}
    assert _read_columns(big_plans["delivery_success_rate"], "orders") == {"o_orderkey", "o_orderstatus"}


def test_filters_reach_the_scan(big_plans):
    plan = big_plans["pre_join_totals"]
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderpriority,1-URGENT\)", plan)


def test_partial_aggregation_before_every_shuffle(spark, small_dir):
    # Algebraic aggregates are split into partial + final around the exchange.
    plan = registry.queries()["sales_by_month_region"](spark, small_dir)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "partial_sum" in plan


def test_windows_are_limited_before_their_shuffle(big_plans):
    # As-of windows run within a key's time bucket (or over one row a bucket) instead.
    for key, plan in big_plans.items():
        windows = [w for w in re.findall(r"\bWindow \[[^\n]*", plan) if "_bucket#" not in w]
        assert plan.count("WindowGroupLimit") >= len(windows), key


def test_as_of_joins_have_no_range_condition(big_plans):
    """Rows and changes are merged by time; no join compares their dates."""
    for key in ("member_period_totals", "first_items_by_period", "points_join_weeks"):
        joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) [^\n]*", big_plans[key])
        assert joins and not any(">" in j or "<" in j for j in joins), key


SCANS = {  # table scans of queries that used to read or build their input twice
    "first_items_by_customer": {"lineitem": 1, "orders": 1},
    "last_items_before_join": {"lineitem": 1, "orders": 2},  # members come from orders too
    "post_join_items_asked": {"lineitem": 1, "orders": 2},
    "order_item_text_asked": {"lineitem": 2},
    "ingredient_list_asked": {"lineitem": 2},
    "ingredient_list": {"lineitem": 1},
}


@pytest.mark.parametrize("key,tables", SCANS.items())
def test_scan_counts(big_plans, key, tables):
    final = big_plans[key].split("== Initial Plan ==")[0]
    for table, most in tables.items():
        assert len(re.findall(r"FileScan parquet [^\n]*" + table + r"\.parquet", final)) <= most


def test_period_queries_push_their_dates_down(spark, small_dir):
    for key in ("before_after_4w", "before_after_12w_asked"):
        plan = registry.queries()[key](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan), key


def test_week_ranges_of_every_year_reach_the_scan(spark, small_dir, big_plans):
    for key in ("before_after_by_year", "before_after_12w_by_year_asked"):  # a range a year; the plan's text is cut short
        assert re.search(r"PushedFilters: \[Or\(Or\([^\n]*ReadSchema: struct<[^\n]*o_orderdate", big_plans[key]), key
    d = Domain(spark, small_dir)
    some = mart.clean_weekly_sales(d, weekly=d.weekly_sales_in_weeks(21, 28))
    every = mart.clean_weekly_sales(d).filter("week_number BETWEEN 21 AND 28")
    assert {r["week_number"] for r in some.select("week_number").distinct().collect()} <= set(range(21, 29))
    assert some.exceptAll(every).isEmpty() and every.exceptAll(some).isEmpty()


def test_written_mart_is_pruned_by_year(spark, small_dir, tmp_path):
    d = Domain(spark, small_dir)
    table = mart.materialise_mart(d, location=f"file://{tmp_path}/mart")
    plan = mart.impact_by_area(d, mart=table)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*calendar_year", plan)


def test_no_lists_meet_in_one_task(spark, small_dir):
    from storefront.plans.fulfilment import _with_lists
    plan = _with_lists(Domain(spark, small_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64(" in plan


def test_items_and_texts_of_orders_are_not_merged_into_few_tasks(spark, tmp_path):
    """AQE merged the join, the count of equal items and the texts to a task a core."""
    def write(name, values, schema):
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    day = dt.datetime(2021, 1, 1)
    write("lineitem", [(o, p, 3, n, flag, "F") for o in (1, 2, 3) for p, n, flag in ((1, 2, "R"), (1, 2, "R"), (2, 1, "N"))]
          + [(None, 1, 3, 2, "R", "F"), (99, 1, 3, 2, "R", "F"), (1, None, 3, 2, "R", "F")],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string")
    write("orders", [(k, 7, day) for k in (1, 2, 3, 3, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    write("part", [(1, "A", 3), (2, "A", 4)], "p_partkey long, p_type string, p_size int")
    write("nation", [(1, "Beef"), (2, "Corn"), (3, "Dill"), (4, "Eggs")], "n_nationkey int, n_name string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = fulfilment.ingredient_list(Domain(spark, str(tmp_path)))
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = rows(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    once = "A: 2xBeef, 2xBeef, 2xCorn, Dill, Dill, 2xEggs"
    twice = "A: " + ", ".join(["2xBeef"] * 4 + ["2xCorn"] * 2 + ["Dill"] * 4 + ["2xEggs"] * 2)
    assert got == [(1, once), (2, once), (3, twice)]
    for keys in (r"l_orderkey#\d+L", r"o_orderkey#\d+L", r"order_id#\d+L, pizza_name#\d+"):
        assert re.search(rf"Exchange hashpartitioning\({keys}, {fulfilment.ORDER_PARTITIONS}\), REPARTITION_BY_NUM", plan), keys
