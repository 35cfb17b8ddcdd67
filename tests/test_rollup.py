"""Distinct counts by level and totals of any period, against plain aggregates."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from storefront.operators import count_sets, distinct_by_levels, distinct_sets, merge_sets, period_totals, running_totals
from storefront.plans import mart
from storefront.sources.bindings import Domain
from tests.conftest import rows

DAY0 = dt.date(2020, 12, 20)


def _days(rng, n):
    ids = [None, 0, -1, -32_768, 1, 32_768, 32_769, 10 ** 12, *range(2, 20)]
    return [(rng.choice([None, *(DAY0 + dt.timedelta(days=i) for i in range(30))]), rng.choice(ids)) for _ in range(n)]


def test_levels_equal_count_distinct(spark):
    data = _days(random.Random(1), 400)
    df = spark.createDataFrame(data, "d date, v long")
    day = F.col("period")
    levels = {"day": day, "month": F.date_format(day, "yyyy-MM"), "all": F.lit("all")}
    want = {}
    for d, v in data:
        for level, period in (("day", d and str(d)), ("month", d and str(d)[:7]), ("all", "all")):
            if v is not None:
                want.setdefault((level, period), set()).add(v)
    found = distinct_by_levels(df, "v", F.col("d"), levels)
    assert rows(found) == sorted(((*k, len(s)) for k, s in want.items()), key=repr)
    assert distinct_by_levels(df.limit(0), "v", F.col("d"), levels).collect() == []


def test_stored_sets_merge_with_later_ones(spark):
    first, second = (spark.createDataFrame(_days(random.Random(s), 100), "d date, v long") for s in (2, 3))
    sets = distinct_sets(first, "v", {"d": F.col("d")}).unionByName(distinct_sets(second, "v", {"d": F.col("d")}))
    merged = count_sets(merge_sets(sets, {"month": F.month("d")}), ["month"])
    want = first.unionByName(second).groupBy(F.month("d").alias("month")).agg(F.countDistinct("v").alias("n"))
    assert rows(merged) == rows(want.filter("n > 0"))


def test_levels_read_the_rows_once(spark, small_dir):
    plan = Domain(spark, small_dir).sales
    plan = distinct_by_levels(plan, "customer_id", F.col("order_date"), {"day": F.col("period"), "all": F.lit("all")})
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("lineitem.parquet") == 1 and "partial_bitmap_construct_agg" in text


@pytest.mark.parametrize("seed", range(3))
def test_period_totals_equal_sums(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", None]), rng.choice("xy"), d, rng.randrange(-5, 50)) for d, _ in _days(rng, 150)]
    df = spark.createDataFrame(data, "k string, l string, d date, s long")
    at = lambda n: DAY0 + dt.timedelta(days=n)
    periods = {"p0": (at(3), at(9)), "p1": (at(9), at(20)), "p2": (at(-30), at(0)), "p3": (at(0), at(60)), "p4": (at(5), at(6))}
    totals = running_totals(df, ["k", "l"], "d", F.col("s"))
    found = {tuple(r["area"]): tuple(r[p] for p in periods) for r in period_totals(totals, "d", periods).collect()}
    want = {}
    for area in {(k, x) for k, x, d, _ in data if d}:
        sums = [[s for k, x, d, s in data if (k, x) == area and d and low <= d < high] for low, high in periods.values()]
        want[area] = tuple(sum(s) if s else None for s in sums)
    assert found == want


def test_one_table_answers_the_present_keys(spark, small_dir):
    d = Domain(spark, small_dir)
    found = mart.before_after_any(d).filter(F.col("baseline") == F.lit(d.baseline))
    for weeks, key in ((4, mart.before_after_4w_asked), (12, mart.before_after_12w_asked)):
        one = key(d).first()
        sums = found.filter(F.col("weeks") == weeks).agg(F.sum("before_sales"), F.sum("after_sales")).first()
        assert tuple(sums) == (one["before_sales"], one["after_sales"])


def test_look_ups_read_the_stored_table_only(spark, small_dir):
    files = mart.before_after_any(Domain(spark, small_dir)).inputFiles()
    assert files and all("weekly-running-totals" in f for f in files)
