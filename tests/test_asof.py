"""As-of joins and membership periods against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from storefront.operators import as_of, carry_forward, with_periods

DAY0 = dt.date(1996, 1, 1)
SALES = "customer_id long, order_date date, product_id long"
PERIODS = "customer_id long, start_date date, end_date date"


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def brute_as_of(rows, changes):
    out = []
    for k, at, v in rows:
        past = [(c_at, s) for c, c_at, s in changes if c is not None and c == k and c_at is not None and at is not None and c_at <= at]
        out.append((k, at, v, *(max(past, key=lambda x: (x[0], x[1] is not None, x[1])) if past else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,days", [(1, 1), (2, 7), (3, 32), (4, 10_000)])
def test_as_of_matches_brute_force(spark, seed, days):
    rng = random.Random(seed)
    some = lambda n: day(rng.choice([None, *range(n)]))
    rows = [(rng.choice([None, 1, 2, 3, 9]), some(90), i % 5) for i in range(150)]
    changes = [(rng.choice([None, 1, 2, 3, 4]), some(90), rng.choice([None, 1, 2, 3])) for _ in range(60)]
    df, told = spark.createDataFrame(rows, "k long, at date, v long"), spark.createDataFrame(changes, "k long, changed date, s long")
    found = as_of(df, told, "k", "at", "changed", ["changed", "s"], days)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_as_of(rows, changes)


def test_timestamps_and_empty_sides(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = spark.createDataFrame([(1, t, "a"), (1, t + dt.timedelta(seconds=1), "b")], "k long, at timestamp, v string")
    changes = spark.createDataFrame([(1, t + dt.timedelta(milliseconds=500), 7)], "k long, at2 timestamp, s long")
    assert sorted(tuple(r)[2:] for r in as_of(rows, changes, "k", "at", "at2", ["s"]).collect()) == [("a", None), ("b", 7)]
    assert as_of(rows.limit(0), changes, "k", "at", "at2", ["s"]).collect() == []
    assert [r["s"] for r in as_of(rows, changes.limit(0), "k", "at", "at2", ["s"]).collect()] == [None, None]


def test_greatest_state_is_carried_over_empty_buckets(spark):
    rows = spark.createDataFrame([(1, day(n), n) for n in (0, 5, 400, 401, 2000)], "k long, at date, v long")
    changes = spark.createDataFrame([(1, day(3), 5), (1, day(399), 2), (1, day(401), 9)], "k long, c date, s long")
    found = carry_forward(rows, changes, "k", "at", "c", {"most": F.col("s")}, days=10)
    assert sorted((r["v"], r["most"]) for r in found.collect()) == [(0, None), (5, 5), (400, 5), (401, 9), (2000, 9)]


@pytest.mark.parametrize("seed", range(3))
def test_periods_match_brute_force(spark, seed):
    rng = random.Random(seed)
    periods = [(rng.choice([None, 1, 2, 3]), day(s), day(rng.choice([None, s, s + 3, s + 40]))) for s in rng.sample(range(300), 12)]
    periods += [(2, None, day(9))]
    sales = [(rng.choice([None, 1, 2, 3, 4]), day(rng.choice([None, *range(320)])), i) for i in range(200)]
    want = []
    for c, d, p in sales:
        own = [(s, e) for k, s, e in periods if k == c and s is not None and c is not None]
        if not own:
            continue
        begun = [(s, e) for s, e in own if d is not None and s <= d]
        since = max((s for s, _ in begun), default=None)
        until = None if not begun or any(e is None for _, e in begun) else max(e for _, e in begun)
        want.append((c, d, p, since, until, any(e is None or e > d for _, e in begun)))
    found = with_periods(spark.createDataFrame(sales, SALES), spark.createDataFrame(periods, PERIODS))
    found = [(r["customer_id"], r["order_date"], r["product_id"], r["since"], r["until"], r["inside"]) for r in found.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_sides(spark):
    sales = spark.createDataFrame([(1, day(n), n) for n in (0, 10, 15, 30)], SALES)
    periods = spark.createDataFrame([(1, day(5), day(12)), (1, day(20), None)], PERIODS)
    side = lambda s: sorted(r["product_id"] for r in with_periods(sales, periods, s).collect())
    assert (side("inside"), side("outside"), side("before")) == ([10, 30], [0, 15], [0])
    with pytest.raises(ValueError):
        with_periods(sales, periods, "beside")


def test_work_grows_with_rows_plus_changes(spark):
    """One customer with all rows: ten times the rows and changes, about ten times the rows merged (not a hundred)."""
    def merged(n):
        rows = spark.range(n).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY0), (F.col("id") % 900).cast("int")).alias("at"))
        changes = rows.select("k", F.col("at").alias("c"), F.lit(1).alias("s"))
        plan = as_of(rows, changes, "k", "at", "c", ["s"])
        assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
        return plan.count()
    assert merged(200) == 200 and merged(2000) == 2000
