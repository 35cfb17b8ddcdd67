"""Reusable operators: semantics on tiny frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from storefront.operators import (
    append_rows,
    exclude_keys,
    explode_ids,
    missing_in_range,
    period_sums,
    rows_at_extreme,
    share_pct,
    success_rate,
    tiered_value,
    top_overall,
    totals_by,
    validate_rows,
    with_membership,
)
from tests.conftest import rows

D = dt.date


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 1), 2),
         ("A", D(2021, 1, 7), 3), ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1),
         ("C", D(2021, 1, 1), 3)],
        "customer_id string, order_date date, product_id int")


@pytest.fixture
def members(spark):
    return spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 4))],
                                 "customer_id string, join_date date")


def test_rows_at_extreme_keeps_ties_and_duplicates(sales):
    first = rows_at_extreme(sales, "customer_id", "order_date")
    assert rows(first, "customer_id", "product_id") == [("A", 1), ("A", 2), ("A", 2), ("B", 2), ("C", 3)]
    last = rows_at_extreme(sales, "customer_id", "order_date", first=False)
    assert rows(last, "customer_id", "product_id") == [("A", 3), ("B", 1), ("C", 3)]


def test_with_membership_sides(sales, members):
    assert rows(with_membership(sales, members, "before"), "customer_id", "product_id") == \
        [("A", 1), ("A", 2), ("A", 2), ("B", 2)]
    assert rows(with_membership(sales, members, "on_or_after"), "customer_id", "product_id") == \
        [("A", 3), ("B", 1)]
    assert with_membership(sales, members).count() == 6  # customer C is not a member


def test_top_overall_breaks_ties_by_label(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "name string, n long")
    assert rows(top_overall(df, [F.desc("n"), F.asc("name")])) == [("a", 3)]


def test_exclude_keys_null_aware(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with_values = spark.createDataFrame([(2,)], "k int")
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(exclude_keys(probe, "k", with_values, "k")) == [(1,)]
    # A NULL in the set makes NOT IN unknown for every probe row.
    assert exclude_keys(probe, "k", with_null, "k").count() == 0
    # NOT IN an empty set is true, even for a NULL probe.
    assert exclude_keys(probe, "k", empty, "k").count() == 3


def test_missing_in_range(spark):
    present = spark.createDataFrame([(w,) for w in range(13, 37)], "week_number int")
    missing = [r[0] for r in missing_in_range(spark, present, "week_number", 1, 53).collect()]
    assert sorted(missing) == list(range(1, 13)) + list(range(37, 54))
    with_null = present.union(spark.createDataFrame([(None,)], "week_number int"))
    assert missing_in_range(spark, with_null, "week_number", 1, 53).count() == 0


def test_validate_rows(spark):
    df = spark.createDataFrame(
        [(1, 4, None), (2, 0, None), (3, None, dt.datetime(2021, 1, 1)), (None, 6, None)],
        "order_id int, rating int, t timestamp_ntz")
    valid, bad = validate_rows(df, not_null=["order_id", "rating"],
                               checks={"rating 1-5": F.col("rating").between(1, 5)},
                               defaults={"t": F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")})
    assert rows(valid) == [(1, 4, dt.datetime(2000, 1, 1))]
    assert rows(bad, "order_id", "violation") == [
        (2, "rating 1-5"), (3, "rating is null"), (None, "order_id is null"), (None, "rating 1-5")]


def test_period_sums_and_totals(spark):
    df = spark.createDataFrame([("x", 1, 10), ("x", 2, 20), ("y", 2, 5)], "k string, w int, s long")
    out = period_sums(df, "s", {"before": F.col("w") == 1, "after": F.col("w") == 2}, ["k"])
    assert rows(out, "k", "before", "after") == [("x", 10, 20), ("y", None, 5)]
    assert rows(totals_by(df, ["k"], total=F.sum("s"))) == [("x", 30), ("y", 5)]


def test_tiered_value_and_share(spark):
    df = spark.createDataFrame([("a", 1, 3), ("b", 2, 0), ("c", None, 4)], "name string, p long, w long")
    price = tiered_value([(F.col("name") == "a", 12), (F.col("name") == "b", 10)], 0)
    out = df.select("name", price.alias("price"), share_pct("p", "w").alias("pct"))
    assert rows(out) == [("a", 12, 33.33), ("b", 10, None), ("c", 0, None)]


def test_success_rate(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "cancel"), (2, 3, None)], "r int, o int, c string")
    out = success_rate(df, "r", F.col("c").isNull(), "o")
    assert rows(out) == [(1, 2, 1, 50.0), (2, 1, 1, 100.0)]


def test_explode_ids_and_append(spark):
    df = spark.createDataFrame([("x", ["1", "5"]), ("y", [])], "k string, ids array<string>")
    out = explode_ids(df, F.col("ids"), "tid", position="pos")
    assert rows(out, "k", "pos", "tid") == [("x", 0, "1"), ("x", 1, "5")]
    both = append_rows(df.select("k"), df.select("k"))
    assert both.count() == 4


def test_compose_list(spark):
    from storefront.operators import compose_list
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "c", 0), (2, "z", 0)], "k int, name string, pos int")
    assert rows(compose_list(df, ["k"], "name", "lst")) == [(1, "a, b, c"), (2, "z")]
    assert rows(compose_list(df, ["k"], "name", "lst", order_by="pos", separator="|")) == [(1, "c|a|b"), (2, "z")]


def test_top_by_count_keeps_ties(spark):
    from storefront.operators import top_by_count
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("A", "y"), ("B", "x"), ("B", "y")], "c string, item string")
    assert rows(top_by_count(df, "c", "item")) == [("A", "x", 2), ("B", "x", 1), ("B", "y", 1)]


def test_before_after_windows(spark):
    from storefront.operators import before_after
    base = D(2020, 6, 15)
    weeks = [D(2020, 5, 18), D(2020, 6, 8), D(2020, 6, 15), D(2020, 7, 6), D(2020, 7, 13), D(2020, 5, 11)]
    df = spark.createDataFrame([(w, 1) for w in weeks], "week_date date, sales long")
    half_open = before_after(df, "week_date", "sales", base, 4).first()
    closed = before_after(df, "week_date", "sales", base, 4, closed_after=True).first()
    assert (half_open["before_sales"], half_open["after_sales"]) == (2, 2)
    assert (closed["before_sales"], closed["after_sales"]) == (2, 3)
