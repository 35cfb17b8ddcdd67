"""Properties that hold whatever the data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from storefront.plans import mart
from storefront.sources.bindings import Domain


def test_platform_shares_sum_to_100(spark, small_dir):
    df = entry.queries()["platform_share_by_month"](spark, small_dir)
    for r in df.collect():
        assert abs(r["retail_percentage"] + r["shopify_percentage"] - 100) <= 0.011


def test_demographic_shares_sum_to_100(spark, small_dir):
    for r in entry.queries()["demographic_share_by_year"](spark, small_dir).collect():
        total = r["couples_sales_percent"] + r["families_sales_percent"] + r["unknown_sales_percent"]
        assert abs(total - 100) <= 0.016


def test_periods_within_total(spark, small_dir):
    d = Domain(spark, small_dir)
    total = mart.clean_weekly_sales(d).filter("calendar_year = '1998'").groupBy().sum("sales").first()[0]
    for key in ("before_after_4w", "before_after_12w", "before_after_12w_asked"):
        r = entry.queries()[key](spark, small_dir).first()
        assert (r["before_sales"] or 0) + (r["after_sales"] or 0) <= total


def test_closed_window_holds_one_week_more(spark, small_dir):
    q = entry.queries()
    closed = q["before_after_4w"](spark, small_dir).first()
    half_open = q["before_after_4w_asked"](spark, small_dir).first()
    assert closed["before_sales"] == half_open["before_sales"]
    assert closed["after_sales"] >= half_open["after_sales"]


@pytest.mark.parametrize("key", ["post_join_items", "ingredient_list", "order_item_text_asked",
                                 "top_extra_like", "impact_by_area", "delivery_facts"])
def test_invariant_to_shuffle_partitions(spark, small_dir, key):
    fn = entry.queries()[key]
    before = sorted(map(tuple, fn(spark, small_dir).collect()), key=repr)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        after = sorted(map(tuple, fn(spark, small_dir).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == after


def test_mart_table_round_trip(spark, small_dir):
    d = Domain(spark, small_dir)
    written = mart.materialise_mart(d, "test_clean_weekly_sales")
    lazy = mart.clean_weekly_sales(d)
    cols = lazy.columns
    assert sorted(map(tuple, written.select(*cols).collect()), key=repr) == \
        sorted(map(tuple, lazy.collect()), key=repr)
    # Queries accept the written table in place of the lazy mart.
    a = mart.impact_by_area(d, mart=written).collect()
    b = mart.impact_by_area(d).collect()
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


@pytest.mark.parametrize("key", ["signups_by_week", "items_by_hour", "clean_weekly_sales", "weekday_of_week_date",
                                 "delivery_facts", "ratings_loaded", "before_after_12w"])
def test_independent_of_session_time_zone(spark, small_dir, key):
    fn = entry.queries()[key]
    utc = sorted(map(tuple, fn(spark, small_dir).collect()), key=repr)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = sorted(map(tuple, fn(spark, small_dir).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == other
