"""Driver contract and coverage properties."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from storefront.plans import registry

# Literal / as-asked pairs that must give different answers on the test tables.
PAIRS = [
    ("post_join_items", "post_join_items_asked"), ("points_flat", "points_by_spend_asked"),
    ("points_join_week", "points_join_week_asked"),
    ("delivered_items_by_runner", "delivered_orders_by_runner_asked"),
    ("changed_items_by_customer", "changed_items_by_customer_asked"),
    ("both_changes_count", "both_changes_count_asked"), ("items_by_hour", "items_by_hour_asked"),
    ("items_by_dow", "orders_by_dow_asked"), ("signups_by_week", "signups_by_week_asked"),
    ("pickup_minutes_by_runner", "pickup_minutes_by_runner_asked"),
    ("distance_by_customer", "distance_by_customer_asked"),
    ("pickup_minutes_range", "duration_range_asked"), ("delivery_speed", "delivery_speed_asked"),
    ("top_exclusion_text", "top_exclusion_asked"), ("order_item_text", "order_item_text_asked"),
    ("ingredient_list", "ingredient_list_asked"), ("ingredient_totals", "ingredient_totals_asked"),
    ("revenue_with_extras", "revenue_with_extras_asked"), ("delivery_facts", "delivery_facts_asked"),
    ("runner_profit", "runner_profit_asked"), ("clean_weekly_sales", "clean_weekly_sales_asked"),
    ("avg_of_avg_transaction", "avg_transaction_asked"), ("before_after_4w", "before_after_4w_asked"),
    ("before_after_by_year", "before_after_12w_by_year_asked"), ("impact_by_area", "impact_by_area_asked"),
]
# Legitimately empty on the test tables: every ISO week 1..53 occurs in them.
MAY_BE_EMPTY = {"missing_weeks"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "amount_spent"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_queries_return_rows(spark, small_dir, key):
    n = entry.queries()[key](spark, small_dir).count()
    assert n > 0 or key in MAY_BE_EMPTY


@pytest.mark.parametrize("literal,asked", PAIRS)
def test_literal_and_asked_differ(spark, small_dir, literal, asked):
    q = entry.queries()
    a = {tuple(r) for r in q[literal](spark, small_dir).collect()}
    b = {tuple(r) for r in q[asked](spark, small_dir).collect()}
    assert a != b


def test_presentation_order(spark, small_dir):
    df = registry.ordered("impact_by_area", entry.queries()["impact_by_area"](spark, small_dir))
    diffs = [r["sales_difference"] for r in df.collect()]
    present = [d for d in diffs if d is not None]
    assert present == sorted(present)
    assert diffs[:len(present)] == present  # NULLs last when ascending
    assert registry.presentation_order("no_such_query") == []


def test_cli_lists_queries(capsys):
    from storefront.__main__ import main
    assert main([]) == 0
    listed = capsys.readouterr().out.splitlines()
    assert len(listed) == len(registry.queries())
    assert main(["no_such_query"]) == 2
