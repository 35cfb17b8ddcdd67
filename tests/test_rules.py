"""Table rules, typed appends, table writes and list multiplicity."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from storefront.constants import RATINGS_LOADED_AT
from storefront.functions import extract_number
from storefront.operators import insert_values, missing_in_range_by, rows_at_extreme, validate_rows
from storefront.plans import fulfilment as ful
from storefront.schemas import CUSTOMER_ORDERS, RATINGS
from storefront.sources.sinks import create_table_as
from tests.conftest import rows

NOW = dt.datetime(2021, 1, 1)


def test_key_and_length_rules(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "abc"), (2, None), (None, "abcd"), (3, "abcde")], "k long, v string")
    valid, bad = validate_rows(df, key=["k"], max_length={"v": 4})
    assert rows(valid) == [(2, None)]
    assert rows(bad) == [(1, "ab", "k not unique"), (1, "abc", "k not unique"), (3, "abcde", "v longer than 4"), (None, "abcd", "k is null")]


def test_ratings_table_rules(spark):
    raw = spark.createDataFrame([("7", 1, 1, 1, 5, "ok", None), ("8", 1, 1, 1, 9, "ok", NOW), ("8", 2, 2, None, 4, None, NOW)],
                                "rating_key string, order_id int, runner_id int, customer_id int, rating int, comment string, rating_time timestamp_ntz")
    valid, bad = validate_rows(RATINGS.conform(raw), **RATINGS.rules())
    assert rows(valid) == [(7, 1, 1, 1, 5, "ok", dt.datetime.fromisoformat(RATINGS_LOADED_AT))]
    assert rows(bad.select("rating_key", "violation")) == [
        (8, "customer_id is null"), (8, "rating between 1 and 5"), (8, "rating_key not unique"), (8, "rating_key not unique")]
    with pytest.raises(ValueError):
        RATINGS.conform(raw.drop("rating"))


def test_supplied_rows_take_the_tables_types(spark):
    orders = spark.createDataFrame([], CUSTOMER_ORDERS.schema)
    got = insert_values(orders, [{"order_id": "1", "pizza_id": 2, "extras": "7, 7", "order_time": "2021-01-01 00:00:00"}])
    assert got.schema == orders.schema
    assert rows(got) == [(1, None, 2, None, "7, 7", NOW)]
    with pytest.raises(ValueError):
        insert_values(orders, [{"no_such_column": 1}])


def test_table_writes_need_a_shared_folder(spark, tmp_path, monkeypatch):
    df = spark.range(3)
    named = create_table_as(spark, df, "t", location=f"file://{tmp_path}/t")
    assert named.count() == 3
    first, second = create_table_as(spark, df, "t"), create_table_as(spark, df, "t")
    assert first.inputFiles() != second.inputFiles()
    from storefront.sources import sinks

    def unset(_):
        raise RuntimeError("set spark.checkpoint.dir")
    monkeypatch.setattr(sinks, "checkpoint_dir", unset)
    with pytest.raises(RuntimeError):
        create_table_as(spark, df, "t")


def test_numbers_that_do_not_fit_are_null(spark):
    df = spark.createDataFrame([("9" * 40 + " km",), ("1.234568km",)], "distance string")
    assert rows(df.select(extract_number("distance", to=ful.KM).cast("string").alias("v"))) == [("1.234568",), (None,)]


def test_missing_in_range_by_group(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (1, 3), (1, None), (2, None), (None, 1), (3, 9)], "g long, w long")
    assert rows(missing_in_range_by(df, "g", "w", 1, 3)) == [(1, 2), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3)]


def test_extremes_of_a_hot_entity(spark):
    df = spark.range(5000).select(F.lit("hot").alias("e"), (F.col("id") % 50).alias("d"), F.col("id").alias("x"))
    got = rows_at_extreme(df, "e", "d", first=False)
    assert sorted(r["x"] for r in got.collect()) == [i for i in range(5000) if i % 50 == 49]


def test_an_extra_listed_twice_counts_twice(spark):
    from storefront.sources.bindings import Domain
    frame = spark.createDataFrame
    shop = Domain.from_frames(
        spark,
        customer_orders=frame([(1, 1, 1, None, "7, 7", NOW)], CUSTOMER_ORDERS.schema),
        runner_orders=frame([(1, 1, NOW, "1km", "5 minutes", None)],
                            "order_id long, runner_id long, pickup_time timestamp_ntz, distance string, duration string, cancellation string"),
        pizza_names=frame([(1, "P")], "pizza_id long, pizza_name string"),
        pizza_recipes=frame([(1, "7")], "pizza_id long, toppings string"),
        pizza_toppings=frame([(7, "Beef")], "topping_id long, topping_name string"))
    assert rows(ful.revenue_with_extras_asked(shop, prices={"P": 12})) == [(14,)]
    assert rows(ful.ingredient_totals_asked(shop)) == [("Beef", 3)]
    assert rows(ful.top_extra_asked(shop)) == [("Beef", 2)]
    assert rows(ful.order_item_text_asked(shop)) == [(1, "P - Extra Beef, Beef")]
    assert rows(ful.ingredient_list_asked(shop)) == [(1, "P: 2xBeef")]
