"""Small in-code domain tables for golden tests.

``FixtureDomain`` builds a ``Domain`` whose tables are given DataFrames
instead of views over the Parquet test tables (``Domain.from_frames``).
"""

from __future__ import annotations

import datetime as dt

from storefront.sources.bindings import Domain


def FixtureDomain(spark, **tables) -> Domain:  # noqa: N802 - reads like the class it builds
    return Domain.from_frames(spark, **tables)


# ---- fixed values: the example rows embedded in the fulfilment statements --
EXAMPLE_ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 102, 3, "null", "null", "2020-01-12 19:45:00"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
]
EXAMPLE_NAMES = [(1, "Meatlovers"), (2, "Vegetarian"), (3, "Supreme")]
EXAMPLE_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12"), (3, "1,2,3,4,5,6,7,8,9,10,11,12")]
EXAMPLE_RATINGS = [
    (1, 1, 101, 4, "Good service"),
    (1, 1, 104, 3, "Nice delivery!!"),
    (2, 1, 101, 5, "Excellent delivery!"),
    (3, 1, 102, 3, "Average delivery"),
    (4, 2, 103, 5, "Great runner!"),
    (4, 3, 102, 4, "Awesome service"),
    (5, 3, 104, 4, "Fast and friendly"),
]


def fulfilment_domain(spark) -> FixtureDomain:
    orders = spark.createDataFrame(
        [(o, c, p, e, x, dt.datetime.fromisoformat(t)) for o, c, p, e, x, t in EXAMPLE_ORDERS],
        "order_id long, customer_id long, pizza_id long, exclusions string, extras string, "
        "order_time timestamp_ntz")
    names = spark.createDataFrame(EXAMPLE_NAMES, "pizza_id long, pizza_name string")
    recipes = spark.createDataFrame(EXAMPLE_RECIPES, "pizza_id long, toppings string")
    # Topping names are not part of the example rows: synthetic ones.
    toppings = spark.createDataFrame([(i, f"topping {i:02d}") for i in range(1, 13)],
                                     "topping_id int, topping_name string")
    ratings = spark.createDataFrame(
        [(k, o, r, c, v, m, None) for k, (o, r, c, v, m) in enumerate(EXAMPLE_RATINGS, start=1)],
        "rating_key long, order_id long, runner_id long, customer_id long, rating int, comment string, "
        "rating_time timestamp_ntz")
    # Runner rows are not part of the example rows: synthetic ones with the
    # text shapes of FIXTURES.md; order 10 has no runner row.
    first_time = {o: dt.datetime.fromisoformat(t) for o, _, _, _, _, t in reversed(EXAMPLE_ORDERS)}
    runs = [(1, 1, 10, "13.4km", "32 minutes", None), (2, 1, 12, "20km", "1 minute", None),
            (3, 2, 15, "23.4", "20 mins", None), (4, 2, 30, " 10 km", "15", None),
            (5, 3, 5, "12.5", "0", None), (6, 3, None, "null", "null", "Restaurant Cancellation"),
            (7, 2, 8, None, None, "Customer Cancellation"), (8, 1, 20, "7.5km", "10.5 minutes", None),
            (9, 3, 25, "9.0", "12", None)]
    runner_orders = spark.createDataFrame(
        [(o, r, None if m is None else first_time[o] + dt.timedelta(minutes=m), dist, dur, c)
         for o, r, m, dist, dur, c in runs],
        "order_id long, runner_id long, pickup_time timestamp_ntz, distance string, duration string, "
        "cancellation string")
    return FixtureDomain(spark, customer_orders=orders, pizza_names=names, pizza_recipes=recipes,
                         pizza_toppings=toppings, raw_ratings=ratings, runner_orders=runner_orders)


def loyalty_domain(spark) -> FixtureDomain:
    """Synthetic sales with the edge rows of FIXTURES.md: two items and a
    repeated item on the first date, a non-member, a member without sales
    before joining, purchases on the join date and on days 6 and 7, tied
    favourites, two products sharing a name, a named (double points) item."""
    d = dt.date
    menu = spark.createDataFrame(
        [(1, "soup", "10.00"), (2, "stew", "15.00"), (3, "pie", "12.00"), (4, "soup", "11.00"),
         (5, "red plate", "20.00")], "product_id long, product_name string, price string")
    menu = menu.selectExpr("product_id", "product_name", "cast(price as decimal(18,2)) as price")
    sales = spark.createDataFrame(
        [("X", d(2021, 1, 1), 1), ("X", d(2021, 1, 1), 2), ("X", d(2021, 1, 1), 2),
         ("X", d(2021, 1, 5), 5), ("X", d(2021, 1, 7), 3), ("X", d(2021, 1, 13), 4),
         ("X", d(2021, 1, 14), 1),
         ("Y", d(2021, 1, 9), 2), ("Y", d(2021, 1, 10), 5),
         ("Z", d(2021, 1, 3), 1), ("Z", d(2021, 1, 4), 3)],
        "customer_id string, order_date date, product_id long")
    members = spark.createDataFrame([("X", d(2021, 1, 7)), ("Y", d(2021, 1, 9))],
                                    "customer_id string, join_date date")
    return FixtureDomain(spark, sales=sales, menu=menu, members=members)


def mart_domain(spark) -> FixtureDomain:
    """Synthetic weekly rows with the edge cases of FIXTURES.md: one-digit
    month, century pivot, malformed date, every segment shape (C1, F2, '1',
    'null', NULL, ...), zero transactions, weeks on both sides of the 4-week
    bounds around the 1998-06-15 baseline, and a year outside the labels."""
    rows = [
        ("31/8/20", "ASIA", "Retail", "C1", "New", 10, 1005),
        ("1/12/99", "ASIA", "Shopify", "F2", "Existing", 3, 100),
        ("x/y/zz", "ASIA", "Retail", "C3", "New", 1, 1),
        ("15/6/98", "EUROPE", "Retail", "1", "New", 0, 50),
        ("8/6/98", "EUROPE", "Retail", "null", "New", 2, 7),
        ("13/7/98", "EUROPE", "Shopify", None, "New", 1, 20),
        ("20/7/98", "EUROPE", "Shopify", "F4", "New", 1, 30),
        ("18/5/98", "EUROPE", "Retail", "C3", "Existing", 4, 40),
        ("11/5/98", "EUROPE", "Retail", "C3", "Existing", 4, 60),
        ("3/3/97", "AFRICA", "Retail", "F4", "Existing", 5, 55),
        ("27/7/98", "EUROPE", "Retail", "C1", "New", 2, 80),
    ]
    ws = spark.createDataFrame(rows, "week_date string, region string, platform string, segment string, "
                                     "customer_type string, transactions int, sales long")
    return FixtureDomain(spark, weekly_sales=ws)
