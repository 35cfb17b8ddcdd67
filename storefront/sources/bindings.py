"""Domain views bound onto the driver's test tables.

The analyses are phrased over a shop's own tables (sales, menu, members,
customer orders, runner orders, weekly sales). The test data is a TPC-H style
star schema, so each domain table is a lazily defined DataFrame over it. The
same definitions exist as SQL text in ``storefront.oracle_views`` for the DuckDB
cross-check; the two must stay in step.

No join carries a broadcast hint. Spark broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-checks that against the real shuffle sizes at runtime; anything larger
falls back to a sort-merge join. So the 25-row ``nation`` table is broadcast
while ``part`` or ``customer`` at a large scale factor are not.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.constants import BASELINE, CANCELLED_TEXT, MEMBER_PRIORITY, YEAR_LABELS
from storefront.sources.tables import read_table


def _text(c) -> F.Column:
    return c.cast("string")


class Domain:
    """The domain tables of one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, year_labels=YEAR_LABELS, baseline=BASELINE):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        # The shop's calendar as the mart analyses read it: the three year
        # labels (any other year falls into the last) and the baseline week.
        self.year_labels = tuple(year_labels)
        self.baseline = baseline

    # The domain tables, as the analyses read them.
    DOMAIN_TABLES = ("sales", "menu", "members", "membership_periods", "customer_orders", "pizza_names", "pizza_recipes",
                     "pizza_toppings", "runner_orders", "runners", "raw_ratings", "weekly_sales")

    @classmethod
    def from_frames(cls, spark: SparkSession, year_labels=YEAR_LABELS, baseline=BASELINE,
                    **frames: DataFrame) -> Domain:
        """A domain over a shop's own tables given as DataFrames (any subset of
        ``DOMAIN_TABLES``); the analyses that read only those tables run on
        them unchanged. An analysis that needs a table not given fails with
        a message naming it (nothing falls back to the test tables)."""
        unknown = set(frames) - set(cls.DOMAIN_TABLES)
        if unknown:
            raise ValueError(f"not domain tables: {sorted(unknown)}")
        domain = cls(spark, "", year_labels, baseline)
        domain._frames_only = True
        for name, df in frames.items():
            domain.__dict__[name] = df  # takes the place of the derived view
        return domain

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, names: tuple[str, ...],
                     year_labels=YEAR_LABELS, baseline=BASELINE) -> Domain:
        """A domain over ``<folder>/<name>.parquet`` for each of ``names``."""
        return cls.from_frames(spark, year_labels, baseline, **{n: read_table(spark, folder, n) for n in names})

    _frames_only = False

    def table(self, name: str) -> DataFrame:
        """The Parquet table ``name``, listed once per domain (a plan that
        uses a table twice shares one relation; Spark re-aliases self-joins)."""
        if self._frames_only:
            given = sorted(k for k in self.DOMAIN_TABLES if k in self.__dict__)
            raise LookupError(f"this analysis needs a domain table that was not given (given: {given})")
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # ---- shared expressions -------------------------------------------
    @staticmethod
    def _order_time(key="o_orderkey", day="o_orderdate"):
        # Test order dates are midnight-only; spread them over the day.
        return F.timestamp_add("MINUTE", F.col(key) % 1440, F.col(day))

    # ---- loyalty -------------------------------------------------------
    @cached_property
    def sales(self) -> DataFrame:
        """sales(customer_id, order_date, product_id): one row per line item."""
        items = self.table("lineitem").select("l_orderkey", "l_partkey")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    @cached_property
    def menu(self) -> DataFrame:
        """menu(product_id, product_name, price); names are not unique."""
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        )

    @cached_property
    def members(self) -> DataFrame:
        """members(customer_id, join_date): first top-priority order date."""
        return (
            self.table("orders")
            .filter(F.col("o_orderpriority") == MEMBER_PRIORITY)
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(F.min(F.to_date("o_orderdate")).alias("join_date"))
        )

    @cached_property
    def membership_periods(self) -> DataFrame:
        """membership_periods(customer_id, start_date, end_date): every
        top-priority order buys one to six times 30 days (some never end);
        periods of a customer may overlap."""
        start, k = F.to_date("o_orderdate"), F.col("o_orderkey")
        end = F.when(k % 40 != 0, F.date_add(start, (30 * (1 + k % 6)).cast("int")))
        return self.table("orders").filter(F.col("o_orderpriority") == MEMBER_PRIORITY).select(
            F.col("o_custkey").alias("customer_id"), start.alias("start_date"), end.alias("end_date"))

    # ---- fulfilment ----------------------------------------------------
    @cached_property
    def customer_orders(self) -> DataFrame:
        """customer_orders(order_id, customer_id, pizza_id, exclusions, extras,
        order_time) with three encodings of 'nothing': NULL, '' and 'null'."""
        return self._customer_orders(self.table("lineitem"), self.table("orders"))

    def dealt(self, df: DataFrame, partitions: int, *keys: str) -> DataFrame:
        """``df`` shuffled by ``keys`` into ``partitions`` (``spark.sql.shuffle.partitions``
        if that is more), which AQE does not merge: for plans that hold the rows
        of a task in memory several times."""
        return df.repartition(max(partitions, int(self.spark.conf.get("spark.sql.shuffle.partitions"))), *keys)

    def customer_orders_in(self, partitions: int) -> DataFrame:
        """The rows of ``customer_orders``, items and orders ``dealt`` by order.
        A table the caller gave is returned as it is."""
        if self._frames_only:
            return self.customer_orders
        return self._customer_orders(self.dealt(self.table("lineitem"), partitions, "l_orderkey"),
                                     self.dealt(self.table("orders"), partitions, "o_orderkey"))

    def _customer_orders(self, lineitem: DataFrame, orders: DataFrame) -> DataFrame:
        items = lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
        orders = orders.select("o_orderkey", "o_custkey", "o_orderdate")
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        part_mod = F.col("l_partkey") % 4
        supp_id = _text(F.col("l_suppkey") % 25)
        exclusions = (
            F.when((flag == "A") & (status == "F"), F.lit(""))
            .when((flag == "A") & (status == "O"), F.lit("null"))
            .when(flag == "R", F.concat(_text(F.col("l_linenumber")), F.lit(", "), supp_id))
        )
        extras = (
            F.when(part_mod == 1, F.lit(""))
            .when(part_mod == 2, F.lit("null"))
            .when(part_mod == 3, F.when(F.col("l_linenumber") % 2 == 1, supp_id)
                  .otherwise(F.concat(supp_id, F.lit(", "), _text(F.col("l_partkey") % 25))))
        )
        return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("pizza_id"),
            exclusions.alias("exclusions"),
            extras.alias("extras"),
            self._order_time().alias("order_time"),
        )

    @cached_property
    def pizza_names(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("pizza_id"), F.col("p_type").alias("pizza_name"))

    @cached_property
    def pizza_recipes(self) -> DataFrame:
        """pizza_recipes(pizza_id, toppings): two ids, ', ' or ',' separated."""
        first, second = _text(F.col("p_size") % 25), _text(F.col("p_partkey") % 25)
        sep = F.when(F.col("p_size") % 5 == 0, F.lit(",")).otherwise(F.lit(", "))
        return self.table("part").select(
            F.col("p_partkey").alias("pizza_id"),
            F.concat(first, sep, second).alias("toppings"),
        )

    @cached_property
    def pizza_toppings(self) -> DataFrame:
        """pizza_toppings(topping_id, topping_name): the 25-row nation table."""
        return self.table("nation").select(
            F.col("n_nationkey").alias("topping_id"), F.col("n_name").alias("topping_name"))

    @cached_property
    def runner_orders(self) -> DataFrame:
        """runner_orders: one row per order; distance and duration are free
        text in several shapes, cancelled orders carry a reason."""
        k = F.col("o_orderkey")
        cancelled = F.col("o_orderstatus") == "P"
        dist = _text(5 + k % 20)
        frac = _text(k % 10)
        distance = (
            F.when(k % 4 == 0, F.concat(dist, F.lit("."), frac, F.lit("km")))
            .when(k % 4 == 1, F.concat(dist, F.lit("km")))
            .when(k % 4 == 2, F.concat(dist, F.lit("."), frac))
            .otherwise(dist)
        )
        mins = _text(10 + k % 40)
        shape = (k / 4).cast("long") % 5
        duration = (
            F.when(shape == 0, F.concat(mins, F.lit(" minutes")))
            .when(shape == 1, F.lit("1 minute"))
            .when(shape == 2, F.concat(mins, F.lit(" mins")))
            .when(shape == 3, mins)
            .otherwise(F.concat(mins, F.lit(".5 minutes")))
        )
        # Cancelled runs have no measurements: NULL or the text 'null'.
        empty = F.when(k % 2 == 0, F.lit("null"))
        order_time = self._order_time()
        return self.table("orders").select(
            k.alias("order_id"),
            (k % 100).alias("runner_id"),
            F.timestamp_add("MINUTE", 10 + k % 47, order_time).alias("pickup_time"),
            F.when(cancelled, empty).otherwise(distance).alias("distance"),
            F.when(cancelled, empty).otherwise(duration).alias("duration"),
            F.when(cancelled, F.lit(CANCELLED_TEXT)).alias("cancellation"),
        )

    @cached_property
    def runners(self) -> DataFrame:
        """runners(runner_id, registration_date): first ship date per supplier."""
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("runner_id"))
            .agg(F.min(F.to_date("l_shipdate")).alias("registration_date"))
        )

    @cached_property
    def raw_ratings(self) -> DataFrame:
        """Incoming rating rows before validation, some of which break the rules;
        an order that was not cancelled has one, or two if its key is divisible by 4."""
        k = F.col("o_orderkey")
        order_time = self._order_time()
        first = F.struct(
            F.lit(1).alias("seq"),
            F.when(k % 13 == 0, F.lit(None)).otherwise(k % 100).alias("runner_id"),
            F.when(k % 11 == 0, F.lit(None)).otherwise(k % 7).cast("int").alias("rating"),
        )
        second = F.struct(
            F.lit(2).alias("seq"),
            (k % 100).alias("runner_id"),
            (1 + (k / 7).cast("long") % 5).cast("int").alias("rating"),
        )
        ratings = F.when(k % 4 == 0, F.array(first, second)).otherwise(F.array(first))
        rows = (
            self.table("orders")
            .filter(F.col("o_orderstatus") != "P")
            .select(k, "o_custkey", "o_orderpriority", order_time.alias("order_time"),
                    F.explode(ratings).alias("r"))
        )
        return rows.select(
            (k * 2 + F.col("r.seq") - 1).alias("rating_key"),
            k.alias("order_id"),
            F.col("r.runner_id").alias("runner_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("r.rating").alias("rating"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Fast and friendly")).alias("comment"),
            F.when(k % 3 == 0, F.lit(None))
            .otherwise(F.timestamp_add("HOUR", 1 + k % 24, F.col("order_time"))).alias("rating_time"),
        )

    # ---- weekly sales mart ---------------------------------------------
    @cached_property
    def weekly_sales(self) -> DataFrame:
        """weekly_sales(week_date 'd/M/yy' text, region, platform, segment,
        customer_type, transactions, sales): orders rolled up per Monday week."""
        return self._weekly(self.table("orders"))

    def weekly_sales_between(self, first: date, last: date) -> DataFrame:
        """The rows of ``weekly_sales`` whose week starts from ``first`` to
        ``last`` (others may be among them): a predicate on the order date that reaches the scan.
        A table the caller gave is returned as it is."""
        if "weekly_sales" in self.__dict__:
            return self.weekly_sales
        orders = self.table("orders")
        kind = orders.schema["o_orderdate"].dataType
        day = F.col("o_orderdate")
        return self._weekly(orders.filter((day >= F.lit(first).cast(kind)) & (day < F.lit(last + timedelta(days=7)).cast(kind))))

    def weekly_sales_in_weeks(self, low: int, high: int) -> DataFrame:
        """The rows of ``weekly_sales`` of ISO weeks ``low``..``high`` of every year
        (others may be among them), as ranges of the order date that reach
        the scan. Everything is kept if the weeks touch the turn of a year, or
        if two digits cannot tell the years. Reads the first and last date."""
        if "weekly_sales" in self.__dict__ or low < 2 or high > 51:
            return self.weekly_sales
        orders = self.table("orders")
        kind = orders.schema["o_orderdate"].dataType
        day = F.col("o_orderdate")
        first, last = orders.agg(F.min(F.year(day)), F.max(F.year(day))).first()
        if first is None or first < 1970 or last > 2069:
            return self.weekly_sales
        wanted = F.lit(False)
        for y in range(first, last + 1):
            start, end = date.fromisocalendar(y, low, 1), date.fromisocalendar(y, high, 1) + timedelta(days=7)
            wanted = wanted | ((day >= F.lit(start).cast(kind)) & (day < F.lit(end).cast(kind)))
        return self._weekly(orders.filter(wanted))

    def _weekly(self, orders: DataFrame) -> DataFrame:
        orders = orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        customers = self.table("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        nations = self.table("nation").select("n_nationkey", "n_regionkey")
        regions = self.table("region").select("r_regionkey", "r_name")
        digit = F.substring("o_orderpriority", 1, 1)
        seg = F.col("c_mktsegment")
        segment = (
            F.when(seg.isin("FURNITURE", "HOUSEHOLD"), F.concat(F.lit("F"), digit))
            .when(seg == "AUTOMOBILE", F.concat(F.lit("C"), digit))
            .when(seg == "BUILDING", digit)
        )
        rows = (
            orders.join(customers, orders.o_custkey == customers.c_custkey)
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.trunc(F.to_date("o_orderdate"), "week").alias("week_start"),
                F.col("r_name").alias("region"),
                F.when(F.col("o_orderstatus") == "F", F.lit("Retail")).otherwise(F.lit("Shopify")).alias("platform"),
                segment.alias("segment"),
                F.when(F.col("c_acctbal") < 5000, F.lit("New")).otherwise(F.lit("Existing")).alias("customer_type"),
                F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
            )
        )
        weekly = rows.groupBy("week_start", "region", "platform", "segment", "customer_type").agg(
            F.count(F.lit(1)).cast("int").alias("transactions"),
            F.floor(F.sum("price")).cast("long").alias("sales"),
        )
        return weekly.select(
            F.date_format("week_start", "d/M/yy").alias("week_date"),
            "region", "platform", "segment", "customer_type", "transactions", "sales",
        )
