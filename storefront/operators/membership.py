"""Sales placed against membership: a start date, or any number of dated periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.operators.asof import carry_forward


def with_membership(sales: DataFrame, members: DataFrame, side: str | None = None,
                    date_col: str = "order_date", key: str = "customer_id") -> DataFrame:
    """Join sales to members on the customer and keep one side of the join date.

    ``side``: ``"before"`` (strictly before joining), ``"on_or_after"``, or
    ``None`` (all sales of members). The date test is a residual filter on
    an equi-join, so it stays a hash / sort-merge join.
    """
    joined = sales.join(members, key)
    if side == "before":
        return joined.filter(F.col(date_col) < F.col("join_date"))
    if side == "on_or_after":
        return joined.filter(F.col(date_col) >= F.col("join_date"))
    if side is None:
        return joined
    raise ValueError(f"unknown side {side!r}")


def with_periods(sales: DataFrame, periods: DataFrame, side: str | None = None, date_col: str = "order_date",
                 key: str = "customer_id") -> DataFrame:
    """Sales of customers who have periods, each with ``since`` (the latest
    start not after the sale), ``until`` (the latest end of the periods begun by
    then, NULL if one is open) and ``inside``.

    ``periods`` are rows (``key``, ``start_date``, ``end_date``): several per
    customer, which may overlap; from the start up to but without the end, NULL
    meaning open. ``side``: ``"inside"`` (in some period), ``"outside"``, ``"before"``
    (before the first start), or ``None`` (all)."""
    day = F.col(date_col)
    begun = {"since": F.col("start_date"),
             "_until": F.struct(F.col("end_date").isNull().alias("open"), F.col("end_date").alias("end"))}
    held = sales.join(periods.filter(F.col("start_date").isNotNull()).select(key).distinct(), key, "left_semi")
    found = carry_forward(held, periods, key, date_col, "start_date", begun)
    inside = F.coalesce(F.col("_until.open") | (F.col("_until.end") > day), F.lit(False))
    found = found.select("*", F.col("_until.end").alias("until"), inside.alias("inside")).drop("_until")
    if side is None:
        return found
    sides = {"inside": F.col("inside"), "outside": ~F.col("inside"), "before": F.col("since").isNull() & day.isNotNull()}
    if side not in sides:
        raise ValueError(f"unknown side {side!r}")
    return found.filter(sides[side])
