"""Totals of any period from running totals.

A table of running totals per key and date, stored once, answers every period
as the difference of two look-ups: the total up to its last day minus the total
up to the day before its first. The look-ups are an as-of join of a few rows a
key and period; the sales themselves are not read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.operators.asof import as_of
from storefront.sources.sinks import create_table_as


def running_totals(df: DataFrame, keys: Sequence[str], at: str, measure: Column, name: str = "running-totals") -> DataFrame:
    """(``area``, a struct of ``keys``; ``at``; ``upto``, ``rows_upto``): the sum of
    ``measure`` and the number of rows up to each date at which a key has rows,
    written to the shared folder. Rows are summed per key and date first, so
    a key's running sum goes over its dates only. Rows without a date are in no
    period and left out."""
    area = F.struct(*[F.col(k) for k in keys]).alias("area")
    days = df.filter(F.col(at).isNotNull()).groupBy(area, F.col(at)).agg(F.sum(measure).alias("s"), F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("area").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return create_table_as(df.sparkSession, days.select("area", at, F.sum("s").over(upto).alias("upto"), F.sum("n").over(upto).alias("rows_upto")), name)


def period_totals(totals: DataFrame, at: str, periods: Mapping[str, tuple[date, date]]) -> DataFrame:
    """Per area, one column per period (first day, day after the last): the
    period's total, NULL where the area has no row in it."""
    edges = sorted({d - timedelta(days=1) for p in periods.values() for d in p})
    asked = totals.select("area").distinct().select("area", F.explode(F.array(*[F.lit(d) for d in edges])).alias("day"))
    found = as_of(asked, totals, "area", "day", at, ["upto", "rows_upto"])
    sums, counts = {}, {}
    for d in edges:
        here = F.col("day") == F.lit(d)
        sums[d] = F.max(F.when(here, F.coalesce("upto", F.lit(0))))
        counts[d] = F.max(F.when(here, F.coalesce("rows_upto", F.lit(0))))
    columns = []
    for name, (first, after) in periods.items():
        low, high = first - timedelta(days=1), after - timedelta(days=1)
        columns.append(F.when(counts[high] > counts[low], sums[high] - sums[low]).alias(name))
    return found.groupBy("area").agg(*columns)
