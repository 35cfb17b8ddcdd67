"""Before/after period totals as conditional sums in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def period_sums(df: DataFrame, measure: Column | str, periods: Mapping[str, Column],
                keys: Sequence[str] = ()) -> DataFrame:
    """One column per period: the sum of ``measure`` over rows in the period
    (NULL when no row falls in it). A single scan and aggregation serves all
    periods; without ``keys`` it is a one-row global aggregate."""
    m = F.col(measure) if isinstance(measure, str) else measure
    aggs = [F.sum(F.when(cond, m)).alias(name) for name, cond in periods.items()]
    return df.groupBy(*keys).agg(*aggs)


def before_after(df: DataFrame, date_col: str, measure: Column | str, baseline: date, weeks: int,
                 closed_after: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Totals of ``measure`` in the ``weeks`` weeks before ``baseline``
    (``before_sales``) and from it on (``after_sales``).

    The before window is [baseline - weeks, baseline). The after window is
    [baseline, baseline + weeks), or closed at both ends with
    ``closed_after`` - one more week start, as a ``<=`` bound gives."""
    d = F.col(date_col)
    base = F.lit(baseline)
    start, end = F.lit(baseline - timedelta(weeks=weeks)), F.lit(baseline + timedelta(weeks=weeks))
    after = (d >= base) & ((d <= end) if closed_after else (d < end))
    return period_sums(df, measure, {"before_sales": (d < base) & (d >= start), "after_sales": after}, keys)
