"""Grouped totals, conditional sums and shares.

Every aggregate here is algebraic (sum/count/min/max), so Spark computes a
partial aggregate before the shuffle: a key holding a third of all rows is
reduced map-side and never reaches one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_by(df: DataFrame, keys: Sequence, **aggs: Column) -> DataFrame:
    """``groupBy(keys).agg(...)`` with every output named by its keyword."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])


def tiered_value(tiers: Sequence[tuple[Column, object]], default) -> Column:
    """Searched CASE: the value of the first tier whose condition holds."""
    out = None
    for cond, value in tiers:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def share_pct(part, whole, digits: int | None = 2) -> Column:
    """``part * 100 / whole`` in double precision, rounded to ``digits``;
    NULL when ``whole`` is 0 or NULL."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    pct = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return pct if digits is None else F.round(pct, digits)


def success_rate(df: DataFrame, key: str, ok: Column, id_col: str) -> DataFrame:
    """Per ``key``: rows with ``id_col``, rows where ``ok`` holds, and the
    percentage of the second in the first."""
    counts = df.groupBy(key).agg(
        F.count(id_col).alias("total_deliveries"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("successful_deliveries"),
    )
    pct = F.try_divide(F.col("successful_deliveries").cast("double"),
                       F.col("total_deliveries").cast("double")) * F.lit(100.0)
    return counts.withColumn("successful_delivery_percentage", pct)
