"""Distinct counts that roll up.

``COUNT(DISTINCT)`` of a month does not follow from those of its days. Sets do:
the ids of a period are kept as bitmaps of 32,768 ids each, which merge by OR
from day to month to all. The counts are exact, every level comes from one
pass over the rows, and stored bitmaps can be merged with later ones. A
period's bitmaps take 4 KB for every 32,768 ids of the range in use, so ids
should be dense integers (``number_rows`` makes them).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sets(df: DataFrame, value: str, keys: Mapping[str, Column]) -> DataFrame:
    """(``keys``, ``bucket``, ``ids``): the different values per key as bitmaps.
    NULL values are in no set. Each task sets its bits before the shuffle, so a
    key with a third of all rows is a few bitmaps a task."""
    v = F.col(value)
    named = df.filter(v.isNotNull()).select(*[c.alias(n) for n, c in keys.items()], F.bitmap_bucket_number(v).alias("bucket"),
                                            F.bitmap_bit_position(v).alias("_bit"))
    return named.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_bit").alias("ids"))


def merge_sets(sets: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """``sets`` merged to coarser ``keys``."""
    named = sets.select(*[c.alias(n) for n, c in keys.items()], "bucket", "ids")
    return named.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def count_sets(sets: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """How many different values each key has."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(out))


def distinct_by_levels(df: DataFrame, value: str, finest: Column, levels: Mapping[str, Column], out: str = "n") -> DataFrame:
    """(``level``, ``period``, ``out``): distinct values per period of every
    level. ``levels`` are expressions of ``period``, the text of the finest one;
    the rows are read once, coarser levels are made of the finest's sets."""
    sets = distinct_sets(df, value, {"period": finest})
    each = F.array(*[F.struct(F.lit(name).alias("level"), expr.cast("string").alias("period")) for name, expr in levels.items()])
    rolled = merge_sets(sets.select(F.explode(each).alias("_to"), "bucket", "ids"), {"level": F.col("_to.level"), "period": F.col("_to.period")})
    return count_sets(rolled, ["level", "period"], out)
