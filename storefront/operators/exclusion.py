"""``NOT IN (subquery)`` with SQL's null-aware meaning, at any size.

Spark plans ``NOT IN`` as a null-aware anti join only when the subquery side
can be broadcast; otherwise it degrades to a nested-loop join. Here the same
truth table is spelled out so the heavy part is an ordinary (shuffled or
broadcast, as Spark decides) left-anti hash join:

    x NOT IN S  is TRUE  iff  S is empty, or
                              (x is not NULL, S holds no NULL and x is not in S)

S is reduced to its distinct values first, by a partial aggregate: a value
that a third of all rows hold is one row per task in the shuffle. The two facts about S (empty? holds a
NULL?) come from one count over S next to that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exclude_keys(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` where ``key NOT IN (SELECT other_key FROM other)``."""
    values = other.select(F.col(other_key).alias("_excluded_key")).distinct()
    kept = df.join(values, df[key] == values["_excluded_key"], "left_anti")
    # One row: how many values S has, and how many of them are not NULL.
    n, known = F.count(F.lit(1)), F.count("_excluded_key")
    verdict = values.agg(F.when(n == 0, "all").when(n > known, "none").otherwise("known")).scalar()
    return kept.filter((verdict == "all") | ((verdict == "known") & F.col(key).isNotNull()))


def missing_in_range(spark: SparkSession, values: DataFrame, col: str, low: int, high: int,
                     out: str = "current_value") -> DataFrame:
    """Integers ``low..high`` that do not occur in ``values[col]`` (NOT IN
    semantics: a NULL among the values empties the answer)."""
    numbers = spark.range(low, high + 1).select(F.col("id").alias(out))
    return exclude_keys(numbers, out, values, col)


def missing_in_range_by(values: DataFrame, group: str, col: str, low: int, high: int) -> DataFrame:
    """Per value of ``group``, the integers ``low..high`` that do not occur in
    ``col`` (NULLs among them are ignored, as by NOT EXISTS).

    Values are made distinct once, by a partial aggregate; each group then
    has at most one row per integer, which an array of them replaces."""
    inside = F.when(F.col(col).between(low, high), F.col(col).cast("long"))
    present = values.filter(F.col(group).isNotNull()).groupBy(group).agg(F.collect_set(inside).alias("_present"))
    every = F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"))
    return present.select(group, F.explode(F.array_except(every, "_present")).alias(col))
