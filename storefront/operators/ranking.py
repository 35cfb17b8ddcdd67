"""Rows at an extreme per entity, and top-k overall.

``rows_at_extreme`` keeps ties and reads its input once. Rows are ranked within
(entity, salt) first, where Spark drops losers before the shuffle
(``WindowGroupLimit``) and a hot entity is spread over the salts; the winners
of the salts are then ranked within the entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def rows_at_extreme(df: DataFrame, entity: Sequence[str] | str, value: str,
                    first: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``value`` is the minimum (``first``) or maximum of
    their entity; all tied rows are kept, duplicates too."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    order = F.col(value).asc() if first else F.col(value).desc()
    # The salt comes from the other columns: a date would keep each day's rows together.
    others = [F.col(c) for c in df.columns if c not in (*keys, value)]
    salted = df.filter(F.col(value).isNotNull() & F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))) \
        .withColumn("_salt", F.pmod(F.xxhash64(*others) if others else F.lit(0), F.lit(SALTS)))
    for partition in ([*keys, "_salt"], keys):
        place = F.rank().over(Window.partitionBy(*partition).orderBy(order))
        salted = salted.withColumn("_rank", place).filter(F.col("_rank") == 1)
    return salted.drop("_salt", "_rank")


def top_overall(df: DataFrame, order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows in ``order`` (ties broken by the later columns).

    Spark plans this as TakeOrderedAndProject: each partition keeps its own
    top k, only k rows per partition reach the final merge."""
    return df.orderBy(*order).limit(k)


def top_by_count(df: DataFrame, entity: Sequence[str] | str, item: Sequence[str] | str,
                 count: str = "n", counted: Column | None = None) -> DataFrame:
    """Per ``entity``, the ``item`` value(s) counted most often (ties kept),
    with their count. Counting is a partial aggregate; the winners are kept
    by ``rows_at_extreme`` on the counts."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    items = [item] if isinstance(item, str) else list(item)
    measure = F.count(F.lit(1)) if counted is None else F.count(counted)
    counts = df.groupBy(*keys, *items).agg(measure.alias(count))
    return rows_at_extreme(counts, keys, count, first=False).select(*keys, *items, count)
