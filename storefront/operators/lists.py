"""Delimited text lists as arrays: explode to rows, and substring candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_ids(df: DataFrame, ids: Column, out: str = "item_id", position: str | None = None) -> DataFrame:
    """One row per element of the array ``ids`` (rows with empty/NULL lists
    vanish). With ``position`` the 0-based element index is kept too."""
    if position:
        return df.select("*", F.posexplode(ids).alias(position, out))
    return df.select("*", F.explode(ids).alias(out))


def substrings(text: Column, lengths: Column) -> Column:
    """All distinct substrings of ``text`` with one of ``lengths`` (an array;
    empty array for '' or NULL text).

    A join ``text LIKE '%' || key || '%'`` for keys without wildcards is the
    same as an equi-join of ``key`` against these substrings, so a theta
    (nested-loop) join becomes a hash join. With the lengths that occur
    among the keys nothing is lost, and the list grows in proportion to the text."""
    n = F.coalesce(F.length(text), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    fitting = F.filter(lengths, lambda j: (j >= 1) & (j <= n))
    per_length = F.transform(fitting, lambda j: F.transform(
        F.filter(starts, lambda i: i + j - 1 <= n), lambda i: F.substring(text, i, j)))
    return F.array_distinct(F.flatten(per_length))


def compose_list(df: DataFrame, keys: Sequence[str], item: Column | str, out: str,
                 separator: str = ", ", order_by: Column | str | None = None) -> DataFrame:
    """Ordered string aggregate: per ``keys``, the ``item`` values joined by
    ``separator``, sorted by ``order_by`` (default: the items themselves;
    equal sort keys are ordered by the item text).

    The list of a group is built in one task, so use it where the group
    size is bounded by the data's shape (ids of one recipe, names of one
    list), or pre-aggregate first."""
    item = F.col(item) if isinstance(item, str) else item
    key = item if order_by is None else (F.col(order_by) if isinstance(order_by, str) else order_by)
    collected = F.array_sort(F.collect_list(F.struct(key.alias("k"), item.alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(collected, lambda e: e["v"]), separator).alias(out))
