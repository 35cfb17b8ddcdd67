"""As-of joins: every row with what the dated changes up to its time have left.

Rows and changes are merged by time and the state is carried along, as a
running maximum, within one key and time bucket at a time. What a bucket opens
with comes from one row a key and earlier bucket. So a row meets only the
changes of its own bucket, work grows with rows plus changes (never with
their product), and a key that holds a third of all rows is spread over its
buckets. A bucket is sorted, not collected: it may spill.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 32


def _bucket(at: Column, days: int) -> Column:
    return F.floor(F.datediff(at, F.lit("1970-01-01").cast("date")) / F.lit(days))


def carry_forward(rows: DataFrame, changes: DataFrame, key: str, at: str, changed_at: str, states: Mapping[str, Column],
                  days: int = BUCKET_DAYS) -> DataFrame:
    """``rows`` with one column per state: the greatest value of its expression
    over the changes of the row's ``key`` whose ``changed_at`` is not after the
    row's ``at``; NULL where there is none.

    A struct that begins with ``changed_at`` gives the last change (``as_of``).
    Rows without key or time have no state; changes without one, and NULL
    states, count for nothing; repeated rows stay repeated."""
    names = list(states)
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    state = F.struct(*[states[n].alias(f"_{i}") for i, n in enumerate(names)])
    asked = rows.filter(known).select(F.col(key).alias("_key"), F.col(at).alias("_at"), _bucket(F.col(at), days).alias("_bucket"), row)
    told = (changes.filter(F.col(key).isNotNull() & F.col(changed_at).isNotNull())
            .select(F.col(key).alias("_key"), F.col(changed_at).alias("_at"), _bucket(F.col(changed_at), days).alias("_bucket"),
                    state.alias("_state")))
    each = [f"_{i}" for i in range(len(names))]
    greatest = [F.max(f"_state.{c}").alias(c) for c in each]

    # One row a key and bucket: what its changes leave, and whether rows ask there.
    left = told.groupBy("_key", "_bucket").agg(*greatest).withColumn("_asks", F.lit(False))
    blank = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in each]
    asks = asked.select("_key", "_bucket").distinct().select("_key", "_bucket", *blank, F.lit(True).alias("_asks"))
    buckets = left.unionByName(asks).groupBy("_key", "_bucket").agg(*[F.max(c).alias(c) for c in each], F.max("_asks").alias("_asks"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    opening = buckets.select("_key", "_bucket", "_asks", *[F.max(c).over(before).alias(c) for c in each]).filter("_asks")

    no_row = F.lit(None).cast(asked.schema["_row"].dataType).alias("_row")
    no_time = F.lit(None).cast(asked.schema["_at"].dataType).alias("_at")
    merged = (asked.select("_key", "_bucket", "_at", *blank, F.lit(1).alias("_kind"), "_row")
              .unionByName(told.select("_key", "_bucket", F.col("_at").cast(asked.schema["_at"].dataType), *[F.col(f"_state.{c}").alias(c) for c in each],
                                       F.lit(0).alias("_kind"), no_row))
              .unionByName(opening.select("_key", "_bucket", no_time, *each, F.lit(0).alias("_kind"), no_row)))
    upto = (Window.partitionBy("_key", "_bucket").orderBy(F.col("_at").asc_nulls_first(), "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (merged.select("_kind", "_row", *[F.max(c).over(upto).alias(c) for c in each]).filter("_kind = 1")
             .select("_row.*", *[F.col(c).alias(n) for c, n in zip(each, names, strict=True)]))
    return found.unionByName(rows.filter(~known).select("*", *[b.alias(n) for b, n in zip(blank, names, strict=True)]))


def as_of(rows: DataFrame, changes: DataFrame, key: str, at: str, changed_at: str, columns: Sequence[str],
          days: int = BUCKET_DAYS) -> DataFrame:
    """``rows`` with ``columns`` of the last change at or before them (NULLs
    without one). Of changes at the same time the greatest values win."""
    last = F.struct(F.col(changed_at).alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    found = carry_forward(rows, changes, key, at, changed_at, {"_as_of": last}, days)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_as_of.v{i}").alias(c) for i, c in enumerate(columns)])
