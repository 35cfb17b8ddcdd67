"""The most frequent items among very many, counted exactly for candidates only.

Counting every item shuffles one row an item and task, most of them for items
that cannot win. Each task instead keeps a bounded number of counters (Misra
and Gries: when there are too many, all lose the count of the greatest one
that has to go). What an item lost is known, so the summed counters tell which
items can be among the first; those alone are counted exactly in a second pass. If some item
without a counter could still reach the last place, nothing is guessed: all
items are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.operators.ranking import top_overall
from storefront.sources.sinks import create_table_as


def shrink(counts: dict, capacity: int) -> tuple[dict, int]:
    """At most ``capacity`` counters, and how much every count has lost."""
    if len(counts) <= capacity:
        return counts, 0
    lost = sorted(counts.values(), reverse=True)[capacity]
    return {item: n - lost for item, n in counts.items() if n > lost}, lost


def _counters(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        lost = 0
        for batch in batches:
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
            counts, more = shrink(counts, capacity)
            lost += more
        names = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([*names, None], pa.string()), pa.array([*counts.values(), 0], pa.int64()),
                                          pa.array([0] * len(names) + [lost], pa.int64())], ["item", "n", "lost"])
    return run


def heavy_candidates(df: DataFrame, item: str, k: int, capacity: int) -> tuple[DataFrame, int]:
    """(item) of all items that may be among the first ``k``, and the greatest
    count that any item outside them can have. NULL items are not counted."""
    made = df.filter(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"))
    counted = create_table_as(df.sparkSession, made.mapInArrow(_counters(capacity), "item string, n long, lost long"), "counters")
    lost = counted.agg(F.coalesce(F.sum("lost"), F.lit(0))).first()[0]
    sums = counted.filter("item IS NOT NULL").groupBy("item").agg(F.sum("n").alias("n"))
    kth = sums.orderBy(F.desc("n")).limit(k).agg(F.min("n"), F.count(F.lit(1))).first()
    least = kth[0] if kth[1] == k else 0
    # A true count lies between the sum of the counters and that plus all that was lost.
    return sums.filter(F.col("n") + F.lit(lost) >= F.lit(least)).select("item"), max(lost, 0)


def top_heavy(df: DataFrame, item: str, k: int = 1, capacity: int = 10_000, count: str = "n") -> DataFrame:
    """The ``k`` most frequent values of the text column ``item`` with their
    exact counts; ties in the order of the values."""
    candidates, outside = heavy_candidates(df, item, k, capacity)
    known = df.filter(F.col(item).isNotNull())
    order = [F.desc(count), F.asc(item)]
    exact = known.join(candidates.withColumnRenamed("item", item), item, "left_semi").groupBy(item).agg(F.count(F.lit(1)).alias(count))
    best = create_table_as(df.sparkSession, top_overall(exact, order, k), "top")
    last = best.agg(F.min(count), F.count(F.lit(1))).first()
    # An item outside the candidates has at most what all counters lost (or, beside a sure candidate, less than the k-th).
    if outside == 0 or (last[1] == k and last[0] > outside):
        return best
    return top_overall(known.groupBy(item).agg(F.count(F.lit(1)).alias(count)), order, k)
