"""Dense numbers over a whole table, and what can be built on them, without
one task that sees every row.

Rows are sorted by range over all tasks and written once, each with its task
and its place there; a task's first number is the count of the rows before
it, which takes one row a task to know. ``row_number()`` over everything
would instead send the whole table through a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.sources.sinks import create_table_as

_PLACE_BITS = 33  # of monotonically_increasing_id: the row's place within its task


def _offsets(placed: DataFrame) -> DataFrame:
    """(task, offset): how many rows the tasks before hold. The running sums
    are taken over an array of one count a task."""
    counts = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    tasks = counts.agg(F.array_sort(F.collect_list(F.struct("_task", "n"))).alias("tasks"))
    start = F.array(F.struct(F.lit(-1).cast("long").alias("_task"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("upto")))
    step = lambda done, t: F.concat(done, F.array(F.struct(
        t["_task"].alias("_task"), F.element_at(done, -1)["upto"].alias("offset"), (F.element_at(done, -1)["upto"] + t["n"]).alias("upto"))))
    return tasks.select(F.explode(F.aggregate("tasks", start, step)).alias("t")).select("t._task", "t.offset").filter("_task >= 0")


def sorted_runs(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` dealt by range of ``order`` (NULLs last; then of its other columns,
    so that equal keys are spread), sorted and written, with each row's
    ``_task`` and ``_place``."""
    columns = [*order, *(c for c in df.columns if c not in order)]
    by = [F.asc_nulls_last(F.col(f"`{c}`")) for c in columns]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    return create_table_as(df.sparkSession, placed, name).withColumn("_task", F.shiftright("_place", _PLACE_BITS))


def number_rows(df: DataFrame, order: Sequence[str], out: str, start: Column | int = 1, name: str = "numbered") -> DataFrame:
    """``df`` with ``out``: ``start``, ``start`` + 1, ... without gaps, in the
    order of the columns ``order`` (NULLs last), ties in the order of the other
    columns. Rows equal in every column are alike, so a rerun gives the same
    table. Columns must be orderable.

    The sorted rows are written to the shared folder: a lost executor cannot
    change which task a row was counted in."""
    stored = sorted_runs(df, order, name)
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    first = start if isinstance(start, Column) else F.lit(start)
    return stored.join(_offsets(stored), "_task").select(*[F.col(f"`{c}`") for c in df.columns],
                                                        (first + F.col("offset") + place).cast("long").alias(out))


def append_numbered(table: DataFrame, rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``table`` and ``rows`` after it, numbered on from the greatest ``key`` of
    the table (a SERIAL key; 1 for an empty table)."""
    last = table.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    return table.unionByName(number_rows(rows, order, key, last + 1).select(*table.columns))


def compose_pieces(df: DataFrame, keys: Sequence[str], item: str, separator: str = ", ", order_by: Sequence[str] = (),
                   rows_a_piece: int = 4096, out: str = "text") -> DataFrame:
    """An ordered string aggregate as pieces of at most ``rows_a_piece`` items:
    ``keys``, ``piece`` (from 0), ``first_item`` (its number in the group, from
    0), ``items`` and ``out``. A group's pieces, joined by ``separator`` in their
    order, are the text that one aggregate would give; no task holds more of
    a group than a piece. Items are sorted by ``order_by``, then by themselves;
    NULL items are left out."""
    order = [*keys, *order_by, *([item] if item not in order_by else [])]
    numbered = number_rows(df.filter(F.col(item).isNotNull()).select(*dict.fromkeys([*keys, *order_by, item])), order, "_n", 0, "pieces")
    # Joined null-safe, written first: the group with a third of all rows can be split.
    marks = [F.col(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)]
    starts = create_table_as(df.sparkSession, numbered.groupBy(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)])
                             .agg(F.min("_n").alias("_start")), "group-starts")
    condition = marks[0]
    for m in marks[1:]:
        condition = condition & m
    at = F.col("_n") - F.col("_start")
    cut = numbered.join(starts, condition).withColumn("piece", F.floor(at / rows_a_piece).cast("long")).withColumn("_at", at)
    piece = F.array_sort(F.collect_list(F.struct("_at", F.col(item).cast("string").alias("v"))))
    return cut.groupBy(*keys, "piece").agg(F.min("_at").alias("first_item"), F.count(F.lit(1)).alias("items"),
                                           F.array_join(F.transform(piece, lambda e: e["v"]), separator).alias(out))
