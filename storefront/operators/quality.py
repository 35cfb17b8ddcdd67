"""Row validation against declared table rules, and appends.

Parquet tables carry no constraints, so the rules of a declared table (NOT
NULL, CHECK, DEFAULT, VARCHAR(n), PRIMARY KEY) are applied when rows arrive: as a
distributed filter, and for keys as a grouped count joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate_rows(df: DataFrame, not_null: Sequence[str] = (),
                  checks: Mapping[str, Column] | None = None,
                  defaults: Mapping[str, Column] | None = None,
                  max_length: Mapping[str, int] | None = None,
                  key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (valid rows, violations).

    A NOT NULL rule fails on NULL. A CHECK rule fails only when its
    condition is FALSE (NULL passes, as in SQL). A length rule fails on texts
    longer than allowed. A key fails on NULL in a key column, and on every
    row whose key occurs more than once. Valid rows get ``defaults`` filled in
    for NULLs; violations are one row per (row, failed rule) with the rule
    name in ``violation``.
    """
    rules = [(f"{c} is null", F.col(c).isNull()) for c in not_null]
    rules += [(name, F.coalesce(~cond, F.lit(False))) for name, cond in (checks or {}).items()]
    rules += [(f"{c} longer than {n}", F.coalesce(F.length(c) > n, F.lit(False))) for c, n in (max_length or {}).items()]
    columns = df.columns
    if key:
        rules += [(f"{c} is null", F.col(c).isNull()) for c in key if c not in not_null]
        repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        df = df.join(repeated, list(key), "left")
        rules.append((f"{', '.join(key)} not unique", F.col("_n").isNotNull()))
    failed = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]),
                      lambda r: r.isNotNull())
    marked = df.withColumn("_failed", failed)
    valid = marked.filter(F.size("_failed") == 0).select(*columns)
    for c, value in (defaults or {}).items():
        valid = valid.withColumn(c, F.coalesce(F.col(c), value))
    violations = marked.select(*columns, F.explode("_failed").alias("violation"))
    return valid, violations


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``INSERT``: the rows of ``rows`` after those of ``df``, matched by name
    and cast to the table's types. Columns left out are NULL; a column the
    table does not have is an error, as is a value its type cannot hold."""
    unknown = set(rows.columns) - set(df.columns)
    if unknown:
        raise ValueError(f"not columns of the table: {sorted(unknown)}")
    typed = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]
    return df.unionByName(rows.select(*typed))


def insert_values(df: DataFrame, values: Sequence[Mapping[str, object]]) -> DataFrame:
    """``INSERT ... VALUES``: rows the caller supplies as mappings from column
    to value, which may be quoted (texts are cast to the column's type)."""
    rows = [tuple(None if (v := row.get(c)) is None else str(v) for c in df.columns) for row in values]
    unknown = {c for row in values for c in row} - set(df.columns)
    if unknown:
        raise ValueError(f"not columns of the table: {sorted(unknown)}")
    texts = ", ".join(f"`{c}` string" for c in df.columns)
    return append_rows(df, df.sparkSession.createDataFrame(rows, texts))
