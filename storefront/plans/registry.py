"""All registered queries: name -> (spark, sf_dir) -> DataFrame, plus the
matching DuckDB SQL for the cross-check and each statement's ORDER BY.

Queries return unordered results: a presentation sort is a global range
shuffle, worth paying only when a person reads the rows. ``ordered``
applies the statement's ORDER BY on request; top-k queries carry their
own ordering and limit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.oracle_views import with_views
from storefront.plans import fulfilment, loyalty, mart
from storefront.sources.bindings import Domain

_MODULES = (loyalty, fulfilment, mart)


def _bind(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Domain(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for module in _MODULES:
        for name, fn in module.QUERIES.items():
            out[name] = _bind(fn)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in _MODULES:
        for name, sql in module.SQL.items():
            out[name] = with_views(sql)
    return out


def presentation_order(name: str) -> list[Column]:
    """The statement's ORDER BY as columns ('-col' = descending), with the
    NULL placement of the original dialect: last when ascending, first when
    descending (Spark's defaults are the reverse)."""
    for module in _MODULES:
        if name in module.ORDER:
            return [F.desc_nulls_first(c[1:]) if c.startswith("-") else F.asc_nulls_last(c)
                    for c in module.ORDER[name]]
    return []


def ordered(name: str, df: DataFrame) -> DataFrame:
    """``df`` sorted as the statement behind ``name`` sorts its rows."""
    order = presentation_order(name)
    return df.orderBy(*order) if order else df
