"""Declared table schemas and the rules that go with them.

Text lengths and keys are not part of a Parquet schema; they are given to
``validate_rows`` by ``rules``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from storefront.constants import RATING_MAX, RATING_MIN, RATINGS_LOADED_AT


@dataclass(frozen=True)
class Table:
    """A table's columns, its key, NOT NULL columns, text lengths, and CHECK
    and DEFAULT expressions in SQL."""

    schema: StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)

    def rules(self) -> dict:
        """The arguments of ``validate_rows`` for this table."""
        return {"key": self.key, "not_null": self.not_null, "max_length": self.max_length,
                "checks": {k: F.expr(v) for k, v in self.checks.items()},
                "defaults": {k: F.expr(v) for k, v in self.defaults.items()}}

    def conform(self, df: DataFrame) -> DataFrame:
        """The declared columns of ``df``, cast to the declared types; a
        missing column is an error."""
        missing = set(self.schema.names) - set(df.columns)
        if missing:
            raise ValueError(f"columns missing: {sorted(missing)}")
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])


def _columns(**types) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in types.items()])


RATINGS = Table(
    _columns(rating_key=LongType, order_id=LongType, runner_id=LongType, customer_id=LongType, rating=IntegerType,
             comment=StringType, rating_time=TimestampNTZType),
    key=("rating_key",),
    not_null=("order_id", "runner_id", "customer_id", "rating"),
    checks={f"rating between {RATING_MIN} and {RATING_MAX}": f"rating BETWEEN {RATING_MIN} AND {RATING_MAX}"},
    defaults={"rating_time": f"CAST('{RATINGS_LOADED_AT}' AS TIMESTAMP_NTZ)"},
)
PIZZA_NAMES = Table(_columns(pizza_id=LongType, pizza_name=StringType))
PIZZA_RECIPES = Table(_columns(pizza_id=LongType, toppings=StringType))
CUSTOMER_ORDERS = Table(
    _columns(order_id=LongType, customer_id=LongType, pizza_id=LongType, exclusions=StringType, extras=StringType,
             order_time=TimestampNTZType),
    max_length={"exclusions": 4, "extras": 4},
)
CLEAN_WEEKLY_SALES = Table(
    _columns(week_date=DateType, week_number=LongType, month_number=LongType, calendar_year=StringType, age_band=StringType,
             demographic=StringType, avg_transaction=DoubleType, region=StringType, platform=StringType, segment=StringType,
             customer_type=StringType, transactions=LongType, sales=LongType))
