"""Table writes (``CREATE TABLE AS``) to a named place or the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from storefront.session import checkpoint_dir


def table_location(spark: SparkSession, name: str) -> str:
    """A folder for a materialised table under ``spark.checkpoint.dir`` that no
    other run uses."""
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def create_table_as(spark: SparkSession, df: DataFrame, name: str, partition_by: tuple[str, ...] = (),
                    location: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table and return a scan of it.

    The table goes to ``location``, or to a new folder under the configured
    ``spark.checkpoint.dir``; with neither this raises. The returned DataFrame
    starts from files every executor can read, so its lineage is cut: a lost
    executor re-reads files instead of recomputing the whole upstream plan.
    """
    path = location or table_location(spark, name)
    write_table(df, path, partition_by, mode="overwrite" if location else "errorifexists")
    # Read back with the written schema: partition values (e.g. a year label
    # '1998') would otherwise be re-typed by inference.
    return spark.read.schema(df.schema).parquet(path)
