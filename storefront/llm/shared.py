"""Helpers the operators share: the shared folder, written tables, row keys,
size-checked broadcasts and text units."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the text contracts: blank and the control characters 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session that runs in one process (tests) may go without the
    setting; it then gets a folder of its own, registered in the session.
    """
    found = (spark.conf.get("spark.checkpoint.dir", None)
             or spark.sparkContext.getConf().get("spark.checkpoint.dir")
             or spark.sparkContext.getCheckpointDir())
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    found = tempfile.mkdtemp(prefix="storefront-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, the
    work is done once, and a lost executor only re-reads files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df``, quoted: names may hold dots or blanks."""
    return df["`" + name.replace("`", "``") + "`"]


def text_key(*cols: Column) -> list[Column]:
    """A 128-bit key of the values of ``cols`` as two longs, ``_k1`` and
    ``_k2``; equal values (nulls too) have equal keys."""
    marked = [x for c in cols for x in (c.isNull(), c)]
    return [F.xxhash64(*marked).alias("_k1"), F.xxhash64(F.lit("2"), *marked).alias("_k2")]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def small_enough(side: DataFrame, max_rows: int) -> DataFrame:
    """``side`` marked for broadcasting if it has at most ``max_rows`` rows;
    beyond that it is returned unmarked and Spark shuffles the join."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side
