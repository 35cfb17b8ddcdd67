"""Replaced and keyed tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from storefront.sources.keyed import KeyedTable
from storefront.sources.versions import VersionedTable
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_see_the_old_or_the_new_table(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(LookupError):
        table.read()
    old = table.replace(spark.range(3))
    pending = table.write_version(spark.range(10))  # a writer at work, or one that died
    assert old.count() == 3 and VersionedTable(spark, table.path).read().count() == 3
    table._publish(pending)
    assert table.read().count() == 10 and old.count() == 3  # the reader that began before still reads its version
    grown = table.replace(table.read().unionByName(spark.range(10, 12)))  # reads itself
    assert rows(grown) == rows(spark.range(12))
    assert len(table.versions()) == 3 and len(table.expire()) == 2
    assert table.read().count() == 12 and len(table.versions()) == 1


def test_a_write_that_fails_leaves_the_table(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    table.replace(spark.range(3))
    with pytest.raises(Exception, match="(?i)bad row"):
        table.replace(spark.range(3).select(F.raise_error(F.lit("bad row")).cast("long").alias("id")))
    assert table.read().count() == 3


def test_buckets_join_without_an_exchange(spark, tmp_path):
    a, b = (VersionedTable(spark, f"file://{tmp_path}/{n}") for n in "ab")
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    right = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    a.replace(left, ["k"], 8)
    b.replace(right, ["k"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for tables in ((a, b), (VersionedTable(spark, a.path), VersionedTable(spark, b.path))):  # as written, and as another reader finds them
            joined = tables[0].read().join(tables[1].read(), "k")
            assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
            assert rows(joined) == rows(left.join(right, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_appends_are_checked_against_the_files_that_may_hold_their_keys(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/k", "id")
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "id long, v string")
    assert rows(table.violations(batch)) == [(1, "a", "key not unique in the batch"), (1, "b", "key not unique in the batch"),
                                             (None, "c", "key is null")]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.append(spark.range(0, 40_000, 2).select("id", F.lit("x").alias("v")))
        table.append(spark.range(100_001, 100_003).select("id", F.lit("y").alias("v")))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert table.read().count() == 20_002
    every = table.read().select(F.input_file_name()).distinct().count()
    batch = spark.createDataFrame([(4, "a"), (7, "b"), (100_001, "c"), (100_001, "d"), (None, "e"), (-5, "f"), (10 ** 9, "g")], "id long, v string")
    want = [(100_001, "c", "key already stored"), (100_001, "c", "key not unique in the batch"), (100_001, "d", "key already stored"),
            (100_001, "d", "key not unique in the batch"), (4, "a", "key already stored"), (None, "e", "key is null")]
    assert rows(table.violations(batch)) == sorted(want, key=repr)
    assert rows(table.violations(batch, max_keys=0)) == sorted(want, key=repr)  # beyond the bound: the whole table
    keys = batch.filter("id IS NOT NULL").select(F.col("id").alias("k")).distinct()
    files = table.files_that_may_hold(keys)
    assert 2 <= len(files) < every
    read = set(re.findall(r"part-[^,\]\s]+parquet", " ".join(table.violations(batch).inputFiles())))
    assert read == {f.rsplit("/", 1)[1] for f in files}
    odd = spark.range(1, 40_000, 398).select(F.col("id").alias("k"))  # not stored: the filters let few through
    assert len(table.files_that_may_hold(odd.limit(20))) < every
    assert table.files_that_may_hold(keys.filter("k > 200000 or k < 0")) == []
