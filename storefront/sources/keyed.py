"""Tables with a primary key: appends are checked against the stored files that
may hold their keys, and no others.

The table lies in files sorted by range of its key. Beside them, an index has
one row a file: the smallest and greatest key, and a Bloom filter as bitmaps of
32,768 bits. A batch's keys are looked up in the index; only the files whose
range and filter let a key through are read. The batch's keys travel to the
index, so their number is checked first; a larger batch is joined with the
whole table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HASHES = 4
BITS_A_KEY = 12
BITMAP = 32_768  # bits of one bitmap (that of bitmap_construct_agg)


def _positions(key: str, bits) -> F.Column:
    """The bits of a key in a filter of ``bits`` bits."""
    return F.transform(F.sequence(F.lit(1), F.lit(HASHES)), lambda i: F.pmod(F.xxhash64(F.col(key), i), bits))


@dataclass
class KeyedTable:
    """Rows at ``path`` under the primary key ``key`` (an integer column)."""

    spark: SparkSession
    path: str
    key: str

    def _folder(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def append(self, rows: DataFrame) -> None:
        """``rows`` as new files with their part of the index. Keys are taken as
        checked (see ``violations``). The index is written first, so a reader
        that finds a file finds its index row; rows without files hurt nobody."""
        run = uuid.uuid4().hex
        files, data = self._folder(f"_runs/{run}"), rows.repartitionByRange(self.key).sortWithinPartitions(self.key)
        data.write.parquet(files)
        named = self.spark.read.schema(rows.schema).parquet(files).select(F.col(self.key).alias("k"), F.input_file_name().alias("file"))
        sizes = named.groupBy("file").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n"))
        most = sizes.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
        bits = BITMAP * max(1, -(-most * BITS_A_KEY // BITMAP))
        places = named.select("file", F.explode(F.array_distinct(_positions("k", F.lit(bits)))).alias("p"))
        maps = (places.groupBy("file", F.floor(F.col("p") / BITMAP).cast("int").alias("block"))
                .agg(F.bitmap_construct_agg(F.col("p") % BITMAP).alias("bitmap"))
                .groupBy("file").agg(F.collect_list(F.struct("block", "bitmap")).alias("blocks")))
        index = sizes.join(maps, "file").select("file", F.col("low").cast("long"), F.col("high").cast("long"), F.lit(bits).cast("long").alias("bits"), "blocks")
        index.write.mode("append").parquet(self._folder("_keys"))
        # Published last: the run's name in the list of runs.
        self.spark.createDataFrame([(run,)], "run string").write.mode("append").parquet(self._folder("_list"))

    def _runs(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder("_list"))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return []
        return sorted(r["run"] for r in self.spark.read.schema("run string").parquet(self._folder("_list")).collect())

    def read(self) -> DataFrame:
        """All stored rows."""
        runs = self._runs()
        if not runs:
            raise LookupError(f"no rows have been written to {self.path}")
        return self.spark.read.parquet(*[self._folder(f"_runs/{r}") for r in runs])

    def files_that_may_hold(self, keys: DataFrame) -> list[str]:
        """The stored files whose range and filter let one of ``keys`` (column
        ``k``, bounded by the caller) through."""
        index = self.spark.read.parquet(self._folder("_keys"))
        runs = self._runs()
        index = index.filter(F.regexp_extract("file", "/_runs/([0-9a-f]+)/", 1).isin(runs))
        by_bits = {}
        for (bits,) in index.select("bits").distinct().collect():  # one a run at most
            rows = keys.select(F.col("k").cast("long").alias("k"), _positions("k", F.lit(bits)).alias("p")).orderBy("k").toArrow()
            by_bits[bits] = (rows.column("k").to_numpy(), np.array(rows.column("p").to_pylist(), dtype=np.int64).reshape(-1, HASHES))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    known, places = by_bits[row["bits"]]
                    some = places[np.searchsorted(known, row["low"]):np.searchsorted(known, row["high"], side="right")]
                    blocks = {b["block"]: np.frombuffer(b["bitmap"], dtype=np.uint8) for b in row["blocks"]}
                    left = np.ones(len(some), dtype=bool)
                    for block in np.unique(some // BITMAP) if len(some) else ():
                        bitmap = blocks.get(int(block))
                        at = some % BITMAP
                        here = some // BITMAP == block
                        set_here = (bitmap[at // 8] >> (at % 8)) & 1 if bitmap is not None else np.zeros_like(at)
                        left &= (~here | (set_here == 1)).all(axis=1)
                    if left.any():
                        found.append(row["file"])
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])

        return sorted(r["file"] for r in index.mapInArrow(run, "file string").collect())

    def violations(self, batch: DataFrame, max_keys: int = 1_000_000) -> DataFrame:
        """Rows of ``batch`` that break the key, with ``violation``: a NULL key,
        a key that the batch holds more than once, a key already stored. A row
        that breaks two rules comes twice."""
        key = F.col(self.key)
        counts = batch.filter(key.isNotNull()).groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("_n"))
        stored = None
        if self._runs():
            if counts.limit(max_keys + 1).count() <= max_keys:
                files = self.files_that_may_hold(counts)
                stored = self.spark.read.parquet(*files) if files else None
            else:
                stored = self.read()
        held = (counts.join(stored.select(key.alias("k")), "k", "left_semi").select("k", F.lit(True).alias("_stored")) if stored is not None
                else counts.filter("false").select("k", F.lit(True).alias("_stored")))
        facts = counts.join(held, "k", "left")
        rules = [(key.isNull(), "key is null"), (F.col("_n") > 1, "key not unique in the batch"), (F.col("_stored"), "key already stored")]
        broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for bad, name in rules]), lambda r: r.isNotNull())
        return batch.join(facts, key == F.col("k"), "left").select(*[F.col(f"`{c}`") for c in batch.columns], F.explode(broken).alias("violation"))
