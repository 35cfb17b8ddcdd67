"""Tables that are replaced while they are read, and tables stored for joins.

A version of a table is a folder of its own; a small pointer file names the
current one. Replacing a table writes a new version beside the old one and
then renames a new pointer over the old, in one step of the file system: a
reader sees the old table or the new one, whole, and a writer that dies leaves
the old one in place. Old versions stay until ``expire`` removes them, so
readers that have begun can end.

Versions may be bucketed and sorted by their join key. Two tables with the
same number of buckets on the key join without an exchange.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class VersionedTable:
    """The table at ``path`` (any file system Spark writes to)."""

    spark: SparkSession
    path: str
    _registered: dict[str, str] = field(default_factory=dict)

    # ---- files -----------------------------------------------------------
    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _pointer(self) -> dict | None:
        fs, path = self._file(POINTER)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: dict) -> None:
        """A new pointer, written aside and renamed over the old one."""
        name = f"{POINTER}.{uuid.uuid4().hex}"
        fs, aside = self._file(name)
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps(version).encode()))
        stream.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context.rename(aside, self._file(POINTER)[1], how)

    # ---- the table -------------------------------------------------------
    def write_version(self, df: DataFrame, bucket_by: Sequence[str] = (), buckets: int = 0) -> dict:
        """``df`` as a version that is not current yet (see ``replace``)."""
        version = {"folder": f"v-{uuid.uuid4().hex}", "bucket_by": list(bucket_by), "buckets": buckets, "schema": df.schema.json()}
        folder = f"{self.path.rstrip('/')}/{version['folder']}"
        if bucket_by:
            # One shuffle by the buckets' own hash: a task writes whole buckets, a bucket is one file.
            name = f"version_{version['folder'][2:]}"
            dealt = df.repartition(buckets, *bucket_by)
            dealt.write.format("parquet").bucketBy(buckets, *bucket_by).sortBy(*bucket_by).option("path", folder).saveAsTable(name)
            self._registered[version["folder"]] = name
        else:
            df.write.parquet(folder)
        return version

    def replace(self, df: DataFrame, bucket_by: Sequence[str] = (), buckets: int = 64) -> DataFrame:
        """Replace the whole table by ``df`` and return a scan of it. ``df`` may
        read the table itself: its version stays until expired."""
        self._publish(self.write_version(df, bucket_by, buckets))
        return self.read()

    def read(self) -> DataFrame:
        """The current version."""
        from pyspark.sql.types import StructType

        version = self._pointer()
        if version is None:
            raise LookupError(f"no table has been written to {self.path}")
        folder = f"{self.path.rstrip('/')}/{version['folder']}"
        schema = StructType.fromJson(json.loads(version["schema"]))
        if not version["bucket_by"]:
            return self.spark.read.schema(schema).parquet(folder)
        if version["folder"] not in self._registered:  # another session wrote it: its buckets are declared here
            name = f"version_{version['folder'][2:]}"
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(map(_quoted, version["bucket_by"]))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                           f"INTO {version['buckets']} BUCKETS LOCATION '{folder}'")
            self._registered[version["folder"]] = name
        return self.spark.table(self._registered[version["folder"]])

    def versions(self) -> list[str]:
        fs, path = self._file("")
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("v-")) if fs.exists(path) else []

    def expire(self) -> list[str]:
        """Remove every version but the current one; returns their names. For
        a time when no reader or writer of older versions is at work."""
        current = (self._pointer() or {}).get("folder")
        old = [v for v in self.versions() if v != current]
        for v in old:
            if v in self._registered:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._registered.pop(v)}")
            fs, path = self._file(v)
            fs.delete(path, True)
        return old
