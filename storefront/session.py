"""Spark session settings used by the library, tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings the plans are tuned for. AQE re-plans joins from
# runtime sizes, splits skewed shuffle partitions and coalesces small ones.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


# Starting points for a large cluster (~100 TB input). Many initial shuffle
# partitions that AQE coalesces towards the advisory size keep each task's
# shuffle block small enough to avoid spilling; splits of a skewed partition
# are sized the same way. Broadcasting stays behind the default size check.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "storefront", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster call it without ``master`` (the launcher decides) and pass
    ``extra=CLUSTER_CONF``. Locally pass ``master="local[8]"`` and a small
    ``shuffle_partitions``.
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset there is a fallback for sessions in one process
    (``local[...]``, as in tests) alone: on a cluster, a folder of one machine would
    lose the rows that the other machines wrote.
    """
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.sparkContext.getConf().get("spark.checkpoint.dir")
                  or spark.sparkContext.getCheckpointDir())
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder, or name a location")
        configured = tempfile.mkdtemp(prefix="storefront-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")
