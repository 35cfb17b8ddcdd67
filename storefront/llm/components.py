"""Connected components of a link table, as alternating star contractions.

Each round points every node at the smallest node it can see; the work is
joins and partial aggregates over links, so neither a component nor a node
with very many links has to fit into one task. The rounds needed grow with
the logarithm of a component's size. Each round is written to the shared
folder: lineage stays short and a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.shared import written


def _smallest_seen(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with ``m``: the smallest of u and all its v."""
    low = links.groupBy("u").agg(F.min("v").alias("lv")).select(F.col("u"), F.least("u", "lv").alias("m"))
    return links.join(low, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = _smallest_seen(both).filter(F.col("v") > F.col("u"))
    return seen.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and itself, to its smallest one."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    seen = _smallest_seen(down)
    moved = seen.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = seen.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (u, v; both longs) that is not
    itself the smallest of its component; root is that smallest node."""
    links, before = written(_small_star(links.select("u", "v").filter("u <> v")), "links"), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        links = written(_small_star(_large_star(links)), "links")
