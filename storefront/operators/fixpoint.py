"""Recursion over a table: rows found from rows found before, until nothing is
new (``WITH RECURSIVE ... UNION``).

Each round follows only the rows that the round before has added (the delta),
drops what is known already, and writes what is left; cycles end because known
rows add nothing. A round's work is its delta's, not that of all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.sources.sinks import create_table_as


def fixpoint(seed: DataFrame, step: Callable[[DataFrame], DataFrame], key: Sequence[str], out: str = "round",
             max_rounds: int = 10_000) -> DataFrame:
    """All rows of ``seed`` and of ``step(rows added last)``, each ``key`` once,
    with the round in which it was found (the seed's is 0). ``key`` names all
    columns; rows with a NULL in it are dropped."""
    columns = list(key)
    spark = seed.sparkSession

    def kept(df: DataFrame, n: int) -> DataFrame:
        fresh = df.select(*columns).dropna().distinct().withColumn(out, F.lit(n).cast("long"))
        return create_table_as(spark, fresh, f"round-{n}")

    delta = kept(seed, 0)
    found, rounds = [delta], 0
    while not delta.isEmpty():
        rounds += 1
        if rounds > max_rounds:
            raise RuntimeError(f"no end after {max_rounds} rounds")
        known = found[0].select(*columns)
        for d in found[1:]:
            known = known.unionByName(d.select(*columns))
        delta = kept(step(delta.drop(out)).select(*columns).distinct().join(known, columns, "left_anti"), rounds)
        found.append(delta)
        if len(found) > 16:  # plans stay short: what is known so far becomes one table
            found = [create_table_as(spark, _union(found), "known"), delta.limit(0)]
    return _union(found)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def reachable(edges: DataFrame, seeds: DataFrame, source: str, target: str, node: str, hops: str = "hops") -> DataFrame:
    """(``node``, ``hops``): the nodes that ``seeds`` (column ``node``) reach along
    ``edges``, with the least number of edges. Equal edges count once."""
    links = create_table_as(edges.sparkSession, edges.select(F.col(source).alias("_from"), F.col(target).alias("_to")).dropna().distinct(), "edges")
    return fixpoint(seeds.select(node), lambda delta: links.join(delta, F.col("_from") == F.col(node)).select(F.col("_to").alias(node)),
                    [node], hops)
