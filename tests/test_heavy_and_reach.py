"""Frequent items by bounded counters, and recursion over tables."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from storefront.operators import fixpoint, reachable, top_heavy
from storefront.operators.heavy import heavy_candidates, shrink
from tests.conftest import rows


def test_shrink_keeps_bounds():
    rng = random.Random(1)
    for _ in range(100):
        counts = {i: rng.randrange(1, 9) for i in range(rng.randrange(1, 30))}
        kept, lost = shrink(dict(counts), 6)
        assert len(kept) <= 6 and all(counts[i] - lost <= kept.get(i, 0) <= counts[i] for i in counts)


@pytest.mark.parametrize("capacity", [3, 10, 1000])
@pytest.mark.parametrize("k", [1, 3])
def test_top_is_exact_whatever_the_counters(spark, capacity, k):
    rng = random.Random(capacity + k)
    data = [rng.choice(["hot"] * 30 + ["warm"] * 20 + ["tie a", "tie b"] * 6 + [None] + [f"i{j}" for j in range(200)]) for _ in range(1500)]
    df = spark.createDataFrame([(x,) for x in data], "v string").repartition(5)
    counts = Counter(x for x in data if x is not None)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    assert sorted(((r["v"], r["n"]) for r in top_heavy(df, "v", k, capacity).collect()), key=lambda x: (-x[1], x[0])) == want


def test_candidates_are_bounded_and_hold_the_winners(spark):
    data = ["hot"] * 400 + ["warm"] * 300 + [f"i{j}" for j in range(600)]
    df = spark.createDataFrame([(x,) for x in data], "v string").repartition(4)
    candidates, outside = heavy_candidates(df, "v", 2, 50)
    found = {r["item"] for r in candidates.collect()}
    assert {"hot", "warm"} <= found and len(found) <= 4 * 50 and 0 < outside < 300


def test_nothing_to_count(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert top_heavy(df, "v", 2).collect() == [] and top_heavy(df.limit(0), "v", 2).collect() == []
    assert rows(top_heavy(spark.createDataFrame([("a",), ("b",)], "v string"), "v", 5)) == [("a", 1), ("b", 1)]


def _duck(edges, seeds):
    con = duckdb.connect()
    con.execute("CREATE TABLE e (a BIGINT, b BIGINT); CREATE TABLE s (n BIGINT)")
    con.executemany("INSERT INTO e VALUES (?, ?)", edges)
    con.executemany("INSERT INTO s VALUES (?)", [(x,) for x in seeds])
    return sorted(con.execute("""WITH RECURSIVE r AS (SELECT n FROM s WHERE n IS NOT NULL UNION SELECT b FROM r JOIN e ON a = n WHERE b IS NOT NULL)
                                 SELECT n FROM r""").fetchall(), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_reach_with_cycles_agrees_with_recursive_sql(spark, seed):
    rng = random.Random(seed)
    node = lambda: rng.choice([None, *range(40)])
    edges, seeds = [(node(), node()) for _ in range(45)] + [(1, 2), (2, 3), (3, 1), (3, 3), (1, 2)], [1, None, node(), 99]
    found = reachable(spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame([(s,) for s in seeds], "n long"), "a", "b", "n")
    assert sorted(((r["n"],) for r in found.collect()), key=repr) == _duck(edges, seeds)
    hops, depth, left = {s: 0 for s in seeds if s is not None}, 0, {s for s in seeds if s is not None}
    while left:
        depth += 1
        left = {b for a, b in edges if a in left and b is not None and b not in hops}
        hops |= {b: depth for b in left}
    assert {r["n"]: r["hops"] for r in found.collect()} == hops


def test_a_long_chain_ends(spark):
    """More rounds than are kept as tables of their own; each adds its delta only."""
    n = 20
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = reachable(edges, spark.createDataFrame([(0,)], "n long"), "a", "b", "n")
    assert sorted((r["n"], r["hops"]) for r in found.collect()) == [(i, i) for i in range(n + 1)]


def test_fixpoint_rounds_and_limits(spark):
    seed = spark.createDataFrame([(1, 1)], "a long, b long")
    step = lambda d: d.select(F.col("b").alias("a"), F.pmod(F.col("a") + F.col("b"), F.lit(5)).alias("b"))
    found = {(r["a"], r["b"]): r["round"] for r in fixpoint(seed, step, ["a", "b"]).collect()}
    assert found[1, 1] == 0 and found[1, 2] == 1 and found[2, 3] == 2 and sorted(found.values()) == list(range(len(found)))
    with pytest.raises(RuntimeError):
        fixpoint(seed, lambda d: d.select("a", (F.col("b") + 1).alias("b")), ["a", "b"], max_rounds=3)
    assert fixpoint(seed.limit(0), step, ["a", "b"]).collect() == []
