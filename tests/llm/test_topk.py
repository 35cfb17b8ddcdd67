from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storefront.llm import topk


def brute(rows, k, every, scale=256):
    vectors = {}
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        q = [math.floor(scale * float(np.float32(x))) for x in e]
        vectors[i] = min(q, vectors.get(i, q))
    out = []
    for i, q in vectors.items():
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, p, strict=True)), j) for j, p in vectors.items() if j != i and len(p) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def got(spark, rows, k, every, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("q", F.lit(1)).withColumn("block", F.lit(2))
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % every == 0, k=k, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"block_rows": 300, "group_rows": 20}])
def test_clustered_vectors_with_ties(spark, options, monkeypatch):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = [(i, [x + rng.gauss(0, 0.01) for x in rng.choice(centres)]) for i in range(1200)]
    rows += [(2000 + i, rows[i][1]) for i in range(40)] + [(50, [9.0] * 6), (50, rows[50][1])]
    rows += [(None, [1.0] * 6), (3000, None), (3001, [1.0, None] * 3), (3002, [float("nan")] * 6), (3003, [float("inf")] * 6),
             (3050, [1.0, 2.0]), (3051, [2.0, 1.0]), (3100, []), (3101, [])]
    assert got(spark, rows, 5, 50, **options) == brute(rows, 5, 50)


def test_pruned_tree_search_is_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 200
    points = np.floor(centres[rng.integers(0, 20, 5000)] + rng.normal(size=(5000, 8))).astype(np.float64)
    queries, calls = points[::50], []
    tree = topk.cover_tree(points)
    assert tree.children  # tight groups are split

    class Counted(topk.Best):
        def add(self, rows, found):
            calls.append(len(rows) * len(found))
            super().add(rows, found)
    best = Counted(queries, np.arange(0, 5000, 50), np.arange(5000), points, 5)
    topk.search(topk.cover_tree(queries, leaf=topk.QUERY_LEAF), tree, best)
    scores = (queries @ points.T).astype(np.int64)
    scores[np.arange(100), np.arange(0, 5000, 50)] = np.iinfo(np.int64).min
    assert (best.score == np.sort(scores, axis=1)[:, ::-1][:, :5]).all()
    assert sum(calls) < 0.5 * len(queries) * len(points)  # most node pairs were pruned


def test_few_candidates_and_empty_table(spark):
    assert got(spark, [(0, [1.0]), (1, [2.0])], 5, 50) == [(0, 1, 1, 256 * 512)]
    assert got(spark, [(0, [1.0])], 5, 50) == []
    assert got(spark, [], 5, 50) == []
