from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from storefront.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def make(n, seed=0):
    rng = random.Random(seed)
    clean = [f"word{i}" for i in range(400)]
    rude = ["grobian", "lummel", "tropf"]
    rows, labels = [], []
    for i in range(n):
        body, toxic = [rng.choice(clean) for _ in range(rng.randint(5, 60))], rng.random() < 0.2
        for _ in range(rng.randint(2, 5) if toxic else 0):
            body.insert(rng.randint(0, len(body)), rng.choice(rude) + rng.choice(["", "isch", "erei"]))
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, documents):
    rows, labels = make(1500)
    lab = spark.createDataFrame(labels, LABELS)
    out = toxicity.score(documents(rows), lab).collect()
    truth = {i: t for i, _, t in labels}
    assert len(out) == len(rows)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    test = [(r["predicted"], truth[r["doc_id"]]) for r in out if r["held_out"]]
    assert sum(p == t for p, t in test) / len(test) > 0.97


def test_held_out_labels_and_other_columns_are_not_used(spark, documents):
    rows, labels = make(600)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a = toxicity.score(documents(rows), spark.createDataFrame(labels, LABELS))
    moved = documents(rows).withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("score", F.lit(9))
    b = toxicity.score(moved, spark.createDataFrame(flipped, LABELS))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_edge_rows(spark, documents):
    rows, labels = make(600)
    rows += [(None, "grobian tropf lummel"), (700, None), (701, ""), (702, "grobian " * 50_000), (0, rows[0][1])]
    lab = spark.createDataFrame(labels + [(None, 1, 1), (1, 1, None), (2, 1, 1), (2, 1, 1)], LABELS)
    out = toxicity.score(documents(rows), lab).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out if r["doc_id"] != 0}
    assert by[None]["predicted"] == 1 and not by[None]["held_out"] and by[702]["predicted"] == 1
    assert by[700]["score"] == by[701]["score"] < 0.5


def test_empty_tables_and_one_class(spark, documents):
    rows, labels = make(60)
    assert toxicity.score(documents([]), spark.createDataFrame(labels, LABELS)).collect() == []
    none = toxicity.score(documents(rows), spark.createDataFrame([], LABELS)).collect()
    assert len(none) == 60 and all(r["score"] < 1e-5 for r in none)


def test_label_model_learns_which_voters_to_trust():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = np.where(y[:, None], rng.random((4000, 8)) < 0.5, rng.random((4000, 8)) < 0.0005)
    noise = rng.random((4000, 2)) < 0.1  # patterns that say nothing about the class
    fired = np.hstack([good, good[:, :1], noise]).astype(np.uint8)  # with a copy of the first voter
    q = toxicity.label_model(fired, 0.2, 9)
    assert ((q > 0.5) == y).mean() > 0.985
    silent = ~good.any(axis=1)
    assert q[silent].max() < 0.2
    flipped = toxicity.label_model(fired[:, [8, *range(1, 8), 0, 9, 10]], 0.2, 9)
    assert np.allclose(q, flipped)  # a voter and its copy share one say


def brute_label_model(fired, prior, lexicon, rounds):
    """The label model row by row and voter by voter."""
    rows = [[float(v) for v in r] + [float(not any(r[:lexicon]))] for r in fired]
    voters, q = len(rows[0]), [0.02 if r[-1] else 0.95 for r in rows]
    say = [1.0] * voters
    for step in range(rounds):
        toxic = sum(q)
        on = [(sum(r[j] * p for r, p in zip(rows, q, strict=True)) + 0.5) / (toxic + 1) for j in range(voters)]
        off = [(sum(r[j] * (1 - p) for r, p in zip(rows, q, strict=True)) + 0.5) / (len(rows) - toxic + 1) for j in range(voters)]
        if step == rounds // 2:
            cov = [[sum(p * (r[i] - on[i]) * (r[j] - on[j]) for r, p in zip(rows, q, strict=True)) / max(toxic, 1.0) for j in range(voters)]
                   for i in range(voters)]
            sd = [math.sqrt(max(cov[i][i], 1e-9)) for i in range(voters)]
            for i in range(voters):
                alike = [cov[i][j] / sd[i] / sd[j] for j in range(voters)]
                say[i] = 1 / max(1.0, sum(c for c in alike if c > 0.5))
        q = [1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(r[j] * math.log(on[j] / off[j]) * say[j] for j in range(voters)))))
             for r in rows]
    return q


def test_label_model_by_its_definition():
    rng = random.Random(5)
    truth = [rng.random() < 0.3 for _ in range(200)]
    fired = np.array([[t and rng.random() < 0.7 or rng.random() < 0.05, t and rng.random() < 0.4, rng.random() < 0.2] for t in truth], dtype=np.uint8)
    fired = np.hstack([fired[:, :2], fired[:, :1], fired[:, 2:]])  # a voter twice: the two share one say
    want = brute_label_model(fired.tolist(), 0.3, 3, 25)
    assert np.allclose(toxicity.label_model(fired, 0.3, 3), want, atol=1e-3)


def test_weights_are_where_the_gradient_is_zero():
    rng = np.random.default_rng(2)
    x, q = (rng.random((300, 6)) < 0.3).astype(np.uint8), rng.random(300)
    w, b = toxicity.logistic(x, q)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (q - p) - 0.3 * w).max() < 1e-2 and abs((q - p).sum() - 1e-3 * b) < 1e-2


def test_scores_are_sums_of_weights(spark, documents):
    rows, labels = make(400, seed=3)
    rows += [(900, None), (901, ""), (902, "grobian " * 50_000)]
    df, lab = documents(rows), spark.createDataFrame(labels, LABELS)
    weights, bias = toxicity.fit(df.select("doc_id", "text"), lab.select("doc_id", "toxic"))
    assert weights
    out = {r["doc_id"]: r["score"] for r in toxicity.score(df, lab).collect()}
    for i, text in rows:
        total = bias + sum(weights.get(f, 0.0) for f in toxicity.features(text))
        assert abs(out[i] - 1 / (1 + math.exp(-total))) < 1e-9
