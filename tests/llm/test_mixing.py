from __future__ import annotations

import random

from storefront.llm.mixing import mix


def shares(sizes, weights, share, most):
    """Targets by repeated resharing, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        for s in over or open_:
            target[s] = float(most * sizes[s]) if over else level * w[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_targets_and_takes(documents):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 30), "en", rng.choice(["b", "B", "a", None, "c"] + ["hot"] * 3), 0) for i in range(600)]
    rows += [(900, None, "en", "empty", 0), (901, "", "en", "empty", 0), (None, "x y", "en", "a", 0), (None, "x y", "en", "a", 0)]
    out = [r.asDict() for r in mix(documents(rows)).collect()]
    assert len(out) == len(rows)
    sizes, taken, goal = {}, {}, {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        goal[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = shares(sizes, (3, 1, 2), 1.5, 2)
    for s in sizes:
        assert abs(goal[s] - want[s]) < 1e-6
        assert abs(taken[s] - goal[s]) <= 15
    assert sorted(map(repr, out)) == sorted(repr(r.asDict()) for r in mix(documents(rows)).collect())


def test_empty_table(documents):
    assert mix(documents([])).collect() == []


def test_only_empty_texts(documents):
    assert [(r["taken"], r["target"]) for r in mix(documents([(1, None), (2, "  ")])).collect()] == [(0, 0.0), (0, 0.0)]
