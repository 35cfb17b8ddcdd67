from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from storefront.llm.components import components
from storefront.llm.simhash import links, near_duplicates


def group(nodes, pairs):
    """node -> smallest node reachable, by repeated relabelling."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def brute_fingerprint(spark, text, size):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    parts = [b" ".join(words[i:i + size]).decode() for i in range(max(1, len(words) - size + 1))]
    hashes = [r[0] for r in spark.createDataFrame([(p,) for p in parts], "s string").select(F.xxhash64("s")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_definition(spark, documents):
    texts = ["", None, "One", "one TWO", "a b c d e f g " * 30, "École É é\x0bx y z", "x" * 3000]
    out = {r["doc_id"]: r["fingerprint"] for r in near_duplicates(documents(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert int(out[i], 16) == brute_fingerprint(spark, t, 3)
        assert len(out[i]) == 16


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, bits):
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    fps = set(seeds)
    for s in seeds:
        for _ in range(6):
            s ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.add(s)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    pairs = [(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= bits]
    found = [tuple(r) for r in links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, 2000).collect()]
    assert {frozenset(p) for p in found} <= {frozenset(p) for p in pairs}
    assert group(signed, found) == group(signed, pairs)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    pairs += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    want = {n: low for n, low in group({n for p in pairs for n in p}, pairs).items() if n != low}
    got = components(spark.createDataFrame(pairs, "u long, v long"))
    assert dict(map(tuple, got.collect())) == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_whole_test_table(spark, small_documents):
    out = near_duplicates(small_documents).collect()
    assert len(out) == small_documents.count()
    fps = {r["doc_id"]: int(r["fingerprint"], 16) for r in out}
    pairs = [(a, b) for a, b in itertools.combinations(fps, 2) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    assert {r["doc_id"]: r["component_id"] for r in out} == group(fps, pairs)


def test_null_ids_repeated_rows_and_empty_table(documents):
    rows = [(5, "a b c"), (3, "A  b\nc"), (None, "a b c"), (3, "a b c"), (None, "zz yy xx ww"), (9, None), (8, " ")]
    out = sorted(((r["doc_id"], r["component_id"]) for r in near_duplicates(documents(rows)).collect()), key=repr)
    assert out == sorted([(5, 3), (3, 3), (None, 3), (3, 3), (None, None), (9, 8), (8, 8)], key=repr)
    assert near_duplicates(documents([])).collect() == []
