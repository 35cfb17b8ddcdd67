"""LIKE joins against a text-by-key check."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from storefront.operators import like_join
from storefront.operators.patterns import Automaton, pieces


def like(text, key):
    parts = "".join(".*" if p == -1 else "." if p == 1 else re.escape(p) for p in pieces(key))
    return re.search(parts, text, re.DOTALL) is not None


def test_automaton_finds_what_is_in_a_text():
    rng = random.Random(4)
    for _ in range(200):
        words = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))}
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 30)))
        automaton = Automaton(words)
        assert {automaton.words[i] for i in automaton.found(text)} == {w for w in words if w in text}


def test_pattern_pieces():
    assert pieces("a%b_c") == ["a", -1, "b", 1, "c"]
    assert pieces(r"5\%\_x\\") == ["5%_x\\"]
    assert pieces("") == [] and pieces("\\") == ["\\"]


@pytest.mark.parametrize("max_chars", [1 << 22, 0])
def test_join_matches_every_pair(spark, max_chars):
    """By the automaton, and by the shuffle that takes over beyond its bound."""
    rng = random.Random(8)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    texts = [(i, rng.choice([None, "", word("abc%_\n", 14), word("ab", 40)])) for i in range(80)]
    keys = [None, "", "%", "_", "__%", "a\\", r"\%", r"a\_b"] + [word("ab%_c", 7) for _ in range(60)] + ["aaaaaaaab", "ba%" * 3]
    df = spark.createDataFrame(texts, "i long, t string").withColumn("_anchor2", F.lit(1))
    patterns = spark.createDataFrame([(k,) for k in keys] * 2, "key string")
    found = sorted((r["i"], r["key"]) for r in like_join(df, "t", patterns, "key", max_chars=max_chars).collect())
    assert found == sorted({(i, k) for i, t in texts for k in keys if t is not None and k is not None and like(t, k)})


def test_agrees_with_like(spark):
    df = spark.createDataFrame([("3, 17",), ("17",), ("1, 7",), ("",), (None,)], "t string")
    patterns = spark.createDataFrame([("1%7",), ("_, 1",), ("7",), ("1_",)], "key string")
    want = df.crossJoin(patterns).filter(F.like("t", F.concat(F.lit("%"), F.col("key"), F.lit("%"))))
    assert sorted(map(tuple, like_join(df, "t", patterns, "key").collect())) == sorted(map(tuple, want.collect()))


def test_empty_sides_and_long_texts(spark):
    df = spark.createDataFrame([("ab" * 200_000,)], "t string")
    patterns = spark.createDataFrame([("ba%ab",), ("bb",), ("a_a_a",)], "key string")
    assert sorted(r["key"] for r in like_join(df, "t", patterns, "key").collect()) == ["a_a_a", "ba%ab"]
    assert like_join(df.limit(0), "t", patterns, "key").collect() == []
    assert like_join(df, "t", patterns.limit(0), "key").collect() == []
