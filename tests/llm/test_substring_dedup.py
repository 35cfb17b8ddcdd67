from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storefront.llm.substring_dedup import remove_repeats
from storefront.llm.suffix_automaton import SuffixAutomaton


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, size):
    texts = [words_of(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + size]) for w in texts for i in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(rows, texts, strict=True):
        gone = set()
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s:s + size])] > 1:
                gone.update(range(s, s + size))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def got(df, size, **options):
    cols = ("doc_id", "n_words", "n_removed", "kept_text")
    return sorted((tuple(r[c] for c in cols) for r in remove_repeats(df, window=size, **options).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_automaton_counts_windows(seed):
    rng = random.Random(seed)
    texts = [[rng.randint(0, 2) for _ in range(rng.randint(0, 40))] for _ in range(12)]
    times = [rng.randint(1, 2) for _ in texts]
    machine = SuffixAutomaton()
    for t, n in zip(texts, times, strict=True):
        machine.add(t, n)
    machine.total()
    for size in (1, 3, 5):
        seen = Counter()
        for t, n in zip(texts, times, strict=True):
            for i in range(len(t) - size + 1):
                seen[tuple(t[i:i + size])] += n
        for t in texts:
            assert machine.repeated_windows(t, size) == [seen[tuple(t[i:i + size])] > 1 for i in range(len(t) - size + 1)]


def rows_with_repeats(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    passages = [[word() for _ in range(rng.randint(10, 60))] for _ in range(8)]
    rows = []
    for d in range(120):
        body = [word() for _ in range(rng.randint(0, 150))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            p = list(p)
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "edited"
            at = rng.randint(0, len(body))
            body[at:at] = p
        rows.append((d, " ".join(body)))
    rows += [(200, rows[3][1]), (200, rows[3][1]), (None, rows[4][1]), (201, None), (202, " \n"), (203, "a b " * 60), (204, "x " * 300),
             (205, "É x " * 40), (206, "\x0b".join(passages[0]))]
    return rows


@pytest.mark.parametrize("options", [{}, {"frequent": 3, "bucket_rows": 50, "shard_words": 100, "filter_bytes": 1 << 16}])
def test_matches_brute_force(documents, options):
    rows = rows_with_repeats(7)
    for size in (12, 35):
        assert got(documents(rows), size, **options) == brute(rows, size)


def test_whole_test_table(small_documents):
    rows = [(r["doc_id"], r["text"]) for r in small_documents.collect()]
    want = brute(rows, 35)
    assert sum(r[2] for r in want) > 0
    assert got(small_documents, 35) == want


def test_empty_table_and_clashing_columns(documents):
    assert got(documents([]), 35) == []
    df = documents([(1, "a " * 50)]).withColumn("_k1", F.lit(1)).withColumn("cuts", F.lit(2)).withColumn("h", F.lit(3))
    assert got(df, 35) == [(1, 50, 50, "")]
