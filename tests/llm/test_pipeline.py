"""Each stage of the pipeline against brute force on what it was given."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from storefront.llm import queries, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], small_dir).cache())
    return seen


def as_dict(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "SimHash near-dedup"
    for df in stages[:-1]:
        assert df.columns == COLUMNS
    assert stages[-1].columns[-1] == "taken"


def test_quality_keeps_clean_documents(spark, small_dir, stages):
    lab = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    before, after = as_dict(stages[0]), as_dict(stages[1])
    assert set(after) < set(before)
    good = [i for i, q in lab.items() if q == 1]
    assert sum(i in after for i in good) >= 0.98 * len(good)


def test_lines_shared_by_ten_documents_go(stages):
    before, after = as_dict(stages[1]), as_dict(stages[2])
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    seen = Counter(k for r in before.values() for k in {key(x) for x in (r["text"] or "").split("\n")})
    for i, r in before.items():
        text = "\n".join(x for x in (r["text"] or "").split("\n") if not key(x) or seen[key(x)] < 10)
        assert after[i]["text"] == text and after[i]["n_chars"] == len(text)


def test_one_document_of_each_group_stays(stages):
    before, after = as_dict(stages[2]), as_dict(stages[3])
    fps = {i: simhash.fingerprint(r["text"], 3) for i, r in before.items()}
    low = {i: i for i in fps}
    pairs = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    for _ in fps:
        moved = False
        for a, b in pairs:
            m = min(low[a], low[b])
            moved |= low[a] != m or low[b] != m
            low[a] = low[b] = m
        if not moved:
            break
    assert set(after) == set(low.values())
    assert all(after[i] == before[i] for i in after)


def test_documents_with_test_items_go(spark, small_dir, stages):
    from tests.llm.test_decontaminate import brute
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    before, after = as_dict(stages[3]), as_dict(stages[4])
    leaks = {d for d, *_ in brute([(i, r["text"]) for i, r in before.items()], items)}
    assert set(after) == set(before) - leaks


def test_mix_takes_of_all_that_is_left(stages):
    assert stages[5].count() == stages[4].count()
    sums = stages[5].groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["g"]) <= r["m"] for r in sums)


def test_repeated_rows_and_null_ids(spark, small_dir, documents):
    rows = [(1, "one two three four five"), (1, "one two three four five"), (2, "One two three four five"), (None, "one two three four five"),
            (None, "six"), (3, None), (4, "")]
    out = corpus_pipeline.near_duplicates(spark, documents(rows).withColumn("fp", F.lit(1)), small_dir)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(
        [(1, rows[0][1]), (None, rows[0][1]), (None, "six"), (3, None)], key=repr)


def test_an_id_that_stands_for_two_groups(spark, small_dir, documents):
    a, b = "one two three four five", "red orange yellow green blue indigo violet"
    assert (simhash.fingerprint(a, 3) ^ simhash.fingerprint(b, 3)).bit_count() > 3
    out = corpus_pipeline.near_duplicates(spark, documents([(1, a), (1, b), (2, a), (3, b), (1, a)]), small_dir)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, a), (1, b)]


def test_line_dedup_with_columns_of_its_own_names(spark, small_dir, documents):
    rows = [(i, f"shared\nown {i}") for i in range(12)]
    df = documents(rows)
    for c in ("n_lines", "n_dropped", "kept_text", "row", "a.b"):
        df = df.withColumn(c, F.concat(F.lit(c), "doc_id"))
    out = corpus_pipeline.lines(spark, df, small_dir)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        (i, f"own {i}", "en", "s", len(f"own {i}"), f"n_lines{i}", f"n_dropped{i}", f"kept_text{i}", f"row{i}", f"a.b{i}") for i in range(12))


def test_registered(spark, small_dir):
    import __spark_entry__ as entry
    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {re.match(r"op\d+_", k)[0] for k in queries.QUERIES if k != "pipeline"}
