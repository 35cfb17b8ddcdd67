from __future__ import annotations

import re
import time
from collections import Counter

from pyspark.sql import functions as F

from storefront.llm.line_dedup import dedup_lines

EDGE = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs):
    keys = [[EDGE.sub("", x).translate(ASCII_LOWER) for x in (t or "").split("\n")] for _, t in rows]
    seen = Counter(k for ks in keys for k in set(ks))
    out = []
    for (i, t), ks in zip(rows, keys, strict=True):
        drop = [k != "" and seen[k] >= min_docs for k in ks]
        kept = [x for x, d in zip((t or "").split("\n"), drop, strict=True) if not d]
        out.append((i, len(ks), sum(drop), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df, min_docs):
    return sorted((tuple(r) for r in dedup_lines(df, min_docs=min_docs).collect()), key=repr)


def test_matches_brute_force_on_edge_rows(documents):
    rows = [(1, "Home\nbody one\n\nFOOT \t"), (2, " home\r\nbody two\nfoot"), (3, None), (4, ""), (5, "\n\n"),
            (6, "HOME\nhome\nÉcole"), (7, "école\nx" * 400), (None, "home"), (None, "home"), (8, "éCOLE "),
            (1, "Home\nbody one\n\nFOOT \t")]
    df = documents(rows)
    for n in (1, 2, 3, 6):
        assert got(df, n) == brute(rows, n)


def test_whole_test_table(small_documents):
    rows = [(r["doc_id"], r["text"]) for r in small_documents.collect()]
    assert got(small_documents, 3) == brute(rows, 3)


def test_empty_table_and_clashing_columns(spark, documents):
    assert got(documents([]), 2) == []
    df = documents([(1, "a\nb"), (2, "a")]).withColumn("h", F.lit(1)).withColumn("_k1", F.lit(2)).withColumn("a.b", F.lit(3))
    out = dedup_lines(df, min_docs=2, keep=("h", "_k1", "a.b"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 2, 3, 2, 1, "b"), (2, 1, 2, 3, 1, 1, "")]


def test_very_long_documents(spark):
    """Twelve documents of 200,000 shared lines and one of their own."""
    ids = spark.range(12, numPartitions=4)
    lines = F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: F.concat(F.lit("line "), i.cast("string")))
    docs = ids.select(F.col("id").alias("doc_id"), F.concat_ws("\n", F.array_join(lines, "\n"), F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"))
    began = time.monotonic()
    found = dedup_lines(docs, min_docs=10).collect()
    assert sorted(tuple(r) for r in found) == [(i, 200_001, 200_000, f"own {i}") for i in range(12)]
    assert time.monotonic() - began < 90
