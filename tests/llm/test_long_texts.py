"""Texts beyond the operators' inner blocks, and columns with clashing names."""

from __future__ import annotations

import hashlib
import math

import pytest
import xxhash
from pyspark.sql import functions as F

from storefront.llm import decontaminate, mixing, quality_lm, simhash, substring_dedup, warc
from tests.llm.test_quality_lm import Brute


def test_simhash_beyond_a_block_of_shingles(documents):
    words = [f"w{i * 7919 % 5003}" for i in range(70_000)]
    text = " ".join(words)
    parts = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), seed=42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in parts) > len(parts))
    out = {r["doc_id"]: r for r in simhash.near_duplicates(documents([(1, text), (2, text + " w1"), (3, "other words here")])).collect()}
    assert int(out[1]["fingerprint"], 16) == want and out[2]["component_id"] == 1 and out[3]["component_id"] == 3


def test_repeats_in_a_very_long_text(documents):
    own = [f"a{i}" for i in range(60_000)]
    passage = [f"p{i}" for i in range(50)]
    rows = [(1, " ".join(own[:30_000] + passage + own[30_000:])), (2, " ".join(["x", *passage, "y"]))]
    out = {r["doc_id"]: r for r in substring_dedup.remove_repeats(documents(rows), window=35).collect()}
    assert (out[1]["n_words"], out[1]["n_removed"], out[1]["kept_text"]) == (60_050, 50, " ".join(own))
    assert (out[2]["n_removed"], out[2]["kept_text"]) == (50, "x y")


def test_items_inside_a_very_long_text(spark, documents):
    item = " ".join(f"q{i}" for i in range(30))
    long = " ".join(f"w{i}" for i in range(100_000))
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    out = decontaminate.leaks_of(documents([(1, f"{long} {item} {long}"), (2, long)]), bench).select("row.doc_id", "leak.item_id").collect()
    assert [tuple(r) for r in out] == [(1, 7)]


def test_perplexity_of_a_text_beyond_a_chunk(spark, documents):
    trusted = [(i, f"the cat sat on mat {i} and the dog ran") for i in range(12)]
    body = "the dog sat on the cat and ran on "
    text = body * (quality_lm.CHUNK // len(body) + 2)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in trusted], "doc_id long, quality int, toxic int")
    out = quality_lm.classify(documents([*trusted, (99, text)]), labels, carry=("doc_id",), prior_units=0)
    found = out.filter("row.doc_id = 99").first()["perplexity"]
    model = Brute([t for _, t in trusted])
    # Once through the repeated part gives its sum; the rest repeats it.
    first, one = model.log(body), model.log(body * 2) - model.log(body)
    times = len(text) // len(body)
    assert found == pytest.approx(math.exp(-(first + one * (times - 1)) / len(text)), rel=1e-6)


def test_mixing_a_long_text_and_clashing_columns(documents):
    rows = [(1, "w " * 300_000, "en", "a", 0), (2, "x y", "en", "a", 0), (3, "z", "en", "b", 0)]
    df = documents(rows)
    for name in ("size", "taken", "target", "bucket", "w", "source_size", "level"):
        df = df.withColumn(name, F.lit("clash"))
    out = {r["doc_id"]: r for r in mixing.mix(df).collect()}
    assert (out[1]["size"], out[2]["size"], out[1]["source_size"]) == (300_000, 2, 300_002)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in out.values())


def test_archives_with_clashing_columns(spark, tmp_path):
    rows = [(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (3, "http://c/", "long " * 400_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("payload", "payload_digest", "refers_to", "record_type", "first", "digest"):
        df = df.withColumn(name, F.lit("clash"))
    warc.write_archives(df, f"file://{tmp_path}/w")
    out = {r["page_id"]: r for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert (out[1]["record_type"], out[2]["record_type"], out[2]["refers_to"]) == ("response", "revisit", 1)
    assert out[3]["payload_digest"] == hashlib.sha256(rows[2][2].encode()).hexdigest() and out[3]["payload_bytes"] == 2_000_000
