from __future__ import annotations

import hashlib

from storefront.llm import warc

ROWS = [(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (3, None, "x" * 200), (4, "http://c/", "y"),
        (5, "http://d/\r\nX: 1", "y"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 50), (9, "u", "é" * 50),
        (1, "again", "x" * 200), (None, "n", "x" * 200), (None, "n", "z" * 100), (None, "n", "z" * 100),
        (10, "long", "Aß\r\n\r\n" * 200_000)]


def expected(rows):
    out = []
    for i, u, h in rows:
        body = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == body and j is not None]
        first = min(same) if same and len(body) >= 100 else None
        revisit = first is not None and (i is None or i > first)
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def round_trip(spark, df, path):
    warc.write_archives(df, path, train_bytes=5000)
    got = warc.read_archives(spark, path)
    return sorted((tuple(r) for r in got.drop("url").collect()), key=repr)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert round_trip(spark, df, f"file://{tmp_path}/w") == expected(ROWS)
    urls = {r["url"] for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert "http://d/%0D%0AX: 1" in urls and None in urls


def test_whole_table_and_dictionary_frames(spark, small_dir, tmp_path):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert round_trip(spark, pages, f"file://{tmp_path}/w") == expected(rows)
    archives = [p.read_bytes() for p in (tmp_path / "w").glob("part-*") if p.stat().st_size]
    assert archives
    for a in archives:
        assert int.from_bytes(a[:4], "little") == warc.DICTIONARY_MAGIC
    payloads = {warc.parse(r)["payload"] for a in archives for r in warc.records_in(a)}
    assert payloads - {None} == {(h or "").encode() for _, _, h in rows}


def test_join_with_first_copies_can_be_split(spark):
    """AQE splits a skewed join only if both its sides are a sort above a shuffle."""
    rows = spark.createDataFrame([(i, "x" * 200, "d") for i in range(9)], "_id long, payload string, digest string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = warc.with_firsts(rows, 100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Aggregate" not in plan
        assert {r["_first"] for r in joined.collect()} == {0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert round_trip(spark, df, f"file://{tmp_path}/w") == []
