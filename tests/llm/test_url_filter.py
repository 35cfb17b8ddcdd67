from __future__ import annotations

import datetime as dt
import random
import re
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from storefront.llm.url_filter import judge, validity

T = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(hours=d)
ENTRY = "list string, key string, added boolean, at timestamp_ntz"
CAPTURE = "page_id long, url string, fetched timestamp_ntz"


def keys_of(url):
    parts = urlsplit(url)
    host, path = (parts.hostname or ""), parts.path or "/"
    if not host:
        return set()
    labels, steps = host.split("."), path.split("/")
    out = {"host:" + host, "url:" + host + path + ("?" + parts.query if parts.query else "")}
    out |= {"domain:" + ".".join(labels[i:]) for i in range(len(labels))}
    return out | {"folder:" + host + "/".join(steps[:i]) + "/" for i in range(1, len(steps))}


def brute(captures, entries):
    out = []
    for page, url, at in captures:
        hits = set()
        if url is not None and at is not None:
            for name, key in {(e[0], e[1]) for e in entries if None not in e} if keys_of(url) else ():
                past = [e for e in entries if e[0] == name and e[1] == key and None not in e and e[3] <= at]
                if key in keys_of(url) and past:
                    last = max(e[3] for e in past)
                    if any(e[2] for e in past if e[3] == last):
                        hits.add((name, key))
        out.append((page, bool(hits), len(hits), ",".join(sorted({n for n, _ in hits}))))
    return sorted(out, key=repr)


def run(spark, captures, entries):
    out = judge(spark.createDataFrame(captures, CAPTURE).withColumn("t", F.lit(1)).withColumn("key", F.lit(2)),
                spark.createDataFrame(entries, ENTRY))
    return sorted((tuple(r) for r in out.select("row.page_id", "blocked", "n_rules", "lists").collect()), key=repr)


def test_matches_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.com", "www.a.com", "b.a.com", "c.org", "x.c.org"]
    urls = [f"{s}://{h}{p}" for s in ("http", "https") for h in hosts for p in ("", "/", "/x/y.html", "/x/?q=1#top", "/x/z/")]
    urls += ["HTTP://User:pw@A.com:8080/x/y.html", "not a url", "http://", "mailto:a@a.com"]
    keys = sorted({k for u in urls for k in keys_of(u)}) + ["domain:com", "folder:a.com/x/"]
    entries = [(rng.choice("pqr"), rng.choice(keys), rng.random() < 0.6, T(rng.randint(0, 30))) for _ in range(300)]
    entries += [("p", "host:a.com", True, T(5)), ("p", "host:a.com", False, T(5)), (None, "host:a.com", True, T(0)),
                ("p", None, True, T(0)), ("p", "host:a.com", None, T(1)), ("p", "host:a.com", True, None)]
    captures = [(i, rng.choice(urls), T(rng.randint(0, 31))) for i in range(300)]
    captures += [(900, None, T(3)), (901, urls[0], None), (None, urls[1], T(9)), (5, urls[1], T(9)), (5, urls[1], T(9))]
    assert run(spark, captures, entries) == brute(captures, entries)
    assert run(spark, captures, []) == brute(captures, [])
    assert run(spark, [], entries) == []


def test_intervals(spark):
    rows = [("p", "k", True, T(1)), ("p", "k", True, T(2)), ("p", "k", False, T(4)), ("p", "k", True, T(6)), ("p", "k", False, T(6))]
    got = validity(spark.createDataFrame(rows, ENTRY)).collect()
    assert sorted((r["valid_from"], r["valid_to"]) for r in got if r["valid_to"]) == [(T(1), T(2)), (T(2), T(4))]
    assert [r["valid_from"] for r in got if r["valid_to"] is None] == [T(6)]


def test_very_long_urls(spark):
    url = "http://" + "a." * 3000 + "com/" + "b/" * 20_000
    assert run(spark, [(1, url, T(1))], [("p", "domain:com", True, T(0)), ("p", "folder:x.y/z/", True, T(0))]) == [(1, True, 1, "p")]


def test_work_grows_with_captures_plus_changes(spark):
    """One hot domain: rows made by joins grow with captures and changes, not with their product."""
    def joined(n):
        captures = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.com/"), F.col("id").cast("string")).alias("url"),
                                         F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 7919 % 2592000)").alias("fetched"))
        entries = spark.range(n).select(F.lit("p").alias("list"), F.lit("domain:a.com").alias("key"), (F.col("id") % 3 != 0).alias("added"),
                                        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 6007 % 2592000)").alias("at"))
        out = judge(captures, entries)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(("<" in j or ">" in j) for j in re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) [^\n]*", plan))
        stack, most = [out._jdf.queryExecution().executedPlan()], 0
        while stack:
            node = stack.pop()
            if node.metrics().contains("numOutputRows"):
                most = max(most, node.metrics().apply("numOutputRows").value())
            kids = node.children()
            stack += [kids.apply(i) for i in range(kids.size())]
            if node.nodeName() == "AdaptiveSparkPlan":
                stack.append(node.executedPlan())
            elif "QueryStage" in node.nodeName():
                stack.append(node.plan())
        return most
    small, large = joined(300), joined(3000)
    assert 300 <= small and large <= 12 * small
