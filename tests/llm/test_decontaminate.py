from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from storefront.llm.decontaminate import find_leaks, leaks_of, without_leaks


def grams(text, n=5):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items, share=0.8):
    return sorted((d, i, len(grams(t) & grams(x)), len(grams(x))) for d, t in docs for i, x in items
                  if grams(x) and len(grams(t) & grams(x)) >= share * len(grams(x)))


def found(df, bench, **options):
    rows = leaks_of(df, bench, **options).select("row.doc_id", "leak.item_id", "leak.shared", "leak.size").collect()
    return sorted(map(tuple, rows))


def test_edited_passages_inside_long_texts(spark, documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 70)))) for i in range(60)] + [(60, None), (61, "")]
    docs = []
    for d in range(80):
        body = [rng.choice(words) for _ in range(rng.randint(0, 900))]
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items[:60])[1].split()
            for _ in range(rng.randint(0, 3)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = part
        docs.append((d, " ".join(body).upper() + "."))
    docs += [(900, None), (901, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 20
    assert found(documents(docs), bench) == want
    assert found(documents(docs), bench, part_chars=1500) == want


def test_rows_without_leaks_are_kept_whole(spark, documents):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    df = documents([(1, "x. One two, three four five six seven!"), (2, "clean"), (None, None)]).withColumn("leaks", F.lit("mine"))
    assert sorted((r["doc_id"], r["leaks"]) for r in without_leaks(df, bench).fillna(-1, "doc_id").collect()) == [(-1, "mine"), (2, "mine")]
    assert without_leaks(df, bench.limit(0)).count() == 3
    assert without_leaks(df.limit(0), bench).columns == df.columns
    assert found(documents([(1, "one two three four five six seven")] * 2), bench.union(bench)) == [(1, 1, 3, 3)] * 4


def test_one_part_of_the_items_is_held_at_a_time(spark, documents):
    text = "one two three four five six seven eight nine"
    bench = spark.createDataFrame([(i, f"{text} {i}") for i in range(8)], "item_id long, text string")
    docs = documents([(1, f"{text} 3"), (1, f"{text} 3"), (2, ""), (3, None)])
    out = find_leaks(docs, bench, shingle=5, share=0.8, part_chars=100)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    got = sorted(((r["row"]["doc_id"], sorted(x["item_id"] for x in r["leaks"])) for r in out.collect()))
    assert got == [(1, list(range(8)))] * 2 + [(2, []), (3, [])]
