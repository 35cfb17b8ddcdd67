from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from storefront.llm import quality_lm as Q

ORDER = Q.ORDER


def windows(text):
    padded = [Q.START] * (ORDER - 1) + [u for c in text for u in _utf16(c)]
    return [tuple(padded[i:i + ORDER]) for i in range(len(padded) - ORDER + 1)]


def _utf16(c):
    b = c.encode("utf-16-le")
    return [b[i] | b[i + 1] << 8 for i in range(0, len(b), 2)]


class Brute:
    """The model by its definition, on dictionaries."""

    def __init__(self, texts):
        counts = {ORDER: Counter(w for t in texts for w in windows(t))}
        for n in range(ORDER - 1, 0, -1):
            counts[n] = Counter(g[1:] for g in counts[n + 1])
        self.counts, self.d, self.total, self.mass = counts, {}, {}, {}
        for n, c in counts.items():
            of = Counter(c.values())
            d = {}
            for i in (1, 2, 3):
                found = None
                if of[1] and of[i]:
                    found = i - (i + 1) * of[1] / (of[1] + 2 * of[2]) * of[i + 1] / of[i]
                d[i] = found if found is not None and 0.05 <= found <= i else 0.5 * i
            self.d[n] = d
            total, mass = defaultdict(int), defaultdict(float)
            for g, k in c.items():
                total[g[:-1]] += k
                mass[g[:-1]] += d[min(k, 3)]
            self.total[n], self.mass[n] = total, mass

    def p(self, g):
        n = len(g)
        if n == 0:
            return 1 / (len(self.counts[1]) + 1)
        h = g[:-1]
        if h not in self.total[n]:
            return self.p(g[1:])
        k = self.counts[n].get(g, 0)
        own = (k - self.d[n][min(k, 3)]) / self.total[n][h] if k else 0.0
        return own + self.mass[n][h] / self.total[n][h] * self.p(g[1:])

    def log(self, text):
        return sum(math.log(self.p(w)) for w in windows(text))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    text = lambda letters, n: " ".join(word(letters) for _ in range(n))
    rows = [(i, text("abcde", rng.randint(3, 60)), "en", "s", 0) for i in range(60)]
    rows += [(100 + i, text("éàxyz😀", rng.randint(3, 60)), "fr", "s", 0) for i in range(30)]
    rows += [(200, "QQQ!!! ### ZZZ " * 20, "en", "s", 0), (201, "", "en", "s", 0), (202, None, "en", "s", 0),
             (203, "abc dea", None, "s", 0), (204, "tout", "xx", "s", 0), (None, "abc", "en", "s", 0), (0, "abc abc", "en", "s", 0)]
    labels = [(i, 1, 0) for i in range(50)] + [(100 + i, 1, 0) for i in range(25)] + [(200, 0, 0), (51, 1, 0), (51, 0, 0), (None, 1, 0), (52, None, 0)]
    return rows, labels


@pytest.mark.parametrize("shard_entries", [3_000_000, 200])
def test_scores_match_the_definition(spark, documents, corpus, shard_entries):
    rows, labels = corpus
    df = documents(rows).withColumn("row", F.lit(1)).withColumn("total", F.lit("t"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = Q.classify(df, lab, carry=("doc_id", "text", "total"), prior_units=0, shard_entries=shard_entries).collect()
    assert len(out) == len(rows)
    good = {i for i in range(50)} | {100 + i for i in range(25)}
    models = {lang: Brute([t or "" for i, t, x, _, _ in rows if x == lang and i in good]) for lang in ("en", "fr")}
    for r in out:
        text, lang = r["row"]["text"] or "", r["lang"]
        assert r["row"]["total"] == "t"
        if not text or lang not in models:
            assert r["perplexity"] is None and r["keep"]
            continue
        assert r["perplexity"] == pytest.approx(math.exp(-models[lang].log(text) / sum(len(_utf16(c)) for c in text)), rel=1e-9)
    gone = {r["row"]["doc_id"] for r in out if not r["keep"]}
    assert 200 in gone and not gone & good


def test_threshold_is_the_quantile_of_trusted_texts_out_of_fold(spark, documents, corpus):
    rows, labels = corpus
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = documents(rows)
    out = Q.classify(df, lab, carry=("doc_id", "text"), prior_units=0).collect()
    fold = {r["text"]: r["f"] for r in df.select("text", F.pmod(F.xxhash64("text"), F.lit(Q.FOLDS)).alias("f")).collect()}
    for lang, ids in (("en", range(50)), ("fr", range(100, 125))):
        good = [t for i, t, x, _, _ in rows if x == lang and i in ids]
        models = {f: Brute([t for t in good if fold[t] != f]) for f in range(Q.FOLDS)}
        each = [math.exp(-models[fold[t]].log(t) / sum(len(_utf16(c)) for c in t)) for t in good]
        assert all(r["threshold"] == pytest.approx(max(each), rel=1e-9) for r in out if r["lang"] == lang)


def test_tables_without_rows_or_labels(spark, documents, corpus):
    rows, labels = corpus
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert Q.classify(documents([]), lab).collect() == []
    assert all(r["keep"] and r["perplexity"] is None for r in Q.classify(documents(rows[:5]), lab.limit(0)).collect())


def test_junk_goes_and_trusted_rows_stay(spark, small_dir, small_documents):
    lab = spark.read.parquet(f"{small_dir}/labels.parquet")
    out = Q.classify(small_documents, lab, carry=("doc_id",)).select("row.doc_id", "keep").join(lab, "doc_id")
    share = {r["quality"]: r["kept"] for r in out.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share.get(0, 0) < 0.5
