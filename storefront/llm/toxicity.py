"""Toxicity by weak supervision.

Voters are mined from a bounded sample of labelled training rows: words and
word beginnings whose presence nearly always means toxic (a confidence bound
on their precision picks them), and fixed patterns. A generative label model,
which sees the votes only, estimates how often each voter fires on toxic and
on clean texts, and how voters depend on each other within the toxic class;
correlated voters share one say. Its posteriors are the labels of a
logistic regression over words and word beginnings, which scores every
document in one pass; the weights that travel are bounded by a parameter.

The sample's bound (``max_train``) limits the fit alone. Copies of a text count once
in it. Labels outside the training rows are never read; language, source and
id are not features.

Defined results: null and empty texts get the classifier's score of a text
without features; repeated rows are each scored; a document with several
labels is toxic if one says so; rows with null ids are scored, never learnt
from, and not held out; without labelled rows of both classes, or without a
word that votes, every score is the share of toxic training rows (0 if there
are none); a very long text is read in whole; extra columns play no part,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.shared import column, small_enough, written

PREFIXES = (4, 5, 6, 7, 8)
_WORDS = re.compile(r"\w+")
# Pattern voters over the unchanged text; the label model finds their polarity.
PATTERNS = (r"(.)\1{4,}", r"!{2,}", r"\?{2,}", r"\w[*#$%@]{2,}\w", r"[*#$%&]{3,}", r"\b[A-Z]{4,}(?:\W+[A-Z]{4,}){3,}",
            r"[A-Z]{12,}", r"(?:\b\w{1,2}\b\W*){12,}")


def features(text: str | None) -> set[str]:
    """The words of a text, lower-cased, and their beginnings (with a star)."""
    words = set(_WORDS.findall((text or "").lower()))
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(text, toxic) of a sample of about ``max_train`` labelled training rows."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = known.count()
    share = min(1.0, max_train / max(1, total))
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(small_enough(known, 2 * max_train), "doc_id")
    return joined.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def count_features(train: DataFrame, least: int) -> DataFrame:
    """(feature, n, bad): in how many training texts, and toxic ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, bad = [], []
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = features(text.as_py())
                names.extend(own)
                bad.extend([toxic] * len(own))
                if len(names) > 100_000:
                    yield batch_of(names, bad)
                    names, bad = [], []
            yield batch_of(names, bad)

    def batch_of(names: list[str], bad: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bad, pa.int32())], ["feature", "bad"])

    rows = train.select("text", "toxic").mapInArrow(run, "feature string, bad int")
    return rows.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")).filter(F.col("n") >= least)


def votes(train: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``names`` and ``PATTERNS`` occur in each training text, as two 0/1 arrays."""
    place = {f: i for i, f in enumerate(names)}
    width = len(names) + len(PATTERNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(p) for p in PATTERNS]
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                row = np.zeros(width, dtype=np.uint8)
                row[[place[f] for f in features(text) if f in place]] = 1
                row[len(names):] = [p.search(text) is not None for p in patterns]
                out.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["bits"])

    packed = train.select("text").mapInArrow(run, "bits binary").toArrow().column("bits").to_pylist()
    bits = np.unpackbits(np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1), axis=1)[:, :width]
    return bits[:, :len(names)], bits[:, len(names):]


def label_model(fired: np.ndarray, prior: float, lexicon: int, rounds: int = 25) -> np.ndarray:
    """P(toxic) of each row of votes.

    A voter that does not fire abstains; one more voter, for clean, fires
    where no lexicon voter (the first ``lexicon`` columns) does. How often
    each fires on either class is fitted by expectation maximisation from a
    start at which any lexicon vote means toxic. Half way, the correlations
    of the voters within the toxic class are estimated: voters that fire
    together share one say."""
    silent = ~fired[:, :lexicon].any(axis=1, keepdims=True)
    x = np.hstack([fired, silent]).astype(np.float32)
    q = np.where(silent[:, 0], 0.02, 0.95)
    say = np.ones(x.shape[1])
    for step in range(rounds):
        on = (x.T @ q + 0.5) / (q.sum() + 1.0)  # fires, given toxic
        off = (x.T @ (1 - q) + 0.5) / ((1 - q).sum() + 1.0)  # fires, given clean
        if step == rounds // 2:
            centred = (x - on) * np.sqrt(q)[:, None]
            cov = centred.T @ centred / max(q.sum(), 1.0)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = cov / sd[:, None] / sd[None, :]
            say = 1.0 / np.where(corr > 0.5, corr, 0.0).sum(axis=1).clip(min=1.0)
        logit = np.log(prior / (1 - prior)) + x @ (np.log(on / off) * say)
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return q


def logistic(x: np.ndarray, q: np.ndarray, ridge: float = 0.3, rounds: int = 10) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression on soft labels ``q``,
    by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30).astype(np.float64)))
        slope = (x.T @ (q - p).astype(np.float32)).astype(np.float64) - penalty * w
        weights = np.maximum(p * (1 - p), 1e-4).astype(np.float32)
        curve = np.diag(penalty)
        for at in range(0, len(x), 2048):
            part = x[at:at + 2048]
            curve += part.T @ (part * weights[at:at + 2048, None])
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, max_voters: int = 200,
        max_features: int = 1000) -> tuple[dict[str, float], float]:
    """The classifier: weights by feature, and its bias."""
    train = written(training_rows(docs, labels, max_train), "toxicity-train")
    n, bad = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = bad / n if n else 0.0
    if not bad or bad == n:
        return {}, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    z, rate = 1.96, F.col("bad") / F.col("n")
    middle = rate + z * z / (2 * F.col("n"))
    spread = z * F.sqrt(rate * (1 - rate) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))
    # Lower bound of the precision; how far the feature's toxic count is from chance.
    ranked = (count_features(train, least=max(5, n // 2000)).withColumn("sure", (middle - spread) / (1 + z * z / F.col("n")))
              .withColumn("far", F.abs(F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))))
    ranked = written(ranked, "toxicity-features")
    lexicon = [r["feature"] for r in ranked.filter(F.col("sure") > max(0.5, 2 * share if share < 0.4 else share))
               .orderBy(F.desc("far"), "feature").limit(max_voters).collect()]
    others = [r["feature"] for r in ranked.orderBy(F.desc("far"), "feature").limit(max_features).collect()]
    names = lexicon + [f for f in others if f not in set(lexicon)][:max_features - len(lexicon)]
    if not lexicon:
        return {}, float(np.log(share / (1 - share)))
    found, patterns = votes(train, names)
    q = label_model(np.hstack([found[:, :len(lexicon)], patterns]), share, len(lexicon))
    w, b = logistic(found, q)
    return {f: float(v) for f, v in zip(names, w, strict=True)}, b


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", **bounds: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    known = labels.select(column(labels, doc_id).alias("doc_id"), column(labels, "toxic").alias("toxic"))
    weights, bias = fit(rows, known, **bounds)
    exact = {f: v for f, v in weights.items() if not f.endswith("*")}
    starts = {n: {f[:-1]: v for f, v in weights.items() if f.endswith("*") and len(f) == n + 1} for n in PREFIXES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for one in batch.column(1):
                words = set(_WORDS.findall((one.as_py() or "").lower()))
                total = sum(exact[w] for w in sorted(words & exact.keys()))
                for n, known_starts in starts.items():
                    heads = {w[:n] for w in words if len(w) > n}
                    total += sum(known_starts[h] for h in sorted(heads & known_starts.keys()))
                sums.append(total)
            p = 1 / (1 + np.exp(-np.clip(np.array(sums, dtype=np.float64) + bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, score double")
    return scored.select(F.col("doc_id").alias(doc_id), held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
