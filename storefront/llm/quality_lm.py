"""Quality classifier: how well a language model of trusted text predicts a document.

The model is an interpolated modified Kneser-Ney model of order four over
UTF-16 units, one per language, trained on all documents labelled as
trusted. Tasks count n-grams, partial counts are summed by (language, n-gram),
and the model comes from joins of count tables with each other: n-gram with
context totals, with the discounts, and with the next lower order. Documents
are then joined with the model in shards: an n-gram and everything its
backing off needs share their last unit but one, so shard s holds what belongs
to units u with u mod shards = s, every shard has a bounded number of entries
(``shard_entries``; more entries make more shards), and documents stream past
each shard in turn, adding up log probabilities. Texts are never shuffled.

A document's perplexity is taken with ``prior_units`` further units at its
language's mean, so a text of a few words is not judged on chance. It is rejected
above its language's threshold: a quantile of the trusted documents'
perplexities out of fold. Trusted texts are dealt into FOLDS folds by their
hash (equal texts share one), and each is scored by a model of the other
folds, whose counts are all counts less the fold's own. So the threshold is
that of texts the model has not seen, as the judged ones are.

Defined results: null and empty texts have no perplexity and are kept, as are
documents in a language without trusted text, or with trusted text in one fold
only (no threshold); a null language is a language of its own; a document is
trusted if it has labels and all are positive; a null id is never trusted;
repeated rows are each judged; lone surrogates count as units; a very long
text is read in pieces of CHUNK units, all of which count; the columns to
carry travel as one struct, whatever their names. Thresholds are approximate
quantiles (accuracy 10,000).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.llm.shared import column, small_enough, text_key, written

ORDER, BITS = 4, 16
START = 2  # unit that stands before a text's first one
CHUNK = 1 << 20
MASK = [(1 << (BITS * n)) - 1 if n < ORDER else -1 for n in range(ORDER + 1)]
NO_LANG = "\x00"
FOLDS, WHOLE = 5, "all"  # models are named by the fold they leave out, ':' and the language
SUMS = ["total", "n", "out_total", "out_n"]  # log probability and windows, by all folds and without the own one
SMALL = 1_000_000  # rows of (id, flag) or per language that may be broadcast


def units(text: str) -> np.ndarray:
    """The UTF-16 units of ``text`` after ORDER - 1 start units."""
    body = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype="<u2")
    return np.concatenate([np.full(ORDER - 1, START, dtype=np.uint16), body])


def codes(seq: np.ndarray) -> np.ndarray:
    """All windows of ORDER units as 64-bit codes, the last unit lowest."""
    wide, n = seq.astype(np.uint64), len(seq) - ORDER + 1
    out = wide[:n].copy()
    for i in range(1, ORDER):
        out = (out << np.uint64(BITS)) | wide[i:i + n]
    return out


def pieces(text: str) -> Iterator[np.ndarray]:
    """The windows' codes of ``text``, at most CHUNK at a time."""
    seq = units(text)
    for at in range(0, len(seq) - ORDER + 1, CHUNK):
        yield codes(seq[at:at + CHUNK + ORDER - 1])


def count_ngrams(trusted: DataFrame) -> DataFrame:
    """(lang, g, c): how often each 4-gram occurs in ``trusted`` (lang, text,
    fold), for each language's model of all folds and of all but one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[str, int], list[np.ndarray]] = {}
            size = 0
            for lang, text, fold in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                for piece in pieces(text.as_py()):
                    held.setdefault((lang, fold), []).append(piece)
                    size += len(piece)
                if size >= 4 * CHUNK:
                    yield from summed(held)
                    held, size = {}, 0
            yield from summed(held)

    def summed(held: dict[tuple[str, int], list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for (lang, fold), found in held.items():
            g, c = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array([fold] * len(g), pa.int64()),
                                              pa.array(g.view(np.int64)), pa.array(c)], ["lang", "fold", "g", "c"])

    parts = trusted.mapInArrow(run, "lang string, fold long, g long, c long")
    own = [F.coalesce(F.sum(F.when(F.col("fold") == i, F.col("c"))), F.lit(0)) for i in range(FOLDS)]
    counts = parts.groupBy("lang", "g").agg(F.sum("c").alias("c"), F.array(*own).alias("own"))
    models = F.array(F.struct(F.lit(WHOLE).alias("name"), F.col("c")),
                     *[F.struct(F.lit(str(i)).alias("name"), (F.col("c") - F.col("own")[i]).alias("c")) for i in range(FOLDS)])
    return (counts.select("lang", "g", F.explode(models).alias("m")).filter("m.c > 0")
            .select(F.concat("m.name", F.lit(":"), "lang").alias("lang"), "g", "m.c"))


def _with_discounts(grams: DataFrame) -> DataFrame:
    """``grams`` (lang, g, c) with the modified Kneser-Ney discount ``d`` of
    each count, from the language's counts of counts."""
    having = [F.count(F.when(F.col("c") == i, 1)).cast("double").alias(f"n{i}") for i in range(1, 5)]
    per = grams.groupBy("lang").agg(*having)
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        found = i - (i + 1) * y * F.try_divide(f"n{i + 1}", f"n{i}")
        return F.when(found.between(0.05, float(i)), found).otherwise(0.5 * i)  # null where counts are missing

    ds = per.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    # One row per language: sent to the n-grams, which have few languages to be dealt by.
    return grams.join(small_enough(written(ds, "discounts"), SMALL), "lang").select("lang", "g", "c", d.alias("d"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, kind, n, code, value): ``gram`` rows hold the log probability of
    an n-gram, ``back`` rows the log weight a context of order n gives to the
    next lower order (order 0: the probability of an unseen unit)."""
    tables = {ORDER: written(counts, "ngram-counts")}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        tables[n] = written(tables[n + 1].groupBy("lang", F.col("g").bitwiseAND(F.lit(MASK[n])).alias("g")).agg(
            F.count(F.lit(1)).alias("c")), f"continuations-{n}")  # read four times below
    out, lower = [], None
    for n in range(1, ORDER + 1):
        grams = _with_discounts(tables[n]).withColumn("h", F.shiftrightunsigned("g", BITS) if n > 1 else F.lit(0).cast("long"))
        contexts = grams.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("d").alias("mass"), F.count(F.lit(1)).alias("kinds"))
        contexts = contexts.withColumn("gamma", F.col("mass") / F.col("total"))
        rows = grams.join(contexts.select("lang", "h", "total", "gamma", "kinds"), ["lang", "h"])
        if n == 1:
            rows = rows.withColumn("below", 1.0 / (F.col("kinds") + 1))
            out.append(contexts.select("lang", F.lit("back").alias("kind"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("code"),
                                       F.log(F.col("gamma") / (F.col("kinds") + 1)).alias("value")))
        else:
            rows = rows.withColumn("suffix", F.col("g").bitwiseAND(F.lit(MASK[n - 1]))).join(
                lower.select("lang", F.col("g").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
            out.append(contexts.select("lang", F.lit("back").alias("kind"), F.lit(n).alias("n"), F.col("h").alias("code"),
                                       F.log("gamma").alias("value")))
        lower = written(rows.select("lang", "g", ((F.col("c") - F.col("d")) / F.col("total")
                                                  + F.col("gamma") * F.col("below")).alias("p")), f"ngram-model-{n}")
        out.append(lower.select("lang", F.lit("gram").alias("kind"), F.lit(n).alias("n"), F.col("g").alias("code"),
                                F.log("p").alias("value")))
    model = out[0]
    for part in out[1:]:
        model = model.unionByName(part)
    return written(model, "ngram-model")


def _shard(model: DataFrame, shard: int, shards: int) -> dict:
    """The model's tables for one shard: (lang, kind, n) -> sorted codes, values."""
    unit = F.when(F.col("kind") == "gram", F.shiftrightunsigned("code", BITS)).otherwise(F.col("code")).bitwiseAND(F.lit(0xFFFF))
    everywhere = (F.col("n") == 0) | ((F.col("kind") == "gram") & (F.col("n") == 1))
    name = F.concat_ws("\x1f", "lang", "kind", F.col("n").cast("string"))
    wanted = model.filter(everywhere | (unit % shards == shard)).select(name.alias("name"), "code", "value")
    # Names come once, rows as three numbers: the driver holds no more than the tables themselves.
    names = {r["h"]: r["name"] for r in wanted.select("name").distinct().select("name", F.xxhash64("name").alias("h")).collect()}
    rows = wanted.select(F.xxhash64("name").alias("h"), "code", "value").toArrow()
    which, code, value = (rows.column(c).to_numpy() for c in ("h", "code", "value"))
    del rows
    code = code.view(np.uint64)
    order = np.lexsort((code, which))
    which, code, value = which[order], code[order], value[order]
    tables = {}
    for h, text in names.items():
        lang, kind, n = text.rsplit("\x1f", 2)
        own = slice(np.searchsorted(which, h), np.searchsorted(which, h, side="right"))
        tables[lang, kind, int(n)] = (code[own], value[own])
    return tables


def _look_up(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of ``wanted`` codes in a sorted table, and which are there."""
    keys, values = table
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


def log_probabilities(tables: dict, lang: str, found: np.ndarray) -> np.ndarray:
    """log p of each window in ``found``: the longest n-gram that the model
    has, times the weights of the longer contexts that had to back off."""
    out = np.zeros(len(found))
    todo, codes_left = np.arange(len(found)), found
    for n in range(ORDER, 0, -1):
        if (lang, "gram", n) in tables:
            value, there = _look_up(tables[lang, "gram", n], codes_left & np.uint64(MASK[n] & 0xFFFFFFFFFFFFFFFF))
            out[todo[there]] += value[there]
            todo, codes_left = todo[~there], codes_left[~there]
        if not len(todo):
            return out
        if n > 1 and (lang, "back", n) in tables:
            context = (codes_left & np.uint64(MASK[n] & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(BITS)
            value, there = _look_up(tables[lang, "back", n], context)
            out[todo[there]] += value[there]
    out[todo] += tables[lang, "back", 0][1][0]
    return out


def _added(parts: list[DataFrame]) -> DataFrame:
    """(_k1, _k2, total, n, out_total, out_n): the shards' sums for each text,
    added in the order of the shards; repeated texts count once."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    once = rows.groupBy("_k1", "_k2", "shard").agg(*[F.max(c).alias(c) for c in SUMS])
    per = once.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_list(F.struct("shard", *SUMS))).alias("s"))
    add = [F.aggregate(F.col(f"s.{c}"), F.lit(0).cast("long" if c.endswith("n") else "double"), lambda a, x: a + x).alias(c) for c in SUMS]
    return per.select("_k1", "_k2", *add)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
             label: str = "quality", carry: tuple[str, ...] | None = None, quantile: float = 0.995,
             prior_units: int = 100, shard_entries: int = 3_000_000) -> DataFrame:
    """(row, lang, perplexity, threshold, keep, trusted) per row of ``docs``;
    ``row`` is a struct of the columns ``carry`` (all, if None)."""
    own = labels.select(column(labels, doc_id).alias("_id"), column(labels, label).alias("q"))
    trusted_ids = own.groupBy("_id").agg(F.min(F.coalesce("q", F.lit(0))).alias("q")).filter("q >= 1 AND _id IS NOT NULL")
    rows = docs.select(F.struct(*[column(docs, c) for c in (carry or docs.columns)]).alias("row"), column(docs, doc_id).alias("_id"),
                       F.coalesce(column(docs, lang), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(column(docs, text), F.lit("")).alias("text"))
    side = small_enough(trusted_ids.select("_id", F.lit(True).alias("trusted")), SMALL)
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("long")
    trusted = rows.join(side, "_id", "left_semi").select("lang", "text", fold.alias("fold"))
    model = kneser_ney(count_ngrams(trusted))
    shards = max(1, -(-model.count() // shard_entries))

    given = rows.join(side, "_id", "left").select("row", "lang", "text", F.coalesce("trusted", F.lit(False)).alias("trusted"),
                                                  F.when(F.col("trusted"), fold).alias("fold"))
    sums = [T.StructField(c, T.LongType() if c.endswith("n") else T.DoubleType()) for c in SUMS]

    def pass_shard(shared, shard: int, through: list[str]) -> callable:
        """Adds the sums of one shard to the columns ``through``: the log
        probability and windows by the model of all folds, and (trusted
        rows) by the model without the row's own fold."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = shared.value
            known = {key[0] for key in tables}
            for batch in batches:
                total, n = np.zeros((2, batch.num_rows)), np.zeros((2, batch.num_rows), dtype=np.int64)
                held: dict[tuple[int, str], list[tuple[int, np.ndarray]]] = {}
                size = 0
                for i, (language, left_out) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("fold").to_pylist(), strict=True)):
                    models = [(k, name) for k, name in enumerate((f"{WHOLE}:{language}", f"{left_out}:{language}")) if name in known]
                    if not models:
                        continue
                    for piece in pieces(batch.column("text")[i].as_py()):
                        for which in models:
                            held.setdefault(which, []).append((i, piece))
                            size += len(piece)
                        if size >= CHUNK:
                            add(held, total, n, tables)
                            held, size = {}, 0
                add(held, total, n, tables)
                columns = [batch.column(c) for c in through] + [pa.array(x) for k in (0, 1) for x in (total[k], n[k])]
                yield pa.RecordBatch.from_arrays(columns, [*through, *SUMS])

        def add(held: dict, total: np.ndarray, n: np.ndarray, tables: dict) -> None:
            for (k, name), found in held.items():
                doc = np.repeat([i for i, _ in found], [len(p) for _, p in found])
                code = np.concatenate([p for _, p in found])
                if shards > 1:
                    mine = (code >> np.uint64(BITS) & np.uint64(0xFFFF)) % np.uint64(shards) == shard
                    doc, code = doc[mine], code[mine]
                total[k] += np.bincount(doc, weights=log_probabilities(tables, name, code), minlength=total.shape[1])
                n[k] += np.bincount(doc, minlength=n.shape[1])
        return run

    def passed(df: DataFrame, shard: int, through: list[str], name: str) -> DataFrame:
        """One pass past one shard, written, so that no other shard is held beside it."""
        tables = docs.sparkSession.sparkContext.broadcast(_shard(model, shard, shards))
        schema = T.StructType([*[df.schema[c] for c in through], *sums])
        out = written(df.mapInArrow(pass_shard(tables, shard, through), schema), name)
        tables.destroy()
        return out

    if shards == 1:
        scored = passed(given, 0, ["row", "lang", "trusted"], "perplexities")
    else:
        given = given.select("*", *text_key(F.col("lang"), F.col("text"), F.col("fold")))
        texts = given.select("_k1", "_k2", "lang", "text", "fold")
        parts = [passed(texts, shard, ["_k1", "_k2"], f"perplexities-{shard}").withColumn("shard", F.lit(shard)) for shard in range(shards)]
        scored = given.select("row", "lang", "trusted", "_k1", "_k2").join(written(_added(parts), "text-sums"), ["_k1", "_k2"])
        scored = written(scored.drop("_k1", "_k2"), "perplexities")
    means = written(scored.filter("trusted AND n > 0").groupBy("lang").agg(F.coalesce(
        F.try_divide(F.sum("out_total"), F.sum("out_n")), F.sum("total") / F.sum("n")).alias("mean")), "language-means")
    scored = scored.join(small_enough(means, SMALL), "lang", "left")

    def perplexity(total: str, n: str) -> Column:
        return F.when(F.col(n) > 0, F.exp(-(F.col(total) + prior_units * F.col("mean")) / (F.col(n) + prior_units)))

    scored = scored.withColumn("perplexity", perplexity("total", "n"))
    limits = written(scored.filter("trusted").groupBy("lang").agg(
        F.percentile_approx(perplexity("out_total", "out_n"), F.lit(quantile), F.lit(10_000)).alias("threshold")), "thresholds")
    judged = scored.join(small_enough(limits, SMALL), "lang", "left")
    keep = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    language = F.when(F.col("lang") != NO_LANG, F.col("lang"))
    return judged.select("row", language.alias("lang"), "perplexity", "threshold", keep.alias("keep"), "trusted")
