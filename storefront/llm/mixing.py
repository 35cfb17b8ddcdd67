"""Mixing sources to target weights without sorting documents.

Every document has a hash; a source takes the documents whose hash lies under
the source's threshold. Thresholds come from histograms: word counts are
summed by source and hash bucket (a partial aggregate, so a hot source costs
one row per bucket and task), a running sum over the buckets finds the one in
which the budget is reached, and only that bucket is split further, until the
60 bits of the hash are used up. Budgets are nested: a document under the
second copy's threshold is under the first copy's as well.

Defined results: null and empty texts have size 0 and take part with 0 words;
the null source is a source of its own and comes last; rows equal in
every column that is hashed (id, text, source) share one hash and are taken
together; an empty table gives no rows; a source of size 0 has target 0; a
very long text counts in whole; extra columns play no part, whatever their
names. Targets are made from one row a source: sources are few (tens of
thousands fit a task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.shared import WORD, column, written

BITS, LEVELS = 15, 4
SALTS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(*cols: Column) -> Column:
    """60 bits of an MD5 over ``cols`` (nulls marked), the same in any engine."""
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size): weights by
    code point order (null last), together ``share`` of all sizes, none above
    ``most`` times its own size, the excess reshared by weight.

    Resharing ends where targets are min(cap, level x weight). Sources reach
    their cap in the order of cap / weight, so the level follows from running
    sums over that order. One row per source: the sources are the mix's
    components, not documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", weight.cast("long").alias("w"),
                          (F.lit(most) * F.col("source_size")).alias("cap"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(share) * F.sum("source_size").over(everything)
    ranked = ranked.withColumn("level", (budget - capped) / open_weight)
    fits = F.col("level") * F.col("w") <= F.col("cap")
    ranked = ranked.withColumn("level", F.max(F.when(fits, F.col("level"))).over(everything))
    target = F.least(F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source of ``budgets`` (source, rest) the hash bound ``bound``:
    documents of ``sized`` (source, u, size) with ``u < bound`` have about
    ``rest`` words, to within half of the one hash at the boundary.

    Level by level: histogram of the bucket in question, running sum, the
    first bucket whose end reaches the rest becomes the next bucket."""
    at = budgets.select("source", "rest", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("done"))
    for level in range(1, LEVELS + 1):
        width = 1 << (BITS * (LEVELS - level))
        inside = _with_source(sized, at).filter((F.col("u") >= F.col("low"))
                                                & (F.col("u") - F.col("low") < F.lit(width << BITS)))
        bucket = F.floor((F.col("u") - F.col("low")) / F.lit(width)) if level < LEVELS else F.col("u") - F.col("low")
        cells = inside.groupBy("source", bucket.cast("long").alias("b")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("b"))
        ends = (cells.join(at.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
                .withColumn("end", F.col("done") + running))
        reached = ends.filter(F.col("end") >= F.col("rest"))
        first = reached.groupBy("source").agg(F.min(F.struct("b", "end", "words", "rest", "low")).alias("f"))
        start = F.col("f.end") - F.col("f.words")
        at = first.select("source", F.col("f.rest").alias("rest"),
                          (F.col("f.low") + F.col("f.b") * F.lit(width)).alias("low"), start.alias("done"),
                          F.col("f.end").alias("end"))
    nearer = (F.col("end") - F.col("rest")) < (F.col("rest") - F.col("done"))
    return at.select("source", (F.col("low") + F.when(nearer, 1).otherwise(0)).alias("bound"))


def _with_source(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """``sized`` joined with one row per source. Documents are spread over
    ``SALTS`` copies of it, so a source that holds a third of all rows does
    not meet in one task."""
    spread = per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) \
        .withColumnRenamed("source", "_s")
    docs = sized.withColumn("_salt", (F.col("u") % SALTS).cast("int"))
    cond = docs["source"].eqNullSafe(spread["_s"]) & (docs["_salt"] == spread["_salt"])
    return docs.join(spread, cond).drop("_salt", "_s")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``source``, ``size`` (words),
    ``source_size``, ``target`` of its source and ``taken``: the words the mix
    takes of it, ``size`` times its number of copies."""
    cols = [column(docs, c) for c in (doc_id, source, text)]
    sized = written(docs.select(cols[0].alias("doc_id"), cols[1].alias("source"), word_count(cols[2]).alias("size"),
                                document_hash(*cols).alias("u")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.floor(F.try_divide(F.col("target"), F.col("source_size")))
    plan = written(source_targets(sizes, weights, share, most)
                   .withColumn("copies", F.coalesce(whole, F.lit(0)).cast("long"))
                   .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")
    bounds = thresholds(sized, plan.filter(F.col("rest") > 0).select("source", "rest"))
    plan = plan.join(bounds.withColumnRenamed("source", "_b"), F.col("source").eqNullSafe(F.col("_b")), "left")
    plan = plan.select("source", "source_size", "target", "copies", F.coalesce("bound", F.lit(0)).alias("bound"))
    copies = F.col("copies") + F.when(F.col("u") < F.col("bound"), 1).otherwise(0)
    return _with_source(sized, plan).select(
        F.col("doc_id").alias(doc_id), F.col("source").alias(source), "size", "source_size", "target",
        (F.col("size") * copies).cast("long").alias("taken"))
