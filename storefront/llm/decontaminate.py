"""Benchmark decontamination: short test items inside long documents.

Size-partitioned MinHash containment: items are put into classes by their
number of distinct shingles (powers of two), and an item's signature is its
smallest shingle hashes, as many as its class needs so that a document
holding the required share of the item must hold one of them: with at most
(1 - share) x u misses in a class of up to u shingles, that is
floor((1 - share) x u) + 1 hashes. Documents of any length are streamed
once; each of their shingle hashes is looked up among the signatures, and
the candidates are verified by the exact share of the item's shingles
(compared as texts) that the document holds. No candidate is missed and none
is taken on its hash alone.

The items travel to the tasks in parts of a bounded size (``part_chars``);
a larger benchmark takes one pass over the documents for each part, and the
leaks of a pass are written, by a key of the text, before the next begins.

Defined results: words are runs of letters, digits and underscores,
lower-cased; items with fewer words than a shingle, empty or null, match
nothing; repeated items are each reported; null or empty documents hold
nothing; every row of the documents is judged on its own, a very long text in
whole; a row's columns travel as one struct, whatever their names. An empty
table has no leaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from storefront.llm.shared import column, text_key, written

_WORDS = re.compile(r"\w+")


def shingles(text: str | None, size: int) -> list[str]:
    """The word shingles of ``text``, in order, repeats included."""
    words = _WORDS.findall((text or "").lower())
    joined = " ".join(words)
    ends, at = [], 0
    for w in words:
        at += len(w) + 1
        ends.append(at)
    return [joined[a:b - 1] for a, b in zip([0, *ends], ends[size - 1:], strict=False)]


def signature(item: set[str], share: float) -> list[int]:
    """The smallest hashes of an item's shingles that its size class needs."""
    upper = 1 << max(0, len(item) - 1).bit_length()
    needed = int((1 - share) * upper + 1e-9) + 1
    return sorted(xxhash.xxh64_intdigest(s) for s in item)[:needed]


def _count(items: DataFrame, part_chars: int) -> int:
    """How many parts of about ``part_chars`` characters the items make."""
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return -(-chars // part_chars) or 1


def _part(items: DataFrame, part: int, parts: int) -> list[tuple]:
    own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
    return [(r["item_id"], r["text"]) for r in own.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", shingle: int = 5, share: float = 0.8,
               part_chars: int = 32_000_000) -> DataFrame:
    """(row, leaks) per row of ``docs``: the row itself as a struct and an
    array of (item_id, shared, size, containment) of the items of which it
    holds at least ``share``."""
    items = benchmark.select(column(benchmark, item_id).alias("item_id"), column(benchmark, item_text).alias("text"))
    leak = StructType([StructField("item_id", items.schema[0].dataType), StructField("shared", LongType()),
                       StructField("size", LongType()), StructField("containment", DoubleType())])
    leaks_type = StructField("leaks", ArrayType(leak))
    rows = docs.select(F.struct(*[column(docs, c) for c in docs.columns]).alias("row"), column(docs, text).alias("text"))

    def search(sets: list[tuple], index: dict[int, list[int]], doc: str | None) -> list[dict]:
        found = shingles(doc, shingle)
        digest = xxhash.xxh64_intdigest
        hits = {i for s in set(found) if (i := digest(s)) in index}
        candidates = sorted({n for h in hits for n in index[h]})
        held = set(found) if candidates else ()
        leaks = []
        for n in candidates:
            item, own = sets[n]
            shared = len(own & held)
            if shared >= share * len(own) - 1e-9:
                leaks.append({"item_id": item, "shared": shared, "size": len(own), "containment": shared / len(own)})
        return leaks

    def judge(part, through: list[str]) -> callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets = [(item, own) for item, t in part.value if (own := set(shingles(t, shingle)))]
            index: dict[int, list[int]] = {}
            for n, (_, own) in enumerate(sets):
                for h in signature(own, share):
                    index.setdefault(h, []).append(n)
            for batch in batches:
                leaks = [search(sets, index, doc.as_py()) for doc in batch.column("text")]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in through], pa.array(leaks, to_arrow_type(leaks_type.dataType))],
                                                 [*through, "leaks"])
        return run

    def passed(df: DataFrame, part, through: list[str]) -> DataFrame:
        return df.mapInArrow(judge(part, through), StructType([*[df.schema[c] for c in through], leaks_type]))

    parts = _count(items, part_chars)
    if parts == 1:
        return passed(rows, docs.sparkSession.sparkContext.broadcast(_part(items, 0, 1)), ["row"])
    # Each pass is written before the next, so that no other part's items are held beside its own.
    keyed, found = rows.select("*", *text_key(F.col("text"))), []
    for part in range(parts):
        own = docs.sparkSession.sparkContext.broadcast(_part(items, part, parts))
        hits = passed(keyed.select("text", "_k1", "_k2"), own, ["_k1", "_k2"]).filter(F.size("leaks") > 0)
        found.append(written(hits, "leaks").withColumn("part", F.lit(part)))
        own.unpersist()
    once = reduce(DataFrame.unionByName, found).groupBy("_k1", "_k2", "part").agg(F.first("leaks").alias("leaks"))
    per = once.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_list(F.struct("part", "leaks"))).alias("s"))
    per = written(per.select("_k1", "_k2", F.flatten("s.leaks").alias("leaks")), "text-leaks")
    return keyed.join(per, ["_k1", "_k2"], "left").select("row", F.coalesce("leaks", F.array().cast(leaks_type.dataType)).alias("leaks"))


def leaks_of(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document row and item found in it: the document's columns
    under ``row``, and the leak's under ``leak``."""
    return find_leaks(docs, benchmark, **options).select("row", F.explode("leaks").alias("leak"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    return find_leaks(docs, benchmark, **options).filter(F.size("leaks") == 0).select("row.*")
