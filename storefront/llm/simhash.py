"""SimHash near-dedup by meet-in-the-middle ball hashing.

Distinct fingerprints emit their variants within half the allowed distance;
two fingerprints that are close enough meet at a common variant. Variants are
shuffled by hash bucket, packed as arrays (10 bytes a variant), and sorted
inside each bucket, whose size is bounded by a parameter.

For an odd distance r = 2k + 1 both sides emit the ball of radius k. A pair at
exactly r has fingerprints of different parity, and one half of the 64 bits
holds k + 1 of its differing bits; so only the side of even parity emits, in
addition, the variants with k + 1 flips inside one half.

Fingerprints that meet are not linked pairwise: whatever meets at a variant is
within r of each member that is there by at most k flips, so the smallest of
those is linked with all others, after checking the distance. That keeps the
connected groups of all links and makes at most one link per emitted variant.

Defined results: null and blank texts have fingerprint zero; texts shorter
than a shingle are one shingle; repeated rows are linked like any equal
texts; a very long text is counted in blocks of shingles, all of them; other
columns travel as one struct, whatever their names; an empty table has no groups;
null ids keep their rows but never name a component that has another id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.components import components
from storefront.llm.shared import column, written

SEED = 42
PER_BUCKET = 250_000  # variants sorted at once
PER_TASK = 4096  # fingerprints that one task makes variants of


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of ``text``, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[starts[i]:ends[i + last] - 1], SEED) for i in range(n)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        block = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str, doc_id: str, shingle: int) -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``; fp is the fingerprint as a
    signed long, text_key a hash of the text."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                                             ["doc_id", "text_key", "fp"])

    rows = docs.select(column(docs, doc_id).alias("doc_id"), F.xxhash64(column(docs, text)).alias("text_key"),
                       column(docs, text).alias("text"))
    return rows.mapInArrow(score, f"doc_id {rows.schema[0].dataType.simpleString()}, text_key long, fp long")


def ball_masks(max_bits: int) -> tuple[np.ndarray, int]:
    """Masks to flip, and how many of them every fingerprint emits (the ball
    of radius max_bits // 2); the others are for even parity only."""
    k, odd = divmod(max_bits, 2)
    near = [c for n in range(k + 1) for c in itertools.combinations(range(64), n)]
    far = [c for half in (range(32), range(32, 64)) for c in itertools.combinations(half, k + 1)] if odd else []
    return np.array([sum(1 << b for b in c) for c in near + far], dtype=np.uint64), len(near)


def links(fps: DataFrame, max_bits: int, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(u, v) between distinct fingerprints of ``fps`` (fp) whose connected
    groups are those of all pairs within ``max_bits`` bits."""
    masks, near = ball_masks(max_bits)
    n = fps.count()
    buckets = max(1, -(-n * len(masks) // per_bucket))
    record = np.dtype([("variant", "<u8"), ("mask", "<u2" if len(masks) <= 65536 else "<u4")])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fp), 2048):
                yield pack(fp[at:at + 2048])

    def pack(fp: np.ndarray) -> pa.RecordBatch:
        even = fp[np.bitwise_count(fp) % 2 == 0]
        out = np.empty(len(fp) * near + len(even) * (len(masks) - near), dtype=record)
        cut = len(fp) * near
        out["variant"][:cut] = (fp[:, None] ^ masks[None, :near]).ravel()
        out["mask"][:cut] = np.tile(np.arange(near), len(fp))
        out["variant"][cut:] = (even[:, None] ^ masks[None, near:]).ravel()
        out["mask"][cut:] = np.tile(np.arange(near, len(masks)), len(even))
        bucket = ((out["variant"] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        out, bucket = out[order], bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[first[1:], len(out)]
        packed = [out[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int64)), pa.array(packed, pa.binary())],
                                          ["bucket", "variants"])

    def meet(table: pa.Table) -> pa.Table:
        got = np.concatenate([np.frombuffer(x.as_buffer(), dtype=record) for x in table.column("variants")])
        got = got[np.argsort(got["variant"], kind="stable")]
        same = got["variant"][1:] == got["variant"][:-1]
        got = got[np.r_[same, False] | np.r_[False, same]]
        if not len(got):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        first = np.flatnonzero(np.r_[True, got["variant"][1:] != got["variant"][:-1]])
        fp = got["variant"] ^ masks[got["mask"]]
        absent = np.uint64(0xFFFFFFFFFFFFFFFF)
        hub = np.minimum.reduceat(np.where(got["mask"] < near, fp, absent), first)
        has_hub = np.logical_or.reduceat(got["mask"] < near, first)
        sizes = np.diff(np.r_[first, len(got)])
        hub, has_hub = np.repeat(hub, sizes), np.repeat(has_hub, sizes)
        linked = has_hub & (hub != fp) & (np.bitwise_count(hub ^ fp) <= max_bits)
        pairs = np.unique(np.stack([hub[linked], fp[linked]], axis=1), axis=0)
        return pa.table({"u": pa.array(pairs[:, 0].view(np.int64)), "v": pa.array(pairs[:, 1].view(np.int64))})

    spread = fps.repartition(max(1, -(-n // PER_TASK)), "fp")  # each row makes hundreds
    variants = spread.mapInArrow(emit, "bucket long, variants binary")
    return variants.groupBy("bucket").applyInArrow(meet, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits, ``text_key``, a hash of the text, and
    ``root``, which tells groups apart that share a ``component_id``."""
    fps = written(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    pairs = written(links(written(distinct.select("fp"), "distinct-fingerprints"), max_bits), "links")
    roots = components(pairs)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.select("fp", "root").join(lows, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select(F.col("doc_id").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0")
                                        .alias("fingerprint"), "component_id", "text_key", "root")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay if one document of each group does: the
    one with the smallest id (of the group's rows with that id, one with the
    smallest text hash; an id may stand for several groups). Rows without an id cannot stand for a group or be told from
    each other, and stay."""
    groups = near_duplicates(docs, text, doc_id, **options).withColumnRenamed(doc_id, "_id")
    stays = groups.filter(F.col("_id") == F.col("component_id")).groupBy("root", "_id").agg(F.min("text_key").alias("_key"))
    rows = docs.select(F.struct(*[column(docs, c) for c in docs.columns]).alias("row"), column(docs, doc_id).alias("_id"),
                       F.xxhash64(column(docs, text)).alias("_key"))
    named = rows.join(stays, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return named.select("row.*").unionByName(rows.filter(F.col("_id").isNull()).select("row.*"))
