"""Substring dedup: word windows that also start anywhere else are removed.

Suffix automata of reference shards decide: the spans that may repeat are
the references, a shard's automaton counts every substring of its spans, and
spans are streamed past it for matching statistics; runs of windows that occur
again make the maximal spans that are removed. An automaton of the whole
corpus past which every document streams would cost (shards x corpus), so
spans are routed to the one shard that can hold their partners:

1. A window's anchor is the smallest hash among its 8-word grams, so equal
   windows have equal anchors. Anchors are counted over all documents (one
   row per anchor and task).
2. Anchors that occur once end there. The others are put into a filter of
   fixed size (``filter_bytes``), broadcast; when it fills up it lets more
   through, which costs work and changes no result. Anchors that tasks would
   send with very many spans are in a second such filter: their windows are
   counted themselves, and those that may repeat go into a third.
3. The runs of windows that passed are dealt to buckets by anchor, or by the
   window's own hash under a frequent anchor, so that no anchor gathers its
   occurrences in one task; a task sends equal spans once. Each bucket's spans
   make reference shards of about ``shard_words`` words.

Words travel as 32-bit hashes, compared in sequence; two different windows
would be taken as equal only if every differing word collides.

Defined results: null and blank texts have no words; texts of fewer words
than a window lose nothing; repeated rows are each other's copies and lose
every window; extra columns play no part, whatever their names; a very long
text is one row of work, in whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.shared import column, text_key, written
from storefront.llm.suffix_automaton import SuffixAutomaton

GRAM = 8
REF = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("start", "<i4")])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of ``text``."""
    words, digest = (text or "").encode().split(), xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` values, from windows of powers of two."""
    n = len(values) - size + 1
    out, done, part, width = None, 0, values, 1
    while True:
        if size & width:  # take this width as the windows' next piece
            piece = part[done:done + n]
            out = piece if out is None else out * np.uint64(pow(BASE, width, 1 << 64)) + piece
            done += width
        if done == size:
            return mixed(out)
        part = part[:-width] * np.uint64(pow(BASE, width, 1 << 64)) + part[width:]
        width *= 2


class Windows:
    """The windows of one text: word hashes, and runs of windows (start, end)
    with a common anchor."""

    def __init__(self, text: str | None, size: int):
        self.size, self.full = size, word_hashes(text)
        if len(self.full) < size:
            self.starts = self.ends = np.empty(0, dtype=np.int64)
            self.anchors = np.empty(0, dtype=np.uint64)
            return
        gram = rolling(self.full, GRAM)
        span = size - GRAM + 1  # grams in a window
        place, least, width = np.arange(len(gram), dtype=np.int32), gram, 1
        while width < span:  # place[i], least[i]: the leftmost smallest of the next `width` grams
            hop = min(width, span - width)
            later = least[hop:] < least[:-hop]
            place, least = np.where(later, place[hop:], place[:-hop]), np.where(later, least[hop:], least[:-hop])
            width += hop
        self.starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        self.ends = np.r_[self.starts[1:], len(place)]
        self.anchors = least[self.starts]

    @cached_property
    def hashes(self) -> np.ndarray:
        """Hashes of all windows."""
        return rolling(self.full, self.size)

    @cached_property
    def spans(self) -> np.ndarray:
        """Hashes of the runs' words: their first and last windows cover them."""
        return mixed(self.hashes[self.starts] * np.uint64(BASE) + self.hashes[self.ends - 1])


class Filter:
    """A set of hashes that may hold more than was put in, of fixed size."""

    SLOTS = 1024

    def __init__(self, parts: dict[int, bytes], size: int):
        self.bits = np.zeros(size, dtype=np.uint8)
        width = size // self.SLOTS
        for slot, part in parts.items():
            self.bits[slot * width:(slot + 1) * width] = np.frombuffer(part, dtype=np.uint8)
        self.size = size

    @staticmethod
    def place(hashes: np.ndarray, size: int) -> np.ndarray:
        return hashes >> np.uint64(8) & np.uint64(8 * size - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self.place(hashes, self.size)
        return self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1

    @classmethod
    def of(cls, hashes: DataFrame, size: int) -> Filter:
        """A filter of ``size`` bytes (a power of two) holding ``hashes`` (h),
        made slot by slot."""
        width = size // cls.SLOTS
        place, slots = cls.place, cls.SLOTS

        def fill(table: pa.Table) -> pa.Table:
            at = place(table.column("h").to_numpy().view(np.uint64), size)
            bits = np.zeros(width, dtype=np.uint8)
            inside = at & np.uint64(8 * width - 1)
            np.bitwise_or.at(bits, inside >> np.uint64(3), np.uint8(1) << (inside & np.uint64(7)).astype(np.uint8))
            return pa.table({"slot": pa.array([int(at[0]) // (8 * width)], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

        slot = F.floor(F.shiftrightunsigned("h", 8).bitwiseAND(F.lit(8 * size - 1)) / (8 * size // slots))
        parts = hashes.select("h", slot.alias("slot")).groupBy("slot").applyInArrow(fill, "slot long, bits binary")
        return cls({r["slot"]: bytes(r["bits"]) for r in parts.collect()}, size)


def _counted(rows: DataFrame, hashes_of) -> DataFrame:
    """(h, n, spans): how often each hash occurs that ``hashes_of`` finds in a
    text, and how many rows with different spans the tasks will send for it.
    ``hashes_of`` gives two arrays, the hashes and their spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0):
                held.append(hashes_of(text.as_py()))
                size += len(held[-1][0])
                if size > 500_000:
                    yield summed(held)
                    held, size = [], 0
            yield summed(held)

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, span = (np.concatenate([np.empty(0, dtype=np.uint64), *[x[i] for x in held]]) for i in (0, 1))
        order = np.lexsort((span, h))
        h, span = h[order], span[order]
        new = np.r_[True, h[1:] != h[:-1]][:len(h)]
        first = np.flatnonzero(new)
        other = (new | np.r_[True, span[1:] != span[:-1]][:len(h)]).astype(np.int64)
        spans = np.add.reduceat(other, first) if len(h) else other
        return pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(np.diff(np.r_[first, len(h)])), pa.array(spans)],
                                          ["h", "n", "spans"])

    return rows.select("text").mapInArrow(run, "h long, n long, spans long").groupBy("h").agg(
        F.sum("n").alias("n"), F.sum("spans").alias("spans"))


def _spans(rows: DataFrame, size: int, buckets: int, repeated, frequent, windows) -> DataFrame:
    """(bucket, key, tokens, refs): runs of windows that may repeat, equal ones
    of a task together, with where they start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[int, bytes], list] = defaultdict(list)
            for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = Windows(text.as_py(), size)
                kept = repeated.value.has(found.anchors)
                if not kept.any():
                    continue
                hot = kept & frequent.value.has(found.anchors)
                tokens = found.full.astype(np.uint32).tobytes()
                for r in np.flatnonzero(kept & ~hot).tolist():
                    at, end = int(found.starts[r]), int(found.ends[r])
                    held[int(found.anchors[r]), tokens[4 * at:4 * (end + size - 1)]].append((k1, k2, at))
                if hot.any():
                    places = np.flatnonzero(np.repeat(hot, found.ends - found.starts))
                    places = places[windows.value.has(found.hashes[places])]
                    for at, key in zip(places.tolist(), found.hashes[places].tolist(), strict=True):
                        held[key, tokens[4 * at:4 * (at + size)]].append((k1, k2, at))
                if len(held) > 50_000:
                    yield packed(held)
                    held = defaultdict(list)
            yield packed(held)

    def packed(held: dict) -> pa.RecordBatch:
        keys = np.array([k for k, _ in held], dtype=np.uint64)
        refs = [np.array(v, dtype=REF).tobytes() for v in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array((keys % np.uint64(buckets)).astype(np.int64)), pa.array(keys.view(np.int64)),
             pa.array([t for _, t in held], pa.binary()), pa.array(refs, pa.binary())], ["bucket", "key", "tokens", "refs"])

    return rows.select("_k1", "_k2", "text").mapInArrow(run, "bucket long, key long, tokens binary, refs binary")


def _find(size: int, shard_words: int):
    """Per bucket, the word ranges (k1, k2, start, stop) of repeated windows."""
    def run(table: pa.Table) -> pa.Table:
        spans: dict[int, dict[bytes, list[bytes]]] = defaultdict(lambda: defaultdict(list))
        columns = (table.column(c).to_pylist() for c in ("key", "tokens", "refs"))
        for key, tokens, refs in zip(*columns, strict=True):
            spans[key][tokens].append(refs)
        out: list[np.ndarray] = []
        shard: list[tuple[list[int], np.ndarray]] = []
        words = 0
        for own in spans.values():
            members = [(np.frombuffer(t, dtype=np.uint32), np.frombuffer(b"".join(refs), dtype=REF)) for t, refs in own.items()]
            # A span that occurs again as a whole repeats throughout.
            out += [places_of(refs, 0, len(t)) for t, refs in members if len(refs) > 1]
            if len(members) == 1:
                continue  # all of the anchor's spans are equal, or it passed the filter by chance
            shard += [(t.tolist(), refs) for t, refs in members]
            words += sum(len(t) for t, _ in members)
            if words >= shard_words:
                out += ranges(shard)
                shard, words = [], 0
        out += ranges(shard)
        got = np.concatenate([np.empty((0, 4), dtype=np.int64), *out])
        return pa.table({n: pa.array(got[:, i]) for i, n in enumerate(("k1", "k2", "start", "stop"))})

    def places_of(refs: np.ndarray, start: int, stop: int) -> np.ndarray:
        """The words ``start`` to ``stop`` of a span, wherever it occurs."""
        first = refs["start"].astype(np.int64)
        return np.stack([refs["k1"], refs["k2"], first + start, first + stop], axis=1)

    def ranges(shard: list[tuple[list[int], np.ndarray]]) -> Iterator[np.ndarray]:
        automaton = SuffixAutomaton()
        for sequence, refs in shard:
            automaton.add(sequence, len(refs))
        automaton.total()
        for sequence, refs in shard:
            if len(refs) > 1:
                continue
            again = np.array([False, *automaton.repeated_windows(sequence, size), False])
            edges = np.flatnonzero(again[1:] != again[:-1])
            for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                yield places_of(refs, start, stop + size - 1)
    return run


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 35,
                   filter_bytes: int = 1 << 25, frequent: int = 500, bucket_rows: int = 20_000,
                   shard_words: int = 20_000) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and
    ``kept_text``, the words left joined by one blank."""
    if window <= GRAM:
        raise ValueError(f"windows must be longer than {GRAM} words")
    context = docs.sparkSession.sparkContext
    rows = docs.select(column(docs, doc_id).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    rows = rows.select("*", *text_key(F.col("doc_id"), F.col("text")))

    def anchors_of(one: str) -> tuple[np.ndarray, np.ndarray]:
        found = Windows(one, window)
        return found.anchors, found.spans if len(found.anchors) else found.anchors

    anchors = written(_counted(rows, anchors_of).filter("n > 1"), "repeated-anchors")
    repeated = context.broadcast(Filter.of(anchors.select("h"), filter_bytes))
    hot = context.broadcast(Filter.of(anchors.filter(F.col("spans") > frequent).select("h"), filter_bytes // 32))

    def hot_windows_of(one: str) -> tuple[np.ndarray, np.ndarray]:
        found = Windows(one, window)
        own = hot.value.has(found.anchors)
        h = found.hashes[np.repeat(own, found.ends - found.starts)] if own.any() else found.anchors[:0]
        return h, h

    again = _counted(rows, hot_windows_of).filter("n > 1").select("h")
    windows = context.broadcast(Filter.of(again, filter_bytes // 4))
    total = anchors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    spans = _spans(rows, window, max(1, -(-int(total) // bucket_rows)), repeated, hot, windows)
    found = spans.groupBy("bucket").applyInArrow(_find(window, shard_words), "k1 long, k2 long, start long, stop long")
    cuts = written(found.groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).agg(
        F.collect_list(F.struct("start", "stop")).alias("cuts")), "repeated-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for one, ranges in zip(batch.column(1), batch.column(2), strict=True):
                words = one.as_py().encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for r in ranges.as_py() or ():
                    gone[r["start"]] += 1
                    gone[r["stop"]] -= 1
                stay = (np.cumsum(gone)[:-1] == 0).tolist()
                left = [w for w, s in zip(words, stay, strict=True) if s]
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    out = rows.join(cuts, ["_k1", "_k2"], "left").select("doc_id", "text", "cuts").mapInArrow(
        cut, f"doc_id {rows.schema[0].dataType.simpleString()}, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("doc_id", doc_id)
