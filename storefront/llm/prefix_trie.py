"""The prefix trie of conversations, from adaptive radix trees over sorted runs.

A turn is a 16-byte id (a hash of role and text), a conversation the string of
its ids; texts never move. Equal conversations are counted before they meet.
The different ones are dealt by range of their ids, sorted, and each task runs
through them in order, building one radix tree after another of a bounded
number of turns. A node that several trees share (a first turn that a third of
all conversations begin with) is cut only along the prefix that the last key
of one tree shares with the first key of the next, and every number of a node
is a sum or a minimum over its trees plus one correction a cut: so parts are
added up by a partial aggregate, and no task has to hold a node's members.

Defined results: rows without a conversation id play no part; a null role or
text is empty; turns of one conversation with the same number come in the
order of their ids, repeated rows are turns of their own; an empty table has
no nodes; columns other than the four named play no part, whatever their
names; a long text is hashed and counted where it lies. The ids of one
conversation (16 bytes a turn) are one row and must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.radix_tree import RadixTree
from storefront.llm.shared import WORD, column, text_key, written

WIDTH = 16
PARTS = ("digest binary, parent binary, depth long, low long, n long, ends long, children long, leaves long, saved long")
EDGES = "first_key binary, first_words array<long>, last_key binary, last_words array<long>"
PART_TYPES = [pa.binary(), pa.binary(), *[pa.int64()] * 7]
EDGE_TYPES = [pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]


def _sequences(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, ids): the turns of every conversation in order, with word counts."""
    said = F.coalesce(column(turns, text), F.lit(""))
    rows = turns.select(column(turns, conv_id).cast("long").alias("conv"), column(turns, turn).alias("at"),
                        *text_key(F.coalesce(column(turns, role), F.lit("")), said),
                        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words")).filter("conv IS NOT NULL")
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", "_k1", "_k2", "words"))).alias("ids"))


def with_shared_heads(sequences: DataFrame, block: int, heads: int) -> DataFrame:
    """Every conversation rebuilt: the first h turns of the first conversation
    of its block, then its own after its first h; h = crc32(id) mod ``heads``."""
    first = F.col("conv") - F.col("conv") % block
    opening = sequences.filter(F.col("conv") % block == 0).select(
        F.col("conv").alias("block"), F.slice("ids", 1, max(1, heads - 1)).alias("opening"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    none = F.slice("ids", 1, 0)
    rows = sequences.select("conv", "ids", first.alias("block"), h.alias("h")).join(opening, "block", "left")
    own = F.expr("slice(ids, h + 1, greatest(size(ids) - h, 0))")
    return rows.select("conv", F.concat(F.coalesce(F.expr("slice(opening, 1, h)"), none), own).alias("ids"))


def _key(ids: Column) -> Column:
    """The ids of a sequence, big-endian, one after the other."""
    half = lambda x: F.lpad(F.hex(x), 16, "0")
    return F.unhex(F.array_join(F.transform(ids, lambda t: F.concat(half(t["_k1"]), half(t["_k2"]))), ""))


def _batch(parts: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in (PARTS + ", " + EDGES).split(", ")]
    rows = [p + (None,) * 4 for p in parts] + [(None,) * 9 + e for e in edges]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 13
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PART_TYPES + EDGE_TYPES, strict=True)], names)


def _cut(last: bytes, first: bytes, words: list[int]) -> list[tuple]:
    """What is to be added because two neighbouring trees (one ends with the
    key ``last``, the next begins with ``first``) both have the prefix the two
    keys share: its nodes were counted twice as children, each tree saved the
    node's words once too little, and a key that only goes on in the next tree
    was no leaf."""
    same = 0
    while same < min(len(last), len(first)) and last[same:same + WIDTH] == first[same:same + WIDTH]:
        same += WIDTH
    deepest, state, digests = same // WIDTH, hashlib.md5(), []
    for depth in range(deepest + 1):
        state.update(last[max(0, depth - 1) * WIDTH:depth * WIDTH])
        digests.append(state.digest())
    leaf, saved, out = -int(same == len(last)), 0, []
    for depth in range(deepest, -1, -1):
        saved += words[depth - 1] if depth else 0
        out.append((digests[depth], digests[depth - 1] if depth else None, depth, None, 0, 0,
                    -int(depth < deepest), leaf, saved))
    return out


def _trees(chunk_turns: int, rows_out: int = 4096):
    """Sorted distinct keys of a task -> parts of nodes and the task's edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, turns, first, last = RadixTree(WIDTH), 0, None, None

        def emptied() -> Iterator[pa.RecordBatch]:
            parts = []
            for node in tree.nodes():
                parts.append(node)
                if len(parts) == rows_out:
                    yield _batch(parts, [])
                    parts = []
            yield _batch(parts, [])

        for batch in batches:
            columns = [batch.column(n) for n in ("key", "n", "low", "words")]
            for i in range(batch.num_rows):
                key, n, low, words = (c[i].as_py() for c in columns)
                if first is None:
                    first = (key, words)
                elif turns >= chunk_turns:
                    yield from emptied()
                    yield _batch(_cut(last[0], key, words), [])
                    tree, turns = RadixTree(WIDTH), 0
                tree.insert(key, n, low, words)
                turns, last = turns + len(words) + 1, (key, words)
        if first is not None:
            yield from emptied()
            yield _batch([], [first + last])
    return run


def _task_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parts = _cut(row["last_key"], row["next_key"], row["last_words"])
            yield _batch(parts, []).select([*range(9)])


def _digest_of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of id lists in order -> one SHA-256 a node, a piece at a time."""
    node, state = None, None
    schema = pa.schema([("ends_at", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for at, piece in zip(batch.column("ends_at").to_pylist(), batch.column("piece"), strict=True):
            if at != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True) if done else ((), ()), schema, strict=True)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], schema=schema)


def _ends(paths: DataFrame, piece_bits: int = 14) -> DataFrame:
    """(ends_at, ends_sha256) of every node at which conversations end. The
    hash runs over a list in order, so one task reads it, as pieces of bounded
    length that sorting brings in order; it holds one piece at a time."""
    piece = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = (paths.groupBy(F.unhex(F.md5("key")).alias("ends_at"), F.shiftright("conv", piece_bits).alias("run"))
              .agg(piece.alias("piece")))
    ordered = pieces.repartition("ends_at").sortWithinPartitions("ends_at", "run").select("ends_at", "piece")
    return ordered.mapInArrow(_digest_of_ends, "ends_at binary, ends_sha256 string")


def trie_of(sequences: DataFrame, chunk_turns: int = 50_000) -> DataFrame:
    """The nodes of the prefix trie of ``sequences`` (conv, ids), one row each:
    ``node`` and ``parent`` (digests), ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    paths = written(sequences.select("conv", _key(F.col("ids")).alias("key"),
                                     F.transform("ids", lambda t: t["words"]).alias("words")), "trie-paths")
    keys = paths.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"), F.first("words").alias("words"))
    runs = keys.repartitionByRange("key").sortWithinPartitions("key")
    made = written(runs.mapInArrow(_trees(chunk_turns), f"{PARTS}, {EDGES}"), "trie-parts")

    # Two keys a task, in order: what neighbouring tasks share is cut like what neighbouring trees of a task share.
    edges = made.filter("first_key IS NOT NULL").select(
        "last_key", "last_words", F.lead("first_key").over(Window.orderBy("first_key")).alias("next_key"))
    cuts = edges.filter("next_key IS NOT NULL").mapInArrow(_task_cuts, PARTS)
    sums = [F.sum(c).alias(c) for c in ("n", "ends", "children", "leaves", "saved")]
    nodes = written(made.filter("digest IS NOT NULL").select(*[p.split()[0] for p in PARTS.split(", ")]).unionByName(cuts)
                    .groupBy("digest", "parent", "depth").agg(F.min("low").alias("low"), *sums), "trie-nodes")

    # Written first: the join that brings a parent's smallest member to its children can then be split.
    parents = nodes.select(F.col("digest").alias("parent"), F.col("low").alias("parent_conv_id"))
    ends = written(_ends(paths), "trie-ends")
    out = nodes.join(parents, "parent", "left").join(ends, F.col("digest") == F.col("ends_at"), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("digest").alias("node"), "parent", F.col("low").alias("conv_id"), "depth", "parent_conv_id",
                      F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text", block: int = 20, heads: int = 4, chunk_turns: int = 50_000) -> DataFrame:
    """The trie of the conversations in ``turns``, each rebuilt with the head
    that its block shares (see ``with_shared_heads``)."""
    sequences = written(_sequences(turns, conv_id, turn, role, text), "conversations")
    return trie_of(with_shared_heads(sequences, block, heads), chunk_turns)
