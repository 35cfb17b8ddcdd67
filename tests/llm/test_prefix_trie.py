from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from storefront.llm.prefix_trie import conversation_trie
from storefront.llm.radix_tree import Direct, Indexed, RadixTree, Sorted

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Nodes from a dictionary of all prefixes."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        gain = (len(m) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += gain
    sha = lambda m: hashlib.sha256(",".join(map(str, sorted(m))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p]))
                   for p, m in members.items()), key=repr)


def got(df, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in conversation_trie(df, **how).collect()), key=repr)


def test_layouts_grow_and_keep_order():
    table, seen = Sorted(), []
    rng = random.Random(3)
    for n, byte in enumerate(rng.sample(range(256), 256), 1):
        table = table.put(byte, byte)
        seen.append(byte)
        assert isinstance(table, Sorted if n <= 16 else Indexed if n <= 48 else Direct)
        assert n > 16 or table.room == (4 if n <= 4 else 16)
        assert table.ordered() == sorted(seen)
    assert all(table.get(b) == b for b in range(256))


def test_tree_against_prefixes():
    rng = random.Random(5)
    for width in (1, 2, 4):
        keys = {bytes(rng.choice((0, 1, 255)) for _ in range(width * rng.randrange(5))) for _ in range(60)}
        tree = RadixTree(width)
        for i, k in enumerate(sorted(keys, key=lambda k: rng.random())):
            tree.insert(k, 2, i, [len(k)] * (len(k) // width))
        found = {(d, digest): (n, ends, kids) for digest, _, d, _, n, ends, kids, _, _ in tree.nodes()}
        want = {}
        for p in {k[:d * width] for k in keys for d in range(len(k) // width + 1)}:
            below = {k[:len(p) + width] for k in keys if k.startswith(p) and len(k) > len(p)}
            want[len(p) // width, hashlib.md5(p).digest()] = (2 * sum(k.startswith(p) for k in keys), 2 * (p in keys), len(below))
        assert found == want


def test_edge_rows(spark):
    rows = [(0, 0, "user", "a b c"), (0, 1, "assistant", "d"), (0, 2, "user", "e f"), (0, 3, "assistant", "g"),
            (1, 5, "user", "x"), (2, None, "user", "first"), (2, 0, "user", "second"), (2, 1, None, None), (2, 2, "", ""),
            (3, 0, "user", "a b c"), (7, 0, "user", "q"), (7, 0, "user", "q"), (7, 0, "user", "q"), (7, 0, "user", "q"),
            (None, 0, "user", "lost"), (21, 0, "user", "no head"), (22, 0, "user", "no head"), (24, 1, "user", "x " * 50_000),
            (40, 0, "user", "a b c"), (41, 0, "user", "z"), (-3, 0, "user", "minus"), (-3, 1, "user", "three")]
    df = spark.createDataFrame(rows, TURNS)
    assert got(df) == brute(rows)
    assert got(df.withColumn("conv", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("key", F.lit(2))) == brute(rows)
    assert got(spark.createDataFrame([], TURNS)) == []


def test_trees_cut_anywhere_give_the_same_nodes(spark):
    """Few turns a tree: shared prefixes run over many trees and tasks."""
    rng = random.Random(7)
    words = ["u v", "w", "x y z", ""]
    rows = [(c, t, "user", rng.choice(words[:2]) if t < 4 else rng.choice(words)) for c in range(400) for t in range(rng.randrange(1, 9))]
    rows += [(c, t, "user", "hot") for c in range(1000, 1400) for t in range(3)]  # a large group of copies
    want = brute(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    for chunk in (1, 9, 1000):
        assert got(df, chunk_turns=chunk) == want


def test_whole_test_table(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/conversations.parquet")
    assert got(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
