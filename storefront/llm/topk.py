"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are quantised to whole numbers. Candidates are dealt into blocks and
queries into groups, both of bounded size and by hash; every (block, group)
pair is one task's work, and each query's best of all blocks are merged by a
window that Spark limits before its shuffle. Inside a pair, both sides are
indexed by a cover tree: a node is a centre and the radius that covers its
members, its children's centres lie more than half that radius apart and
cover within half of it. Node pairs are visited best bound first; with
centres c and radii r, no member pair scores above

    cq.cp + rq |cp| + rp |cq| + rq rp

and a pair is pruned when that is below the worst kth score of the query
node's members. Where points spread so evenly that covering children are
mostly single points, a node stays a leaf, scored as one matrix product.

Defined results: vectors that are null, hold null or non-finite components or
have no id take no part; rows with the same id are one vector (the smallest in
array order); vectors are compared with those of their own length; ties go to
the smaller id; a query with fewer candidates returns them all. Scores must
fit a long; larger ones raise an error; extra columns play no part, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.shared import column, written

LEAF, QUERY_LEAF = 128, 8  # members below which a node is not split
NONE = np.iinfo(np.int64).min


class Node:
    """Members (row numbers), their centre and covering radius, children."""

    def __init__(self, members: np.ndarray, centre: np.ndarray, radius: float, children: list[Node]):
        self.members, self.centre, self.radius, self.children = members, centre, radius, children
        self.norm = float(np.linalg.norm(centre))


def cover_tree(points: np.ndarray, members: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    members = np.arange(len(points)) if members is None else members
    own = points[members].astype(np.float64)
    far = np.linalg.norm(own - own[0], axis=1)
    radius, children = float(far.max()), []
    if len(members) > leaf and radius > 0:
        nearest, home, centres = far.copy(), np.zeros(len(members), dtype=np.int64), 1
        while nearest.max() > radius / 2 and centres <= len(members) // max(2, leaf // 8):
            at = int(nearest.argmax())
            d = np.linalg.norm(own - own[at], axis=1)
            home[d < nearest] = centres
            nearest = np.minimum(nearest, d)
            centres += 1
        if nearest.max() <= radius / 2:
            groups = [np.flatnonzero(home == i) for i in range(centres)]
            # a child's centre is its first member: put the chosen point there
            children = [cover_tree(points, members[g[np.argsort(nearest[g], kind="stable")]], leaf) for g in groups]
    return Node(members, own[0], radius, children)


class Best:
    """The k best of each query so far, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, points: np.ndarray, k: int):
        self.q, self.q_ids, self.p, self.p_ids, self.k = queries, ids, points, own, k
        self.score = np.full((len(ids), k), NONE, dtype=np.int64)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def worst(self, rows: np.ndarray) -> int:
        return int(self.score[rows, -1].min())

    def add(self, rows: np.ndarray, found: np.ndarray) -> None:
        scores = np.rint(self.q[rows] @ self.p[found].T).astype(np.int64)
        scores[self.q_ids[rows][:, None] == self.p_ids[found][None, :]] = NONE
        least = np.maximum(self.score[rows, -1], NONE + 1)
        if len(found) > self.k:
            least = np.maximum(least, np.partition(scores, len(found) - self.k, axis=1)[:, len(found) - self.k])
        r, c = np.nonzero(scores >= least[:, None])
        all_r = np.r_[r, np.repeat(np.arange(len(rows)), self.k)]
        all_s = np.r_[scores[r, c], self.score[rows].ravel()]
        all_i = np.r_[self.p_ids[found][c], self.id[rows].ravel()]
        order = np.lexsort((all_i, -all_s.astype(np.float64) if abs(all_s).max() < 2**53 else ~all_s, all_r))
        all_r, all_s, all_i = all_r[order], all_s[order], all_i[order]
        first = np.flatnonzero(np.r_[True, all_r[1:] != all_r[:-1]])
        take = first[:, None] + np.arange(self.k)[None, :]
        self.score[rows], self.id[rows] = all_s[take], all_i[take]


def search(q: Node, p: Node, best: Best) -> None:
    """Visit the node pair and what it covers, unless its bound is too low."""
    if bound(q, p) < best.worst(q.members):
        return
    if not q.children and not p.children:
        best.add(q.members, p.members)
    elif p.children and (p.radius >= q.radius or not q.children):
        for child in sorted(p.children, key=lambda c: -bound(q, c)):
            search(q, child, best)
    else:
        for child in q.children:
            search(child, p, best)


def bound(q: Node, p: Node) -> float:
    top = float(q.centre @ p.centre) + q.radius * p.norm + p.radius * q.norm + q.radius * p.radius
    return top + 1e-9 * (abs(top) + q.norm * p.norm) + 0.5  # never below the truth by rounding


def best_of_block(block: pa.Table, group: pa.Table, k: int) -> pa.Table:
    empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
    if not block.num_rows or not group.num_rows:
        return empty
    p, q = (np.array(t.column("q").to_pylist(), dtype=np.int64).reshape(t.num_rows, -1) for t in (block, group))
    p_ids, q_ids = (t.column("vec_id").to_numpy() for t in (block, group))
    largest = float(np.abs(p.astype(np.float64)).max(initial=0)) * float(np.abs(q.astype(np.float64)).max(initial=0)) * max(1, p.shape[1])
    if largest >= 2**62:
        raise OverflowError("inner products do not fit a long")
    if largest < 2**52:  # exact in doubles, whose products are much faster
        p, q = p.astype(np.float64), q.astype(np.float64)
    best = Best(q, q_ids, p_ids, p, k)
    search(cover_tree(q, leaf=QUERY_LEAF), cover_tree(p), best)
    row, col = np.nonzero(best.score > NONE)
    return pa.table({"query_id": q_ids[row], "vec_id": best.id[row, col], "score": best.score[row, col]})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: int = 256, block_rows: int = 4096, group_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each
    vector for which ``is_query`` (over ``vec_id``) holds."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(column(vectors, vec_id).cast("long").alias("vec_id"), column(vectors, embedding).alias("e"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull()).filter(F.forall("e", usable))
    whole = rows.select("vec_id", F.transform("e", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q"))
    whole = written(whole.groupBy("vec_id").agg(F.min("q").alias("q")).withColumn("dim", F.size("q")), "vectors")
    queries = whole.filter(is_query)
    blocks = max(1, -(-whole.count() // block_rows))
    groups = max(1, -(-queries.count() // group_rows))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = whole.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("group", numbers(groups))
    right = (queries.withColumn("group", F.pmod(F.xxhash64("vec_id", F.lit("q")), F.lit(groups)).cast("int"))
             .withColumn("block", numbers(blocks)))
    key = ["block", "group", "dim"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda b, g: best_of_block(b, g, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
