"""Adaptive radix tree over byte strings made of fixed-width ids.

Inner nodes hold their children in the smallest of four layouts that has room
(4, 16, 48 or 256), and every node holds the bytes that all keys below it
share (path compression). A key that ends inside another one is a value on the
path. Ids may part in the middle; only depths that are whole ids are nodes of
the trie that the tree stands for.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to 4, then 16 children: their bytes in order beside them."""

    __slots__ = ("keys", "kids", "room")

    def __init__(self, room: int = 4):
        self.keys, self.kids, self.room = bytearray(), [], room

    def get(self, byte: int):
        at = self.keys.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid) -> Sorted | Indexed:
        at = self.keys.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.room:
            if self.room == 16:
                return Indexed(zip(self.keys, self.kids, strict=True)).put(byte, kid)
            self.room = 16
        at = bisect_left(self.keys, byte)
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def ordered(self) -> list:
        return list(self.kids)


class Indexed:
    """Up to 48 children: a table from byte to place."""

    __slots__ = ("places", "kids")

    def __init__(self, pairs):
        self.places, self.kids = bytearray(256), []
        for byte, kid in pairs:
            self.put(byte, kid)

    def get(self, byte: int):
        place = self.places[byte]
        return self.kids[place - 1] if place else None

    def put(self, byte: int, kid) -> Indexed | Direct:
        place = self.places[byte]
        if place:
            self.kids[place - 1] = kid
        elif len(self.kids) == 48:
            return Direct((b, self.kids[p - 1]) for b, p in enumerate(self.places) if p).put(byte, kid)
        else:
            self.kids.append(kid)
            self.places[byte] = len(self.kids)
        return self

    def ordered(self) -> list:
        return [self.kids[p - 1] for p in self.places if p]


class Direct:
    """Up to 256 children: one place a byte."""

    __slots__ = ("kids",)

    def __init__(self, pairs):
        self.kids = [None] * 256
        for byte, kid in pairs:
            self.kids[byte] = kid

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> Direct:
        self.kids[byte] = kid
        return self

    def ordered(self) -> list:
        return [kid for kid in self.kids if kid is not None]


class _Node:
    __slots__ = ("shared", "value", "row", "kids")

    def __init__(self, shared: bytes, row: int):
        self.shared, self.row, self.value, self.kids = shared, row, None, None

    def add(self, byte: int, kid: _Node) -> None:
        self.kids = (self.kids or Sorted()).put(byte, kid)


def _common(a: bytes, b: bytes) -> int:
    """The length of the bytes that ``a`` and ``b`` begin with alike."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


class RadixTree:
    """Keys (different byte strings, each a whole number of ids) with a count,
    a smallest member and a weight for every id of the key."""

    def __init__(self, width: int):
        self.width, self.keys, self.weights, self.root = width, [], [], None

    def insert(self, key: bytes, count: int, low: int, weights: list[int]) -> None:
        row = len(self.keys)
        self.keys.append(key)
        self.weights.append(weights)
        if self.root is None:
            self.root = _Node(key, row)
            self.root.value = (count, low)
            return
        node, above, byte, at = self.root, None, 0, 0
        while True:
            shared = node.shared
            if not key.startswith(shared, at):
                same = _common(shared, key[at:at + len(shared)])
                fork = _Node(shared[:same], node.row)
                fork.add(shared[same], node)
                node.shared = shared[same + 1:]
                if above is None:
                    self.root = fork
                else:
                    above.kids = above.kids.put(byte, fork)
                node, shared = fork, fork.shared
            at += len(shared)
            if at == len(key):
                node.value = (count, low)
                return
            kid = node.kids.get(key[at]) if node.kids else None
            if kid is None:
                kid = _Node(key[at + 1:], row)
                kid.value = (count, low)
                node.add(key[at], kid)
                return
            node, above, byte, at = kid, node, key[at], at + 1

    def nodes(self) -> Iterator[tuple]:
        """Every trie node as (digest, parent's digest, depth, smallest
        member, members, members that end here, children, leaves and saved
        weight in its subtree), children first. The digest is the MD5 of the
        key bytes down to the node; the root has no parent."""
        if self.root is None:
            return
        width = self.width
        frames = [self._frame(self.root, -1, 0, hashlib.md5(), None)]
        while frames:
            node, end, digests, state, parent, kids, totals = frames[-1]
            if kids:
                frames.append(self._frame(kids.pop(), end, end + 1, state, parent))
                continue
            frames.pop()
            n, low, leaves, saved, tops = totals
            ends, weights = 0, self.weights[node.row]
            if node.value:
                ends = node.value[0]
                n, low = n + ends, min(low, node.value[1])
            for above, digest, depth in reversed(digests):
                leaves = leaves or 1
                saved += (n - 1) * weights[depth - 1] if depth else 0
                yield digest, above, depth, low, n, ends if depth * width == end else 0, tops, leaves, saved
                tops = 1
            if frames:
                up = frames[-1][6]
                up[:] = up[0] + n, min(up[1], low), up[2] + leaves, up[3] + saved, up[4] + tops

    def _frame(self, node: _Node, above: int, start: int, state, parent: bytes | None) -> tuple:
        """The node (its parent ends at byte ``above``, its shared bytes begin
        at ``start``), its end, its whole-id depths with digests, the hash and
        digest of the last of them, its children and room for their totals
        (members, smallest, leaves, saved weight, shallowest nodes)."""
        width, key = self.width, self.keys[node.row]
        end = start + len(node.shared)
        digests = []
        for depth in range(above // width + 1, end // width + 1):
            state = state.copy()
            if depth:
                state.update(key[(depth - 1) * width:depth * width])
            digests.append((parent, state.digest(), depth))
            parent = digests[-1][1]
        kids = node.kids.ordered()[::-1] if node.kids else []
        return node, end, digests, state, parent, kids, [0, float("inf"), 0, 0, 0]
