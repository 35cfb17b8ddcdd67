"""LIKE joins: every text with the patterns it holds.

``text LIKE '%' || key || '%'`` compares every text with every key when it is
planned as a join. Here the keys' literal pieces are looked for instead, all
at once: one automaton (Aho-Corasick) of the longest piece of every key reads
a text in one pass, and only the keys whose piece occurs are checked in full
for their wildcards. The work is the length of the texts plus the hits.

The automaton travels to the tasks, so its size is checked first. More keys
than that are joined by shuffle: on the first characters of their longest
piece, against the texts' substrings of those lengths, then checked.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.operators.lists import substrings

ESCAPE = "\\"
ANCHOR = 6  # characters of a piece that keys are joined on beyond the automaton's bound


class Automaton:
    """Finds all of many words in one pass over a text."""

    def __init__(self, words: Iterable[str]):
        self._next: list[dict[str, int]] = [{}]
        self._word: list[int | None] = [None]
        self.words: list[str] = []
        for word in dict.fromkeys(words):
            state = 0
            for c in word:
                if c not in self._next[state]:
                    self._next[state][c] = len(self._next)
                    self._next.append({})
                    self._word.append(None)
                state = self._next[state][c]
            self._word[state] = len(self.words)
            self.words.append(word)
        # The longest proper ending of a state that is a state, and the next one along these that ends a word.
        self._back, self._hit = [0] * len(self._next), [0] * len(self._next)
        queue = deque(self._next[0].values())
        while queue:
            state = queue.popleft()
            for c, kid in self._next[state].items():
                queue.append(kid)
                back = self._back[state]
                while back and c not in self._next[back]:
                    back = self._back[back]
                back = self._next[back].get(c, 0)
                self._back[kid] = back if back != kid else 0
                self._hit[kid] = self._back[kid] if self._word[self._back[kid]] is not None else self._hit[self._back[kid]]

    def found(self, text: str) -> set[int]:
        """The places in ``words`` of the words that occur in ``text``."""
        out: set[int] = set()
        state, step, back, word, hit = 0, self._next, self._back, self._word, self._hit
        for c in text:
            while state and c not in step[state]:
                state = back[state]
            state = step[state].get(c, 0)
            at = state if word[state] is not None else hit[state]
            while at and word[at] not in out:  # a word found before has its endings found too
                out.add(word[at])
                at = hit[at]
        return out


def pieces(key: str) -> list[str | int]:
    """A LIKE pattern as literal texts and wildcards: a number n stands for n
    characters, -1 for any number."""
    out: list[str | int] = []
    i = 0
    while i < len(key):
        c = key[i]
        if c in "%_":
            out.append(-1 if c == "%" else 1)
        else:
            if c == ESCAPE and i + 1 < len(key):
                i += 1
                c = key[i]
            if out and isinstance(out[-1], str):
                out[-1] += c
            else:
                out.append(c)
        i += 1
    return out


def _longest(key: str) -> str:
    return max((p for p in pieces(key) if isinstance(p, str)), key=len, default="")


def _check(key: str) -> re.Pattern | None:
    """What is to be checked besides the longest piece; None: nothing."""
    parts = pieces(key)
    if all(isinstance(p, str) for p in parts):
        return None
    return re.compile("".join(re.escape(p) if isinstance(p, str) else ".*" if p < 0 else "." for p in parts), re.DOTALL)


def _by_automaton(texts: DataFrame, text: str, keys: list[str], out: str) -> DataFrame:
    schema = T.StructType([*texts.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, list[tuple[str, re.Pattern | None]]] = {}
        for key in keys:
            of.setdefault(_longest(key), []).append((key, _check(key)))
        always = of.pop("", [])  # wildcards alone
        automaton = Automaton(of)
        held = [of[word] for word in automaton.words]
        for batch in batches:
            rows, hits = [], []
            for i, value in enumerate(batch.column(text).to_pylist()):
                if value is None:
                    continue
                for group in [always, *(held[w] for w in automaton.found(value))]:
                    for key, check in group:
                        if check is None or check.search(value):
                            rows.append(i)
                            hits.append(key)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(hits, pa.string())], [*taken.schema.names, out])

    return texts.mapInArrow(run, schema)


def _by_shuffle(texts: DataFrame, text: str, keys: DataFrame, out: str) -> DataFrame:
    """The keys by the first characters of their longest pieces, joined with
    the texts' substrings of those lengths, then checked in full."""
    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = [_longest(k)[:ANCHOR] for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(anchors, pa.string())], [out, "_anchor"])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        check = lru_cache(maxsize=10_000)(lambda key: (_check(key), _longest(key)))
        for batch in batches:
            held = []
            for value, key in zip(batch.column(text).to_pylist(), batch.column(out).to_pylist(), strict=True):
                wild, piece = check(key)
                held.append(wild.search(value) is not None if wild else piece in value)
            yield batch.filter(pa.array(held, pa.bool_()))

    schema = T.StructType([T.StructField(out, T.StringType()), T.StructField("_anchor", T.StringType())])
    lengths = F.array(*[F.lit(n) for n in range(1, ANCHOR + 1)])
    grams = F.concat(F.array(F.lit("")), substrings(F.col(text), lengths))  # the empty one: wildcards alone
    asked = texts.filter(F.col(text).isNotNull()).select("*", F.explode(grams).alias("_anchor"))
    matched = asked.join(keys.mapInArrow(anchored, schema), "_anchor").select(*[F.col(f"`{c}`") for c in texts.columns], out)
    return matched.mapInArrow(checked, matched.schema)


def like_join(texts: DataFrame, text: str, patterns: DataFrame, key: str, out: str | None = None, max_chars: int = 1 << 22) -> DataFrame:
    """``texts`` with every different ``key`` of ``patterns`` (column ``out``)
    for which ``text LIKE '%' || key || '%'`` holds: ``%`` and ``_`` are
    wildcards, a backslash takes the next character as it is.

    NULL texts and keys match nothing; an empty key matches every text; a row
    of ``texts`` comes once a key. Repeated texts are read again, so make them
    distinct first where there are many. Keys of up to ``max_chars`` characters
    in all travel to the tasks; beyond that the join shuffles."""
    out = out or key
    keys = patterns.filter(F.col(key).isNotNull()).select(F.col(key).alias(out)).distinct()
    size = keys.agg(F.coalesce(F.sum(F.length(out) + 1), F.lit(0)).alias("n")).first()["n"]
    if size <= max_chars:
        return _by_automaton(texts, text, sorted(r[out] for r in keys.collect()), out)
    return _by_shuffle(texts, text, keys, out)
