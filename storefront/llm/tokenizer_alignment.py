"""Alignment of two tokenizers over the same bytes, and how often ids go together.

A text splits where one blank stands between two other characters: no token of
either side crosses such a place (checked for the piece vocabulary when it is
loaded), so both sides encode and align every different chunk of a block of
texts once, and documents are sums over their chunks.

Offsets at which tokens of both sides end cut the tokens into groups. An
identity map (A id -> B id of the same bytes) is made beforehand. Links that
follow it, all exact one-to-one groups among them, are counted in one vector
of vocabulary length a task; only the other links of irregular groups are
shuffled, as (block, pair, documents): a pair costs one row a block, however
many documents hold it. The totals go back to the blocks that asked for them
and are met there by the documents' stored link counts, so the table of pairs
is never held in one place. What is broadcast has vocabulary length.

Defined results: null and empty texts, and texts that one side does not give
back byte for byte (a literal U+2581), have no tokens: zeros and an empty
string, and they add to no count; repeated rows are documents of their own;
ids whose best count is tied are all best; an empty table gives no rows; the
columns to keep travel as one struct, so their names may clash; a long text
is a block of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.llm.shared import column, written

# Fixed: how a byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CHUNK = re.compile(r"(?<=\S) (?=\S)")
BLANK = "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: printable bytes stand for
    themselves, the others, in order, for the code points from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers: their encoders, the bytes of every id and the identity map."""

    def __init__(self, byte_vocabulary: bytes, piece_model: bytes):
        import sentencepiece
        import tiktoken

        spec, letters = json.loads(byte_vocabulary), byte_level_alphabet()
        vocabulary = spec["model"]["vocab"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        for i, merge in enumerate(spec["model"]["merges"]):  # ids in the order of merges: an id is its rank
            token = "".join(merge if isinstance(merge, list) else merge.split(" "))
            if vocabulary[token] != 256 + i:
                raise ValueError("the ids of the byte-level vocabulary do not follow its merges")
        self.n_a = 1 + max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_a = [b""] * self.n_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.encoder = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.n_b = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(self.n_b)]
        self.apart = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in names)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(names)]
        first: dict[bytes, int] = {}
        for i, token in enumerate(self.bytes_b):
            if not (self.pieces.is_control(i) or self.pieces.is_unknown(i)):
                # A byte piece only where no other piece has the byte: the encoder prefers the other.
                if token not in first or self.pieces.is_byte(first[token]):
                    first[token] = i
        self.identity = np.array([first.get(token, -1) if token else -1 for token in self.bytes_a], dtype=np.int64)
        self.length_a, self.length_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        # How an id is written in the list of groups: followed by more of its side, or as the last of it.
        self.shown = ([f"{i},".encode() for i in range(self.n_a)] + [f"{i}|".encode() for i in range(self.n_a)]
                      + [f"{i},".encode() for i in range(self.n_b)] + [f"{i};".encode() for i in range(self.n_b)])
        self.shown_length = np.array([len(x) for x in self.shown], dtype=np.int64)

    def split(self, text: str) -> list[str]:
        """Chunks of `` `` + text, each without the blank it begins with."""
        return _CHUNK.split(text) if self.apart else [text]

    def encode(self, chunks: list[str], run_chars: int = 50_000) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids and B ids of all chunks on end, the byte lengths of the chunks
        (0 where a side does not give the bytes back) and whether it does."""
        a_ids, b_ids, whole = [], [], np.ones(len(chunks), dtype=bool)
        sizes = np.zeros(len(chunks), dtype=np.int64)
        at = 0
        while at < len(chunks):
            upto, chars = at + 1, len(chunks[at])
            # White space at an edge would join that of the next chunk.
            while not self._alone(chunks[upto - 1]) and upto < len(chunks) and chars < run_chars and not self._alone(chunks[upto]):
                chars += len(chunks[upto]) + 1
                upto += 1
            a, b, same = self._encoded(" ".join(chunks[at:upto]))
            if same:
                sizes[at:upto] = [len(c.encode()) + 1 for c in chunks[at:upto]]
                a_ids += a
                b_ids += b
            else:
                for i in range(at, upto):
                    a, b, whole[i] = self._encoded(chunks[i])
                    if whole[i]:
                        sizes[i] = len(chunks[i].encode()) + 1
                        a_ids += a
                        b_ids += b
            at = upto
        return np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64), sizes, whole

    def _alone(self, chunk: str) -> bool:
        return not self.apart or not chunk or chunk[0].isspace() or chunk[-1].isspace()

    def _encoded(self, text: str) -> tuple[list[int], list[int], bool]:
        a = self.encoder.encode_ordinary(" " + text)
        # An empty text gets no blank in front of it from the encoder.
        b = self.pieces.encode(text) if text else [self.pieces.piece_to_id(BLANK)]
        full = b" " + text.encode()
        return a, b, (b"".join(map(self.bytes_a.__getitem__, a)) == full and b"".join(map(self.bytes_b.__getitem__, b)) == full)


class Aligned:
    """Chunks aligned: counts and the written groups of each, and its links as
    codes (an A id where a link follows the identity map, else n_a + the pair)."""

    def __init__(self, pair: Pair, chunks: list[str]):
        a, b, sizes, self.whole = pair.encode(chunks)
        ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
        total = int(sizes.sum())
        ends = np.zeros(total + 1, dtype=np.int8)
        ends[ends_a] += 1
        ends[ends_b] += 2
        both_a, both_b = ends[ends_a] == 3, ends[ends_b] == 3
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        n_groups = int(both_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)

        # B tokens that overlap each A token: from the first that ends after its start to the first that ends at its end or later.
        low = np.searchsorted(ends_b, ends_a - pair.length_a[a], side="right")
        high = np.searchsorted(ends_b, ends_a, side="left")
        overlaps = high - low + 1
        upto_a, upto_b = (np.searchsorted(e, np.cumsum(sizes), side="right") for e in (ends_a, ends_b))
        running = lambda x: np.concatenate([[0], np.cumsum(x)])
        between = lambda x: np.diff(x, prepend=0)
        self.counts = {"n_a": between(upto_a), "n_b": between(upto_b), "n_groups": between(running(both_a)[upto_a]),
                       "n_links": between(running(overlaps)[upto_a])}
        self.counts = {k: np.where(self.whole, v, 0) for k, v in self.counts.items()}

        # Exact one-to-one groups need no list of overlaps: their link is the map's own.
        exact = (in_a[group_a] == 1) & (in_b[group_a] == 1) & (pair.identity[a] == b[low] if len(b) else False)
        odd = np.flatnonzero(~exact)
        n = overlaps[odd]
        left, right = np.repeat(odd, n), np.repeat(low[odd] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        link_a, link_b = a[left], b[right]
        codes = np.where(pair.identity[link_a] == link_b, link_a, pair.n_a + link_a * pair.n_b + link_b)
        chunk_of = np.repeat(np.arange(len(chunks)), self.counts["n_a"])
        self.chunk = np.concatenate([chunk_of[exact], chunk_of[left]])
        self.code = np.concatenate([a[exact], codes])

        # A group is written as its A ids, then its B ids.
        after_a, after_b = running(in_a), running(in_b)
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + after_b[group_a]] = a + pair.n_a * both_a
        order[np.arange(len(b)) + after_a[group_b + 1]] = 2 * pair.n_a + b + pair.n_b * both_b
        text = b"".join(map(pair.shown.__getitem__, order.tolist()))
        at = running(pair.shown_length[order])[running(self.counts["n_a"] + self.counts["n_b"])].tolist()
        self.groups = [text[i:j] for i, j in zip(at, at[1:], strict=False)]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[starts], np.add.reduceat(weights[order], starts) if len(keys) else weights


def _links(pair: Pair, texts: list[str | None]) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """Outputs per document, and its links as (document, code, occurrences)."""
    place: dict[str, int] = {}
    own = [[place.setdefault(c, len(place)) for c in pair.split(t)] if t else [] for t in texts]
    made = Aligned(pair, list(place))
    own = [x if made.whole[x].all() else [] for x in own]
    n = np.array([len(x) for x in own], dtype=np.int64)
    chunk = np.fromiter((u for x in own for u in x), dtype=np.int64, count=int(n.sum()))
    doc = np.repeat(np.arange(len(texts)), n)
    out = {k: np.bincount(doc, weights=v[chunk], minlength=len(texts)).astype(np.int64) for k, v in made.counts.items()}
    out["groups_sha256"] = [hashlib.sha256(b"".join([made.groups[u] for u in x])[:-1]).hexdigest() if x else "" for x in own]

    # Links of every chunk, then of every document by its chunks.
    codes, code = np.unique(made.code, return_inverse=True)
    width = max(1, len(codes))
    keys, times = _summed(made.chunk * width + code, np.ones(len(code), dtype=np.int64))
    first = np.searchsorted(keys, np.arange(len(place) + 1) * width)
    seen, often = _summed(doc * max(1, len(place)) + chunk, np.ones(len(doc), dtype=np.int64))
    doc, chunk = np.divmod(seen, max(1, len(place)))
    size = first[chunk + 1] - first[chunk]
    at = np.repeat(first[chunk] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    keys, times = _summed(np.repeat(doc, size) * width + keys[at] % width, np.repeat(often, size) * times[at])
    doc, code = np.divmod(keys, width)
    return out, doc, codes[code] if len(codes) else code, times


def _packed(values: np.ndarray, cuts: np.ndarray, steps: bool = False) -> list[bytes]:
    """Each run of ``values`` as 32-bit numbers; ``steps``: as differences."""
    if steps:
        at = cuts[:-1][cuts[:-1] < cuts[1:]]
        step = np.diff(values, prepend=0)
        step[at] = values[at]
        values = step
    data = values.astype("<u4").tobytes()
    return [data[4 * i:4 * j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_PACKS = ("plain", "plain_times", "odd", "odd_times")


def _scan(byte_vocabulary: bytes, piece_model: bytes, row_type: pa.DataType | None, block_bytes: int):
    """Texts -> documents with their packed links, (block, pair, documents), (A id, documents)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(byte_vocabulary, piece_model)
        vector, block = np.zeros(pair.n_a, dtype=np.int64), TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            start = 0
            for i, length in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                size += length or 0
                if size >= block_bytes:
                    held.append(batch.slice(start, i + 1 - start))
                    yield from made(pair, held, block, vector)
                    held, size, start, block = [], 0, i + 1, block + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from made(pair, held, block, vector)
        known = np.flatnonzero(vector)
        yield rows(a=pa.array(known), n=pa.array(vector[known]))

    def rows(**given) -> pa.RecordBatch:
        n = len(next(iter(given.values())))
        names = ["row", "block", *COUNTS, "groups_sha256", *_PACKS, "a", "pair", "n"]
        kinds = [row_type, pa.int64(), *[pa.int64()] * 4, pa.string(), *[pa.binary()] * 4, *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([given.get(k) if k in given else pa.nulls(n, t) for k, t in zip(names, kinds, strict=True)], names)

    def made(pair: Pair, held: list[pa.RecordBatch], block: int, vector: np.ndarray) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        out, doc, code, times = _links(pair, table.column(1).to_pylist())
        plain = code < pair.n_a
        np.add.at(vector, code[plain], 1)
        pairs, odd = np.unique(code[~plain] - pair.n_a, return_inverse=True)
        packs = {}
        for name, part, ids in (("plain", plain, code[plain]), ("odd", ~plain, odd)):
            cuts = np.searchsorted(doc[part], np.arange(table.num_rows + 1))
            packs[name] = pa.array(_packed(ids, cuts, steps=True), pa.binary())
            packs[f"{name}_times"] = pa.array(_packed(times[part], cuts), pa.binary())
        row = table.column(0).combine_chunks()
        yield rows(row=row.chunk(0) if isinstance(row, pa.ChunkedArray) else row, block=pa.array(np.full(table.num_rows, block)),
                   **{k: pa.array(v, pa.string() if k == "groups_sha256" else pa.int64()) for k, v in out.items()}, **packs)
        yield rows(block=pa.array(np.full(len(pairs), block)), pair=pa.array(pairs), n=pa.array(np.bincount(odd, minlength=len(pairs))))
    return run


def _answers(n_b: int, plain_count: np.ndarray, best: np.ndarray):
    """A block's documents and the totals of its pairs -> finished documents."""
    def values(packs: pa.ChunkedArray, sizes: np.ndarray, steps: bool) -> np.ndarray:
        data = np.frombuffer(b"".join(packs.to_pylist()), dtype="<u4").astype(np.int64)
        if not steps or not len(data):
            return data
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        running = np.cumsum(data)
        return running - np.repeat(running[starts] - data[starts], sizes[sizes > 0])

    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        pairs, total = (totals.column(c).to_numpy() for c in ("pair", "total"))
        order = np.argsort(pairs)
        pairs, total = pairs[order], total[order]
        n_best, count_sum = np.zeros(docs.num_rows, dtype=np.int64), np.zeros(docs.num_rows, dtype=np.int64)
        for name in ("plain", "odd"):
            sizes = np.array([len(x) // 4 for x in docs.column(name).to_pylist()], dtype=np.int64)
            ids, times = values(docs.column(name), sizes, True), values(docs.column(f"{name}_times"), sizes, False)
            count, a = (plain_count[ids], ids) if name == "plain" else (total[ids], pairs[ids] // n_b)
            doc = np.repeat(np.arange(docs.num_rows), sizes)
            np.add.at(count_sum, doc, times * count)
            np.add.at(n_best, doc, times * (count == best[a]))
        return pa.table([docs.column(c) for c in ("row", *COUNTS)] + [pa.array(n_best), pa.array(count_sum), docs.column("groups_sha256")],
                        names=["row", *COUNTS, "n_best", "count_sum", "groups_sha256"])
    return run


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
          block_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``docs``: ``row`` (a struct of the columns ``keep``), ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256``. ``byte_vocabulary`` is a byte-level BPE in JSON form
    (side A), ``piece_model`` a BPE of pieces with byte fallback that puts a
    blank in front of a text (side B)."""
    from pyspark.sql.pandas.types import to_arrow_type

    with open(byte_vocabulary, "rb") as a, open(piece_model, "rb") as b:
        vocabulary, model = a.read(), b.read()
    row = F.struct(*[column(docs, c).alias(c) for c in keep])
    given = docs.select(row.alias("row"), column(docs, text).cast("string").alias("text"))
    kind = given.schema["row"].dataType
    longs = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    row_field, text_field = T.StructField("row", kind), T.StructField("groups_sha256", T.StringType())
    schema = T.StructType([row_field, *longs("block", *COUNTS), text_field, *[T.StructField(n, T.BinaryType()) for n in _PACKS],
                           *longs("a", "pair", "n")])
    made = written(given.mapInArrow(_scan(vocabulary, model, to_arrow_type(kind), block_bytes), schema), "alignment", compression="zstd")

    asked = made.filter("pair IS NOT NULL").select("block", "pair", "n")
    totals = written(asked.groupBy("pair").agg(F.sum("n").alias("total")), "pair-totals")
    n_a, n_b = _sizes(vocabulary, model)
    plain, best = np.zeros(n_a, dtype=np.int64), np.zeros(n_a, dtype=np.int64)
    # Both come to the driver: one number an A id at most.
    counted = made.filter("a IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    plain[counted.column("a").to_numpy()] = counted.column("n").to_numpy()
    highest = totals.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("total").alias("n")).toArrow()
    best[highest.column("a").to_numpy()] = highest.column("n").to_numpy()
    best = np.maximum(best, plain)

    back = asked.select("block", "pair").join(totals, "pair").select(F.col("block").alias("of"), "pair", "total")
    held = made.filter("groups_sha256 IS NOT NULL").select("row", "block", *COUNTS, "groups_sha256", *_PACKS)
    out = T.StructType([made.schema["row"], *longs(*COUNTS, "n_best", "count_sum"), text_field])
    return held.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_answers(n_b, plain, best), out)


def _sizes(vocabulary: bytes, model: bytes) -> tuple[int, int]:
    import sentencepiece

    spec = json.loads(vocabulary)
    ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]
    return 1 + max(ids), sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
