from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storefront.llm.tokenizer_alignment import Pair, align

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["", " ", "  ", "a", " a", "a ", "\n", "a  b", "a\n b", "a \n  b  ", "\t\tx\r\n y", "é ê ç", "你好 世界", "😀 😀😀", "<|endoftext|> <s> </s>",
       "x y z", "don't we'll  THE End", "a\x00b c", "▁ a", "a▁b", "aaaaaaa aaa aa", "1234567 89", "%%% ### $$$", " lead", "trail ",
       "\x1c \x1d", "a　b c", "é fi ﬁ Å", "x" * 3000, "   " * 300, ("word " * 500), "end \n"]


@pytest.fixture(scope="module")
def sides():
    whole = tokenizers.Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    return whole, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def pair():
    with open(A, "rb") as a, open(B, "rb") as b:
        return Pair(a.read(), b.read())


def brute(texts, sides):
    """Whole texts encoded, tokens compared pair by pair."""
    whole, pieces = sides
    letters = {i: t for t, i in whole.get_vocab().items()}
    from storefront.llm.tokenizer_alignment import byte_level_alphabet
    byte = byte_level_alphabet()
    rows, links = [], []
    for text in texts:
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        in_a = [bytes(byte[c] for c in letters[i]) for i in a]
        in_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
                for i in b]
        if not text or not (b"".join(in_a) == b"".join(in_b) == (" " + text).encode()):
            rows.append((0, 0, 0, ""))
            links.append(Counter())
            continue
        spans = []
        for tokens in (in_a, in_b):
            at, own = 0, []
            for t in tokens:
                own.append((at, at + len(t)))
                at += len(t)
            spans.append(own)
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        sides_of = [[[] for _ in common], [[] for _ in common]]
        for ids, own, into in zip((a, b), spans, sides_of, strict=True):
            for i, (_, end) in zip(ids, own, strict=True):
                into[bisect_left(common, end)].append(str(i))
        parts = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides_of, strict=True)]
        rows.append((len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest()))
        own, j = Counter(), 0
        for i, (s, e) in zip(a, spans[0], strict=True):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                own[i, b[k]] += 1
                k += 1
        links.append(own)
    held = Counter(p for own in links for p in own)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return [(n_a, n_b, n_groups, sum(own.values()), sum(n for p, n in own.items() if held[p] == best[p[0]]),
             sum(n * held[p] for p, n in own.items()), sha) for (n_a, n_b, n_groups, sha), own in zip(rows, links, strict=True)]


def got(df, **how):
    return sorted(((r["row"]["doc_id"], *(r[c] for c in COLUMNS)) for r in align(df, A, B, **how).collect()), key=repr)


def expected(rows, sides):
    return sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], sides), strict=True)), key=repr)


def test_chunks_encode_as_whole_texts(pair, sides):
    whole, pieces = sides
    rng = random.Random(11)
    texts = ODD + ["".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "ing", ".", "1", "\t", "世", "'s"]) for _ in range(rng.randrange(40)))
                   for _ in range(300)]
    for text in filter(None, texts):
        a, b, _, ok = pair.encode(pair.split(text))
        if ok.all():
            assert a.tolist() == whole.encode(" " + text, add_special_tokens=False).ids, repr(text)
            assert b.tolist() == pieces.encode(text), repr(text)
        else:
            assert "▁" in text or "".join(pieces.id_to_piece(i) for i in pieces.encode(text)).replace("▁", " ") != " " + text


def test_identity_map(pair):
    assert all(pair.bytes_a[i] == pair.bytes_b[j] for i, j in enumerate(pair.identity.tolist()) if j >= 0)
    assert (pair.identity >= 0).sum() > 10_000


def test_edge_rows(spark, documents, sides):
    rows = [*enumerate(ODD), (100, None), (101, "a  b"), (101, "a  b"), (None, "the end"), (102, "Énde " * 30)]
    df = documents(rows)
    want = expected(rows, sides)
    assert got(df) == want
    for size in (1, 60):  # a block a text, a few texts a block
        assert got(df.repartition(3), block_bytes=size) == want
    assert got(documents([])) == []


def test_clashing_columns_and_long_text(spark, documents, sides):
    rows = [(1, "lorem ipsum dolor " * 60_000), (2, "lorem ips")]
    df = documents(rows).withColumn("n_a", F.lit("x")).withColumn("block", F.lit(7)).withColumn("a.b", F.lit(3))
    out = align(df, A, B, keep=("doc_id", "n_a", "block", "a.b"))
    found = sorted((tuple(r["row"]), *(r[c] for c in COLUMNS)) for r in out.collect())
    assert found == [((i, "x", 7, 3), *x) for (i, *x) in expected(rows, sides)]


def test_whole_test_table(small_documents, sides):
    rows = [(r["doc_id"], r["text"]) for r in small_documents.collect()]
    assert got(small_documents, block_bytes=50_000) == expected(rows, sides)
