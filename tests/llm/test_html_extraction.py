from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from storefront.llm import block_labeller as lstm
from storefront.llm import html_extraction as extraction

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return extraction.fit(extraction.sample_pages(pages, "html", 200, 20_000))


def truth(page):
    """The article of a test page, cut at its paragraph and heading tags."""
    article = page[page.find("<article>") + 9:page.find("</article>")]
    parts = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
    return "\n".join(x for x in parts if x)


def test_blocks_of_odd_markup():
    read = lambda page: [(b.path[-1] if b.path else "", b.text) for b in extraction.blocks(page)]
    assert read(None) == read("") == read("<p></p>  <div> &nbsp; </div>") == []
    assert read("plain &lt;b&gt; text") == [("", "plain <b> text")]
    assert read("<p>one<p>two<div>three") == [("p", "one"), ("p", "two"), ("div", "three")]
    assert read("<p>a <b>b</p><p>c</b> d</p>") == [("p", "a b"), ("p", "c d")]
    assert read("<script>var t='</p>';if(a<b){}</script><p>x") == [("p", "x")]
    assert read("<style>p{}</style>a<!-- <p>no</p> -->b") == [("", "ab")]
    assert read('<a title="x > y">q</a> <img src=a.png>r') == [("", "q r")]
    assert read("<p>cut <b") == [("p", "cut")]
    assert read('<p>bad "quote <a href="x>y</a> z</p>')[0][1].startswith('bad "quote')
    assert read("<ul><li>1<li>2</ul>x") == [("li", "1"), ("li", "2"), ("", "x")]
    assert read("<script>never ends") == []
    assert len(extraction.blocks("<div>" * 3000 + "deep" + "</div>" * 3000)[0].path) <= 50


def test_gradients_match_differences():
    rng = random.Random(1)
    made = [extraction._layout_truth(extraction.layout(rng, ["One two.", "Three four five.", "Six."])) for _ in range(3)]
    pages, truth_of = [extraction.features(b) for b, _ in made], [t for _, t in made]
    w = lstm.fresh_weights(3)
    _, g = lstm._gradients(w, pages, truth_of)
    step = 1e-5
    for name, place in (("tags", (int(pages[0][0][0]), 2)), ("words", (int(pages[0][2][0]), 1)), ("numbers", (0, 3)), ("fx", (2, 5)),
                        ("fh", (3, 20)), ("bh", (1, 40)), ("bx", (0, 60)), ("f0", (7,)), ("b0", (33,)), ("out", (4, 0)), ("out0", (0,))):
        sides = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in w.items()}
            moved[name][place] += sign * step
            sides.append(lstm._gradients(moved, pages, truth_of)[0])
        assert abs((sides[0] - sides[1]) / (2 * step) - g[name][place]) < 1e-6, name


def test_labels_do_not_depend_on_the_batch(weights):
    rng = random.Random(2)
    pages = [extraction.features(extraction._layout_truth(extraction.layout(rng, ["Some text here.", "More."]))[0]) for _ in range(20)]
    together = lstm.label(weights, pages)
    for page, found in zip(pages, together, strict=True):
        assert np.allclose(lstm.label(weights, [page], cells=1)[0], found)


def test_held_out_layouts(weights, pages):
    """Layouts from other random numbers: blocks labelled as they were made."""
    rng = random.Random(99)
    sentences = [s for r in pages.collect() for s in re.split(r"(?<=\.) ", truth(r["html"])) if s]
    made = [extraction._layout_truth(extraction.layout(rng, sentences)) for _ in range(300)]
    found = lstm.label(weights, [extraction.features(b) for b, _ in made])
    right = np.concatenate([(x >= 0.5) == (t > 0.5) for x, (_, t) in zip(found, made, strict=True)])
    assert right.mean() > 0.97


def test_usual_pages(weights):
    page = """<html><body><header class="site-header"><a href=/>Home</a></header><div class="cookie-notice">We use cookies.<button>OK</button></div>
    <nav><ul><li><a href=/a>News</a></li></ul></nav><main><article><h1>The title</h1><p>First &amp; only paragraph, with some more words in it.</p>
    <p>Second paragraph of the text. It has two sentences.</p></article></main><aside class="sidebar"><p>Related articles</p></aside>
    <section id="comments"><h3>2 comments</h3><p>Great article, thanks!</p></section><form><label>Email</label><input></form>
    <footer>&copy; 2024 All rights reserved</footer></body></html>"""
    assert extraction.extract(weights, [page]) == ["The title\nFirst & only paragraph, with some more words in it.\n"
                                                   "Second paragraph of the text. It has two sentences."]


def test_whole_test_table(pages):
    rows = {r["page_id"]: r["html"] for r in pages.collect()}
    found = {r["row"]["page_id"]: (r["text"], r["n_chars"]) for r in extraction.main_text(pages).collect()}
    assert found == {i: (truth(h), len(truth(h))) for i, h in rows.items()}


def test_edge_rows(spark, pages):
    some = pages.limit(60).select("page_id", "url", "html")
    long = "<html><body><nav><a>x</a></nav><article>" + "".join(f"<p>Paragraph number {i}.</p>" for i in range(20_000)) + "</article></body></html>"
    rows = [(-1, None, None), (-2, "u", ""), (-3, "u", "<div></div>"), (None, "u", None), (-4, "u", long), (-4, "u", long)]
    df = some.unionByName(spark.createDataFrame(rows, PAGES)).withColumn("text", F.lit(1)).withColumn("a.b", F.lit(2))
    out = extraction.main_text(df, keep=("page_id", "text", "a.b"), batch_chars=50_000).collect()
    assert len(out) == df.count() and all(tuple(r["row"])[1:] == (1, 2) for r in out)
    found = [(r["row"]["page_id"], r["n_chars"]) for r in out if r["row"]["page_id"] is None or r["row"]["page_id"] < 0]
    whole = sum(len(f"Paragraph number {i}.") + 1 for i in range(20_000)) - 1
    assert sorted(found, key=str) == sorted([(-1, 0), (-2, 0), (-3, 0), (None, 0), (-4, whole), (-4, whole)], key=str)


def test_empty_table(spark):
    assert extraction.main_text(spark.createDataFrame([], PAGES), layouts=20).collect() == []
