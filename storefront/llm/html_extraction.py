"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its text blocks, each with its tag path
(names, classes, ids and roles of the elements around it) and its words. A
bidirectional LSTM (``block_labeller``) labels every block with the whole page
in view; the blocks labelled main text are the result. Pages are read, labelled
and joined where they lie: one pass, no shuffle.

The labeller learns from pages whose labels are known: a bounded sample of the
table's own pages that mark their article (``max_pages``), and as many layouts
again as ``layouts`` says, put together from the sample's sentences with
menus, notices, adverts, forms, comments and the like in many usual mark-ups.
The sample limits the fit alone; every page is labelled.

Defined results: a null or empty page, or one without text, has an empty text;
mark-up that is not closed, crossed or cut off is read as far as it goes; a
table without marked pages is labelled by a model of layouts alone; repeated
rows are each read; the columns to keep travel as one struct, so names may
clash; long pages are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.llm import block_labeller as lstm
from storefront.llm.shared import column

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I)
_NAME = re.compile(r"[a-z]+")
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
                    "sub sup time tt u var wbr br".split())
# Elements whose content is no text of the page, or is text without mark-up.
_RAW = frozenset("script style template noscript iframe object svg math canvas audio video textarea title select".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = re.compile(r"(?:p|div|ul|ol|li|dl|table|article|section|main|aside|nav|header|footer|form|h[1-6]|blockquote|pre|hr|figure|address)\Z")
_PATH = 48  # names of a tag path; deeper elements add none (a feature's bound: the text below is read all the same)


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag's part of a path: the tag, and its class, id and role words."""
    out = [tag]
    for kind, *values in _NAMES.findall(attributes) if attributes else ():
        out += [("@" if kind.lower() == "role" else ".") + x for x in _NAME.findall("".join(values).lower())]
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, white space as single blanks."""
    page, out = page or "", []
    stack: list[tuple[str, tuple]] = []
    pieces: list[str] = []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, next((path for tag, path in reversed(stack) if tag not in _INLINE), ()), linked))
            pieces.clear()
        linked = 0

    while at < len(page):
        found = _MARKUP.search(page, at)
        if found is None:
            pieces.append(page[at:])
            break
        if found.start() > at:
            pieces.append(page[at:found.start()])
            if links:
                linked += found.start() - at
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag not in _INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag or tag in _HEADINGS and stack[i][0] in _HEADINGS:  # any end of a heading ends it
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
                if tag in _INLINE and stack[i][0] not in _INLINE:
                    break
            continue
        if tag in _RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*+>", re.I).search(page, at)
                at = end.end() if end else len(page)
            flush()
            continue
        if tag == "br":
            pieces.append(" ")
        elif tag not in _INLINE:
            flush()
            # An open paragraph ends where a block begins, an open item at the next one.
            low = "p" if _CLOSES_P.match(tag) else None
            for i in range(len(stack) - 1, -1, -1):
                name = stack[i][0]
                if name == low or name == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    links -= sum(t == "a" for t, _ in stack[i:])
                    del stack[i:]
                    break
                if name not in _INLINE:
                    break
        if tag not in _EMPTY and not found[3].endswith("/"):
            path = stack[-1][1] if stack else ()
            if len(path) < _PATH:
                path = path + _names(tag, found[3])
            stack.append((tag, path))
            links += tag == "a"
    flush()
    return out


def features(page: list[Block]) -> lstm.Page:
    """A page's blocks as the labeller reads them."""
    tags, words, tag_at, word_at, numbers = [], [], [0], [0], []
    known: dict[tuple, list[int]] = {}
    for i, b in enumerate(page):
        own = known.get(b.path)
        if own is None:
            names = {*b.path, *("^" + x for x in b.path[-1:])}
            own = known[b.path] = [crc32(x.encode()) % lstm.TAGS for x in sorted(names)]
        tags += own
        split = b.text.lower().encode().split()
        words += {crc32(x) % lstm.WORDS for x in split}  # which words, not how often: a word said a thousand times is one
        tag_at.append(len(tags))
        word_at.append(len(words))
        n = len(b.text)
        numbers.append((1.0, np.log1p(len(split)) / 4, np.log1p(n) / 6, min(1.0, b.linked / n), float(b.text[-1] in ".!?…\"”"),
                        min(1.0, sum(map(b.text.count, ",.;:")) * 8 / n), i / len(page), float(b.text[0] in "©|»›#@")))
    whole = lambda x: np.array(x, dtype=np.int64)
    return whole(tags), whole(tag_at), whole(words), whole(word_at), np.array(numbers, dtype=float).reshape(-1, lstm.NUMBERS)


# Names and phrases by which pages usually mark what is not their main text.
OUTSIDE = {
    "nav": ("nav", ("nav", "menu", "navbar", "navigation", "breadcrumb", "toc", "pager")),
    "header": ("header", ("header", "masthead", "topbar", "branding", "banner", "site")),
    "footer": ("footer", ("footer", "bottom", "copyright", "legal", "colophon")),
    "aside": ("aside", ("sidebar", "related", "widget", "aside", "recommended", "popular", "trending", "promo")),
    "ad": ("div", ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "banner", "promo")),
    "notice": ("div", ("cookie", "notice", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "paywall")),
    "form": ("form", ("form", "search", "login", "signup", "newsletter", "contact")),
    "comments": ("section", ("comments", "comment", "reply", "respond", "discussion", "disqus", "replies")),
    "share": ("div", ("share", "social", "tags", "meta", "byline", "author", "buttons")),
}
INSIDE = ("content", "post", "entry", "article", "story", "body", "text", "main", "page", "blog", "prose")
PHRASES = {
    "nav": "Home|About|Contact|News|Products|Blog|Archive|Next|Previous|Login", "header": "Welcome|Daily News|Search|Skip to content|Sign in",
    "footer": "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|Powered by", "aside": "Related articles|Most read|Popular posts|You may also like",
    "ad": "Advertisement|Sponsored|Buy now|Special offer: 50 % off", "notice": "We use cookies to improve your experience.|Accept all|Subscribe to our newsletter",
    "form": "Your name|Email|Message|Send|Search|Password", "comments": "Leave a reply|3 comments|Reply|Posted by guest|Great article, thanks!",
    "share": "Share on social media|Tweet|Posted in News|By staff writer",
}
_MARK = ""  # before a layout's main text; taken off again


def layout(rng: random.Random, sentences: list[str]) -> str:
    """A page of known labels: ``_MARK`` leads every block of main text."""
    def said(n: int) -> str:
        text = " ".join(rng.choice(sentences) for _ in range(n))
        if rng.random() < 0.06:  # poor text is text as well
            text = " ".join([rng.choice(text.split())] * rng.randint(2, 80))
        return html.escape(text)

    def classes(names: tuple[str, ...], always: bool) -> str:
        if not always and rng.random() < 0.25:
            return ""
        name = rng.choice(names)
        name = rng.choice([name, name, f"{rng.choice(('site', 'page', 'box', 'c', 'wp', 'the'))}-{name}", f"{name}-{rng.choice(('box', 'main', 'list', 'wrap', '1'))}"])
        return f' {rng.choice(("class", "class", "class", "id"))}="{name}"'

    def outside(kind: str) -> str:
        own, names = OUTSIDE[kind]
        tag = own if rng.random() < 0.6 else "div"
        items = [rng.choice(PHRASES[kind].split("|")) if rng.random() < 0.5 else said(1) for _ in range(rng.randint(1, 6))]
        shape = rng.choice(("ul", "p", "div", "bare", "a")) if kind not in ("nav", "form") else rng.choice(("ul", "a")) if kind == "nav" else "form"
        if shape == "ul":
            inner = "<ul>" + "".join(f'<li><a href="/x">{x}</a></li>' if rng.random() < 0.8 else f"<li>{x}</li>" for x in items) + "</ul>"
        elif shape == "form":
            inner = "".join(f"<label>{x}</label><input name=x>" if rng.random() < 0.5 else f"<p>{x}</p>" for x in items) + "<button>Send</button>"
        elif shape == "a":
            inner = " ".join(f'<a href="#">{x}</a>' for x in items)
        else:
            inner = "".join(f"<{shape}>{x}</{shape}>" for x in items) if shape != "bare" else " ".join(items)
        if kind in ("comments", "aside") and rng.random() < 0.5:
            inner = f"<h{rng.randint(2, 4)}>{items[0]}</h3>{inner}"
        return f"<{tag}{classes(names, tag == 'div')}>{inner}</{tag}>"

    def main_block() -> str:
        kind = rng.random()
        if kind < 0.7:
            text = said(rng.randint(1, 5))
            if rng.random() < 0.15:
                text = f'{said(1)} <a href="/y">{said(1)}</a> {text}'
            if rng.random() < 0.15:
                return f"<p><b>{_MARK}{text}<br>"
            return f"<p>{_MARK}{text}</p>"
        if kind < 0.8:
            return f"<h{rng.randint(2, 4)}>{_MARK}{rng.choice(sentences)[:rng.randint(6, 60)]}</h2>"
        if kind < 0.88:
            return "<ul>" + "".join(f"<li>{_MARK}{said(1)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if kind < 0.92:
            return f"<table><tr><td>{_MARK}{said(1)}</td><td>{_MARK}{said(1)}</td></tr></table>"
        return rng.choice((f"<blockquote>{_MARK}{said(2)}</blockquote>", f"<pre>{_MARK}{said(2)}</pre>", f"<div>{_MARK}{said(2)}</div>"))

    title = rng.choice(sentences)[:60]
    inner = [main_block() for _ in range(rng.choice((1, 2, 4, 7, 12)) * (12 if rng.random() < 0.03 else 1))]
    for kind in rng.sample(("ad", "aside", "form", "notice", "share", "nav", "comments"), rng.choice((0, 0, 1, 2))):
        inner.insert(rng.randint(0, len(inner)) if kind != "comments" else len(inner), outside(kind))
    if rng.random() < 0.8:
        head = f"<h1>{_MARK}{html.escape(title)}</h1>"
        inner.insert(0, f"<header>{head}</header>" if rng.random() < 0.2 else head)
    tag = rng.choice(("article", "article", "article", "main", "div", "div", "section"))
    body = f"<{tag}{classes(INSIDE, tag in ('div', 'section'))}>{''.join(inner)}</{tag}>"
    if rng.random() < 0.3:
        body = f"<{rng.choice(('main', 'div class=wrapper', 'div id=page'))}>{body}"
    before = [outside(k) for k in rng.sample(("nav", "header", "ad", "notice", "form", "aside"), rng.choice((0, 1, 2, 2, 3)))]
    after = [outside(k) for k in rng.sample(("footer", "comments", "aside", "ad", "share", "nav", "notice", "form"), rng.choice((0, 1, 1, 2, 3)))]
    return f"<html><head><title>{title}</title></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"


def _layout_truth(page: str) -> tuple[list[Block], np.ndarray]:
    made = blocks(page)
    truth = np.array([b.text.startswith(_MARK) for b in made], dtype=float)
    for b in made:
        b.text = b.text.replace(_MARK, "") or "x"
    return made, truth


_OUT_TAGS = frozenset("nav header footer aside form".split())
_OUT_NAMES = frozenset("." + n for _, names in OUTSIDE.values() for n in names)


def marked_truth(page: list[Block]) -> np.ndarray:
    """Labels of a page that marks its article: what lies in it, but for the
    parts named as something else. None (empty) for other pages."""
    truth = []
    for b in page:
        at = max((i for i, x in enumerate(b.path) if x in ("article", "main")), default=-1)
        inside = b.path[at + 1:] if at >= 0 else ()
        truth.append(at >= 0 and not any(x in _OUT_TAGS or x in _OUT_NAMES for x in inside))
    return np.array(truth, dtype=float) if any(truth) else np.zeros(0)


def fit(pages: list[str], layouts: int = 1200, seed: int = 7) -> dict[str, np.ndarray]:
    """The labeller's weights from marked pages and made layouts."""
    rng = random.Random(seed)
    read = [blocks(p) for p in pages]
    own = [(b, t) for b in read if len(t := marked_truth(b))]
    sentences = sorted({s.strip() for b, _ in own for x in b for s in re.split(r"(?<=[.!?]) ", x.text) if 2 < len(s) < 400})
    sentences = sentences or [x for v in PHRASES.values() for x in v.split("|")]
    made = [_layout_truth(layout(rng, sentences)) for _ in range(layouts)]
    return lstm.train([features(b) for b, _ in own + made], [t for _, t in own + made], seed=seed)


def extract(weights: dict[str, np.ndarray], pages: list[str | None]) -> list[str]:
    """The main text of every page."""
    read = [blocks(p) for p in pages]
    labels = lstm.label(weights, [features(b) for b in read])
    return ["\n".join(b.text for b, x in zip(page, p, strict=True) if x >= 0.5) for page, p in zip(read, labels, strict=True)]


def sample_pages(pages: DataFrame, html_column: str, max_pages: int, max_chars: int) -> list[str]:
    """At most ``max_pages`` different pages of at most ``max_chars``: those
    with the smallest hashes, whatever the order or number of the rows."""
    text = column(pages, html_column)
    order = F.xxhash64(text, F.lit("sample"))
    small = pages.select(text.alias("t"), order.alias("o")).filter(F.length("t").between(1, max_chars))
    # Pre-aggregated by the hash: copies of one page count once.
    kept = small.filter(F.pmod("o", F.lit(1 << 20)) < _share(small, max_pages)).groupBy("o").agg(F.first("t").alias("t"))
    return [r["t"] for r in kept.orderBy("o").limit(max_pages).collect()]


def _share(pages: DataFrame, max_pages: int) -> int:
    """The part of 2^20 hash values that holds about three times ``max_pages`` pages."""
    total = pages.count()
    return min(1 << 20, (3 * max_pages << 20) // max(1, total) + 1)


def main_text(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url"), max_pages: int = 200,
              max_chars: int = 20_000, layouts: int = 1200, batch_chars: int = 4 << 20) -> DataFrame:
    """Per row of ``pages``: ``row`` (a struct of the columns ``keep``),
    ``text`` and ``n_chars``."""
    weights = fit(sample_pages(pages, html_column, max_pages, max_chars), layouts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, chars = 0, 0
            for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                chars += n or 0
                if chars >= batch_chars or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    texts = extract(weights, part.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                     ["row", "text", "n_chars"])
                    start, chars = i + 1, 0

    given = pages.select(F.struct(*[column(pages, c).alias(c) for c in keep]).alias("row"), column(pages, html_column).alias("html"))
    schema = T.StructType([T.StructField("row", given.schema["row"].dataType), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return given.mapInArrow(run, schema)
