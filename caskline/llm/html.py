"""HTML extraction: a linear-chain conditional random field over the DOM's leaf blocks."""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caskline.llm.common import slices

#: Pages the field is trained on (of those that mark their article, the smallest hashes), each in its own and in other layouts.
TRAIN_PAGES, LAYOUTS = 200, 4
#: Blocks of a training sequence, and HTML bytes handled at a time inside a task.
TRAIN_BLOCKS, PIECE = 120, 2 << 20

_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening tags that a head may hold (beside those _TOKEN takes whole); any other one ends it, as text does.
_IN_HEAD = frozenset("html head title meta link base basefont bgsound script style noscript template".split())
#: An opening tag here ends an open element of the second kind, looked for up to one of the third.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    # Foreign elements may close themselves, and a tag of HTML's own ends one that stays open.
    r"|<(?:svg|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(?:svg|math)\b[^>]*>.*?(?:</(?:svg|math)\s*>|\Z|(?=</?(?:p|div|h[1-6]|[uod]l|li|d[td]|table|t[rdh]|article|section|main|aside|nav|header|footer|figure|blockquote|pre|body|html|form|br|hr|img|span)\b))"
    r"|<(script|style|template|noscript|textarea|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """A leaf block: its text, the open elements around it, the names in their class and id attributes,
    and the characters that are link text."""

    text: str
    tags: tuple[str, ...]
    names: frozenset[str]
    linked: int


@dataclass
class _Open:
    tag: str
    names: frozenset[str] = field(default_factory=frozenset)


def _names(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    return frozenset(
        x.lower() for groups in _ATTRIBUTE.findall(attributes) for value in groups for x in _NAME.findall(value)
    )


def _silent(source: str, begin: int, tag: str) -> int:
    """Where the content of an element that is never text ends; without an end tag it has none."""
    end = re.compile(rf"</{tag}\s*>", re.I).search(source, begin)
    return end.end() if end else begin


def leaf_blocks(source: str | None) -> list[Block]:
    """Cut a page into leaf blocks in page order: runs of text between block-level tags.

    Character references are decoded, white space (line breaks and <br> too) becomes one blank, blocks
    without text are left out. A head ends at its end tag, at the first tag it may not hold or at text.
    Missing end tags are implied, stray ones ignored, comments and the
    content of scripts, styles, templates and the like are no text. Drawings and formulas may close
    themselves or end at the next HTML tag; media without an end tag hide nothing. A page cut off in a
    tag keeps what comes before it. Null: no blocks.
    """
    blocks: list[Block] = []
    stack: list[_Open] = []
    held: list[str] = []
    linked, in_link, in_head = 0, False, False

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                names = frozenset().union(*(x.names for x in stack)) if stack else frozenset()
                blocks.append(Block(text, tuple(x.tag for x in stack), names, min(linked, len(text))))
            held.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked, in_head
        if in_head and text.strip():
            in_head = False
        if text and not in_head:
            text = entities.unescape(text) if "&" in text else text
            held.append(text)
            if in_link:
                linked += len(text)

    source, at = source or "", 0
    while True:
        found = _TOKEN.search(source, at)
        if not found:
            rest = source[at:]
            cut = re.search(r"<[/A-Za-z!?]", rest)
            say(rest[: cut.start()] if cut else rest)
            break
        say(source[at : found.start()])
        at = found.end()
        if not found[3]:
            continue
        tag = found[3].lower()
        if found[2]:
            if tag == "a":
                in_link = False
            elif tag == "head":
                in_head = False
            elif tag in _BLOCK:
                flush()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            continue
        if tag not in _IN_HEAD:
            in_head = False
        if tag == "a":
            in_link = True
        elif tag == "br":
            say(" ")
        elif tag == "head":
            in_head = True
        elif tag in ("object", "canvas", "audio", "video"):
            at = _silent(source, at, tag)
        elif tag in _BLOCK:
            flush()
            in_link = False
            if tag in _ENDS:
                ends, upto = _ENDS[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag in upto:
                        break
                    if stack[k].tag in ends:
                        del stack[k:]
                        break
            if stack and stack[-1].tag == "p":
                stack.pop()
            if tag not in _VOID and not found[4].endswith("/"):
                stack.append(_Open(tag, _names(found[4])))
    flush()
    return blocks


def _step(x: float, edges: Sequence[float]) -> int:
    return sum(x > e for e in edges)


def _containers(blocks: Sequence[Block]) -> list[tuple[float, bool]]:
    """For each block how much of the page's plain text its container holds, and whether none holds more.

    Blocks with the same ancestors (but the last) and the same names around them are in one container, as
    far as a list of leaves can tell; plain text is text that is no link, of blocks of 6 words or more.
    """
    held: dict[tuple, int] = {}
    keys = [(b.tags[:-1], b.names) for b in blocks]
    for key, b in zip(keys, blocks, strict=True):
        held[key] = held.get(key, 0) + (len(b.text) - b.linked if b.text.count(" ") >= 5 else 0)
    total, most = max(1, sum(held.values())), max(held.values(), default=0)
    return [(held[key] / total, most > 0 and held[key] == most) for key in keys]


def block_features(blocks: Sequence[Block]) -> list[list[str]]:
    """What the field sees of each block: ancestor tags and names, own tag, traits of the text and of the
    blocks beside it, and the part of the page's text that its container holds."""
    out, n = [], len(blocks)
    held = _containers(blocks)
    long = [_step(b.text.count(" ") + 1, (3, 10, 25)) for b in blocks]
    for k, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        ends = b.text[-1]
        own = [f"has {t}" for t in set(b.tags)]
        own += [f"name {x}" for x in b.names if " " not in x]
        own += [
            f"tag {b.tags[-1] if b.tags else ''}",
            f"words {_step(words, (1, 3, 6, 12, 25, 60))}",
            f"linked {_step(b.linked / len(b.text), (0, 0.3, 0.7, 0.95))}",
            f"ends {'stop' if ends in '.!?…' else 'word' if ends.isalnum() else 'other'}",
            f"commas {_step(b.text.count(',') / words, (0, 0.02, 0.08))}",
            f"place {_step((k + 0.5) / n, (0.1, 0.3, 0.7, 0.9))}",
            f"depth {min(len(b.tags), 8)}",
            f"container {_step(held[k][0], (0.02, 0.1, 0.3, 0.6))}{' most' if held[k][1] else ''}",
            f"before {long[k - 1] if k else 'none'}",
            f"after {long[k + 1] if k + 1 < n else 'none'}",
            f"linked words {_step(words, (3, 10, 25))} {b.linked > 0.5 * len(b.text)}",
        ]
        if k:
            own.append(f"moves {b.tags[:-1] == blocks[k - 1].tags[:-1]} {held[k][1]} {held[k - 1][1]}")
        if "©" in b.text or "copyright" in b.text.lower():
            own.append("copyright")
        out.append(own)
    return out


@dataclass
class Field:
    """A trained field over two labels: weights of features, of neighbouring labels and of the start."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def decode(self, features: Sequence[Sequence[str]]) -> list[int]:
        """The most probable labels (Viterbi)."""
        if not features:
            return []
        get, w = self.index.get, self.weights.tolist()
        (t00, t01), (t10, t11) = self.moves.tolist()
        back: list[tuple[int, int]] = []
        a, b = self.start.tolist()
        for k, own in enumerate(features):
            e0 = e1 = 0.0
            for name in own:
                j = get(name)
                if j is not None:
                    e0 += w[j][0]
                    e1 += w[j][1]
            if k:
                c0, c1, d0, d1 = a + t00, b + t10, a + t01, b + t11
                back.append((int(c1 > c0), int(d1 > d0)))
                a, b = max(c0, c1), max(d0, d1)
            a, b = a + e0, b + e1
        labels = [int(b > a)]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train_field(
    sequences: Sequence[tuple[Sequence[Sequence[str]], Sequence[int]]], steps: int = 100, rate: float = 0.15, ridge: float = 1e-3, least: int = 3
) -> Field:
    """Maximise the penalised conditional likelihood of labelled sequences (Adam, exact gradients by
    the forward-backward recursions over all sequences at once). Features seen fewer than ``least``
    times get no weight."""
    cut = [(f[k : k + TRAIN_BLOCKS], y[k : k + TRAIN_BLOCKS]) for f, y in sequences for k in range(0, len(y), TRAIN_BLOCKS)]
    counts: dict[str, int] = {}
    for f, _ in cut:
        for own in f:
            for name in own:
                counts[name] = counts.get(name, 0) + 1
    index = {name: j for j, name in enumerate(sorted(n for n, c in counts.items() if c >= least))}
    size, longest = len(cut), max((len(y) for _, y in cut), default=0)
    cell, feature = [], []
    truth = np.zeros((size, longest), int)
    length = np.array([len(y) for _, y in cut], int)
    for s, (f, y) in enumerate(cut):
        truth[s, : len(y)] = y
        for t, own in enumerate(f):
            ids = [index[x] for x in own if x in index]
            cell += [s * longest + t] * len(ids)
            feature += ids
    cell, feature = np.array(cell, int), np.array(feature, int)
    theta = np.zeros(2 * len(index) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    if not size:
        return Field(index, theta[:-6].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:])
    here = np.arange(longest) < length[:, None]
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for step in range(1, steps + 1):
        w, moves, start = theta[:-6].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:]
        e = np.stack([np.bincount(cell, w[feature, c], size * longest).reshape(size, longest) for c in (0, 1)], -1)
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = start + e[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.where(here[:, t, None], lse(ahead[:, t - 1, :, None] + moves, 1) + e[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind[:, t] = np.where(here[:, t + 1, None], lse(moves + (e + behind)[:, t + 1, None, :], 2), 0.0)
        total = lse(ahead[:, -1], 1)
        p = np.exp(ahead + behind - total[:, None, None]) * here[:, :, None]
        diff = p.copy()
        np.subtract.at(diff, (np.arange(size)[:, None], np.arange(longest), truth), here.astype(float))
        grad = np.zeros_like(theta)
        for c in (0, 1):
            grad[c:-6:2] = np.bincount(feature, diff[:, :, c].ravel()[cell], len(index))
        pair = np.exp(ahead[:, :-1, :, None] + moves + (e + behind)[:, 1:, None, :] - total[:, None, None, None])
        pair *= here[:, 1:, None, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (truth[:, :-1][here[:, 1:]], truth[:, 1:][here[:, 1:]]), 1)
        grad[-6:-2] = (pair.sum((0, 1)) - seen).ravel()
        grad[-2:] = diff[:, 0].sum(0)
        grad = grad / size + ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(index, theta[:-6].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:])


# Elements and attribute names in common use on web pages, by what they hold.
_ARTICLE = ["<article>", "<main>", '<div class="content">', '<div id="main-content">', '<div class="post-body entry-content">', '<section class="article-body">', '<div class="story text">', '<main><article class="post">', '<div itemprop="articleBody">']
_AROUND = {
    "menu": ["<nav>", '<div class="menu">', '<ul class="nav navbar">', '<div id="navigation">', '<div class="breadcrumbs">', '<div role="navigation">'],
    "header": ["<header>", '<div class="header">', '<div id="masthead">', '<div class="top-bar site-header">', '<div role="banner">'],
    "footer": ["<footer>", '<div class="footer">', '<div id="site-footer">', '<div class="copyright legal">', '<div role="contentinfo">'],
    "sidebar": ["<aside>", '<div class="sidebar">', '<div class="widget related">', '<div class="trending recommended">', '<aside class="sidebar most-read">', '<div role="complementary">'],
    "notice": ['<div class="cookie-notice">', '<div class="notice">', '<div id="consent-banner">', '<div role="alert">', '<div class="popup newsletter subscribe">', '<div class="gdpr privacy">', "<dialog>", '<section class="notice">'],
    "advert": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement sponsored">', '<div class="promo banner">', '<aside class="ad">', '<section class="advert">'],
    "form": ["<form>", '<form class="search">', '<form id="login">', '<div class="signup form"><form>'],
    "comments": ['<section id="comments">', '<div class="comments">', '<ol class="comment-list">', '<div class="comment">', '<div id="respond" class="reply discussion">', '<section class="user comments">', '<article class="comment">'],
    "share": ['<div class="share social">', '<div class="tags">', '<div class="pagination pager">'],
}


def _closed(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))


def laid_out(heading: str, paragraphs: Sequence[str], words: Sequence[str], rng: random.Random) -> tuple[str, list[int]]:
    """Set an article and other parts, made of the page's own words, in a random layout.

    Returns the page and the label of each of its blocks: 1 for the article's, 0 for all others.
    """
    out: list[str] = []
    labels: list[int] = []

    def put(tag: str, text: str, label: int, inner: str = "{}") -> None:
        out.append(f"<{tag}>{inner.format(entities.escape(text))}</{tag}>")
        labels.append(label)

    def some(low: int, high: int) -> str:
        return " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))

    def part(kind: str) -> None:
        opening = rng.choice(_AROUND[kind])
        out.append(opening)
        if kind in ("menu", "share"):
            if not opening.startswith("<ul"):
                out.append("<ul>")
            for _ in range(rng.randint(2, 7)):
                put("li", some(1, 2), 0, '<a href="/x">{}</a>')
            if not opening.startswith("<ul"):
                out.append("</ul>")
        elif kind == "form":
            for _ in range(rng.randint(1, 3)):
                put(rng.choice(("label", "p")), some(1, 6), 0)
                out.append("<input>")
            put("button", some(1, 2), 0)
        elif kind == "footer" and rng.random() < 0.5:
            put("p", f"© {some(3, 15)}", 0)
        elif rng.random() < 0.4:
            out.append(entities.escape(some(3, 20)))
            labels.append(0)
        else:
            if kind in ("sidebar", "comments", "header") and rng.random() < 0.6:
                put(rng.choice(("h1", "h2", "h3")), some(1, 6), 0)
            tag = "li" if opening.startswith("<ol") else rng.choice(("p", "p", "div"))
            for _ in range(rng.randint(1, 4)):
                text = some(4, 60)
                put(tag, text + rng.choice((".", ".", "", "!")), 0)
        out.append(_closed(opening))

    out.append("<html><body>")
    kinds = list(_AROUND)
    for kind in ("header", "menu", *rng.sample(kinds, rng.randint(0, 2))):
        if rng.random() < 0.7:
            part(kind)
    opening = rng.choice(_ARTICLE)
    out.append(opening)
    if rng.random() < 0.3:
        out.append("<header>")
        put("h1", heading, 1)
        out.append("</header>")
    elif rng.random() < 0.9:
        put("h1", heading, 1)
    for text in paragraphs:
        # Paragraphs of other pages may be short, or end without a stop.
        if rng.random() < 0.15:
            text = " ".join(text.split()[: rng.randint(1, 5)])
        if rng.random() < 0.4:
            text = text.rstrip(".!? ") or text
        put(rng.choice(("p", "p", "p", "p", "p", "h2", "blockquote", "li", "div")), text, 1)
        if rng.random() < 0.12:
            part(rng.choice(("advert", "notice", "sidebar", "share", "form")))
    out.append(_closed(opening))
    for kind in ("comments", *rng.sample(kinds, rng.randint(1, 3)), "footer"):
        if rng.random() < 0.75:
            part(kind)
    out.append("</body></html>")
    return "".join(out), labels


_NOT_ARTICLE = frozenset("nav aside footer form button select dialog".split())
_NOT_ARTICLE_NAMES = frozenset("ad ads advert advertisement sidebar comment comments notice cookie menu footer".split())


def labelled_by_markup(blocks: Sequence[Block]) -> list[int] | None:
    """Labels of a page that marks its article with <article> or <main>; None for a page that doesn't."""
    if not any({"article", "main"} & set(b.tags) for b in blocks):
        return None
    return [
        int(bool({"article", "main"} & set(b.tags)) and not _NOT_ARTICLE & set(b.tags) and not _NOT_ARTICLE_NAMES & b.names)
        for b in blocks
    ]


def without_names(blocks: Sequence[Block], rng: random.Random) -> list[Block]:
    """The blocks as on a page that names its parts in no way that others do: no names, articles in plain
    containers, and in half of the cases plain containers for all other parts too."""
    plain = rng.choice(("div", "section", "td", ""))
    parts = rng.random() < 0.5

    def bare(b: Block) -> Block:
        # Containers stay told apart, as they are on a page with names of its own.
        own = frozenset({"unnamed " + " ".join(sorted(b.names))}) if b.names else frozenset()
        tags = (plain if t in ("article", "main") else "div" if parts and t in _PARTS else t for t in b.tags)
        return Block(b.text, tuple(t for t in tags if t), own, b.linked)

    return [bare(b) for b in blocks]


_PARTS = frozenset("nav aside header footer".split())


def training_sequences(pages: Sequence[str], layouts: int = LAYOUTS, seed: int = 7) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled sequences from pages that mark their article: as they are, set in other layouts, and each of
    these again without the names."""
    out = []
    rng = random.Random(seed)
    for source in pages:
        blocks = leaf_blocks(source)
        labels = labelled_by_markup(blocks)
        if labels is None:
            continue
        out.append((block_features(blocks), labels))
        out.append((block_features(without_names(blocks, rng)), labels))
        own = [b.text for b, y in zip(blocks, labels, strict=True) if y]
        words = [w for b in blocks for w in b.text.split()][:500]
        for _ in range(layouts if own else 0):
            page, truth = laid_out(own[0], own[1:40], words, rng)
            made = leaf_blocks(page)
            if len(made) == len(truth):
                out.append((block_features(made), truth))
                out.append((block_features(without_names(made, rng)), truth))
    return out


def extract_text(model: Field, source: str | None) -> str:
    """The blocks the field labels as the article's, joined by line feeds."""
    blocks = leaf_blocks(source)
    return "\n".join(b.text for b, y in zip(blocks, model.decode(block_features(blocks)), strict=True) if y)


def train_on(pages: DataFrame, html_col: str = "html", rows: int = TRAIN_PAGES) -> Field:
    """Train on at most ``rows`` different pages: of those with an <article> or <main> tag, the ones with
    the smallest hashes of their HTML.

    The hashes are chosen first, so that no task sends pages to be thrown away; copies of a page are one.
    Without a page that marks its article the field is trained on layouts of a fixed sentence.
    """
    keyed = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s/>]")).select(F.xxhash64(html_col).alias("_key"), F.col(html_col).alias("_html"))
    keys = keyed.select("_key").distinct().orderBy("_key").limit(rows)
    sample = keyed.join(F.broadcast(keys), "_key").groupBy("_key").agg(F.min("_html").alias(html_col)).collect()
    sample.sort(key=lambda r: r["_key"])
    sequences = training_sequences([r[html_col] for r in sample])
    if not sequences:
        plain = "<article><h1>A heading</h1>" + "<p>One sentence of several plain words, and a second part.</p>" * 6 + "</article>"
        sequences = training_sequences([plain] * 40)
    return train_field(sequences)


def extract_articles(
    pages: DataFrame, model: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """The main text of every page: id, url, text (empty if there is none), n_chars (code points).

    Null or empty HTML gives empty text. Repeated rows give a row each, an empty table none. The field
    (a few thousand numbers at most) goes to every task.
    """
    field_ = model or train_on(pages, html_col)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col, PIECE):
            texts = [extract_text(field_, x) for x in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column(url_col), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"{id_col} {kind}, {url_col} string, text string, n_chars long"
    )
