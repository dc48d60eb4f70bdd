"""Main text of HTML pages by the maximum-scoring subsequence.

A page becomes a sequence of scored tokens: a word scores P(main) - P(not main) of its context (the
innermost element that is not mere formatting), a tag scores a little below zero, more for tags that
stand outside main text. One linear scan finds the contiguous region of greatest total score, and
its words are the text. The weights come from labelled pages: those that mark their main text with
``article`` or ``main`` (a sample bounded by ``sample_pages``; the bound is the parameter).

Elements that never are main text (menus, headers, footers, asides, forms, scripts, styles, hidden ones) are left
out before scoring, so they neither add to the region nor cut it in two. So are elements whose class, id or role names
an advert, notice, sidebar or reader comments, unless the main text must lie inside: an element that holds the
page's largest ``article`` or ``main`` stays, and on a page without either (or whose only ones are named so
themselves) an element stays that holds two thirds of the words left. What is named so inside it is judged again.
Character references are decoded once, white space inside a block becomes one blank, blocks are joined by one blank.

Null or empty html gives an empty text. Unclosed elements end with their parent or the page; end
tags without a start are ignored; a comment, script or style that never ends takes the rest. The parser is linear in the
page: names of open elements are counted, and each element knows its nearest block.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.llm.frames import map_batches

SAMPLE_PAGES = 20_000
#: Share of a page's words from which an unmarked element with a telling name counts as a wrapper of the page.
WRAPPER = 2 / 3

# --- fixed values: HTML's own element kinds ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "template", "noscript", "svg", "title", "iframe")
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong "
                   "sub sup time tt u var wbr big strike".split())
FORMATTING = INLINE - {"a", "label", "small"}
DROPPED = frozenset("head nav header footer aside form script style textarea template noscript svg title iframe select "
                    "button dialog menu object canvas".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main nav ol p pre section table ul".split())
MARKS_MAIN = frozenset(("article", "main"))
# --- fixed values: words of class, id or role that name what is not main text ---
NOT_MAIN = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies "
                     "consent notice notices alert popup modal overlay newsletter subscribe signup sidebar menu "
                     "navigation navbar nav breadcrumb breadcrumbs footer header masthead comment comments reply "
                     "replies respond disqus share sharing social related recommended widget pagination toolbar "
                     "search complementary contentinfo dialog form login".split())

_MARKUP = re.compile(r"<!--|<!|<\?|</?[a-zA-Z]")
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_NAME_WORD = re.compile(r"[A-Za-z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in RAW}


@dataclass
class Element:
    """An element with its place among the page's elements and those that it is asked for all the time: its parent,
    the innermost one that is no formatting (the context of its words) and the innermost block."""
    name: str
    key: str
    place: int
    parent: Element | None
    context: Element | None
    block: Element | None
    gone: bool
    named: bool
    main: bool
    words: int = 0


@dataclass
class Page:
    """Tokens of one page in order: ``(kind, key, text, in main)``, kind ``w`` text, ``t`` tag, ``b``
    the edge of a block."""

    tokens: list[tuple[str, str, str, bool]] = field(default_factory=list)
    marked: bool = False


def _key(name: str, attributes: str) -> tuple[str, bool, bool]:
    """Context key of an element, whether its attributes name something that is not main text, and whether they hide it."""
    if not attributes or attributes.isspace():
        return name, False, False
    first, out, hidden = "", False, False
    for a, value in _ATTR.findall(attributes):
        a = a.lower()
        words = [w.lower() for w in _NAME_WORD.findall(entities.unescape(value))]
        if a in ("hidden", "aria-hidden"):
            hidden = hidden or (a == "hidden" or "true" in words)
            continue
        out = out or any(w in NOT_MAIN for w in words)
        if a == "class" and words:
            first = words[0]
    return (f"{name}.{first}" if first else name), out, hidden


def _left_out(elements: list[Element]) -> set[int]:
    """Places of the elements that are left out: those of a dropped kind, and those with a telling name unless the main
    text must lie inside. Elements stand in document order, parents first."""
    for e in reversed(elements):
        if e.parent is not None and not e.gone:
            e.parent.words += e.words
    marks = [e for e in elements if e.name in MARKS_MAIN and not e.gone and not e.named]
    mark = max(marks, key=lambda e: e.words, default=None)
    holds: set[int] = set()
    while mark is not None:
        holds.add(mark.place)
        mark = mark.parent
    left = sum(e.words for e in elements if e.parent is None and not e.gone)
    out: set[int] = set()
    for e in elements:
        if e.gone or (e.parent is not None and e.parent.place in out):
            out.add(e.place)
        elif e.named and e.place not in holds and (marks or e.words < WRAPPER * left or not e.words):
            out.add(e.place)
            left -= e.words
    return out


def tokenize(html: str | None, until_marked: bool = False) -> Page:
    """Split a page into text, tags and block edges, without the elements left out; ``until_marked``: only
    as far as it takes to see that the page marks its main text."""
    page, at, stack, elements = Page(), 0, [], []
    html = html or ""
    found: list[tuple[str, str, str, Element | None]] = []  # tokens with the element that they belong to
    opened: dict[str, int] = {}

    def text(piece: str) -> None:
        inside = stack[-1] if stack else None
        if piece and not (inside and inside.gone):
            context = inside.context if inside else None
            piece = entities.unescape(piece)
            if inside:
                inside.words += len(piece.split())
            found.append(("w", context.key if context else "", piece, inside))

    def edge(e: Element) -> None:
        if e.name not in INLINE:
            found.append(("b", "", "", e.parent))
        found.append(("t", e.name, "", e))

    def close(name: str) -> None:
        while stack:
            e = stack.pop()
            opened[e.name] -= 1
            edge(e)
            if e.name == name:
                return

    while at < len(html):
        m = _MARKUP.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at:m.start()])
        if m[0] == "<!--":
            end = html.find("-->", m.end())
            at = len(html) if end < 0 else end + 3
            continue
        if m[0] in ("<!", "<?"):
            end = html.find(">", m.end())
            at = len(html) if end < 0 else end + 1
            continue
        tag = _TAG.match(html, m.start())
        if not tag:
            end = html.find(">", m.end())
            at = len(html) if end < 0 else end + 1
            continue
        at, name = tag.end(), tag[1].lower()
        if m[0].startswith("</"):
            if opened.get(name):
                close(name)
            continue
        if name in CLOSES_P:
            # a paragraph ends where a block begins, together with the formatting opened in it
            if stack and stack[-1].block is not None and stack[-1].block.name == "p":
                close("p")
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1].name == name:
            close(name)
        key, named, hidden = _key(name, tag[2])
        inside = stack[-1] if stack else None
        e = Element(name, key, len(elements), inside, inside.context if inside else None, inside.block if inside else None,
                    name in DROPPED or hidden or bool(inside and inside.gone), named, name in MARKS_MAIN or bool(inside and inside.main))
        if name not in FORMATTING:
            e.context = e
            if name != "a":
                e.block = e
        elements.append(e)
        if name in MARKS_MAIN and not e.gone and not named:
            page.marked = True
            if until_marked:
                return page
        edge(e)
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not tag[2].rstrip().endswith("/"):
            stack.append(e)
            opened[name] = opened.get(name, 0) + 1
    out = _left_out(elements)
    page.tokens = [(kind, key, piece, kind != "b" and bool(e and e.main)) for kind, key, piece, e in found if e is None or e.place not in out]
    return page


@dataclass
class PageWeights:
    """Per word context and per tag name: how often inside and outside the marked main text."""

    words: dict[str, float]
    tags: dict[str, float]

    def word(self, key: str) -> float:
        w = self.words.get(key)
        if w is None:
            w = self.words.get(key.partition(".")[0], 0.2)
        return w

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.2)


def main_text(html: str | None, weights: PageWeights) -> str:
    """Text of the best contiguous region of a page."""
    tokens = tokenize(html).tokens
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for k, (kind, key, text, _) in enumerate(tokens):
        if kind == "w":
            total += weights.word(key) * len(text.split())
        elif kind == "t":
            total += weights.tag(key)
        if total > best:
            best, span = total, (start, k + 1)
        if total <= 0:
            total, start = 0.0, k + 1
    region = "".join(text if kind == "w" else " " if kind == "b" else "" for kind, _, text, _ in tokens[span[0]:span[1]])
    return " ".join(region.split())


def _count_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    """Words and tags inside and outside the marked main text, per key."""
    found: dict[tuple[str, str], list[int]] = {}
    for html in b.column(0).to_pylist():
        page = tokenize(html)
        if page.marked:
            for kind, key, text, main in page.tokens:
                if kind != "b":
                    found.setdefault((kind, key), [0, 0])[not main] += len(text.split()) if kind == "w" else 1
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
         pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
        names=["kind", "key", "n_in", "n_out"])


def _marked_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    n = sum(tokenize(html, until_marked=True).marked for html in b.column(0).to_pylist())
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])


def fit_page_weights(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> PageWeights:
    """Learn the weights from marked pages. ``sample_pages``: expected most marked pages learned from, out
    of all that are marked (chosen by a hash of the html); every context of theirs gets a weight."""
    rows = pages.select(F.col(html_col).alias("html")).filter("html is not null")
    unit = F.xxhash64("html").bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / float(1 << 52)
    # others cannot be marked
    rows = rows.filter(F.col("html").rlike(f"(?i)<({'|'.join(sorted(MARKS_MAIN))})"))
    marked = map_batches(rows, _marked_batch, "n long").agg(F.sum("n")).first()[0] or 0
    sample = rows.filter(unit < min(1.0, sample_pages / max(1, marked)))
    counted = map_batches(sample, _count_batch, "kind string, key string, n_in long, n_out long") \
        .groupBy("kind", "key").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).collect()
    words, tags = {}, {}
    for r in counted:
        share = (r["n_in"] + 0.5) / (r["n_in"] + r["n_out"] + 1)
        if r["kind"] == "w":
            words[r["key"]] = 2 * share - 1
        else:
            tags[r["key"]] = -0.01 - (1 - share)
    return PageWeights(words, tags)


def extract_pages(pages: DataFrame, weights: PageWeights, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page; one row per input row."""
    kept = pages.select(id_col, url_col, html_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h, weights) for h in b.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=[id_col, url_col, "text", "n_chars"])

    types = [f.dataType.simpleString() for f in kept.schema]
    return map_batches(kept, batch, f"`{id_col}` {types[0]}, `{url_col}` {types[1]}, text string, n_chars long")
