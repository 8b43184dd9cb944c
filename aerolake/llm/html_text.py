"""Main text of web pages from flat text blocks (operator 8).

A page is cut into flat blocks of text at block-level tags.  A block is
described by its words and link density, those of the blocks before and after
it, and by where it stands (an element that names itself navigation, advert,
comment and so on; an article or main element; a heading; a part of an article with
a name that may or may not be such).  Formulas, and what stands in for media, are
inline text.  A decision tree,
grown here on a small labelled table of blocks (``html_training``), tells main
text from the rest.  Pages are independent: one map step, no shuffle.

Defined results: null or empty html, and pages without main text, give "".
Scripts, styles, comments, hidden elements and the head are never text.  A
single <br> is white space, several in a row end a block.  Markup may be broken:
unclosed elements end with their parent, stray end tags are ignored.  Each row is
judged by its own page: equal and repeated rows give equal texts.
"""

from __future__ import annotations

import dataclasses
import functools
import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aerolake.llm.common import released

# Element names of HTML and words that sites use in class and id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q
    rp rt ruby s samp small span strike strong sub sup time tt u var wbr img
    object canvas audio video iframe svg select option optgroup datalist button textarea map noscript template
    math semantics maction merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow
    ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover annotation annotation-xml""".split())
NEVER_TEXT = frozenset("""head title noscript template svg iframe annotation annotation-xml
    select button option datalist textarea map""".split())
BOILERPLATE = frozenset("nav aside footer form menu dialog".split())
CLASS_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo
    banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login
    sidebar aside rail widget widgets nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs
    header masthead topbar toolbar footer foot copyright legal disclaimer
    share sharing social follow related recommended recommendations trending popular more-stories outbrain taboola
    comment comments commentlist disqus respond replies reply discussion
    tags byline author-box author-bio metadata search searchbox form skip sr-only print-only hidden""".split())
# words that may as well name a section of an article
AMBIGUOUS = frozenset("""alert copyright disclaimer discussion foot follow header legal menu metadata popular rail
    recommended recommendations related replies reply respond search social tabs tags trending""".split())
MAIN_WORDS = frozenset("article articlebody content main story post entry text body page".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
ANSWER_WORDS = frozenset("respond replies reply discussion related".split())

SCRIPTS = r"(?:script|style|xmp|noembed|noframes)"
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    rf"|<(?P<raw>{SCRIPTS})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
NO_MARKS = (False, False, False, False, False, False)
TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
ATTRIBUTE = re.compile(r"""(?P<k>class|id|role|hidden|style|aria-hidden|itemprop)\s*(?:=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s>]+)))?""", re.I)

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "boilerplate", "in_main", "outside_main", "heading", "named")


@dataclasses.dataclass
class Block:
    text: str
    words: int
    link_density: float
    boilerplate: bool       # inside an element that names itself so
    named: bool             # inside a part of an article whose name may say so
    in_main: bool           # inside an article or main element
    heading: bool


@dataclasses.dataclass
class _Open:
    name: str
    boilerplate: bool
    comments: bool
    main: bool
    never: bool
    heading: bool
    link: bool
    named: bool


@functools.lru_cache(maxsize=10_000)
def _marks(attrs: str) -> tuple[bool, bool, bool, bool, bool, bool]:
    """(boilerplate, comments, main, hidden, perhaps boilerplate, perhaps comments) as an
    element's attributes say."""
    boilerplate = comments = main = hidden = perhaps = answers = False
    for m in ATTRIBUTE.finditer(attrs):
        key, value = m["k"].lower(), (m["a"] or m["b"] or m["c"] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" \
                or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif key == "role":
            boilerplate |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog",
                                     "alert", "menu", "menubar", "form")
            main |= value in ("main", "article")
        elif key == "itemprop":
            main |= value == "articlebody"
        elif key in ("class", "id"):
            for name in value.split():
                parts = re.split(r"[-_:]+|(?<=\D)(?=\d)", name)
                told = {name, parts[0], parts[-1]}
                boilerplate |= bool(told & (CLASS_WORDS - AMBIGUOUS)) and not told & MAIN_WORDS
                perhaps |= bool(told & AMBIGUOUS) and not told & MAIN_WORDS
                comments |= bool(told & COMMENT_WORDS)
                answers |= bool(told & ANSWER_WORDS)
                main |= name in ("article-body", "articlebody", "article-content", "post-content", "entry-content",
                                 "post-body", "story-body", "main-content")
    return boilerplate, comments, main, hidden, perhaps, answers


def _plain(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[_Open] = []
    text: list[str] = []
    link_text: list[str] = []
    breaks = 0

    def flush() -> None:
        nonlocal breaks
        breaks = 0
        if text:
            words = _plain("".join(text)).split()
            if words:
                top = stack[-1] if stack else None
                linked = len(_plain(" ".join(link_text)).split()) if link_text else 0
                out.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)),
                                 bool(top and top.boilerplate), bool(top and top.named), bool(top and top.main),
                                 bool(top and top.heading)))
            text.clear()
            link_text.clear()

    def add(piece: str) -> None:
        nonlocal breaks
        if piece and not (stack and stack[-1].never):
            text.append(piece)
            if not piece.isspace():
                breaks = 0
                if stack and stack[-1].link:
                    link_text.append(piece)

    def close(at: int) -> None:
        if any(x.name not in INLINE for x in stack[at:]):
            flush()
        del stack[at:]

    done = 0
    for m in MARKUP.finditer(page):
        add(page[done:m.start()])
        done = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at].name == name:
                    close(at)
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name == "br":
            add(" ")
            breaks += 1
            if breaks > 1:
                flush()
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if name not in INLINE:
            flush()
            # a new block ends an open paragraph, a new item the open item
            ends = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
                    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "body": ("head",)}.get(name, ("p",))
            for at in range(len(stack) - 1, -1, -1):
                if stack[at].name in ends:
                    del stack[at:]
                    break
                if stack[at].name not in INLINE and stack[at].name not in ends:
                    break
        top = stack[-1] if stack else _Open("", False, False, False, False, False, False, False)
        # the links of a page rarely say anything but where they lead
        boilerplate, comments, main, hidden, perhaps, answers = _marks(attrs) if attrs and TELLING.search(attrs) else NO_MARKS
        # within an article such a name is weighed by the tree, elsewhere it tells
        named = perhaps and top.main
        if not top.main:
            boilerplate, comments = boilerplate or perhaps, comments or answers
        whole = name in ("html", "body", "main", "article")
        if whole:
            boilerplate, named = comments and name == "article", False
        main |= name in ("main", "article")
        own = boilerplate or name in BOILERPLATE or comments or (name == "header" and not top.main)
        inherited = top.boilerplate
        if name in ("article", "main") and not top.comments and not any(x.name in BOILERPLATE for x in stack):
            inherited = False               # a wrapper's class says nothing about the article in it
        stack.append(_Open(name, own or inherited, comments or top.comments, main or top.main,
                           top.never or hidden or name in NEVER_TEXT,
                           top.heading or name in ("h1", "h2", "h3", "h4", "h5", "h6"), top.link or name == "a", named or top.named))
    add(page[done:])
    flush()
    return out


def features(found: list[Block]) -> list[tuple]:
    """One row of ``FEATURES`` for each block."""
    has_main = any(b.in_main and not b.boilerplate for b in found)
    sides = [(0, 0.0), *((b.words, b.link_density) for b in found), (0, 0.0)]
    return [(b.words, b.link_density, *sides[i], *sides[i + 2], b.boilerplate, b.in_main,
             has_main and not b.in_main, b.heading, b.named) for i, b in enumerate(found)]


class DecisionTree:
    """A binary classification tree grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, max_depth: int = 8, min_rows: int = 1):
        self.root = self._grow(np.asarray(x, float), np.asarray(y, bool), max_depth, min_rows)

    def _grow(self, x, y, depth, min_rows):
        share = float(y.mean()) if len(y) else 0.0
        if depth == 0 or len(y) < 2 * min_rows or share in (0.0, 1.0):
            return share
        best = None
        for k in range(x.shape[1]):
            order = np.argsort(x[:, k], kind="stable")
            v, t = x[order, k], np.cumsum(y[order])
            n = np.arange(1, len(v))
            left = t[:-1] / n
            right = (t[-1] - t[:-1]) / (len(v) - n)
            gini = n * left * (1 - left) + (len(v) - n) * right * (1 - right)
            gini[(v[1:] == v[:-1]) | (n < min_rows) | (len(v) - n < min_rows)] = np.inf
            at = int(np.argmin(gini))
            if np.isfinite(gini[at]) and (best is None or gini[at] < best[0] - 1e-12):
                best = (gini[at], k, (v[at] + v[at + 1]) / 2)
        if best is None:
            return share
        _, k, cut = best
        low = x[:, k] <= cut
        return (k, float(cut), self._grow(x[low], y[low], depth - 1, min_rows),
                self._grow(x[~low], y[~low], depth - 1, min_rows))

    def predict(self, rows) -> list[bool]:
        out = []
        for row in rows:
            node = self.root
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            out.append(node >= 0.5)
        return out


def labelled_rows(pages: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of pages labelled block by block (+ main text, - not)."""
    xs, ys = [], []
    for page, labels in pages:
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks, {len(labels)} labels: {[b.text for b in found]}")
        xs += features(found)
        ys += [c == "+" for c in labels]
    return np.array(xs, dtype=float), np.array(ys)


@functools.lru_cache(maxsize=1)
def classifier() -> DecisionTree:
    from aerolake.llm.html_training import PAGES

    return DecisionTree(*labelled_rows(PAGES))


def main_text(page: str | None, tree: DecisionTree | None = None) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = (tree or classifier()).predict(features(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract_text(df: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``df`` without ``html_col`` and with ``text_col``, the main text."""
    if text_col in df.columns and text_col != html_col:
        raise ValueError(f"column {text_col} exists already")
    at = df.columns.index(html_col)
    fields = [f for f in df.schema.fields if f.name != html_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p) for p in batch.column(at).to_pylist()], pa.string())
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, texts], [*(f.name for f in fields), text_col])

    return df.mapInArrow(released(run), T.StructType([*fields, T.StructField(text_col, T.StringType())]))
