"""Main text of web pages: flat text blocks with what surrounds them, classified by a decision tree trained on a small labelled table.

A page is cut at its block-level tags. A block has its words, the share of them in links, the same of its neighbours, and the
kind of container it stands in. The tree is grown on LABELLED once a job, from those rows alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import extended

TAG = re.compile(r"""<!--(?:.*?-->|.*+)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|$)""", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PART = re.compile(r"[a-z]+")

RAW = {"script", "style", "title", "textarea", "xmp", "noembed", "noframes", "iframe"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Containers and the words of a class, id or role that set a part of the page apart.
APART = {"nav", "footer", "aside", "form", "header", "head", "menu", "dialog", "noscript", "template", "svg", "select", "button", "object", "canvas", "datalist"}
WORDS_APART = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "menu", "nav", "navbar",
               "navigation", "breadcrumb", "breadcrumbs", "sidebar", "footer", "comment", "comments", "disqus", "reply", "replies", "respond", "cookie",
               "cookies", "consent", "gdpr", "notice", "notices", "newsletter", "subscribe", "signup", "popup", "modal", "overlay", "share", "sharing",
               "social", "related", "recommended", "widget", "login", "search", "pagination", "pager", "toolbar", "masthead", "copyright", "alert",
               "toast", "complementary", "contentinfo", "header"}
WORDS_MAIN = {"article", "content", "post", "entry", "story", "main"}
MAIN = {"article", "main"}

COLUMNS = ["zone", "has_main", "words", "links", "words_before", "links_before", "words_after", "links_after"]
#: Labelled by hand: zone (-1 set apart, 0 neither, 1 main), the page has a main part, words, share of them in links, the same of
#: the block before and after (0 words at the ends of a page), and whether the block is main text.
LABELLED = [
    (-1, 1, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-1, 1, 12, 0.0, 1, 1.0, 60, 0.0, 0), (-1, 1, 25, 0.1, 80, 0.0, 0, 0.0, 0), (-1, 1, 140, 0.0, 60, 0.0, 90, 0.0, 0),
    (-1, 0, 3, 1.0, 0, 0.0, 2, 1.0, 0), (-1, 0, 45, 0.0, 30, 0.0, 20, 0.0, 0), (-1, 0, 8, 0.0, 70, 0.0, 0, 0.0, 0), (-1, 0, 220, 0.0, 4, 1.0, 5, 0.2, 0),
    (-1, 1, 1, 0.0, 1, 0.0, 1, 0.0, 0), (-1, 1, 30, 0.0, 2, 0.0, 40, 0.0, 0), (-1, 1, 60, 0.0, 90, 0.0, 80, 0.0, 0), (-1, 0, 15, 0.0, 3, 0.0, 10, 0.0, 0),
    (-1, 0, 40, 0.0, 30, 0.0, 60, 0.0, 0), (-1, 0, 3, 0.0, 2, 1.0, 45, 0.0, 0), (-1, 0, 18, 0.1, 20, 0.0, 30, 0.0, 0), (-1, 0, 9, 0.0, 0, 0.0, 80, 0.0, 0),
    (-1, 1, 2, 0.0, 30, 0.0, 30, 0.0, 0), (-1, 1, 6, 0.5, 15, 0.0, 2, 1.0, 0),
    (1, 1, 8, 0.0, 10, 0.0, 70, 0.0, 1), (1, 1, 90, 0.0, 8, 0.0, 60, 0.0, 1), (1, 1, 1, 0.0, 90, 0.0, 60, 0.0, 1), (1, 1, 3, 0.0, 2, 0.0, 1, 0.0, 1),
    (1, 1, 40, 0.3, 50, 0.0, 45, 0.1, 1), (1, 1, 9, 1.0, 60, 0.0, 55, 0.0, 1), (1, 1, 30, 0.6, 40, 0.0, 0, 0.0, 1), (1, 1, 5, 0.0, 1, 1.0, 1, 1.0, 1),
    (1, 1, 2, 0.0, 0, 0.0, 0, 0.0, 1), (1, 1, 400, 0.02, 12, 0.0, 25, 0.2, 1), (1, 1, 15, 0.0, 4, 1.0, 50, 0.0, 1), (1, 1, 6, 0.0, 30, 0.0, 4, 1.0, 1),
    (1, 1, 1, 0.0, 1, 0.0, 1, 0.0, 1), (1, 1, 6, 0.0, 1, 0.0, 45, 0.0, 1), (1, 1, 60, 0.0, 1, 0.0, 1, 0.0, 1), (1, 1, 4, 0.0, 2, 0.0, 3, 0.0, 1),
    (1, 1, 25, 0.0, 1, 0.0, 2, 0.0, 1), (1, 1, 3, 0.0, 3, 0.0, 5, 0.0, 1), (1, 1, 8, 0.0, 5, 0.0, 1, 0.0, 1), (1, 1, 20, 0.0, 6, 0.2, 7, 0.0, 1),
    (1, 1, 150, 0.0, 3, 0.0, 8, 0.0, 1), (1, 1, 2, 0.0, 5, 0.0, 90, 0.0, 1), (1, 1, 2, 0.0, 2, 1.0, 3, 1.0, 1), (1, 1, 70, 0.0, 2, 1.0, 3, 1.0, 1),
    (1, 1, 2, 1.0, 3, 0.0, 2, 0.0, 1), (1, 1, 5, 1.0, 8, 0.0, 12, 0.0, 1), (1, 1, 3, 1.0, 14, 0.0, 0, 0.0, 1), (1, 1, 4, 1.0, 9, 0.0, 40, 0.2, 1),
    (1, 1, 2, 1.0, 2, 1.0, 3, 1.0, 0), (1, 1, 4, 1.0, 1, 1.0, 2, 1.0, 0), (1, 1, 3, 1.0, 5, 1.0, 2, 1.0, 0), (1, 1, 7, 1.0, 6, 1.0, 8, 1.0, 0),
    (1, 1, 2, 1.0, 40, 0.0, 30, 0.0, 1), (1, 1, 12, 1.0, 25, 0.1, 33, 0.0, 1),
    (0, 1, 10, 0.0, 2, 1.0, 60, 0.0, 0), (0, 1, 30, 0.1, 50, 0.0, 3, 1.0, 0), (0, 1, 70, 0.0, 8, 0.0, 9, 0.0, 0), (0, 1, 2, 1.0, 0, 0.0, 1, 1.0, 0),
    (0, 1, 5, 0.0, 60, 0.0, 0, 0.0, 0), (0, 1, 4, 0.0, 0, 0.0, 6, 0.0, 0),
    (0, 0, 60, 0.0, 8, 0.0, 70, 0.0, 1), (0, 0, 35, 0.1, 40, 0.0, 25, 0.0, 1), (0, 0, 120, 0.2, 2, 1.0, 3, 1.0, 1), (0, 0, 22, 0.0, 5, 0.0, 4, 0.5, 1),
    (0, 0, 18, 0.0, 1, 1.0, 50, 0.0, 1), (0, 0, 7, 0.0, 3, 1.0, 45, 0.0, 1), (0, 0, 4, 0.0, 50, 0.0, 60, 0.0, 1), (0, 0, 1, 0.0, 45, 0.0, 40, 0.0, 1),
    (0, 0, 12, 0.0, 40, 0.0, 50, 0.0, 1), (0, 0, 26, 0.3, 30, 0.0, 28, 0.0, 1), (0, 0, 14, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 6, 0.0, 40, 0.0, 35, 0.1, 1),
    (0, 0, 2, 1.0, 1, 1.0, 2, 1.0, 0), (0, 0, 3, 0.0, 2, 1.0, 1, 1.0, 0), (0, 0, 5, 0.0, 2, 1.0, 4, 0.0, 0), (0, 0, 9, 0.9, 3, 1.0, 40, 0.0, 0),
    (0, 0, 20, 0.8, 2, 1.0, 25, 0.9, 0), (0, 0, 4, 0.5, 50, 0.0, 2, 1.0, 0), (0, 0, 3, 0.0, 1, 1.0, 0, 0.0, 0), (0, 0, 30, 0.7, 40, 0.0, 30, 0.8, 0),
    (0, 0, 1, 1.0, 60, 0.0, 1, 1.0, 0), (0, 0, 15, 0.6, 10, 0.7, 3, 0.0, 0),
]


@dataclass
class Node:
    label: int
    column: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray) -> Node:
    """A classification tree by Gini impurity, down to pure leaves; of equal splits the first column, then the lowest cut."""
    node = Node(int(2 * y.sum() >= len(y)))
    best = len(y) * _gini(y) - 1e-9
    for c in range(x.shape[1]):
        values = np.unique(x[:, c])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, c] <= cut
            cost = low.sum() * _gini(y[low]) + (~low).sum() * _gini(y[~low])
            if cost < best - 1e-9:
                best, node.column, node.cut = cost, c, float(cut)
    if node.column >= 0:
        low = x[:, node.column] <= node.cut
        node.low, node.high = grow(x[low], y[low]), grow(x[~low], y[~low])
    return node


def _gini(y: np.ndarray) -> float:
    p = y.mean()
    return 2 * p * (1 - p)


def decide(node: Node, row: tuple) -> int:
    while node.column >= 0:
        node = node.low if row[node.column] <= node.cut else node.high
    return node.label


def trained() -> Node:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def kind(tag: str, attributes: str, in_main: bool) -> int:
    """-1: the element is set apart, 1: it is main, 0: neither."""
    if tag in APART and not (tag == "header" and in_main):
        return -1
    if tag in MAIN:
        return 1
    if attributes and tag not in ("html", "body"):
        if HIDDEN.search(attributes):
            return -1
        words = {w for m in NAMES.finditer(attributes) for w in PART.findall((m[2] or m[3] or m[4] or "").lower())}
        if words & WORDS_APART and not (in_main and "header" in words and not words & (WORDS_APART - {"header"})):
            return -1
        if words & WORDS_MAIN:
            return 1
    return 0


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, zone) of each block with a word or other sign, in page order."""
    found: list[tuple[str, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int]] = []       # open containers with the zone in them
    link, at, zone = False, 0, 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            found.append((text, len(text.split()), len("".join(linked).split()), zone))
        parts.clear()
        linked.clear()

    def say(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if link:
                linked.append(text)

    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                link = not closing
            elif tag == "br":
                parts.append(" ")
                if link:
                    linked.append(" ")
            if not attributes or closing or tag in VOID or kind(tag, attributes, zone == 1) != -1:
                if not (closing and any(t == tag and z == -1 for t, z in stack[-1:])):
                    continue
        flush()
        link = False
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            zone = stack[-1][1] if stack else 0
        else:
            if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
                stack.pop()                 # closed by the next of its kind
                zone = stack[-1][1] if stack else 0
            if tag == "body":
                stack, zone = [], 0
            own = kind(tag, attributes, zone == 1)
            if tag in MAIN and zone == -1 and all(t in ("nav", "header", "footer", "head") or z != -1 for t, z in stack):
                stack, zone = [], 0         # a menu that was never closed does not hold the article
            zone = -1 if zone == -1 or own == -1 else max(zone, own)
            stack.append((tag, zone))
    flush()
    return found


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    has = int(any(z == 1 for *_, z in found))
    share = [(w, n / w if w else 0.0) for _, w, n, _ in found]
    around = [(0, 0.0), *share, (0, 0.0)]
    return "\n".join(t for k, (t, w, n, z) in enumerate(found) if decide(tree, (z, has, *share[k], *around[k], *around[k + 2])))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of (page_id, url, html), from the whole page; html null or without main text: empty text.

    A block is main text if the tree says so. Character references are decoded, white space in a block becomes one space, and
    blocks are joined by line ends. Broken markup is read as far as it goes: unclosed elements end with the page.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in batches:
            texts = [main_text(x.as_py() or "", tree) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    rows = pages.select("page_id", "url", F.col("html"))
    schema = extended(rows.select("page_id", "url").schema, "text string, n_chars long")
    return rows.mapInArrow(run, schema)
