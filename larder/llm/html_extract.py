"""The main text of web pages by tag-path ratios.

A page is cut into blocks: runs of text with no block element beginning or ending
inside. The path of a block is the sequence of block elements, with their classes,
from the root to it. For each path the page's text length and punctuation are summed
over its blocks and divided by their number. These two ratios are smoothed over
paths, nearer ones more (paths under one container support each other, an article
element most of all), fused by multiplication, and paths below a share of the page's
best score are left out. Link text does not count, and paths through elements or
classes that mark menus, headers, footers, sidebars, notices, adverts, forms or
reader comments score nothing.

Defined results: null or empty html gives an empty text; broken markup is read as far
as it goes (unclosed elements end where HTML says that they do); rows that repeat
and null ids keep their rows; other columns are not touched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of elements and of classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math nobr q ruby rp rt s "
    "samp small span strike strong sub sup time tt u var wbr input".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
CONTAINERS = frozenset("article main".split())
LEFT_OUT = frozenset(
    "nav footer aside form button select dialog menu svg object applet canvas audio video map head "
    "fieldset datalist".split())
# Elements that may begin in a head; any other, and any text, ends an open head.
IN_HEAD = frozenset("base link meta title style script noscript noframes template head".split())
# An element that begins ends open elements of the second kind, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "thead": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
    "sidenav menu menubar nav navbar navigation breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended recommendations trending comment comments commentlist reply replies respond disqus "
    "copyright legal disclaimer toolbar widget widgets pagination pager skip hidden".split())
TOP_MARKS = frozenset("header topbar hero".split())
NEGATIONS = frozenset("no has with without not".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^a-zA-Z]+")

SAME_CONTAINER, PER_LEVEL = 0.8, 0.3
SHARE = 0.2


@dataclass(frozen=True)
class Label:
    """One element of a path: its name with classes, and what it marks."""

    name: str
    tag: str
    left_out: bool
    top: bool


@lru_cache(maxsize=20_000)
def label_of(tag: str, attributes: str) -> Label:
    found = {}
    for key, value in ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
        found.setdefault(key.lower(), value.strip("\"'"))
    words = [w.lower() for k in ("class", "id", "role") for w in CAMEL.split(found.get(k, "")) if w]
    marked = False
    top = tag == "header"
    if tag not in CONTAINERS and tag not in ("html", "body") and not NEGATIONS.intersection(words):
        marked = bool(MARKS.intersection(words))
        top = top or bool(TOP_MARKS.intersection(words))
    unseen = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    classes = ".".join(sorted(set(w for w in words if len(w) > 1)))
    return Label(f"{tag}.{classes}" if classes else tag, tag, marked or unseen or tag in LEFT_OUT, top)


@dataclass
class Block:
    path: tuple[str, ...]
    kept: bool
    inside: int
    text: str
    linked: int


@dataclass(frozen=True)
class Open:
    """An open element: its tag, its path, whether the path may hold content, and the depth of its container."""

    tag: str
    path: tuple[str, ...]
    kept: bool
    inside: int


ROOT = Open("", (), True, 0)


def _opened(parent: Open, label: Label) -> Open:
    inside = parent.inside or (len(parent.path) + 1 if label.tag in CONTAINERS else 0)
    kept = parent.kept and not label.left_out and not (label.top and not parent.inside)
    return Open(label.tag, (*parent.path, label.name), kept, inside)


def blocks(html: str) -> list[Block]:
    """The blocks of a page in page order, with their paths."""
    stack: list[Open] = [ROOT]
    inline_links = 0
    pieces: list[str] = []
    linked = 0
    found: list[Block] = []

    def close_block() -> None:
        nonlocal linked, inline_links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                top = stack[-1]
                found.append(Block(top.path, top.kept, top.inside, text, linked))
            pieces.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal inline_links
        close_block()
        del stack[depth:]
        inline_links = 0

    def end_open(tags: set[str], bounds: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                pop_to(i)
                return
            if stack[i].tag in bounds:
                return

    def end_head() -> None:
        while stack[-1].tag == "head":
            pop_to(len(stack) - 1)

    at = 0
    size = len(html)
    while at < size:
        m = TOKEN.search(html, at)
        stop = m.start() if m else size
        if stop > at:
            text = unescape(html[at:stop])
            if stack[-1].tag == "head" and text.strip():
                end_head()
            pieces.append(text)
            if inline_links:
                linked += len(text.strip())
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            if html.startswith("<![CDATA[", m.start()):
                pieces.append(html[m.start() + 9:at - 3])
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE:
                if tag == "a":
                    inline_links = max(0, inline_links - 1)
                if tag == "br":
                    pieces.append(" ")
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
            else:
                if tag == "p":
                    close_block()
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(html, at)
            at = size if end is None else end.start()
            if end is not None:
                gone = html.find(">", end.start())
                at = size if gone < 0 else gone + 1
            continue
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                inline_links += 1
            continue
        if tag in ENDS:
            end_open(*ENDS[tag])
        end_open({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body"})
        close_block()
        inline_links = 0
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(_opened(stack[-1], label_of(tag, m[3])))
    close_block()
    return found


@dataclass
class Sums:
    """What a path's blocks add up to."""

    inside: int
    blocks: int = 0
    own: int = 0
    chars: int = 0
    punctuation: float = 0.0


def _smoothed(ratios: dict[tuple[str, ...], float], inside: dict[tuple[str, ...], int]) -> dict[tuple[str, ...], float]:
    """For each path the best ratio that it or a path near it has.

    Another path counts for less with every level that the two part above its
    container, but not within an article. Paths only meet in their common prefixes, so
    the work grows with the number of paths.
    """
    near: dict[tuple[str, ...], float] = {}
    any_: dict[tuple[str, ...], float] = {}
    for path, ratio in ratios.items():
        for same in range(len(path) + 1):
            prefix = path[:same]
            value = ratio * SAME_CONTAINER * PER_LEVEL ** max(0, len(path) - 1 - same)
            near[prefix] = max(near.get(prefix, 0.0), value)
            any_[prefix] = max(any_.get(prefix, 0.0), ratio * SAME_CONTAINER)
    found = {}
    for path, ratio in ratios.items():
        best = max(ratio, *(near[path[:same]] for same in range(len(path) + 1)))
        if inside[path]:
            best = max(best, any_[path[:inside[path]]])
        found[path] = best
    return found


def main_text(html: str | None) -> str:
    """The content blocks of one page, joined by empty lines."""
    found = blocks(html or "")
    sums: dict[tuple[str, ...], Sums] = {}
    for block in found:
        if block.kept:
            s = sums.setdefault(block.path, Sums(block.inside))
            own = max(0, len(block.text) - block.linked)
            s.blocks += 1
            s.own += own
            s.chars += len(block.text)
            s.punctuation += len(PUNCTUATION.findall(block.text)) * own / len(block.text)
    if not sums:
        return ""
    inside = {p: s.inside for p, s in sums.items()}
    lengths = _smoothed({p: s.own / s.blocks for p, s in sums.items()}, inside)
    stops = _smoothed({p: s.punctuation / s.blocks for p, s in sums.items()}, inside)
    scores = {
        p: lengths[p] * log(2 + stops[p]) * (1.0 if s.inside else s.own / s.chars) for p, s in sums.items()
    }
    bound = SHARE * max(scores.values())
    return "\n\n".join(b.text for b in found if b.kept and scores[b.path] >= bound)


def extracted(html: Column) -> Column:
    """The main text of a column of html."""
    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in pages], dtype=object)

    return of(html)


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """Every page's id, url, main text and its length."""
    return pages.select(
        F.col(id_column), F.col(url_column), extracted(F.col(html_column)).alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))
