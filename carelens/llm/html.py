"""Operator 2, main text by consensus host paths.

Each page's containers are scored and its best one is a vote for that container's
path, the tags and classes from the root with numbers left out. Spark counts the
votes per host, and every page is extracted again from the containers on its
host's winning path. A page without that path uses its own best one.

A class or id that names a menu, an advert or the like only puts an element in doubt.
It stays if it holds the page's largest article or main part, or, unless it stands
beside that, most of the page's text; a list of related pages in an article goes only
if it is mostly links.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import carrying, mapped, stored, text_of

#: Hosts whose winning paths are broadcast; more are joined.
BROADCAST_HOSTS = 100_000

# fixed values: elements by what HTML makes of them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody"
    " td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside body div main section td center".split())
#: Never part of an article.
LEFT_OUT = RAW | frozenset("head nav footer aside form button select menu dialog audio video canvas".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
JUNK = frozenset(
    "ad ads adv advert advertisement advertising adbox banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus footer menu modal nav navbar navigation newsletter notice notices pagination pager popup promo"
    " promoted related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar"
    " widget".split())
HEADERS = frozenset("header masthead topbar".split())
#: Words of what readers wrote and of notices, which may be longer than an article.
STRONG = frozenset("comment comments consent cookie cookies disqus modal notice notices popup replies reply respond".split())
READERS = frozenset("comment comments disqus replies reply respond".split())
WEAK = frozenset(["related"])
#: Shares of a page's text outside links from which an element in doubt stays.
MOST, NEARLY_ALL = 0.5, 0.9
#: What an opening tag closes: the nearest of these, unless one of the others is nearer.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: A paragraph ends where a block begins, within these.
HOLDS_P = frozenset("button td th caption object table".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>",
    re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An element of a page: ``doubt`` is the nearest one in doubt and ``inside`` the
    nearest article or main part, from itself up; ``plain`` and ``linked`` count the
    characters of such elements outside and inside links."""

    __slots__ = ("tag", "path", "out", "container", "up", "inside", "doubt", "words", "plain", "linked", "spared", "gone")

    def __init__(self, tag: str, path: str, out: bool, up: Element | None, words: frozenset[str]):
        self.tag, self.path, self.out, self.up, self.words = tag, path, out, up, words
        self.container = tag in CONTAINERS
        self.inside = self if tag in ("article", "main") else up and up.inside
        self.doubt = self if words else up and up.doubt
        self.plain = self.linked = 0
        self.spared = self.gone = False


def _opened(tag: str, attributes: str, up: Element) -> Element:
    """An element below ``up``; ``out`` if it is no part of an article, in doubt if a
    class or id says so."""
    out = up.out or tag in LEFT_OUT or (tag == "header" and not up.inside)
    label, words = tag, frozenset()
    if attributes and not attributes.isspace():
        values = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        named = references.unescape(values.get("class", ""))
        if named:
            label += "".join(f".{c}" for c in sorted({re.sub(r"\d+", "", c) for c in named.split()}) if c)
        if not out and tag not in ("html", "body"):
            out = bool(
                values.get("role", "").lower() in ROLES or "hidden" in values
                or values.get("aria-hidden", "").lower() == "true" or HIDDEN.search(values.get("style", "")))
            if tag in ("article", "main"):  # only as a reader's comment
                words = READERS.intersection(named.lower().split())
            else:
                parts = {w.lower() for w in PART.findall(f"{named} {values.get('id', '')}")}
                words = frozenset(parts & (JUNK if up.inside else JUNK | HEADERS))
    return Element(tag, f"{up.path}>{label}" if up.path else label, out, up, words)


def blocks(page: str) -> list[tuple[str, int, Element]]:
    """The text of each block of a page that belongs to no menu, advert or the like,
    how many of its characters are in links, and the element it stands in, in page
    order."""
    parts: list[Element] = []
    found = list(_blocks(page, parts))
    if all(element.doubt is None for _, _, element in found):
        return found
    total, doubted = 0, {}
    for text, linked, element in found:
        plain = max(0, len(text) - linked)
        total += plain
        doubted |= {id(e): e for e in _doubts(element)}
        for e in {id(e): e for e in (*_doubts(element), *_parts(element))}.values():
            e.plain += plain
            e.linked += linked
    # the largest article or main part that no reader wrote
    own = [p for p in parts if not any(
        READERS.intersection(e.words) and (e.tag in ("article", "main") or e.plain < NEARLY_ALL * total) for e in _doubts(p))]
    main = up = max(own, key=lambda p: p.plain) if own else None
    while up is not None:
        up.spared = True
        up = up.up
    for e in doubted.values():
        share = e.plain / total if total else 0
        beside = main is not None and main not in _parts(e)
        e.gone = not (
            e.spared or (not beside and share >= (NEARLY_ALL if e.words & STRONG else MOST))
            or (e.words <= WEAK and e.inside is not None and e.plain >= e.linked))
    return [x for x in found if not any(e.gone for e in _doubts(x[2]))]


def _doubts(element: Element) -> Iterator[Element]:
    """The elements in doubt from this one up."""
    up = element.doubt
    while up is not None:
        yield up
        up = up.up and up.up.doubt


def _parts(element: Element) -> Iterator[Element]:
    """The articles and main parts from this element up."""
    up = element.inside
    while up is not None:
        yield up
        up = up.up and up.up.inside


def _blocks(page: str, parts: list[Element]) -> Iterator[tuple[str, int, Element]]:
    """The text of each block, also of those in doubt, as ``blocks`` returns them. Adds
    the articles and main parts to ``parts``, those without text too."""
    root = Element("", "", False, None, frozenset())
    here, links = root, 0
    pieces: list[str] = []
    linked = 0

    def ended() -> Iterator[tuple[str, int, Element]]:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                yield text, linked, here
        linked = 0

    at, size = 0, len(page)
    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue  # within what a raw element holds
        if m.start() > at and not here.out:
            text = references.unescape(page[at : m.start()])
            pieces.append(text)
            if links:
                linked += len(text.strip())
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in VOID:
                continue
            target = here
            while target is not None and target.tag != tag:
                target = target.up
            if tag == "a":
                links = max(0, links - 1)
            if target is None or target is root:
                continue
            if tag in BLOCKS or target.out != here.out or target.doubt is not target.up.doubt:
                yield from ended()
            # an inline end doesn't close the blocks around its start
            if tag not in BLOCKS and any(e.tag in BLOCKS for e in _up_to(here, target)):
                continue
            here = target.up
            continue
        if tag in BLOCKS:
            yield from ended()
            near = here
            while near is not root and near.tag != "p" and near.tag not in HOLDS_P:
                near = near.up
            if near.tag == "p" and not any(e.tag in CONTAINERS for e in _up_to(here, near)):
                here = near.up
            links = 0
        if tag in CLOSES:
            closed, bound = CLOSES[tag]
            near = here
            while near is not root and near.tag not in closed and near.tag not in bound:
                near = near.up
            if near.tag in closed:
                yield from ended()
                here = near.up
        if tag in VOID:
            if tag in ("br", "wbr", "hr") and not here.out and tag != "wbr":
                pieces.append(" ")
            continue
        attributes = m[3] if m[2] else m[6]
        if attributes and attributes.endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        below = _opened(tag, attributes, here)
        if (below.out and not here.out) or below.doubt is below:
            yield from ended()
        if tag == "a":
            links += 1
        if below.inside is below and not below.out:
            parts.append(below)
        here = below
    if at < size and not here.out:
        pieces.append(references.unescape(page[at:]))
    yield from ended()


def _up_to(low: Element, high: Element) -> Iterator[Element]:
    while low is not high:
        yield low
        low = low.up


def best_path(page: str) -> tuple[str, float]:
    """The path of the page's best container and its score. A block's characters
    outside links count for the container it stands in, half for the next one up,
    and so on; the element that names an article or the main part counts more."""
    scores: dict[str, float] = defaultdict(float)
    for text, linked, element in blocks(page):
        worth = max(0, len(text) - 2 * linked)
        up = element
        while up is not None and worth >= 1:
            if up.container or up.up is None:
                scores[up.path] += worth * (1.5 if up.tag in ("article", "main") else 1.0)
                worth /= 2
            up = up.up
    if not scores:
        return "", 0.0
    path = max(scores, key=lambda p: (scores[p], p))
    return path, scores[path]


def main_text(page: str, path: str | None) -> str:
    """The blocks in the containers on ``path``, one a line; those on the page's own
    best path if no container is on it."""
    found = blocks(page)

    def on(wanted: str) -> list[str]:
        out = []
        for text, _, element in found:
            up = element
            while up is not None and up.path != wanted:
                up = up.up
            if up is not None:
                out.append(text)
        return out

    lines = on(path) if path else []
    return "\n".join(lines or on(best_path(page)[0]))


def host_of(url: Column) -> Column:
    """The host in lower case; null if the address has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path) of the path that most pages of each host vote for; ties go to the
    greater sum of scores, then to the later path by code point. Votes are counted
    map-side first, so a host of very many pages sends few rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [best_path(page) for page in batch["html"]]
            out = pd.DataFrame({"host": batch["host"], "path": [t[0] for t in told], "score": [t[1] for t in told]})
            yield out[out["score"] > 0]

    votes = pages.select(host_of(F.col("url")).alias("host"), text_of("html").alias("html")).where(F.col("host").isNotNull())
    counted = votes.mapInPandas(run, "host string, path string, score double").groupBy("host", "path").agg(
        F.count("*").alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))
    return counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("best")).select("host", "best.path")


def extract(pages: DataFrame) -> DataFrame:
    """``row`` (the input row without its html) and text of every page.

    ``pages`` has url and html. Null and empty pages have an empty text. Pages
    without a host use their own best container. Repeated rows each come back (and
    each vote)."""
    winners = stored(host_paths(pages), "paths")
    few = winners.count() <= BROADCAST_HOSTS
    rows = carrying(pages, [c for c in pages.columns if c != "html"], "html", host_of(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(winners) if few else winners, "host", "left").select("row", "text", "path")

    def make():
        return lambda found, paths: [[main_text(page, path) for page, path in zip(found, paths, strict=True)]]

    return mapped(rows, make, {"text": "string"})


def extraction_digest(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and its number of code points."""
    told = extract(pages.select("page_id", "url", "html"))
    return told.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
