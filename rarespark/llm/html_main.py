"""Main text of web pages, after site templates are removed.

A page is read once. Every element subtree is hashed twice: with its text, and by its shape
alone (tags, classes, roles, whether there is text or a link), in which runs of equal children
count as one. Spark counts, per host, the pages that hold a hash; a subtree that recurs on many
pages of its host is template and is deleted. Menus, adverts and footers whose words differ from
page to page recur by their shape; shapes count outside the article only, on pages that mark
one, since an article's paragraphs are alike in shape as well.

What recurrence can't tell, as on hosts of few pages, is deleted by element, role or class name.
A class name counts as a whole. No element goes by its name that holds the article or main part,
or, outside an article, most of the page's text. If the page marks its article, the text is
taken from there, with what stands before it in the main part; of several articles the one that
holds two thirds of their text, or else all.

The outline of a page (its pieces of text and the spans of its elements) is written once, and
the text is put together from it. Hashes are counted and joined by host and hash, so a host that
holds a third of all pages is spread like any other. A small table of templates goes to all
tasks; if it is large, outlines that hold a template are moved to their template lists.

Nulls: a null page is empty and has an empty text; a null URL has a host of its own, the
empty one. Rows that repeat an id and a page get equal texts. Unclosed and unmatched tags cost
no more than others. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rarespark.functions.small import fetch_if_small
from rarespark.llm import words as W
from rarespark.session import cut_lineage

#: A subtree on at least so many pages of a host, and on over this share of them, is template.
TEMPLATE_PAGES = 4
TEMPLATE_SHARE = 0.5
#: So is one on at least so many pages and on over a share of those that have an element at
#: its position (tags and classes from the root), so that each layout of a host counts by
#: itself. Inside the article the share is TEMPLATE_SHARE, so that its sentences stay.
POSITION_PAGES = 20
POSITION_SHARE = 0.2
#: Bytes of templates that are sent to all tasks.
TEMPLATE_BYTES = 8 << 20

# Element, role and name lists of HTML and of common page layouts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th img option".split())
NO_TEXT = frozenset("head title script style noscript template iframe object svg math canvas audio video map button select textarea datalist input".split())
NOT_MAIN = frozenset("nav footer aside dialog menu form label fieldset search".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tooltip".split())
NOT_MAIN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer masthead cookie cookies consent gdpr comment comments disqus respond replies reply newsletter "
    "subscribe subscription signup share sharing social related popup modal overlay toolbar pagination pager notice notices alert "
    "alerts banner widget widgets skip".split()
)
NAME_PREFIXES = frozenset("site page main global top bottom left right primary secondary post article entry cookie reader user".split())
NAME_SUFFIXES = frozenset("area bar box block buttons container form inner links link list notice popup section wrapper wrap unit slot".split())
COMMENT_NAMES = frozenset("comment comments reply replies disqus ad ads advert advertisement sponsored promo".split())
CLOSED_BY = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "tbody": ("tr", "td", "th", "thead", "tbody"),
    "body": ("head",),
}
SCOPES = frozenset("html body table ul ol dl div section article main aside nav header footer form blockquote td th".split())
WHOLE = frozenset("html body main article".split())
BREAK = None
#: Kinds of spans in an outline.
EXACT, SHAPE, DROPPED, ARTICLE, MAIN = range(5)


def named_like(name: str, names: frozenset[str]) -> bool:
    """Whether a class name is one of ``names``, or one with a usual prefix or suffix."""
    if name in names:
        return True
    first, _, rest = name.replace("_", "-").partition("-")
    return (first in NAME_PREFIXES and rest in names) or (first in names and rest in NAME_SUFFIXES)


def _names(attrs: dict) -> list[str]:
    return f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()


def boilerplate(tag: str, attrs: dict, in_article: bool) -> str:
    """Why an element is no part of the article, judged by itself: "hidden", "comments" or
    "other"; empty if it may be."""
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I):
        return "hidden"
    names = _names(attrs)
    if any(named_like(n, COMMENT_NAMES) for n in names) and tag not in ("html", "body"):
        return "comments"
    if tag in ("html", "body", "article", "main"):
        return ""
    if tag in NOT_MAIN or (attrs.get("role") or "").lower() in NOT_MAIN_ROLES or any(named_like(n, NOT_MAIN_NAMES) for n in names):
        return "other"
    header = tag == "header" or any(named_like(n, frozenset(["header"])) for n in names)
    return "other" if header and not in_article else ""


class _Element:
    __slots__ = ("tag", "start", "parts", "shapes", "look", "hidden", "why", "article", "main", "chars", "holds", "position")

    def __init__(self, tag, start, hidden, why, article, main, position=0, look=""):
        self.tag, self.start, self.hidden, self.why, self.article, self.main = tag, start, hidden, why, article, main
        self.position, self.look = position, look
        self.parts: list[bytes] = []
        self.shapes: list[bytes] = []
        self.chars = 0
        self.holds = False


class Outline(HTMLParser):
    """Reads a page once: ``pieces`` of text, with BREAK between blocks, and ``spans`` of
    elements as ``(start, end, kind, hash, position)`` over the pieces."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str | None] = []
        self.spans: list[tuple[int, int, int, int, int]] = []
        self.named: list[tuple[int, int, int, bool]] = []
        self.stack = [_Element("", 0, False, "", False, False)]
        self.open: dict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []
        self.roots: list[tuple[int, bytes]] = []
        self.feed(_complete(html))
        self.close()
        self._close_to(1)
        self._finish()

    def handle_starttag(self, tag, attrs):
        attrs = {k: v for k, v in reversed(attrs)}
        self._close_implied(tag)
        if tag in BLOCK:
            self.pieces.append(BREAK)
        elif tag in SPACED and not self.stack[-1].hidden:
            self.pieces.append(" ")
        top = self.stack[-1]
        if tag in VOID:
            top.parts.append(tag.encode())
            return
        role = (attrs.get("role") or "").lower()
        article = tag == "article" or role == "article" or "articlebody" in (attrs.get("itemprop") or "").lower()
        main = tag == "main" or role == "main"
        why = boilerplate(tag, attrs, top.article or top.main)
        classes = " ".join(sorted((attrs.get("class") or "").lower().split()))
        look = f"{tag} {classes} {role}"
        # The lowest bit of a position tells whether it is inside the article.
        position = xxhash.xxh64_intdigest(f"{top.position} {tag} {classes}".encode("utf-8", "replace")) & ~1 | (top.article or top.main)
        if tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.open[tag].append(len(self.stack))
        hidden = top.hidden or tag in NO_TEXT
        self.stack.append(_Element(tag, len(self.pieces), hidden, why, top.article or article, top.main or main, position, look))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _close_implied(self, tag):
        """Close what a start tag ends: down to the nearest scope, nothing below it."""
        closed = CLOSED_BY.get(tag, ())
        if tag in BLOCK:
            closed = (*closed, "p", "head")
        while closed:
            at = max((self.open[name][-1] for name in closed if self.open[name]), default=0)
            if not at or at < (self.scopes[-1] if self.scopes else 0):
                return
            self._close_to(at)

    def handle_endtag(self, tag):
        if tag not in VOID and self.open[tag]:
            self._close_to(self.open[tag][-1])

    def _close_to(self, at):
        while len(self.stack) > at:
            self._pop()

    def _pop(self):
        element, parent = self.stack.pop(), self.stack[-1]
        self.open[element.tag].pop()
        if element.tag in SCOPES:
            self.scopes.pop()
        digest = xxhash.xxh64(b"\x00".join([element.tag.encode(), *element.parts])).digest()
        shape = xxhash.xxh64(b"\x00".join([element.look.encode("utf-8", "replace"), *element.shapes])).digest()
        parent.parts.append(digest)
        if not parent.shapes or parent.shapes[-1] != shape:  # equal children in a row count as one
            parent.shapes.append(shape)
        block = element.tag in BLOCK
        own_article, own_main = element.article and not parent.article, element.main and not parent.main
        whole = element.tag in WHOLE or element.holds or own_article or own_main
        start, end = element.start, len(self.pieces)
        inside = element.article or element.main
        if not element.hidden and element.chars:
            parent.chars += element.chars
            parent.holds |= element.holds or own_article or own_main
            if element.why and not (whole and element.why != "comments"):
                spare = element.why == "other" and not (parent.article or parent.main)
                self.named.append((start, end, element.chars, spare))
            elif block and not whole:
                self.spans.append((start, end, EXACT, int.from_bytes(digest, "little"), element.position))
            if block and not whole and not inside:
                self.spans.append((start, end, SHAPE, int.from_bytes(shape, "little"), element.position))
            if own_article or own_main:
                self.spans.append((start, end, ARTICLE if own_article else MAIN, 0, 0))
                self.roots.append((ARTICLE if own_article else MAIN, digest))
        if block:
            self.pieces.append(BREAK)

    def handle_data(self, data):
        text = " ".join(data.split())
        top = self.stack[-1]
        if text:
            top.parts.append(text.encode("utf-8", "replace"))
            if not top.shapes or top.shapes[-1] != b"text":
                top.shapes.append(b"text")
        if not top.hidden:
            top.chars += len(text)
            self.pieces.append(data)

    def _finish(self):
        """Settle what depends on the whole page."""
        total = self.stack[0].chars
        self.spans += [(a, b, DROPPED, 0, 0) for a, b, chars, spare in self.named if not (spare and 2 * chars > total)]
        if not any(kind in (ARTICLE, MAIN) for _, _, kind, _, _ in self.spans):
            self.spans = [x for x in self.spans if x[2] != SHAPE]

    def content(self) -> int:
        """Digest of the article, or of the whole page that marks none; pages of one content
        count once."""
        kind = min((k for k, _ in self.roots), default=None)
        parts = [d for k, d in self.roots if k == kind] or self.stack[0].parts
        return xxhash.xxh64_intdigest(b"\x00".join(parts))


def _complete(html: str) -> str:
    """Without a last tag that never ends."""
    last = html.rfind("<")
    if last > html.rfind(">") and re.match(r"[a-zA-Z/!?]", html[last + 1 : last + 2]):
        return html[:last]
    return html


def _covered(n: int, spans: list[tuple[int, int]]) -> list[int]:
    """How many of the spans cover each of ``n`` places."""
    edge = [0] * (n + 1)
    for a, b in spans:
        edge[a] += 1
        edge[b] -= 1
    return list(accumulate(edge[:-1]))


def _blocks(pieces: list[str | None], kept: list[bool]) -> str:
    blocks, own = [], []
    for piece, keep in zip([*pieces, BREAK], [*kept, True], strict=True):
        if piece is BREAK:
            text = " ".join("".join(own).split())
            if text:
                blocks.append(text)
            own = []
        elif keep:
            own.append(piece)
    return "\n\n".join(blocks)


def assemble(pieces: list[str | None], spans, template: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of an outline without dropped spans and those whose hash is in ``template``."""
    n = len(pieces)
    gone = _covered(n, [(a, b) for a, b, kind, key, _ in spans if kind == DROPPED or (kind <= SHAPE and key in template)])
    chars = [0, *accumulate(0 if p is BREAK or g else len(p) - p.count(" ") for p, g in zip(pieces, gone, strict=True))]
    size = lambda span: chars[span[1]] - chars[span[0]]
    articles, mains = ([(a, b) for a, b, k, _, _ in spans if k == kind] for kind in (ARTICLE, MAIN))
    articles, mains = ([x for x in found if size(x)] for found in (articles, mains))
    regions = articles or mains or [(0, n)]
    skipped: list[tuple[int, int]] = []
    if articles:
        story = max(articles, key=size)
        if 3 * size(story) >= 2 * sum(map(size, articles)):
            skipped = [x for x in articles if x != story]
            around = [a for a, b in mains if a <= story[0] and story[1] <= b]
            regions = [(min(around, default=story[0]), story[1])]
    wanted, left_out = _covered(n, regions), _covered(n, skipped)
    return _blocks(pieces, [bool(w) and not g and not s for w, g, s in zip(wanted, gone, left_out, strict=True)])


def main_text(html: str, template: frozenset[int] = frozenset()) -> str:
    page = Outline(html)
    return assemble(page.pieces, page.spans, template)


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


OUTLINE = "page_id bigint, url string, host string, content bigint, pieces array<string>, spans array<struct<start:int,end:int,kind:int,hash:bigint,position:bigint>>"
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("hash", pa.int64()), ("position", pa.int64())])


def _outline_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, contents, pieces, spans, sizes = [], [], [], [], []
        for url, html in zip(batch.column(1), batch.column(2), strict=True):
            page = Outline(html.as_py() or "")
            hosts.append(host(url.as_py()))
            contents.append(page.content())
            pieces.append([p if p is BREAK else p.encode("utf-8", "replace").decode() for p in page.pieces])
            spans += page.spans
            sizes.append(len(page.spans))
        columns = list(zip(*spans, strict=True)) or [()] * 5
        numbers = [pa.array(np.array(c, np.int32)) for c in columns[:3]] + [W.signed(np.array(c, np.uint64)) for c in columns[3:]]
        flat = pa.StructArray.from_arrays(numbers, fields=list(SPAN))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(hosts, pa.string()), W.signed(np.array(contents, np.uint64)),
                pa.array(pieces, pa.list_(pa.string())), pa.ListArray.from_arrays(offsets, flat),
            ],
            ["page_id", "url", "host", "content", "pieces", "spans"],
        )


def outlines(pages: DataFrame) -> DataFrame:
    """Pages of ``(page_id, url, html)``, read once: hosts, contents, pieces and spans."""
    W.bounded_batches(pages.sparkSession)
    named = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return cut_lineage(named.mapInArrow(_outline_rows, OUTLINE), "outlines", codec="zstd")


def subtrees_of(pages: DataFrame) -> DataFrame:
    """``(host, content, hash, position)`` of the subtrees that may be template; a page without
    any counts as a page."""
    own = F.filter("spans", lambda s: s["kind"] <= SHAPE)
    none = F.array(F.struct(F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("bigint").alias("position")))
    pairs = F.array_distinct(F.transform(own, lambda s: F.struct(s["hash"].alias("hash"), s["position"].alias("position"))))
    found = pages.select("host", "content", F.explode(F.when(F.size(pairs) > 0, pairs).otherwise(none)).alias("s"))
    return found.select("host", "content", "s.hash", "s.position")


def template_subtrees(subtrees: DataFrame, pages: int = TEMPLATE_PAGES, share: float = TEMPLATE_SHARE) -> DataFrame:
    """``(host, hash)`` of the subtrees that recur on many pages of their host. Pages of one
    content, as copies are, count as one page."""
    sizes = subtrees.groupBy("host").agg(F.count_distinct("content").alias("n_pages"))
    subtrees = subtrees.where("hash is not null")
    counts = subtrees.groupBy("host", "hash").agg(F.count_distinct("content").alias("n")).where(F.col("n") >= pages)
    wide = counts.join(cut_lineage(sizes, "hosts"), "host").where(F.col("n") > F.col("n_pages") * share).select("host", "hash")
    many = F.col("n") >= POSITION_PAGES
    places = subtrees.groupBy("host", "position").agg(F.count_distinct("content").alias("n")).where(many)
    blocks = subtrees.groupBy("host", "position", "hash").agg(F.count_distinct("content").alias("n")).where(many)
    inside = F.col("position").bitwiseAND(F.lit(1)) == 1
    part = F.when(inside, F.lit(share)).otherwise(F.lit(min(share, POSITION_SHARE)))
    sections = blocks.join(places.withColumnRenamed("n", "n_pages"), ["host", "position"]).where(F.col("n") > F.col("n_pages") * part)
    return wide.unionByName(sections.select("host", "hash")).distinct()


TEXTS = "page_id bigint, url string, text string, n_chars bigint"


def _text_rows(known: dict[str, set[int]] | None):
    """Texts of outlines. ``known`` has the template hashes by host; without it the last column
    has those of the page."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for k in range(batch.num_rows):
                spans = batch.column(4)[k].values
                table = zip(*[spans.field(f).to_pylist() for f in SPAN.names], strict=True) if len(spans) else ()
                if known is None:
                    template = set(batch.column(5)[k].as_py() or ())
                else:
                    template = known.get(batch.column(2)[k].as_py(), frozenset())
                texts.append(assemble(batch.column(3)[k].as_py(), list(table), template))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    return rows


def main_texts(
    pages: DataFrame, template_pages: int = TEMPLATE_PAGES, share: float = TEMPLATE_SHARE, template_bytes: int = TEMPLATE_BYTES
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page of ``pages (page_id, url, html)``."""
    read = outlines(pages)
    template = cut_lineage(template_subtrees(subtrees_of(read), template_pages, share), "template")
    columns = ["page_id", "url", "host", "pieces", "spans"]
    table, small = fetch_if_small(template, template_bytes)
    if small:
        known: dict[str, set[int]] = defaultdict(set)
        for r in table.collect():
            known[r["host"]].add(r["hash"])
        held = pages.sparkSession.sparkContext.broadcast(dict(known))
        return read.select(*columns).mapInArrow(lambda batches: _text_rows(held.value)(batches), TEXTS)
    key = F.xxhash64("page_id", "url", "content", "pieces")
    keyed = read.withColumn("key", key)
    hashes = keyed.select("key", "host", F.explode(F.filter("spans", lambda s: s["kind"] <= SHAPE)).alias("s")).select("key", "host", "s.hash")
    found = hashes.join(template, ["host", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("template"))
    return keyed.join(found, "key", "left").select(*columns, "template").mapInArrow(_text_rows(None), TEXTS)
