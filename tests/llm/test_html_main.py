from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

import pytest

from rarespark.llm import html_main as H

PAGE = """<!DOCTYPE html><html class="no-sidebar"><head><title>T</title><style>p{}</style></head><body class="has-menu">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- note --><script>var t="</p>";</script>
<div class="ad">Buy</div><div id="cookie-notice">Cookies</div><div class="site-header">Top</div><div class="SideBar">s</div>
<article><header><h1>Head &amp; line</h1></header><p><b>First <i>para</i>&nbsp;graph<br>line two<p>Second &lt;b&gt;</p>
<form><input name="q"><button>Go</button></form><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>
<aside>side</aside><div class="share-buttons">tweet</div><section id="comments"><article><p>me too</p></article></section>
<div hidden>gone</div><div style="display: none">gone</div>tail</article><footer>&copy; x</footer></body>"""
TEXT = "Head & line\n\nFirst para graph line two\n\nSecond <b>\n\none\n\ntwo\n\na b\n\nc\n\ntail"


def test_article_of_a_page():
    assert H.main_text(PAGE) == TEXT


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &eacute; text", "plain é text"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div>a<span> b</span>c<div>d</div>e</div>", "a bc\n\nd\n\ne"),
        ("<main><p>in</p></main><p>out", "in"),
        ("<div role=navigation>n</div><p>x", "x"),
        ("<p>x</div></p></b>y", "x\n\ny"),
        ("<p>unclosed <b", "unclosed"),
        ("<article></article><p>rest", "rest"),
        ("<script>1", ""),
        ("<br><br>", ""),
        ("<article>a</article><p>no</p><article>b</article>", "a\n\nb"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_small_pages(html, text):
    assert H.main_text(html) == text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, id int, key string, host string, text string")


def row(i, url, html):
    return (i, url, html, 0, "k", "h", "t")


def test_templates_of_a_host_go(spark):
    """A block on most pages of a host goes, wherever it stands; one on few pages stays."""
    promo = "<div class=x1><p>Weekly <b>letter</b></p></div>"
    rows = [row(i, f"http://a.example/{i}", f"<article><p>Text {i}</p>{promo}</article>") for i in range(8)]
    rows += [row(100 + i, f"http://b.example/{i}", f"<article><p>Text {i}</p>{promo if i < 4 else ''}</article>") for i in range(10)]
    rows += [row(200, "http://c.example/", f"<p>Alone</p>{promo}")]
    got = {r.page_id: r.text for r in H.main_texts(pages(spark, rows)).collect()}
    assert all(got[i] == f"Text {i}" for i in range(8))
    assert all(got[100 + i] == (f"Text {i}\n\nWeekly letter" if i < 4 else f"Text {i}") for i in range(10))
    assert got[200] == "Alone\n\nWeekly letter"


def test_edge_cases(spark):
    rows = [row(1, None, "<p>x"), row(2, "http://[bad", None), row(None, "u", "<p>y"), row(3, "u", ""), row(3, "u", ""), row(3, "u", "<p>z")]
    got = sorted((tuple(r) for r in H.main_texts(pages(spark, rows)).collect()), key=repr)
    assert got == sorted(
        [(1, None, "x", 1), (2, "http://[bad", "", 0), (None, "u", "y", 1), (3, "u", "", 0), (3, "u", "", 0), (3, "u", "z", 1)], key=repr
    )
    assert H.main_texts(pages(spark, [])).collect() == []


def test_copies_on_a_host_keep_their_text(spark):
    """Copied pages, and pages that share one article, are no template of their host."""
    copy = "<html><body><div><p>Same</p></div></body></html>"
    shared = "<html><body><p>Top {}</p><div><article><p>One</p><p>Two</p></article></div></body></html>"
    rows = [row(i, f"http://a.example/{i}", copy) for i in range(6)] + [row(10, "http://a.example/x", "<p>Other</p>")]
    rows += [row(20 + i, f"http://b.example/{i}", shared.format(i)) for i in range(6)]
    rows += [row(40 + i, None, copy) for i in range(5)]
    got = {r.page_id: r.text for r in H.main_texts(pages(spark, rows)).collect()}
    want = {i: "Same" for i in range(6)} | {10: "Other"} | {20 + i: "One\n\nTwo" for i in range(6)} | {40 + i: "Same" for i in range(5)}
    assert got == want


def test_each_layout_of_a_host_counts(spark):
    """Three layouts on a third of the pages each: their blocks go, sentences of articles stay."""
    rows = []
    for i in range(150):
        box = f"<div class=x{i % 3}><p>Block {i % 3}</p></div>"
        said = "<p>Often said</p>" if i % 3 == 0 else ""
        body = f"<p>Text {i}</p>{said}"
        rows.append(row(i, f"http://a.example/{i}", f"<article>{body}{box}</article>" if i % 2 else f"<div>{box}<section><p>Text {i}</p></section></div>"))
    rows += [row(1000 + i, f"http://b.example/{i}", f"<div><p class=z>Block {i % 3}</p><section><p>Text {i}</p></section></div>") for i in range(75)]
    got = {r.page_id: r.text for r in H.main_texts(pages(spark, rows)).collect()}
    assert all(got[1000 + i] == f"Text {i}" for i in range(75))
    assert all(f"Block {i % 3}" not in got[i] for i in range(150))
    assert all(got[i] == (f"Text {i}\n\nOften said" if i % 2 and i % 3 == 0 else f"Text {i}") for i in range(150))


@pytest.mark.parametrize(
    "html",
    [
        "<body><form id=f><article><p>Told at length</p></article></form></body>",
        '<article><div class="elementor-widget text"><p>Told at length</p></div></article>',
        '<div class="layout-sidebar-right"><article><p>Told at length</p></article></div>',
        '<div class="page-overlay"><main><p>Told at length</p></main></div>',
        '<section class="social-science"><p>Told at length</p></section>',
        '<div class="sidebar"><p>Told at length</p></div><p>x</p>',
        '<body style="display:none"><article><p>Told at length</p></article></body>',
        '<main class="content widget"><p>Told at length</p></main>',
    ],
)
def test_layouts_keep_their_article(html):
    assert "Told at length" in H.main_text(html)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<main><h1>T</h1><p>lead</p><article><p>A long story is told</p></article><p>after</p></main>", "T\n\nlead\n\nA long story is told"),
        ("<article><p>A long story is told here</p></article><article><h2>Tease</h2></article>", "A long story is told here"),
        ("<article><p>One of two</p></article><article><p>Two of two</p></article>", "One of two\n\nTwo of two"),
        ("<article><p>Text</p><div class=comments><p>A reader says more than the text has</p></div></article>", "Text"),
        ("<p>Text</p><div id=comments><p>A reader says more than the text has</p></div>", "Text"),
        ("<article><p>Text <span class=ad>Buy</span>here</p></article>", "Text here"),
        ("<ul><li><div>a</div><li>b</ul><table><tr><td><p>c<td>d<tr><td>e</table>", "a\n\nb\n\nc\n\nd\n\ne"),
    ],
)
def test_parts_of_a_page(html, text):
    assert H.main_text(html) == text


def test_unclosed_and_unmatched_tags_are_read_in_linear_time():
    for tag in ("b", "font", "div", "p", "li", "span"):
        start = time.perf_counter()
        assert H.main_text(f"<p>start</p>{f'<{tag}>' * 60_000}{'</i>' * 60_000}{'</q><li>x' * 20_000}").startswith("start")
        assert time.perf_counter() - start < 20


def layout(i, menu, rng):
    """A page of a site: menu, advert and footer differ from page to page, and no name tells them."""
    words = lambda n: " ".join(rng.choice(["ba", "de", "ki", "lo", "mu"]) + str(rng.randrange(900)) for _ in range(n))
    links = "".join(f"<li><a href=/{k}>{words(1)}</a>" for k in range(rng.randint(3, 7)))
    body = "".join(f"<p>{words(9)}</p>" for _ in range(rng.randint(1, 5)))
    story = f"<h1>{words(3)}</h1>{body}"
    return f"<html><body><div class={menu}><ul>{links}</ul></div><div class=q7><p>{words(4)}</p></div><article>{story}</article><div class=z><p>{words(5)}</p></div></body></html>", story


def test_recurring_shapes_go_without_names_or_article():
    """The same text comes out whether the article is preferred or recurrence alone decides."""
    rng = random.Random(3)
    made = [layout(i, "m1", rng) for i in range(30)]
    outlines = [H.Outline(html) for html, _ in made]
    counts = Counter(h for o in outlines for h in {s[3] for s in o.spans if s[2] <= H.SHAPE})
    template = {h for h, n in counts.items() if n >= H.TEMPLATE_PAGES and n > H.TEMPLATE_SHARE * len(made)}
    for o, (_, story) in zip(outlines, made, strict=True):
        alone = [s for s in o.spans if s[2] <= H.SHAPE]
        assert H.assemble(o.pieces, alone, template) == H.main_text(story) == H.assemble(o.pieces, o.spans)
        assert H.assemble(o.pieces, alone) != H.main_text(story)


def brute_template(rows):
    """Template hashes per host, counted plainly."""
    seen, at, contents, places = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for _, url, html, *_ in rows:
        page, where = H.Outline(html or ""), H.host(url)
        contents[where].add(page.content())
        for _, _, kind, key, position in page.spans:
            if kind <= H.SHAPE:
                seen[where, key].add(page.content())
                at[where, position, key].add(page.content())
                places[where, position].add(page.content())
    out = defaultdict(set)
    for (where, key), pages_ in seen.items():
        if len(pages_) >= H.TEMPLATE_PAGES and len(pages_) > H.TEMPLATE_SHARE * len(contents[where]):
            out[where].add(key)
    for (where, position, key), pages_ in at.items():
        share = H.TEMPLATE_SHARE if position & 1 else H.POSITION_SHARE
        if len(pages_) >= H.POSITION_PAGES and len(pages_) > share * len(places[where, position]):
            out[where].add(key)
    return out


@pytest.mark.parametrize("template_bytes", [H.TEMPLATE_BYTES, 0])
def test_counting_matches_brute_force(spark, sf, template_bytes):
    """Over the given pages and a hot host of several layouts, templates sent to all tasks or joined."""
    rng = random.Random(9)
    given = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    made = [(10_000 + i, f"http://hot.example/{i}", layout(i, f"m{i % 3}", rng)[0]) for i in range(90)]
    made += [(20_000 + i, f"http://hot.example/x{i}", made[0][2]) for i in range(40)] + [(None, None, None), (5, "http://b.example", "")]
    rows = [row(*r) for r in given + made]
    template = brute_template(rows)
    assert template["hot.example"]
    want = []
    for page_id, url, html, *_ in rows:
        page = H.Outline(html or "")
        text = H.assemble(page.pieces, page.spans, template[H.host(url)])
        want.append((page_id, url, text, len(text)))
    got = H.main_texts(pages(spark, rows).repartition(5), template_bytes=template_bytes).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
