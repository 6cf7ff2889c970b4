import html as references
import re

import pytest
from llm_fixtures import SMALL

from carelens.llm import html
from carelens.llm.common import table
from carelens.llm.html import best_path, extract, extraction_digest, main_text

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header class="site-header"><h1>Site</h1><p>Slogan of the site</p></header><div id=cookie-notice>We use cookies.</div>
<nav><ul><li><a href=/>Home</a></ul></nav><div class="page wide"><div class="content post12">
<h1>Title &amp; more</h1><p>First  para\n with <a href='x>y'>a link</a> and &eacute;&nbsp;x.<p>Second &lt;b&gt; one<br>two
<ul><li>a<li>b</ul><div class="share">Share!</div><form>Name <input></form><aside>side</aside>
<table><tr><td>c1<td>c2</table><div class="ad-box">Buy</div><section class="comments"><p>Nice post, thanks</p></section></div>
<div class="sidebar"><p>Read this other long story about nothing at all</p></div></div>
<footer>&copy; foot</footer><script>if (a<b) "</p>"</script><p hidden>hid</p></body></html>"""
TEXT = "Title & more\nFirst para with a link and é x.\nSecond <b> one two\na\nb\nc1\nc2"


def test_article_of_a_page():
    path, _ = best_path(PAGE)
    assert path == "html>body.home>div.page.wide>div.content.post"
    assert main_text(PAGE, None) == main_text(PAGE, path) == TEXT


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain text", "plain text"), ("<", "<"), ("a <b", "a <b"), ("<p>x</b></p><b>y", "x\ny"), ("<div><p>x", "x"),
    ("&amp &copy2 &#x41; &bogus;", "& ©2 A &bogus;"), ("<p>a<!-- <p>b --> c</p>", "a c"), ("<p>a<script>'<p>'</script>b", "ab"),
    ("<nav><p>x</nav>", ""), ("<p>one<i> two</i>three</p>", "one twothree"), ("<p>" + "w " * 100_000, ("w " * 100_000).strip()),
    ("<article><header><h1>T</h1></header><p>x</article><header>site</header>", "T\nx"), ("<div style='display: none'>x</div><p>y", "y"),
    ("<p>" + "<div>" * 3000 + "deep", "deep"),
])
def test_odd_pages(page, text):
    assert main_text(page, None) == text


STORY = "<h1>Title</h1><p>" + "A story of many plain words. " * 8 + "</p>"
READ = "Title\n" + ("A story of many plain words. " * 8).strip()
SIDE = "<div class='sidebar'><p>Other stories to read</p></div><div id='comments'><p>" + "Nice. I liked this a lot. " * 6 + "</p></div>"


@pytest.mark.parametrize("page", [
    f"<div class='layout with-sidebar'><article>{STORY}</article>{SIDE}</div>",
    f"<div class='layout with-sidebar'><div class='content'>{STORY}</div>{SIDE}</div>",
    f"<article class='post ad-free'>{STORY}</article>{SIDE}",
    f"<main class='comments-open'>{STORY}{SIDE}</main>",
    f"<div class='wrap comments-open has-header'><section>{STORY}</section></div><div class='share'>Share this</div>",
    f"<div id='no-ads'><table><tr><td>{STORY}</td></tr></table></div><div class='footer'>Foot</div>",
    f"<div class='post'>{STORY}</div><div class='comments'><article class='comment'>{'Very good. ' * 40}</article></div>",
    f"<div class='post'>{STORY}<span class='ad'>Buy</span></div><div class='sidebar'><article>Teaser text</article></div>",
])
def test_wrappers_and_layouts(page):
    """A class of an element around or on the article doesn't lose it; what the same
    words name beside it goes."""
    assert main_text(f"<html><body>{page}</body></html>", None) == READ


@pytest.mark.parametrize(("article", "text"), [("", ""), ("<p>Short.</p>", "Short.")])
def test_long_sidebar_beside_a_short_article(article, text):
    assert main_text(f"<body><article>{article}</article><div class='sidebar'><p>{'Other story. ' * 30}</p></div></body>", None) == text


def test_related_work_is_a_section_and_related_pages_are_links():
    work = "<div class='related-work'><h2>Related work</h2><p>Others did it <a href=x>before</a> us.</p></div>"
    pages = "<div class='related'><ul><li><a href=x>One page</a><li><a href=y>Another page</a></ul></div>"
    assert main_text(f"<article>{STORY}{work}{pages}</article>", None) == READ + "\nRelated work\nOthers did it before us."


def test_hosts_vote(spark):
    """A page whose own best container is a long list of links text follows its host."""
    usual = "<body><div class='story'><p>{0} story text with a few words.</p></div><div class='teasers'><p>{1}</p></div></body>"
    rows = [(i, f"http://a.example.com/{i}", usual.format(f"Real {i} " + "word " * 20, "Teaser.")) for i in range(9)]
    odd = usual.format("Short", "Teaser after teaser, long and longer. " * 9)
    rows += [(9, "https://user@A.example.com:80/9", odd), (10, "http://b.example.com/", odd), (11, None, odd), (12, "no host", None),
             (13, "http://a.example.com/13", "<body><main><p>Other layout</p></main></body>"), (13, "http://a.example.com/13", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as host", "'y' as path", "'z' as text", "1 as votes")
    told = [(r["row"]["page_id"], r["text"]) for r in extract(df).collect()]
    got = dict(told)
    assert len(told) == len(rows) and got[0] == "Real 0 " + "word " * 20 + "story text with a few words."
    assert got[9] == "Short story text with a few words."
    assert got[10] == got[11] == ("Teaser after teaser, long and longer. " * 9).strip()
    assert got[12] == "" and ("Other layout" in [t for i, t in told if i == 13])


def test_paths_by_join_when_hosts_are_too_many_to_broadcast(spark, monkeypatch):
    pages = table(spark, SMALL, "pages")
    want = sorted(map(tuple, extraction_digest(pages).collect()))
    monkeypatch.setattr(html, "BROADCAST_HOSTS", 0)
    assert sorted(map(tuple, extraction_digest(pages).collect())) == want


def test_given_pages(spark):
    """The given pages' articles, cut out by hand: one h1, then paragraphs."""
    pages = {r["page_id"]: r["html"] for r in table(spark, SMALL, "pages").collect()}
    told = extraction_digest(table(spark, SMALL, "pages")).collect()
    assert len(told) == len(pages)
    for r in told:
        found = re.search(r"<article>(.*?)</article>", pages[r["page_id"]] or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", found[1] if found else "")
        parts = [" ".join(references.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in parts]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_no_pages(spark):
    assert extraction_digest(spark.createDataFrame([], SCHEMA)).collect() == []
