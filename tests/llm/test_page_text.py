from __future__ import annotations

import html
import re
import time

import pytest

from portolan.llm import page_text as P

SHOP = (
    "<html><body class='has-sidebar'><div id=header>Site <a href=/>Home</a></div><div class='cookie-notice'>Cookies, very many of them, everywhere here.</div>"
    "<div class=wrap><div class='post-{n} content'><h1>Title &eacute;&nbsp;{n}</h1><p>One <b>bo</b>ld<p>Two a < b &amp; c<br>three<ul><li>x<li>y</ul>"
    "<form><input name=q>Search<select><option>1<option>2</select></form><table><tr><td>c1<td>c2</table><div class='ad'>Buy!</div>"
    "<aside>side</aside><script>if (a<b) write('</p>');</script>end</div><section id=comments><p>A comment that is far longer than the article is, all in all,"
    " with many words of no use to any reader.</p></section></div><footer>(c)</footer>"
)
WANT = "Title é {n} One bold Two a < b & c three x y c1 c2 end"


def alone(source):
    page = P.read(source)
    return page.inside(page.best().path)


def test_broken_markup():
    assert alone(SHOP.format(n=1)) == WANT.format(n=1)


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a b"), ("a<i>b</i>c<div>d</div>e", "abc d e"),
    ("<form><p>all in a form</p></form>", "all in a form"), ("<script>never closed", ""), ("<!-- open", ""),
    ('<p title="unclosed>abc</p>', "abc"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<article>x\n \t y</article> menu", "x y"),
    ("<nav>menu</nav>", ""), ("</div></p>x", "x"),
])
def test_small_pages(source, want):
    assert alone(source) == want


def test_hosts_agree(spark):
    """A page on which a teaser outweighs the article follows the host's other pages."""
    odd = "<div class=teaser><p>" + "a long teaser text " * 40 + "</p></div><div class='item-9'><p>short</p></div>"
    usual = "<div class=teaser><p>teaser</p></div><div class='item-{n}'><p>" + "the article " * 30 + "</p></div>"
    rows = [(i, f"https://u@WWW.example.org:80{i}/p/{i}", usual.format(n=i)) for i in range(5)]
    rows += [(5, "http://www.example.org/x", odd), (6, "https://other.example.org/", odd), (7, None, None), (8, "not a url", "<p>no host</p>"), (6, "https://other.example.org/", odd)]
    pages = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    found = {}
    for r in P.extract_text(pages).collect():
        found.setdefault(r["page_id"], []).append(r["text"])
    assert found[0] == ["the article " * 29 + "the article"] and found[5] == ["short"] and found[7] == [""] and found[8] == ["no host"]
    assert len(found[6]) == 2 and found[6][0].startswith("a long teaser")
    assert P.extract_text(pages.limit(0)).count() == 0


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        body = re.sub(r"</?[a-z][^>]*>", "", re.sub(r"</?(?:h1|p|br)[^>]*>", " ", body))
        want[r["page_id"]] = " ".join(html.unescape(body).split())
    assert {r["page_id"]: r["text"] for r in P.extract_text(pages).collect()} == want


@pytest.mark.parametrize("piece, after", [
    ("<a ", ""), ("<div><i>", "</b>"), ("<i>", "<p>"), ("<a title=\"x>", ""), ("<a t='", ""), ("<!x ", ""), ("<li><b>", "</u>"), ("</p>", ""),
    ("<td>", "</i>"), ("<b>x", "</s>"), ("&", ""), ("<script", ">"), ("< ", "> "), ("<p class=' ", "'>"),
])
def test_a_megabyte_of_broken_markup(piece, after):
    n = 1_000_000 // len(piece + after)
    source = "<article>some text" + piece * n + after * n
    began = time.process_time()
    assert P.article(P.read(source), None).startswith("some text") or piece == "<script"
    assert time.process_time() - began < 15  # the slowest takes two or three seconds alone


def test_names_of_the_articles_own_parts(spark):
    page = (
        "<body><div class='search-box'>find</div><article><p class='search-term'>Terms stay.</p><p class='text-alert'>Alerts stay.</p>"
        "<div class='related-work'>Work stays.</div><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><object>An object.</object>"
        "<div class='x-widget x-widget-text'>Body.</div><div class='related-posts'>more</div><div class='share buttons'>tell</div>"
        "<div class='ad-slot-3'>buy</div></article></body>"
    )
    assert alone(page) == "Terms stay. Alerts stay. Work stays. Let x=1 be. An object. Body."


def test_two_layouts_on_one_host(spark):
    """Pages of a second layout have an empty container, or a teaser, where the others have the article."""
    first = "<body><div class=content><p>" + "first layout {n} " * 20 + "</p></div><div class=promo-text><p>x</p></div></body>"
    second = "<body><div class=content>{t}</div><div class=story><p>" + "second layout {n} " * 20 + "</p></div></body>"
    rows = [(i, f"http://h.example/{i}", first.format(n=i)) for i in range(12)]
    rows += [(100 + i, f"http://h.example/{i}", second.format(n=i, t="" if i % 2 else "a teaser")) for i in range(6)]
    rows += [(200, "http://h.example/odd", "<body><div class=content> </div><div class=unique><p>" + "alone " * 30 + "</p></div></body>")]
    rows += [(300, None, first.format(n=1)), (301, "relative/path", second.format(n=2, t="a teaser")), (302, "", first.format(n=1))]
    found = {r["page_id"]: r["text"] for r in P.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i, _, _ in rows[:12]:
        assert found[i].startswith(f"first layout {i}")
    for i in range(6):
        assert found[100 + i].startswith(f"second layout {i}")
    assert found[200].startswith("alone alone") and found[301].startswith("second layout 2") and found[300] == found[302]


def test_clashing_columns(spark):
    names = ["path", "paths", "host", "text", "votes", "score", "all", "first", "_html"]
    rows = spark.createDataFrame([(1, "http://a/", "<article>x y</article>", *names)], "page_id long, url string, html string, " + ", ".join(f"`{n}` string" for n in names))
    assert [tuple(r) for r in P.extract_text(rows).collect()] == [(1, "http://a/", "x y")]
