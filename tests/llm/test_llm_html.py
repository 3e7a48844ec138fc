"""Operator 6 on written pages and on the given table."""

from __future__ import annotations

import html as H
import re

import pytest

from marketlake.llm import html_text as X

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=1>x</a></li></ul></nav><div id="wrap"><div class="sidebar"><p>Side text that is long enough to count as text, really it is.</p></div>
<div class="content"><h2>Title</h2><p>First   paragraph, long
enough &amp; f&#105;ne.</p><p>Second, with a <a href=2>link</a> inside <b>and</b> more text.<br>After a break.</p><aside>Aside</aside>
<div class="cookie-notice">We use cookies</div><blockquote>Quote that counts</blockquote><ul><li>one<li>two</ul>
<script>var t="</p>";</script><form><input value=1>Mail</form><div class="advert">Buy</div></div>
<div id="comments"><article class="comment"><p>I liked it a lot, great article, thank you for that, and so on.</p><p>Me too, me too, me too, for ages.</p></article></div></div>
<footer>&copy; c</footer></body></html>"""


def test_a_page():
    assert X.main_text(PAGE).split("\n\n") == [
        "Title", "First paragraph, long enough & fine.", "Second, with a link inside and more text. After a break.", "Quote that counts", "one", "two"]


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), (" \n ", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("a &lt;b&gt; &am", "a <b> &am"),
    ("<script>no</script>", ""), ("<!-- no -->yes", "yes"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"), ("</p></div>x", "x"), ("<p>cut <b>here", "cut here")])
def test_odd_pages(page, text):
    assert X.main_text(page) == text


def test_long_page():
    assert len(X.main_text("<article>" + "<p>some words here</p>" * 50_000)) == 50_000 * 17 - 2


def _article(page: str) -> str:
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(H.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = X.extract(df.selectExpr("*", "'own' AS text", "1 AS n_chars")).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r.text == _article(r.html) and r.n_chars == len(r.text)
    assert X.extract(df.limit(0)).count() == 0
    assert [r.text for r in X.extract(spark.createDataFrame([(1, None), (None, "x")], "page_id long, html string")).collect()] == ["", "x"]


LONG = "<p>Here is a passage of running text, long enough to be the heart of a page, number {}.</p>"


def _passages(a: int, b: int) -> str:
    return "".join(LONG.format(i) for i in range(a, b))


def _want(n: int) -> str:
    return "\n\n".join(re.sub("<.*?>", "", LONG.format(i)) for i in range(n))


@pytest.mark.parametrize("page", [
    "<article>{a}</article><article>{b}</article>", "<main><article>{a}</article><article>{b}</article></main>",
    "<article>{a}<article>{b}</article></article>", "<article><article>{a}</article>{b}</article>", "<div><div>{a}{b}</div></div>"])
def test_articles_apart_nested_and_none(page):
    page = page.format(a=_passages(0, 4), b=_passages(4, 9))
    menu = "<ul>" + "".join(f"<li><a href={i}>Link number {i}</a></li>" for i in range(30)) + "</ul>"
    assert X.main_text(f"<body><nav>{menu}</nav><div>{menu}</div>{page}<footer>end</footer></body>") == _want(9)


@pytest.mark.parametrize("start", [
    '<div class="content with-sidebar">', '<div id="page" class="fixed-header">', '<div class="post sponsored widget-area main">',
    "<form action=x>", '<div role="search">', '<div class="has-nav"><div class="widget"><form>', '<div class="with-banner"><main>'])
def test_wrappers_named_like_boilerplate(start):
    page = f'<body><nav><a href=1>x</a></nav>{start}<div class="sidebar"><p>Side text.</p></div><div>{_passages(0, 6)}</div>'
    assert X.main_text(page) == _want(6)


def test_a_long_advert_beside_a_short_article_stays_out():
    assert X.main_text('<body><div class="ad">An advert of many words and more.</div><article><p>Short.</p></article></body>') == "Short."
    assert X.main_text(f'<body><article><div class="has-sidebar">{_passages(0, 6)}</div></article></body>') == _want(6)


@pytest.mark.parametrize("tag", ["div", "section"])
def test_given_pages_without_article_tags(spark, tag):
    """The same texts; only where the article is one block may what outweighs it come along."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        found, want = X.main_text(re.sub(r"(</?)article\b", rf"\g<1>{tag}", r.html)), _article(r.html)
        assert found == want or "\n\n" not in want and want in found.split("\n\n")


def test_inline_elements_are_text_of_their_block():
    page = "<div class=x><p>A <b>short</b> <i>paragraph</i> with <span>inline</span> parts.</p><p>Another <em>one</em>.</p></div>"
    assert X.main_text(f"<body><nav><a href=1>x</a></nav>{page}</body>") == "A short paragraph with inline parts.\n\nAnother one."


@pytest.mark.parametrize("media", ["<svg><path>", "<video src=x>", "<object><object></object>", "<canvas>no</canvas><canvas>", "<SVG><g></g></SVG ><audio>"])
def test_embedded_media_left_open(media):
    assert X.main_text(f"<article><p>First.</p>{media}<p>Second.</p></article>") == "First.\n\nSecond."
    assert X.main_text("<p>a<video><p>no video</p></video><svg><svg><text>t</text></svg></svg>b</p>") == "ab"
