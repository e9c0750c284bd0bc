"""Pages as browsers read them, against tables made by hand."""

import datetime as dt

import pytest

from tessera.operators import pages as PG

TEXTS = [
    ("<p>one<p>two", ["one", "two"]),
    ("<p>a &amp; b &lt;c&gt; &#233;&nbsp;x</p>", ["a & b <c> é x"]),
    ("<p>first<div>not in a paragraph</div>nor this<p>second", ["first", "second"]),
    ("<p>with <b>bold <i>both</b> end</i></p>", ["with bold both end"]),
    ("<p>line<br>break\n  and   blanks</p>", ["line break and blanks"]),
    ("<script>var t='<p>no</p>';</script><p>yes</p><!-- <p>no</p> --><style>p{}</style>", ["yes"]),
    ("</p><p>stray ends</b></i></p></div>", ["stray ends"]),
    ("<P CLASS=x>upper</P><p>never closed", ["upper", "never closed"]),
    ("<table><tr><td><p>cell<td><p>next</table><p>after", ["cell", "next", "after"]),
    ("<ul><li><p>item<li><p>item two</ul>", ["item", "item two"]),
    ("<p><span>a</span><p></p><p> </p>", ["a", "", ""]),
    ("", []), (None, []), ("no tags & nothing", []), ("<p", []),
]


@pytest.mark.parametrize("html, want", TEXTS)
def test_paragraphs(html, want):
    assert PG.read_page(html, texts=[("p", {})]).texts == want


def test_links_of_the_container(spark):
    html = """<a href="/out">o</a><ul data-test='news-list'><li><article data-test="article-item"><div class="relative">
      <a class=t href='/in/one?a=1&amp;b=2'>x<a href=two>y</a><a name=z>no target</a></div><a href="/beside">b</a></article>
      <li><article data-test=article-item><div class="relative other"><a href="/class">c</a></div></article></ul>
      <div class=relative><a href="https://b.example/z#f">z</a></div>"""
    pages = spark.createDataFrame([(1, "https://a.example/dir/page", html), (2, None, None), (3, "https://a.example/", "<base href=/b/><a href=c>")],
                                  "page_id long, url string, html string")
    way = (("ul", {"data-test": "news-list"}), ("article", {"data-test": "article-item"}), ("div", {"class": "relative"}))
    got = [tuple(r) for r in PG.extract_links(pages, within=way).collect()]
    assert got == [(1, "https://a.example/in/one?a=1&b=2"), (1, "https://a.example/dir/two")]
    every = [tuple(r) for r in PG.extract_links(pages).collect()]
    assert (1, "https://b.example/z#f") in every and (3, "https://a.example/b/c") in every and len(every) == 7


def test_article_and_date(spark):
    html = """<span>Published 04-06-2025, 10:00</span><div id="article" class="article_container"><p>One &amp; two<p> <p>three</div><p>out"""
    other = """<script>"Published 01-01-2020"</script><div id="article"><p>x</div>"""
    pages = spark.createDataFrame([(1, html), (2, other), (3, None)], "page_id long, html string")
    way = (("*", {"id": "article", "class": "article_container"}),)
    got = {r["page_id"]: tuple(r)[1:] for r in PG.extract_article(pages, within=way).collect()}
    assert got == {1: ("One & two three", 2, dt.date(2025, 6, 4)), 2: ("", 0, None), 3: ("", 0, None)}


def test_price_table_without_end_tags(spark):
    html = """<div class=container data-testid=history-table><table><thead><tr><th>Date<th>Open<th>Close<tbody>
      <tr><td>Jun 4, 2025<td>1<td>24,620.20<tr><td>Jun 3, 2025</td><td>2</td><td><b>24,000.10</b></td></tr><tr><td>bad</table></div>
      <table><tr><th>Date</th><th>Close</th></tr><tr><td>Jun 1, 2025</td><td>1</td></tr></table>"""
    pages = spark.createDataFrame([(1, html), (2, "<table><tr><td>x</table>"), (3, None)], "page_id long, html string")
    way = (("div", {"class": "container", "data-testid": "history-table"}),)
    got = sorted((tuple(r) for r in PG.extract_price_table(pages, within=way).collect()), key=str)
    assert got == [(1, None, None), (1, dt.date(2025, 6, 3), 24000.10), (1, dt.date(2025, 6, 4), 24620.20)]
