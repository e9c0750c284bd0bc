"""Captured web pages as browsers read them.

Pages are cut into tags and text, and a stack of open elements is kept: an end tag closes what is open above its element, a
stray one is passed over, a paragraph, list item or table cell ends where the next one or a block begins, entities are
decoded, and what stands in scripts, styles and comments is no text. Elements are chosen by a path of steps ``(tag, {attribute: value})``,
each anywhere below the one before; tag ``*`` is any. Pages are parsed in Arrow batches, one at a time, in their own task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# HTML elements without content, and those whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
# Elements that the start of another one ends, with what keeps the search inside.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"})}
SILENT = frozenset("script style template title noscript".split())
BLANKS = re.compile("[ \t\n\r\f]+")
PUBLISHED = re.compile(r"Published\s+([0-9]{2}-[0-9]{2}-[0-9]{4})")

Path = Sequence[tuple[str, dict]]


class Page(HTMLParser):
    """One page's links below ``links``, texts of the elements ``texts`` and rows of the tables below ``tables``."""

    def __init__(self, links: Path | None = None, texts: Path | None = None, tables: Path | None = None):
        super().__init__(convert_charrefs=True)
        self.ways = {"links": links, "texts": texts, "tables": tables}
        self.open: list[tuple[str, dict]] = []
        self.links: list[str] = []
        self.texts: list[str] = []
        self.rows: list[list[str]] = []
        self.base: str | None = None
        self.published: str | None = None
        self.gathers: list[tuple[int, list[str], str]] = []  # depth of the element, its text so far, what it is
        self.cells: list[str] | None = None

    def on(self, path: Path | None) -> bool:
        """Whether the innermost open element is the end of ``path``."""
        if path is None:
            return False
        steps = list(path)
        tag, attrs = self.open[-1]
        if not self.fits(steps[-1], tag, attrs):
            return False
        left = steps[:-1]
        for tag, attrs in reversed(self.open[:-1]):
            if left and self.fits(left[-1], tag, attrs):
                left.pop()
        return not left

    @staticmethod
    def fits(step: tuple[str, dict], tag: str, attrs: dict) -> bool:
        return step[0] in ("*", tag) and all(attrs.get(k) == v for k, v in step[1].items())

    def close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, _ = self.open.pop()
            while self.gathers and self.gathers[-1][0] > len(self.open):
                _, parts, what = self.gathers.pop()
                text = BLANKS.sub(" ", "".join(parts)).strip(" ")
                if what == "text":
                    self.texts.append(text)
                elif self.cells is not None:
                    self.cells.append(text)
            if tag == "tr" and self.cells is not None:
                self.rows.append(self.cells)
                self.cells = None

    def close_last(self, tags: frozenset | set, until: frozenset | set = frozenset()) -> None:
        """Closes the outermost of ``tags`` that is open inside the innermost of ``until``."""
        depth = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in until:
                break
            if self.open[i][0] in tags:
                depth = i
        if depth is not None:
            self.close_to(depth)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        own = {}
        for k, v in attrs:
            own.setdefault(k, v or "")  # the first of equal attributes counts
        if tag == "br":
            self.handle_data("\n")
        if tag == "base" and self.base is None:
            self.base = own.get("href")
        if tag in BLOCKS:
            self.close_last({"p"}, {"table", "td", "th", "button"})
        if tag in ENDS:
            self.close_last(*ENDS[tag])
        if tag in VOID:
            return
        self.open.append((tag, own))
        depth = len(self.open)
        if "href" in own and self.on(self.ways["links"]):
            self.links.append(own["href"])
        if self.on(self.ways["texts"]):
            self.gathers.append((depth, [], "text"))
        if self.ways["tables"] is not None and tag in ("tr", "td", "th"):
            inner = [(t, {}) for t in ("tr",)] if tag == "tr" else [("tr", {}), (tag, {})]
            if self.on([*self.ways["tables"], *inner]):
                if tag == "tr":
                    self.cells = []
                else:
                    self.gathers.append((depth, [], "cell"))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_to(i)
                return

    def handle_data(self, data: str) -> None:
        if any(tag in SILENT for tag, _ in self.open):
            return
        for _, parts, _ in self.gathers:
            parts.append(data)
        if self.published is None and (found := PUBLISHED.search(data)):
            self.published = found.group(1)


def read_page(html: str | None, **ways: Path) -> Page:
    page = Page(**ways)
    page.feed(html or "")
    page.close()
    page.close_to(0)
    return page


def _frozen(path: Path) -> list[tuple[str, dict]]:
    return [(t, dict(a)) for t, a in path]


def extract_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", within: Path = ()) -> DataFrame:
    """SRC-06: ``key, link``, the target of every link below the container ``within`` (default: the whole page), made absolute by
    the page's address and its base. Null pages have none."""
    way = [*_frozen(within), ("a", {})]

    @F.pandas_udf("array<string>")
    def links(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for urls, texts in batches:
            out = []
            for u, t in zip(urls, texts):
                page = read_page(t, links=way)
                base = urljoin(u or "", page.base or "")
                out.append([urljoin(base, x.strip()) for x in page.links])
            yield pd.Series(out)

    return pages.select(key, F.explode(links(F.col(url), F.col(html))).alias("link"))


def paragraphs(pages: DataFrame, keep: Sequence[str], html: str = "html", within: Path = (("article", {}),)) -> DataFrame:
    """``keep``, ``paragraphs`` (texts of the ``p`` elements below ``within``, in order of their ends, runs of
    blanks as one) and ``published`` (text ``dd-MM-yyyy`` behind the word, where the page has it)."""
    way = [*_frozen(within), ("p", {})]

    @F.pandas_udf("paragraphs array<string>, published string")
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            got = [read_page(t, texts=way) for t in texts]
            yield pd.DataFrame({"paragraphs": [p.texts for p in got], "published": [p.published for p in got]})

    return pages.select(*keep, parsed(F.col(html)).alias("__p")).select(*keep, "__p.*")


def extract_article(pages: DataFrame, key: str = "page_id", html: str = "html", within: Path = (("article", {}),)) -> DataFrame:
    """SRC-07: the article's non-empty paragraphs joined by a blank, their number, and the date of publication."""
    got = paragraphs(pages, [key], html, within)
    return got.select(key, X.join_paragraphs(F.col("paragraphs")).alias("article"),
                      F.size(F.filter("paragraphs", lambda p: p != "")).alias("n_paragraphs"),
                      F.try_to_timestamp(F.col("published"), F.lit("dd-MM-yyyy")).cast("date").alias("published"))


def table_rows(pages: DataFrame, key: str = "page_id", html: str = "html", within: Path = ()) -> DataFrame:
    """``key, r, cells``: the rows of the tables below ``within``, from 0 on each page."""
    way = [*_frozen(within), ("table", {})]

    @F.pandas_udf("array<array<string>>")
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([read_page(t, tables=way).rows for t in texts])

    return pages.select(key, F.posexplode(rows(F.col(html))).alias("r", "cells"))


def extract_price_table(pages: DataFrame, key: str = "page_id", html: str = "html", date_header: str = "Date", close_header: str = "Close",
                        within: Path = ()) -> DataFrame:
    """SRC-08: the first row of a page names the places of date and close; ``MMM d, yyyy`` dates and ``1,234.56`` numbers
    are parsed. Pages whose first row lacks one of the names give nothing, shorter rows null."""
    from ..functions.dates import HISTORY_DATE
    from ..functions.numeric import parse_number
    rows = table_rows(pages, key, html, within)
    head = rows.filter(F.col("r") == 0).select(key, F.array_position("cells", date_header).cast("int").alias("__d"),
                                               F.array_position("cells", close_header).cast("int").alias("__c"))
    body = rows.filter(F.col("r") > 0).join(head.filter("__d > 0 AND __c > 0"), key)
    return body.select(key, F.try_to_timestamp(F.try_element_at("cells", F.col("__d")), F.lit(HISTORY_DATE)).cast("date").alias("date"),
                       parse_number(F.try_element_at("cells", F.col("__c"))).alias("close"))
