"""HTML sources: links and paragraphs of pages, by Arrow-batched functions.

``xpath`` needs well-formed input, which pages are not; the standard library's
parser is used, closing paragraphs where HTML implies it.
"""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dims import DEFAULT, Dims
from ..schemas import TEXTS

ANCHORS = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))

_BLOCK = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


class _Page(HTMLParser):
    """Collects anchors, and paragraphs under the article, the article body, or anywhere."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, list[str]]] = []
        self.paragraphs: dict[str, list[list[str]]] = {"article": [], "body": [], "all": []}
        self.seen: set[str] = set()
        self.anchor: list[str] | None = None
        self.open: list[list[str]] = []
        self.skip = 0
        self.depth = {"article": 0, "body": 0}
        self.done: set[str] = set()
        self.body_tag = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.skip += 1
        if tag in _BLOCK:
            self.open = []
        named = dict(attrs)
        if tag == "article" and "article" not in self.done:
            self.depth["article"] += 1
            self.seen.add("article")
        if "body" not in self.done:
            if self.depth["body"] and tag == self.body_tag:
                self.depth["body"] += 1
            elif not self.depth["body"] and named.get("itemprop") == "articleBody":
                self.body_tag, self.depth["body"] = tag, 1
                self.seen.add("body")
        if tag == "a" and named.get("href") is not None:
            self.anchor = []
            self.links.append((named["href"], self.anchor))
        if tag == "p":
            text: list[str] = []
            self.open = [text]
            for where in ("article", "body"):
                if self.depth[where]:
                    self.paragraphs[where].append(text)
            self.paragraphs["all"].append(text)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        if tag == "a":
            self.anchor = None
        if tag in _BLOCK:
            self.open = []
        for where, name in (("article", "article"), ("body", self.body_tag)):
            if tag == name and self.depth[where]:
                self.depth[where] -= 1
                if not self.depth[where]:
                    self.done.add(where)

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        for text in self.open:
            text.append(data)
        if self.anchor is not None:
            self.anchor.append(data)


def _parse(html: str | None) -> _Page | None:
    """The page, or None where the parser gives up on its markup."""
    page = _Page()
    try:
        page.feed(html or "")
        page.close()
    except (AssertionError, ValueError):  # declarations that are none
        return None
    return page


def _joined(root: str, href: str) -> str | None:
    try:
        return urljoin(root, href)
    except ValueError:  # such as a bracket without its partner in the host
        return None


@F.pandas_udf(ANCHORS)
def anchors_of(html: pd.Series) -> pd.Series:
    """Every anchor with an href, in order; text pieces stripped and joined.  Null if the
    page cannot be parsed."""
    return html.map(lambda h: _anchors(_parse(h)))


def _anchors(page: _Page | None, root: str | None = None) -> list[dict] | None:
    if page is None:
        return None
    return [{"href": a if root is None else _joined(root, a), "text": "".join(x.strip() for x in t)} for a, t in page.links]


@F.pandas_udf(TEXTS)
def paragraphs_of(html: pd.Series) -> pd.Series:
    """Texts of the paragraphs of the first article, else the article body, else the page.
    Null if the page cannot be parsed."""

    def texts(h: str | None) -> list[str] | None:
        page = _parse(h)
        if page is None:
            return None
        where = "article" if "article" in page.seen else "body" if "body" in page.seen else "all"
        return [" ".join(s for x in p if (s := x.strip())) for p in page.paragraphs[where]]

    return html.map(texts)


def scan_links(pages: DataFrame, dims: Dims = DEFAULT) -> DataFrame:
    """(page_id, pos, href, text) of a listing's article links.

    Relative links are joined to the site root; links elsewhere, with short texts
    or outside the section go, as do links that are no URL and pages that cannot be
    parsed.  A link given twice has the place of its first and the text of its last anchor.
    """
    root = dims.site_root
    absolute = F.pandas_udf(lambda s: s.map(lambda h: _anchors(_parse(h), root)), ANCHORS)
    rows = pages.select("page_id", F.posexplode(absolute("html")).alias("pos", "a")).select("page_id", "pos", "a.text", "a.href")
    rows = rows.filter(F.startswith("href", F.lit(root)) & (F.length("text") >= dims.min_link_text) & F.contains("href", F.lit(dims.section)))
    return rows.groupBy("page_id", "href").agg(F.min("pos").alias("pos"), F.max_by("text", "pos").alias("text")).select("page_id", "pos", "href", "text")


def titles(html):
    """Text of the title element, white space collapsed; null without one."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.nullif(F.trim(F.regexp_replace(raw, r"\s+", " ")), F.lit(""))


