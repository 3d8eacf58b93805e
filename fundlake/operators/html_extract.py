"""HTML extraction over landed pages (O-10..O-15).

Parsing HTML is per-row Python: each Arrow batch of pages is parsed with the
standard library's ``html.parser`` inside ``mapInPandas``; Spark partitions
the pages and everything around the parse (filters, joins, quarantine) stays
in built-in operators. Selectors are a small CSS subset: ``tag``, ``.class``,
``[attr]``, descendant (space) and child (``>``) combinators.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.session import ship_package

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}

_NO_TEXT = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def text(self) -> str:
        """The text below, without that of scripts, styles and templates in it."""
        out: list[str] = []
        stack: list[object] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            elif item is self or item.tag not in _NO_TEXT:  # type: ignore[union-attr]
                stack.extend(reversed(item.children))  # type: ignore[union-attr]
        return "".join(out)

    def elements(self) -> Iterator["Node"]:
        """Descendant elements in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, dict(attrs), self.cur))

    def handle_endtag(self, tag):
        node = self.cur
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:  # close it and anything left open inside
            self.cur = node.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse_html(html: str) -> Node:
    builder = _TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_COMPOUND = re.compile(r"([a-zA-Z0-9_-]+|\*)?((?:\.[a-zA-Z0-9_-]+)*)((?:\[[a-zA-Z0-9_-]+\])*)")


@lru_cache(maxsize=256)
def _compile(selector: str) -> list[tuple[str, tuple[str | None, set[str], list[str]]]]:
    """'ul.a > li.b c' -> [(' ', ul.a), ('>', li.b), (' ', c)]."""
    steps, combinator = [], " "
    for token in selector.replace(">", " > ").split():
        if token == ">":
            combinator = ">"
            continue
        m = _COMPOUND.fullmatch(token)
        if not m:
            raise ValueError(f"unsupported selector part: {token}")
        tag = None if m.group(1) in (None, "*") else m.group(1).lower()
        classes = {c for c in m.group(2).split(".") if c}
        attrs = re.findall(r"\[([a-zA-Z0-9_-]+)\]", m.group(3))
        steps.append((combinator, (tag, classes, attrs)))
        combinator = " "
    return steps


def _matches(node: Node, compound) -> bool:
    tag, classes, attrs = compound
    return (tag is None or node.tag == tag) and classes <= node.classes() and all(a in node.attrs for a in attrs)


def select(scope: Node, selector: str) -> list[Node]:
    """All elements under ``scope`` matching ``selector``, in document order."""
    steps = _compile(selector)
    current = [scope]
    for combinator, compound in steps:
        found: list[Node] = []
        seen: set[int] = set()
        for base in current:
            pool = (c for c in base.children if isinstance(c, Node)) if combinator == ">" else base.elements()
            for node in pool:
                if id(node) not in seen and _matches(node, compound):
                    seen.add(id(node))
                    found.append(node)
        current = found
    if len(steps) > 1:  # restore document order across different bases
        order = {id(n): i for i, n in enumerate(scope.elements())}
        current.sort(key=lambda n: order[id(n)])
    return current


def select_one(scope: Node, selector: str) -> Node | None:
    hits = select(scope, selector)
    return hits[0] if hits else None


@dataclass(frozen=True)
class ListingSpec:
    """Selectors of a listing page. Defaults are the original site's."""

    card: str = "ul.wp-block-post-template > li.wp-block-post"
    title: str = "h3.loop-card__title"
    link: str = "a"  # looked up inside the title element (or the card: link_in_card)
    link_in_card: bool = False
    author: str | None = "a.loop-card__author"  # required when given; text not stripped
    time: str = "time"


@dataclass(frozen=True)
class ArticleSpec:
    """Selectors of an article page. Defaults are the original site's."""

    title: str = "h1.wp-block-post-title"
    author_blocks: tuple[str, ...] = ("div.post-authors-list__authors", "div.article-hero__authors")
    time: str | None = "div.wp-block-post-date > time"
    content: str | None = "div.wp-block-post-content"


# Driver pages: <nav><ul><li><a href=..>..</a></li>..</ul></nav>, <h1>, <article>.
DRIVER_LISTING = ListingSpec(card="nav li", title="a", link="a", link_in_card=True, author=None, time="time")
DRIVER_ARTICLE = ArticleSpec(title="h1", author_blocks=(), time=None, content="article")

LISTING_FIELDS = ("pos", "title", "url", "author", "publication_date", "error")
ARTICLE_FIELDS = ("title", "author", "publication_date", "content", "error")


def listing_records(html: str, spec: ListingSpec) -> list[dict]:
    """O-10/O-11/O-12 for one page: one record per card, ``error`` set when a
    mandatory part is missing."""
    root = parse_html(html)
    out = []
    for pos, card in enumerate(select(root, spec.card)):
        rec = {"pos": pos, "title": "", "url": "", "author": "", "publication_date": "", "error": None}
        try:
            title_el = select_one(card, spec.title)
            rec["title"] = title_el.text().strip() if title_el else ""
            if spec.link_in_card:
                link = select_one(card, spec.link)
                if link is None or link.attrs.get("href") is None:
                    raise ValueError("link without href")
                rec["url"] = link.attrs["href"]
            elif title_el is not None:
                link = select_one(title_el, spec.link)
                if link is None:
                    raise ValueError("title without link")
                if link.attrs.get("href") is None:
                    raise ValueError("link without href")
                rec["url"] = link.attrs["href"]
            if spec.author:
                author = select_one(card, spec.author)
                if author is None:
                    raise ValueError("missing author")
                rec["author"] = author.text()
            t = select_one(card, spec.time) if spec.time else None
            if t is not None:
                if t.attrs.get("datetime") is None:
                    raise ValueError("time without datetime")
                rec["publication_date"] = t.attrs["datetime"]
        except ValueError as exc:
            rec["error"] = str(exc)
        out.append(rec)
    return out


def article_record(html: str, spec: ArticleSpec) -> dict:
    """O-13/O-14 for one page: the article fields, ``error`` when a mandatory
    part is missing."""
    root = parse_html(html)
    rec = {"title": None, "author": None, "publication_date": None, "content": None, "error": None}
    try:
        title = select_one(root, spec.title)
        if title is None:
            raise ValueError("missing title")
        rec["title"] = title.text().strip()
        if spec.author_blocks:
            block = None
            for sel in spec.author_blocks:
                block = select_one(root, sel)
                if block is not None:
                    break
            link = select_one(block, "a") if block is not None else None
            if link is None:
                raise ValueError("missing author")
            rec["author"] = link.text()
        if spec.time:
            t = select_one(root, spec.time)
            if t is None or t.attrs.get("datetime") is None:
                raise ValueError("missing publication date")
            rec["publication_date"] = t.attrs["datetime"]
        if spec.content:
            content = select_one(root, spec.content)
            if content is None:
                raise ValueError("missing content")
            rec["content"] = content.text().strip()
    except ValueError as exc:
        rec["error"] = str(exc)
    return rec


def extract_listings(pages: DataFrame, spec: ListingSpec = ListingSpec(), keys=("page_id", "url"),
                     html_col: str = "html") -> DataFrame:
    """One row per listing card of every page (O-10), with its fields (O-11)
    and an ``error`` column for the row-level drop rule (O-12)."""
    keys = [k for k in keys if k in pages.columns]
    key_fields = [pages.schema[k].simpleString() for k in keys]
    schema = ", ".join(f"{k} {t.split(':', 1)[1]}" for k, t in zip(keys, key_fields))
    schema += (", pos int, title string, url_found string, author string, "
               "publication_date string, error string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rec_keys, html in zip(batch[keys].itertuples(index=False), batch[html_col]):
                for r in listing_records(html, spec):
                    rows.append((*rec_keys, r["pos"], r["title"], r["url"], r["author"],
                                 r["publication_date"], r["error"]))
            cols = keys + ["pos", "title", "url_found", "author", "publication_date", "error"]
            yield pd.DataFrame(rows, columns=cols)

    ship_package(pages.sparkSession)
    return pages.select(*keys, html_col).mapInPandas(run, schema)


def extract_articles(pages: DataFrame, spec: ArticleSpec = ArticleSpec(), keys=("page_id", "url"),
                     html_col: str = "html") -> DataFrame:
    """One row per page with the article fields (O-13) and ``error`` (O-14)."""
    keys = [k for k in keys if k in pages.columns]
    key_fields = [pages.schema[k].simpleString() for k in keys]
    schema = ", ".join(f"{k} {t.split(':', 1)[1]}" for k, t in zip(keys, key_fields))
    schema += ", title string, author string, publication_date string, content string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            recs = [article_record(h, spec) for h in batch[html_col]]
            out = batch[keys].reset_index(drop=True).copy()
            for f in ARTICLE_FIELDS:
                out[f] = [r[f] for r in recs]
            yield out

    ship_package(pages.sparkSession)
    return pages.select(*keys, html_col).mapInPandas(run, schema)


def ok_rows(df: DataFrame) -> DataFrame:
    """O-12 / O-14: the rows without an extraction error."""
    return df.where(F.col("error").isNull()).drop("error")


def rejected_rows(df: DataFrame) -> DataFrame:
    """The rows dropped by the error rule, kept for inspection."""
    return df.where(F.col("error").isNotNull())


def successful_pages(pages: DataFrame, status_col: str | None = "status") -> DataFrame:
    """O-02: keep pages fetched with status 200. A table without ``status_col`` is an
    error; None says that all its pages were fetched."""
    if status_col is None:
        return pages
    if status_col not in pages.columns:
        raise ValueError(f"pages have no column {status_col}: pass None if all of them were fetched")
    return pages.where(F.col(status_col) == 200)


def failed_pages(pages: DataFrame, status_col: str | None = "status") -> DataFrame:
    """(url, error): the pages ``successful_pages`` leaves out."""
    status = F.lit(200) if status_col is None else F.col(status_col)
    error = F.concat(F.lit("status "), F.coalesce(status.cast("string"), F.lit("unknown")))
    return pages.where(~F.coalesce(status == 200, F.lit(False))).select("url", error.alias("error"))


def index_to_articles(index: DataFrame, pages: DataFrame, url_col: str = "url", keep_cols: Sequence[str] = ()) -> DataFrame:
    """O-15: the index's url list drives the article fetch: an inner join on
    url, duplicates kept (no distinct). ``keep_cols`` of the index stay."""
    return index.select(url_col, *keep_cols).join(pages, url_col, "inner")
