"""Main text of pages by consensus host paths.

Every page is read into blocks of text, each under the path of its containers
(tag and classes, numbers generalised). Boilerplate elements are left out: menus,
page headers and footers, sidebars, notices, adverts, forms, scripts, styles, drawings and
reader comments, by their tags and by the words in the names of containers; words that
may name a part of an article as well only lower a container's score inside one. Containers are scored by the text of their blocks less that of
links, and a page's own choice is the deepest container that holds most of its
page's score and leaves no prose behind: no text that stands directly in a container
on the way, nothing inside an article or main element, and elsewhere no heading and no
sentence. The pages of a host vote with their choices in Spark; the path
with most votes (then the largest score, then the first path) is the host's, and all
pages are extracted again with it. It decides where it leaves no prose behind, and also where
it holds most of the page's score and what it leaves is neither directly in a container
around it nor inside an article: a rail or a legal note of a sentence, which the host's other
pages do not have, is no article. A page without the host's path, or where that path
holds nothing or too little, is extracted with its own choice.

A page is read in one pass over its tags, and its containers are a tree of paths (equal
paths are one node), so very long and deeply nested pages take time in proportion.

Inside a block white space becomes one space; blocks are joined in page order
by an empty line; character references are decoded.

A host with a third of all pages is no hot task: votes are summed before they
are shuffled, and pages meet their host's path by host and salt.

Defined results: null and empty html gives an empty text; a null or odd url is
host ''; repeated rows are extracted each; no rows give no rows; extra columns
are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import read_table, text_slices
from fundlake.session import materialize

SALTS = 32
SHARE = 0.7

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?/][^>]*>|<[a-zA-Z][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+", re.I)
_SENTENCE = re.compile(r"[.!?…。！？।۔؟]['\"”’»)\]]*(?:\s|\Z)")
_NUMBERS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw text, not markup.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
SKIPPED = frozenset(
    "nav footer aside form button select option dialog menu object canvas audio video map datalist head".split()
)
CONTAINERS = frozenset("body div section article main table tbody tr td center".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
) | SKIPPED
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a new element of the same group closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
#: Elements whose classes, ids and roles may mark boilerplate; not headings, paragraphs, list items or inline elements.
MARKED = frozenset("div section table tbody tr td center ul ol dl fieldset details address header hgroup iframe".split())
#: Words of classes, ids and roles that mark boilerplate.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot "
    "cookie cookies consent gdpr newsletter subscribe signup "
    "sidebar sidenav widget widgets nav navbar breadcrumb breadcrumbs pagination pager footer masthead "
    "topbar toolbar sharing comments commentlist disqus searchbox complementary contentinfo".split()
)
#: Words that may as well name a part of an article. They mark a container outside
#: articles, by tokens that hold nothing but such words; inside they only lower its score.
AMBIGUOUS = frozenset(
    "banner sponsor sponsored promo promotion notice notification alert popup modal overlay subscription aside menu navigation "
    "share social related recommended recommendations comment reply replies respond discussion login search form hidden "
    "skip copyright".split()
)
#: Words that say nothing about the content.
STRUCTURE = frozenset(
    "area bar block box button buttons container content group inner items item links link list main outer page panel post posts "
    "section site top middle bottom left right inline unit slot mobile desktop wrap wrapper".split()
)
PENALTY = 0.25
#: Elements of markup of their own; block elements of the page end an unclosed one.
FOREIGN = frozenset("svg math".split())


class Paths:
    """The containers of a page as a tree: node 0 is the page, equal paths are one node."""

    def __init__(self) -> None:
        self.parent, self.labels, self.article = [-1], [""], [False]
        self.children: list[dict[str, int]] = [{}]

    def child(self, node: int, label: str) -> int:
        found = self.children[node].get(label)
        if found is None:
            found = self.children[node][label] = len(self.parent)
            self.parent.append(node)
            self.labels.append(label)
            self.article.append(self.article[node] or label.split(".", 1)[0] in ("article", "main"))
            self.children.append({})
        return found

    def text(self, node: int) -> str:
        labels = []
        while node > 0:
            labels.append(self.labels[node])
            node = self.parent[node]
        return "".join(f"/{x}" for x in reversed(labels))

    def find(self, path: str) -> int | None:
        node: int | None = 0
        for label in path.split("/")[1:]:
            node = self.children[node].get(label)
            if node is None:
                return None
        return node

    def under(self, top: int) -> list[bool]:
        """Whether each node is the given one or below it (parents come before children)."""
        below = [False] * len(self.parent)
        below[top] = True
        for i in range(top + 1, len(below)):
            below[i] = below[i] or below[self.parent[i]]
        return below


class Block:
    __slots__ = ("node", "text", "link", "heading", "doubt")

    def __init__(self, node: int, text: str, link: int, heading: bool = False, doubt: bool = False):
        self.node, self.text, self.link, self.heading, self.doubt = node, text, link, heading, doubt

    @property
    def gain(self) -> float:
        """Its text less that of links; little in a doubtful container."""
        return max(0.0, len(self.text) - 2.0 * self.link) * (PENALTY if self.doubt else 1.0)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)} if source.strip(" /") else {}


def _is_boilerplate(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in SKIPPED or tag in ("svg", "annotation", "annotation-xml") or (tag == "header" and not inside_article):
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    if tag not in MARKED:
        return False
    id_ = attributes.get("id", "")
    named = f"{attributes.get('class', '')} {attributes.get('role', '')}"
    # The id of a section is the slug of its heading.
    slugless = named if tag == "section" else f"{named} {id_}"
    if inside_article:
        return any(_is_pure(t, BOILERPLATE) for t in slugless.split())
    if any(w.lower() in BOILERPLATE for w in _WORDS.findall(f"{named} {id_}")):
        return True
    return any(_is_pure(t, AMBIGUOUS) for t in slugless.split())


def _is_pure(token: str, names: frozenset[str]) -> bool:
    """Whether a token holds one of the names and beside it only words that mark boilerplate or say nothing."""
    words = [w.lower() for w in _WORDS.findall(token)]
    return any(w in names for w in words) and all(
        w in BOILERPLATE or w in AMBIGUOUS or w in STRUCTURE or len(w) < 3 for w in words
    )


def _is_doubtful(tag: str, attributes: dict[str, str]) -> bool:
    """Whether ambiguous words lower the score of a container inside an article."""
    if tag not in MARKED or not attributes:
        return False
    return any(_is_pure(t, AMBIGUOUS) for t in f"{attributes.get('class', '')} {attributes.get('role', '')}".split())


def _label(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(_NUMBERS.sub("#", attributes.get("class", "").lower().replace("/", "|")).split()))
    return ".".join([tag, *classes])


def blocks(source: str) -> tuple[list[Block], Paths]:
    """The text blocks of a page in page order, without boilerplate, and its containers."""
    found: list[Block] = []
    paths = Paths()
    # Open elements: (tag, container, skipped, inside an article, inside a heading, doubtful), and how many of each tag.
    stack: list[tuple[str, int, bool, bool, bool, bool]] = [("", 0, False, False, False, False)]
    opened: Counter[str] = Counter()
    foreign: list[int] = []  # places of open elements of foreign markup (or back from it) in the stack
    pieces: list[str] = []
    link = 0
    path = 0

    def flush() -> None:
        nonlocal link
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append(Block(path, text, link, stack[-1][4], stack[-1][5]))
            pieces.clear()
        link = 0

    def close(depth: int) -> None:
        for element in stack[depth:]:
            opened[element[0]] -= 1
        del stack[depth:]
        while foreign and foreign[-1] >= depth:
            foreign.pop()

    # No tag ends behind the last ">": what follows is text, whatever it looks like.
    at, n, last = 0, len(source), source.rfind(">") + 1
    while at < n:
        m = _TAG.search(source, at, last) if at < last else None
        text = source[at : m.start()] if m else source[at:]
        if not m and "<!--" in text:
            text = text[: text.index("<!--")]
        top = stack[-1]
        if text and not top[2]:
            pieces.append(text)
            if opened["a"]:
                link += len(text)
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break  # a comment without an end
            continue
        tag = name.lower()
        if m[1]:
            if tag in BLOCKS:
                flush()
            if opened[tag]:
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
                if any(x[0] in BLOCKS for x in stack[depth:]):
                    flush()
                close(depth)
                path = stack[-1][1]
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at, max(last, at))
                at = end.end() if end else n
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if foreign and stack[foreign[-1]][0] in FOREIGN:
                close(foreign[-1])
            closing = CLOSES.get(tag, set())
            if tag != "p":
                closing = closing | {"p"}
            if any(opened[t] for t in closing):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in closing:
                        close(i)
                        break
                    if stack[i][0] in CONTAINERS or stack[i][0] in ("ul", "ol", "dl", "blockquote"):
                        break
            path = stack[-1][1]
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        top = stack[-1]
        attributes = _attributes(m[3])
        skipped = top[2] or _is_boilerplate(tag, attributes, top[3])
        own = paths.child(top[1], _label(tag, attributes)) if tag in CONTAINERS else top[1]
        article = top[3] or tag in ("article", "main")
        doubtful = top[5] or article and _is_doubtful(tag, attributes)
        if tag in FOREIGN or tag == "foreignobject":
            foreign.append(len(stack))
        stack.append((tag, own, skipped, article, top[4] or tag in HEADINGS, doubtful))
        opened[tag] += 1
        path = own
    flush()
    return found, paths


class Scores:
    """Sums over every container of a page and all below it."""

    def __init__(self, found: list[Block], paths: Paths):
        n = len(paths.parent)
        self.paths = paths
        self.score, self.direct = [0.0] * n, [0] * n  # score; blocks directly in the container
        self.prose, self.article = [0] * n, [0] * n  # blocks of prose; blocks inside an article
        for b in found:
            gain = b.gain
            if gain > 0:
                self.score[b.node] += gain
                self.direct[b.node] += 1
                self.article[b.node] += paths.article[b.node]
                self.prose[b.node] += bool(paths.article[b.node] or b.heading or _SENTENCE.search(b.text))
        for i in range(n - 1, 0, -1):
            for sums in (self.score, self.prose, self.article):
                sums[paths.parent[i]] += sums[i]
        self.total = sum(self.score[c] for c in paths.children[0].values())

    def around(self, node: int) -> int:
        """Blocks that stand directly in a container around the node."""
        count, node = 0, self.paths.parent[node]
        while node >= 0:
            count += self.direct[node]
            node = self.paths.parent[node]
        return count

    def decides(self, node: int) -> bool:
        """Whether a page is extracted with its host's path, the node."""
        if self.around(node) or self.article[0] > self.article[node]:
            return False
        return self.prose[0] == self.prose[node] or self.score[node] >= SHARE * self.total


def best_path(found: list[Block], paths: Paths, share: float = SHARE) -> tuple[int, float]:
    """The deepest container that holds most of the page's score and leaves no prose behind, and its score.

    Prose is text beside links that stands directly in a container around the path or inside an
    article or main element, or that is a heading or holds a sentence."""
    sums = Scores(found, paths)
    node, around = 0, 0
    while True:
        below = paths.children[node]
        deeper = max(below.values(), key=lambda c: (sums.score[c], paths.labels[c]), default=0)
        around += sums.direct[node]
        if not deeper or sums.score[deeper] < share * sums.total or sums.score[deeper] <= 0 or around or sums.prose[0] > sums.prose[deeper]:
            return node, sums.score[node] if node else 0.0
        node = deeper


def extract(source: str | None, host_path: str | None) -> tuple[str, str]:
    """The text under the host's path (or the page's own choice), and the path used."""
    found, paths = blocks(source or "")

    def text_under(node: int) -> list[str]:
        below = paths.under(node)
        return [b.text for b in found if below[b.node]]

    if host_path is not None:
        node = paths.find(host_path)
        own = text_under(node) if node is not None and Scores(found, paths).decides(node) else []
        if own:
            return "\n\n".join(own), host_path
    node = best_path(found, paths)[0]
    own = text_under(node)
    return ("\n\n".join(own), paths.text(node)) if own else ("", host_path or "")


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def own_choice(source: str) -> tuple[str, float]:
    """The path of a page's own choice and its score."""
    found, paths = blocks(source)
    node, score = best_path(found, paths)
    return paths.text(node), score


def page_choices(pages: DataFrame) -> DataFrame:
    """host, path and score of every page's own choice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            chosen = [own_choice(h or "") for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("host"), pa.array([c[0] for c in chosen], pa.string()), pa.array([c[1] for c in chosen], pa.float64())],
                names=["host", "path", "score"],
            )

    return pages.select("host", "html").mapInArrow(run, "host string, path string, score double")


def host_paths(pages: DataFrame) -> DataFrame:
    """The winning path of every host with text (host, path, votes)."""
    votes = page_choices(pages).where("score > 0").groupBy("host", "path").agg(
        F.count("*").alias("votes"), F.sum("score").alias("score")
    )
    winner = F.min(F.struct(-F.col("votes"), -F.col("score"), F.col("path").alias("path"), F.col("votes").alias("votes")))
    return votes.groupBy("host").agg(winner.alias("w")).select("host", "w.path", "w.votes")


EXTRACTED = "page_id bigint, url string, text string, n_chars bigint, path string, voted boolean"


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, the path used and whether it is the host's."""
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    winners = materialize(host_paths(pages), "host_paths").select(
        "host", F.col("path").alias("host_path"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    met = salted.join(winners, ["host", "salt"], "left").select("page_id", "url", "html", "host_path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            hosts = part.column("host_path").to_pylist()
            made = [extract(h, p) for h, p in zip(part.column("html").to_pylist(), hosts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array([m[0] for m in made], pa.string()),
                 pa.array([len(m[0]) for m in made], pa.int64()), pa.array([m[1] for m in made], pa.string()),
                 pa.array([p is not None and m[1] == p for m, p in zip(made, hosts)], pa.bool_())],
                names=["page_id", "url", "text", "n_chars", "path", "voted"],
            )

    return met.mapInArrow(run, EXTRACTED)


def op8_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
