"""Ranked lexical search of all items over all documents with two trees.

A document is a sparse vector of its terms' impacts, an item one of its terms' weights
(times their repeats), and a score is their product. Both sides stand in hierarchies
whose nodes hold the largest value of every coordinate below them, so the product of
two nodes bounds the score of any item of the one with any document of the other. A pair
of nodes is left out when its bound is under the weakest k-th score of the node's items;
all numbers are whole, bounds are exact, and equal ones are followed, so no result and
no tie is lost.

Spark does it in three passes. The first cuts every text into terms once and writes each
document's counts of the items' terms (a small part of the text). Term and corpus statistics
are sums over that table. The search then reads the table: every task builds a tree over
:func:`tree_rows` documents at a time and searches it with the broadcast tree of items, its
k-th scores carried from tree to tree. A first search of a sixteenth of the documents
gives every item a score that k documents are known to reach; the search of all documents
starts from it, so that tasks return few rows beyond the result.

Items are searched in blocks of distinct texts with about :data:`BLOCK_CHARS` characters in
all, one search of all documents per block: what is broadcast is bounded by the block, not
by the number of items (a single longer item is a block's worst case).

Defined results: null and termless documents count for nothing and are never ranked; null
and termless items have no rows; repeated rows of either side stand for themselves; equal
scores go by doc_id, null ids first; no documents or no items give no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Tokens, read_table, release_memory, segment_sum, text_slices
from fundlake.session import materialize

TOP = 10
BLOCK_CHARS = 400_000
ITEM_LEAF, DOC_LEAF = 8, 32
#: Numbers in one tree's dense matrix of documents by terms, and its most rows.
TREE_CELLS, TREE_ROWS = 8_000_000, 2048
#: One in so many documents is searched first for scores to start from.
FIRST_OF = 16
NO_ID = -(1 << 63)

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of a text to bytes of its terms: A-Z lower-cased, ASCII marks to spaces.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_BYTES[ord("A") : ord("Z") + 1] += 32


def terms(texts: pa.Array) -> Tokens:
    """The terms of a slice of texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = texts.take(pa.array(np.arange(len(texts))))  # a slice's own buffers
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    mapped = pa.Array.from_buffers(pa.large_string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(_BYTES[raw].tobytes())])
    return Tokens(mapped, lower=False)


def terms_of(text: str) -> list[str]:
    found = terms(pa.array([text], pa.large_string()))
    words = found.words.to_pylist()
    return [words[c] for c in found.codes]


@dataclass
class Sparse:
    """Rows of (code, value) pairs; ``starts`` has one more entry than there are rows."""

    starts: np.ndarray
    codes: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        size = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.starts[rows] - starts[:-1], size) + np.arange(starts[-1])
        return Sparse(starts, self.codes[at], self.values[at])

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.codes[self.starts[i] : self.starts[i + 1]], self.values[self.starts[i] : self.starts[i + 1]]

    def product(self, dense: np.ndarray) -> np.ndarray:
        return segment_sum(self.values * dense[self.codes], self.starts)


@dataclass
class Node:
    first: int  # rows from first to last (not included) in tree order
    last: int
    children: tuple[int, ...] = ()


def grow(rows: Sparse, width: int, leaf: int) -> tuple[np.ndarray, list[Node]]:
    """The order of the rows and the nodes of a tree over them, the root first. A node is
    halved between two unlike rows: the heaviest one and the one least like it."""
    orders: list[np.ndarray] = []
    nodes: list[Node] = []
    done = 0

    def add(own: np.ndarray) -> int:
        nonlocal done
        me = len(nodes)
        nodes.append(Node(done, done + len(own)))
        if len(own) <= leaf:
            orders.append(own)
            done += len(own)
            return me
        part = rows.take(own)
        total = np.maximum(segment_sum(part.values.astype(np.float64), part.starts), 1.0)
        like = part.product(spread(part, int(np.argmax(total)), width)) / total
        unlike = part.product(spread(part, int(np.argmin(like)), width)) / total
        own = own[np.argsort(unlike - like, kind="stable")]
        nodes[me].children = (add(own[: len(own) // 2]), add(own[len(own) // 2 :]))
        return me

    add(np.arange(len(rows)))
    return np.concatenate(orders), nodes


def spread(rows: Sparse, i: int, width: int) -> np.ndarray:
    dense = np.zeros(width)
    codes, values = rows.row(i)
    dense[codes] = values
    return dense


class ItemTree:
    """The items of a block: per node its largest weights, per leaf the weights themselves."""

    def __init__(self, weights: Sparse, width: int, dtype: type):
        self.order, self.nodes = grow(weights, width, ITEM_LEAF)
        rows = weights.take(self.order)
        self.bounds: list[tuple[np.ndarray, np.ndarray]] = []
        self.leaves: dict[int, np.ndarray] = {}
        for k, node in enumerate(self.nodes):
            span = slice(rows.starts[node.first], rows.starts[node.last])
            codes, place = np.unique(rows.codes[span], return_inverse=True)
            largest = np.zeros(len(codes), dtype)
            np.maximum.at(largest, place, rows.values[span].astype(dtype))
            self.bounds.append((codes, largest))
            if not node.children:
                own = np.zeros((len(codes), node.last - node.first), dtype)
                size = np.diff(rows.starts[node.first : node.last + 1])
                own[place, np.repeat(np.arange(node.last - node.first), size)] = rows.values[span]
                self.leaves[k] = own


class DocTree:
    """Some documents: a dense matrix in tree order and per node its largest impacts."""

    def __init__(self, impacts: Sparse, ids: np.ndarray, width: int, dtype: type):
        order, self.nodes = grow(impacts, width, DOC_LEAF)
        rows = impacts.take(order)
        self.ids = ids[order]
        self.matrix = np.zeros((len(rows), width), dtype)
        self.matrix[np.repeat(np.arange(len(rows)), np.diff(rows.starts)), rows.codes] = rows.values
        self.bounds = np.zeros((len(self.nodes), width), dtype)
        for k in range(len(self.nodes) - 1, -1, -1):  # children stand behind their parent
            node = self.nodes[k]
            if node.children:
                np.maximum(self.bounds[node.children[0]], self.bounds[node.children[1]], out=self.bounds[k])
            else:
                self.bounds[k] = self.matrix[node.first : node.last].max(axis=0)


class Search:
    """The best documents of every item so far (items in tree order)."""

    def __init__(self, items: ItemTree, floors: np.ndarray, top: int = TOP):
        self.items, self.top = items, top
        self.floors = np.maximum(floors[items.order], 1)  # a score above 0 is 1 or more
        self.kth = self.floors.copy()
        self.scores = [np.empty(0)] * len(self.kth)
        self.ids = [np.empty(0, np.int64)] * len(self.kth)
        self.scored = 0  # item-document pairs whose score was computed

    def add(self, docs: DocTree) -> None:
        self._visit(0, np.zeros(1, np.int64), docs)

    def _visit(self, item: int, nodes: np.ndarray, docs: DocTree) -> None:
        codes, largest = self.items.bounds[item]
        node = self.items.nodes[item]
        bounds = docs.bounds[np.ix_(nodes, codes)] @ largest
        kept = bounds >= self.kth[node.first : node.last].min()
        nodes, bounds = nodes[kept], bounds[kept]
        if not len(nodes):
            return
        if not node.children and not any(docs.nodes[n].children for n in nodes):
            self._score(item, nodes[np.argsort(-bounds, kind="stable")], np.sort(bounds)[::-1], docs)
            return
        below = np.array([c for n in nodes for c in (docs.nodes[n].children or (n,))])
        for child in node.children or (item,):
            self._visit(child, below, docs)

    def _score(self, item: int, nodes: np.ndarray, bounds: np.ndarray, docs: DocTree) -> None:
        codes, weights = self.items.bounds[item][0], self.items.leaves[item]
        node = self.items.nodes[item]
        kth = self.kth[node.first : node.last]  # a view: follows the scores found
        for n, bound in zip(nodes, bounds):
            if bound < kth.min():
                return
            rows = slice(docs.nodes[n].first, docs.nodes[n].last)
            scores = docs.matrix[rows][:, codes] @ weights
            self.scored += scores.size
            for j in np.nonzero((scores >= kth).any(axis=0))[0]:
                self._keep(node.first + j, scores[:, j], docs.ids[rows])

    def _keep(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.kth[i]
        scores = np.concatenate([self.scores[i], scores[good]])
        ids = np.concatenate([self.ids[i], ids[good]])
        best = np.lexsort((ids, -scores))[: self.top]
        self.scores[i], self.ids[i] = scores[best], ids[best]
        if len(best) == self.top:
            self.kth[i] = max(self.floors[i], scores[best[-1]])


def tree_rows(width: int) -> int:
    """Documents of one tree: its dense matrix holds TREE_CELLS numbers at most, or 64 rows."""
    return min(TREE_ROWS, max(64, TREE_CELLS // max(width, 1)))


COUNTS = "doc_id bigint, n bigint, codes array<int>, tfs array<bigint>"


def term_counts(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, n, codes, tfs): per document its number of terms and its counts of the vocabulary's."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for part in text_slices(batches, "text", 4 << 20):
            found = terms(part.column("text"))
            code = np.array([known.get(w, -1) for w in found.words.to_pylist()], np.int64)[found.codes]
            sizes = np.diff(found.offsets)
            row = np.repeat(np.arange(len(sizes)), sizes)
            keys, tfs = np.unique(row[code >= 0] * len(known) + code[code >= 0], return_counts=True)
            offsets = pa.array(np.searchsorted(keys, np.arange(len(sizes) + 1) * len(known)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes),
                 pa.ListArray.from_arrays(offsets, pa.array((keys % len(known)).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int64)))],
                names=["doc_id", "n", "codes", "tfs"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, COUNTS)


def document_frequencies(counts: DataFrame, width: int) -> np.ndarray:
    """How many documents hold each term: every task returns one row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("codes").flatten().to_numpy(zero_copy_only=False), minlength=width)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["code", "df"])

    sums = counts.select("codes").mapInArrow(run, "code bigint, df bigint").groupBy("code").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(width, np.int64)
    df[sums["code"].to_numpy()] = sums["df"].to_numpy()
    return df


def impacts(counts: pa.RecordBatch, n_docs: int, n_terms: int) -> Sparse:
    """A batch of counts as rows of (1000000000 tf) div (1000 tf + 8 m)."""
    codes, tfs = counts.column("codes"), counts.column("tfs").flatten().to_numpy(zero_copy_only=False)
    starts = codes.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    n = counts.column("n").to_numpy(zero_copy_only=False)
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    per = np.repeat(m, np.diff(starts))
    return Sparse(starts - starts[0], codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64), (1_000_000_000 * tfs) // (1000 * tfs + 8 * per))


def weights(texts: list[str], vocabulary: dict[str, int], df: np.ndarray, n_docs: int) -> Sparse:
    """Every item's term weights, repeats included."""
    w = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    starts, codes, values = [0], [], []
    for text in texts:
        found = sorted(Counter(vocabulary[t] for t in terms_of(text)).items())
        codes += [c for c, _ in found]
        values += [w[c] * times for c, times in found]
        starts.append(len(codes))
    return Sparse(np.array(starts, np.int64), np.array(codes, np.int64), np.array(values, np.int64))


def best_documents(counts: DataFrame, tree: ItemTree, floors: np.ndarray, width: int, dtype: type, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(no, doc_id, score, rank): the best documents of every item (no: its place in the block)."""
    held = counts.sparkSession.sparkContext.broadcast((tree, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, floors = held.value
        search, size = Search(tree, floors, top), tree_rows(width)
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("codes")), 0))
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids = part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                search.add(DocTree(impacts(part, n_docs, n_terms), ids, width, dtype))
        no = np.repeat(tree.order, [len(s) for s in search.scores])
        scores = np.concatenate([np.empty(0), *search.scores]).astype(np.int64)
        ids = np.concatenate([np.empty(0, np.int64), *search.ids])
        del search
        release_memory()
        yield pa.RecordBatch.from_arrays(
            [pa.array(no.astype(np.int64)), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], names=["no", "doc_id", "score"])

    found = counts.select("doc_id", "n", "codes", "tfs").mapInArrow(run, "no bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("no").orderBy(F.col("score").desc(), F.col("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, texts: list[str], top: int = TOP) -> DataFrame:
    """(text, rank, doc_id, score) for the distinct item texts of one block."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for text in texts for t in terms_of(text)))}
    width = len(vocabulary)
    counts = materialize(term_counts(docs, vocabulary), "term-counts")
    n_docs, n_terms = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    schema = "text string, rank int, doc_id bigint, score bigint"
    if not n_docs:
        return spark.createDataFrame([], schema)
    rows = weights(texts, vocabulary, document_frequencies(counts, width), n_docs)
    # Impacts stay under 1000000, so scores are exact in doubles unless an item's weights are huge.
    dtype = np.float64 if 1_000_000 * segment_sum(rows.values, rows.starts).max() < 2**53 else np.int64
    tree = ItemTree(rows, width, dtype)
    floors = np.zeros(len(texts), dtype)
    first = counts.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST_OF)) == 0)
    args = (width, dtype, n_docs, n_terms, top)
    for r in best_documents(first, tree, floors, *args).where(F.col("rank") == top).select("no", "score").collect():
        floors[r.no] = r.score  # one row per item of the block
    found = materialize(best_documents(counts, tree, floors, *args), "best-documents")
    named = spark.createDataFrame(list(enumerate(texts)), "no bigint, text string")
    return found.join(named, "no").select("text", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score) of every row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    texts = items.where(F.col("text").rlike(TERM)).select("text").distinct()
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(chars / block_chars))
    found = spark.createDataFrame([], "text string, rank int, doc_id bigint, score bigint")
    for block in range(blocks):
        own = [r.text for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()]
        if own:
            found = found.unionByName(search_block(docs, sorted(own), top))
    return items.select("item_id", "text").join(found, "text").select("item_id", "rank", "doc_id", "score")


def op12_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def oracle() -> str:
    """DuckDB: every item's score for every document that holds a term of it."""
    split = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"
    return f"""
WITH words AS (SELECT row_number() OVER () AS row, doc_id, {split} AS t FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT row, doc_id, CAST(len(t) AS BIGINT) AS n FROM words WHERE len(t) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sizes),
items AS (SELECT row_number() OVER () AS item, item_id, unnest({split}) AS term FROM benchmark),
tf AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(t) AS term FROM words)
       WHERE term IN (SELECT term FROM items) GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, big_n),
scored AS (SELECT item, item_id, doc_id, row,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
           FROM items JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (row), corpus
           GROUP BY item, item_id, doc_id, row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
