"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic
function of its words' weights, and the document's is their noisy-or,
``1 - prod(1 - p)``. Only document labels are known; the weights are trained by
gradient ascent on the documents' log-likelihood, which shares a document's
label among its sentences by their responsibility, and the trained sentence
scores then locate the offending sentences.

Sentences end at ``.``, ``!`` or ``?`` at the end of a word, and at line ends.
Features are lower-case runs of letters and their proper beginnings of
:data:`STEMS` letters, hashed to 2^:data:`BITS` places and counted once a
sentence. Only features that documents of label 1 hold clearly more often than
chance has it (:data:`MIN_Z` standard deviations) get weights. A sentence without
such a feature tells nothing: its probability is 0, so that a text's length alone adds
nothing to its score. The model is fitted on a bounded sample of labelled rows outside the held-out bucket
(:data:`SAMPLE_DOCS` documents of at most :data:`SAMPLE_CHARS` characters);
scoring reads every whole text.

Defined results: null and empty texts have no sentence and score 0; with no
training rows, or none of label 1, every score is 0; repeated rows are scored
alike; null ids are kept (held_out is then null); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import Tokens, crc_bucket, mix64, read_table, release_memory, segment_sum, text_slices
from fundlake.llm.nbsvm_quality import labelled_sample

BITS = 22
SAMPLE_DOCS = 8000
SAMPLE_CHARS = 20_000
#: Texts of the sample that are taken apart at a time.
PIECE = 250
STEPS = 150
RATE = 0.3
DECAY = 1e-4
PRIOR = -6.0
MIN_Z = 6.0
STEMS = (4, 5, 6, 7, 8)

_LETTERS = re.compile(r"[^\W\d_]+")


class Sentences:
    """Sentences of a slice of texts as distinct hashed words.

    ``places`` holds the words' hash places sentence by sentence, ``words`` the
    range of each sentence and ``bags`` the sentence range of each text.
    """

    def __init__(self, texts: pa.Array, bits: int = BITS, known: np.ndarray | None = None):
        import xxhash

        # A line end closes a sentence: it becomes a word of its own.
        lined = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " \x1e ")
        tokens = Tokens(lined)
        digest = xxhash.xxh3_64_intdigest
        own, size, stop, line = [], [], [], []
        for word in tokens.words.to_pylist():
            runs = _LETTERS.findall(word.lower())
            before = len(own)
            for r in runs:
                own.append(digest(r))
                own.extend(digest(r[:k] + "-") for k in STEMS if len(r) > k)
            size.append(len(own) - before)
            line.append(word == "\x1e")
            stop.append(line[-1] or word[-1] in ".!?")
        size, stop, line_end = np.array(size, np.int64), np.array(stop, bool), np.array(line, bool)
        hashed = mix64(np.array(own, np.uint64)) >> np.uint64(64 - bits) if own else np.zeros(0, np.uint64)
        if known is not None:  # features without a weight are dropped before they are spread out
            told = known[hashed.astype(np.int64)]
            size = np.diff(np.concatenate([[0], np.cumsum(told)])[np.concatenate([[0], np.cumsum(size)])])
            hashed = hashed[told]
        codes, n = tokens.codes, len(tokens.offsets) - 1
        # A sentence begins with a text and behind a word that ends one.
        begins = np.zeros(len(codes) + 1, bool)
        begins[1:][stop[codes]] = True
        begins[:-1][line_end[codes]] = False  # a line end is no sentence of its own
        begins[tokens.offsets] = True
        first = np.flatnonzero(begins[:-1])
        number = np.cumsum(begins[:-1]) - 1
        length = size[codes]
        starts = (np.cumsum(size) - size)[codes]
        spread = np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        pairs = (number.repeat(length).astype(np.uint64) << np.uint64(bits)) | hashed[spread] if len(spread) else np.zeros(0, np.uint64)
        distinct = np.unique(pairs)
        self.places = (distinct & np.uint64((1 << bits) - 1)).astype(np.int64)
        self.words = np.searchsorted(distinct, np.arange(len(first) + 1, dtype=np.uint64) << np.uint64(bits))
        self.bags = np.searchsorted(first, tokens.offsets)
        self.first_token = first
        self.n = n


    @classmethod
    def joined(cls, parts: list["Sentences"]) -> "Sentences":
        """The sentences of several slices of texts as those of one."""
        whole = cls.__new__(cls)
        whole.places = np.concatenate([p.places for p in parts])
        whole.words, whole.bags = (
            np.concatenate([[0], *(own[1:] + before for own, before in zip(each, np.cumsum([0, *(v[-1] for v in each)])))])
            for each in ([p.words for p in parts], [p.bags for p in parts])
        )
        whole.n = sum(p.n for p in parts)
        return whole


class MilModel:
    def __init__(self, texts: list[str], y: np.ndarray, bits: int = BITS):
        self.bits, self.bias = bits, PRIOR
        self.known, self.weights = np.zeros(1 << bits, bool), np.zeros(1 << bits, np.float32)
        self.blind = not len(y) or y.max() == 0
        if self.blind:
            return
        pieces = [(a, pa.array(texts[a : a + PIECE], pa.large_string())) for a in range(0, len(texts), PIECE)]
        docs_with, hits = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for a, piece in pieces:
            bag = Sentences(piece, bits)
            per_doc = np.repeat(np.arange(a, a + bag.n), np.diff(bag.words[bag.bags]))
            pairs = np.unique(per_doc * (1 << bits) + bag.places)
            place = pairs & ((1 << bits) - 1)
            docs_with += np.bincount(place, minlength=1 << bits)
            hits += np.bincount(place[y[pairs >> bits] == 1], minlength=1 << bits)
        share = min(y.mean(), 0.99)
        z = (hits - docs_with * share) / np.sqrt(np.maximum(docs_with, 1) * share * (1 - share))
        self.known = z >= MIN_Z
        bag = Sentences.joined([Sentences(piece, bits, self.known) for _, piece in pieces])
        release_memory()
        used = np.flatnonzero(self.known)
        at = np.searchsorted(used, bag.places)
        start = np.log((hits + 0.5) / (docs_with - hits + 0.5)) - np.log(share / (1 - share))
        weights, bias = start[used].astype(float), PRIOR
        sentence = np.repeat(np.arange(len(bag.words) - 1), np.diff(bag.words))
        owner = np.repeat(np.arange(bag.n), np.diff(bag.bags))
        squares, bias_square = np.full(len(used), 1e-8), 1e-8
        for _ in range(STEPS):
            p, q = self._scores(weights[at], bias, bag)
            # d log-likelihood / d margin of a sentence: -p for label 0, and for
            # label 1 its responsibility p * (1 - q) / q.
            part = np.where(y[owner] == 1, p * (1 - q[owner]) / np.maximum(q[owner], 1e-9), -p)
            slope = np.bincount(at, part[sentence], minlength=len(used)) - DECAY * len(y) * weights
            squares += slope**2
            weights = weights + RATE * slope / np.sqrt(squares)
            tilt = part.sum()
            bias_square += tilt**2
            bias += RATE * tilt / np.sqrt(bias_square)
        self.weights[used], self.bias = weights, bias

    @staticmethod
    def _scores(weights: np.ndarray, bias: float, bag: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """Sentence probabilities and the documents' noisy-or; ``weights`` of each feature of the bag."""
        margin = np.clip(segment_sum(weights, bag.words) + bias, -30, 30)
        told = np.diff(bag.words) > 0  # sentences without a weighted feature add nothing
        p = np.where(told, 1 / (1 + np.exp(-margin)), 0.0)
        # log(1 - p) = -log(1 + e^margin)
        quiet = segment_sum(np.where(told, -np.log1p(np.exp(margin)), 0.0), bag.bags)
        return p, -np.expm1(quiet)

    def sentences(self, texts: pa.Array) -> tuple[Sentences, np.ndarray, np.ndarray]:
        """The sentences of texts, their scores and the texts' scores."""
        bag = Sentences(texts, self.bits, self.known)
        if self.blind:
            return bag, np.zeros(len(bag.words) - 1), np.zeros(bag.n)
        p, q = self._scores(self.weights[bag.places].astype(float), self.bias, bag)
        return bag, p, np.clip(q, 0.0, 1.0)

    def score(self, texts: pa.Array) -> np.ndarray:
        return self.sentences(texts)[2]


LOCATED = "doc_id bigint, score double, worst_sentence int, worst_score double, offending array<int>"


def locate(docs: DataFrame, model: MilModel, threshold: float = 0.5) -> DataFrame:
    """Document score, the worst sentence and the numbers of all offending ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mil = shared.value
        for part in text_slices(batches, "text"):
            bag, p, q = mil.sentences(part.column("text"))
            worst, top, bad = [], [], []
            for a, b in zip(bag.bags, bag.bags[1:]):
                own = p[a:b]
                worst.append(int(own.argmax()) if b > a else None)
                top.append(float(own.max()) if b > a else 0.0)
                bad.append(np.flatnonzero(own >= threshold).tolist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(q), pa.array(worst, pa.int32()),
                 pa.array(top, pa.float64()), pa.array(bad, pa.list_(pa.int32()))],
                names=["doc_id", "score", "worst_sentence", "worst_score", "offending"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, LOCATED)


def op5_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = MilModel(*labelled_sample(docs, labels, "toxic", 0, 5, SAMPLE_DOCS, SAMPLE_CHARS))
    return locate(docs, model).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_sentence", "worst_score", "offending",
    )
