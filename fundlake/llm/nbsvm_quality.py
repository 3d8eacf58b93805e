"""Quality classifier: naive Bayes support vectors (NB-SVM).

Features are indicators of n-grams: a text's words give unigrams of their
lower-case pieces (runs of letters, digits or marks) and of their shape (case,
digits and marks behind them), and bigrams of neighbouring shapes and of
neighbouring words, each hashed to one of 2^:data:`BITS` places. Every
indicator is scaled by its class log-count ratio
``log((1 + p) / |p|) - log((1 + q) / |q|)`` (p and q: documents of either class
with the feature, smoothed), rows are brought to unit length, and a linear
L2-regularised hinge loss is minimised by dual coordinate descent. A
logistic curve, fitted to margins of left-out folds, turns margins into scores.

The model is fitted on a bounded sample of the labelled rows outside the
held-out bucket: the first :data:`SAMPLE_DOCS` by hash with at most
:data:`SAMPLE_CHARS` characters each. Scoring reads every whole text.

Defined results: null and empty texts have no features and get the score of the
intercept alone; with no training rows, or rows of one class only, scores are
that class's share (0.5 without rows); repeated rows are scored alike; null ids
are kept (held_out is then null); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Tokens, crc_bucket, mix64, read_table, seeds, segment_sum, text_slices

BITS = 18
SAMPLE_DOCS = 4000
SAMPLE_CHARS = 20_000
COST = 1.0
EPOCHS = 30
FOLDS = 4
SLICE = 8 << 20
THRESHOLD = 0.7

_PIECES = re.compile(r"[^\W\d_]+|\d+|[\W_]+")
_SHAPE = seeds(8, 31)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: int, buckets: int,
    max_docs: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS,
) -> tuple[list[str], np.ndarray]:
    """A bounded sample of (text, label) outside the held-out bucket.

    Labels given twice count once if they agree and are left out if not. The
    result on the driver has at most ``max_docs * max_chars`` characters.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("y"), F.max(label).alias("z")
    ).where("y = z")
    # Hash order over the labelled ids, in two levels so that no task ranks them all.
    ids = marks.where(crc_bucket(F.col("doc_id"), buckets) != held_out).withColumn("h", F.xxhash64("doc_id"))
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy(F.pmod("h", F.lit(64))).orderBy("h", "doc_id")))
    per_part = -(-max_docs // 64)
    ids = ids.where(F.col("r") <= per_part).select("doc_id", "y")
    usable = docs.where(F.length("text") <= max_chars).select("doc_id", "text")
    rows = usable.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], np.array([r["y"] for r in rows], np.int64)


def _word_features(word: str) -> tuple[list[str], str]:
    pieces = _PIECES.findall(word)
    shape = []
    for p in pieces:
        if p[0].isalpha():
            shape.append("X" if p.isupper() and len(p) > 1 else "Xx" if p[0].isupper() else "x")
        else:
            shape.append("9" if p[0].isdigit() else p[:3])
    return [p.lower() for p in pieces], "".join(shape)


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, back to back, and the offsets."""
    import xxhash

    tokens = Tokens(texts, lower=False)
    words = tokens.words.to_pylist()
    digest = xxhash.xxh3_64_intdigest
    own, size = [], np.zeros(len(words), np.int64)
    shape, word = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    for i, w in enumerate(words):
        pieces, form = _word_features(w)
        hashes = [digest(p) for p in dict.fromkeys(pieces)]
        own.extend(hashes)
        size[i] = len(hashes)
        shape[i] = digest("shape " + form)
        word[i] = digest(w.lower())
    own = np.array(own, np.uint64)
    starts = np.cumsum(size) - size
    codes, n = tokens.codes, len(tokens.offsets) - 1
    row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(tokens.offsets))
    same = row[:-1] == row[1:]  # bigrams stay inside a text
    length = size[codes]
    spread = np.repeat(starts[codes] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    with np.errstate(over="ignore"):
        shapes, whole = shape[codes], word[codes]
        kinds = [
            (row.repeat(length), own[spread] if len(spread) else own[:0]),
            (row, shapes ^ _SHAPE[0]),
            (row[:-1][same], (shapes[:-1] * _SHAPE[1] + shapes[1:] * _SHAPE[2])[same]),
            (row[:-1][same], (whole[:-1] * _SHAPE[3] + whole[1:] * _SHAPE[4])[same]),
        ]
        places = [(r << np.uint64(bits)) | (mix64(h) >> np.uint64(64 - bits)) for r, h in kinds]
    distinct = np.unique(np.concatenate(places)) if len(codes) else np.zeros(0, np.uint64)
    ends = np.searchsorted(distinct, np.arange(n + 1, dtype=np.uint64) << np.uint64(bits))
    return (distinct & np.uint64((1 << bits) - 1)).astype(np.int64), ends


def log_count_ratio(places: np.ndarray, offsets: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    side = np.repeat(y, np.diff(offsets))
    p = 1.0 + np.bincount(places[side == 1], minlength=size)
    q = 1.0 + np.bincount(places[side == 0], minlength=size)
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights (the last is the intercept) of the hinge loss.

    Every step minimises the dual exactly along one row's variable, which lies between 0
    and the row's cost; rows are visited in a new fixed random order each epoch until the
    largest projected gradient is small. Classes weigh alike in total.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    most = row_costs(y, cost)
    weights, alpha = np.zeros(size + 1), np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(17)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            gradient = sign[i] * (weights[at] @ value + weights[-1]) - 1.0
            step = min(max(alpha[i] - gradient / square[i], 0.0), most[i]) - alpha[i]
            if step:  # none at a bound whose gradient points outward
                worst = max(worst, abs(gradient))
                alpha[i] += step
                weights[at] += step * sign[i] * value
                weights[-1] += step * sign[i]
        if worst < 1e-3:
            break
    return weights


def row_costs(y: np.ndarray, cost: float = COST) -> np.ndarray:
    """The cost of a unit of each row's loss: both classes have the same in total."""
    return cost * 0.5 / np.where(y == 1, (y == 1).mean(), (y == 0).mean())


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's curve, by damped Newton steps."""
    pos, neg = int((y == 1).sum()), int((y == 0).sum())
    goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g = np.array([((p - goal) * margin).sum() + 1e-3 * a, (p - goal).sum()])
        w = p * (1 - p) + 1e-6
        h = np.array([[(w * margin**2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


class NbSvm:
    """Folded weights of one hashed feature each, an intercept and the score's curve."""

    def __init__(self, texts: list[str], y: np.ndarray, bits: int = BITS):
        self.bits, self.weights, self.intercept = bits, None, 0.0
        self.share = float((y == 1).mean()) if len(y) else 0.5
        if not len(y) or y.min() == y.max():
            return
        places, offsets = features(pa.array(texts, pa.large_string()), bits)
        fold = np.arange(len(y)) % FOLDS
        margin = np.zeros(len(y))
        for f in range(FOLDS):
            learn = np.flatnonzero(fold != f)
            if y[learn].min() == y[learn].max():
                learn = np.arange(len(y))
            w, b = self._fit(places, offsets, y, learn)
            margin[fold == f] = self._margin(w, b, places, offsets)[fold == f]
        self.weights, self.intercept = self._fit(places, offsets, y, np.arange(len(y)))
        self.curve = logistic_curve(margin, y)

    def _fit(self, places, offsets, y, learn) -> tuple[np.ndarray, float]:
        size = 1 << self.bits
        picked = np.concatenate([places[offsets[i] : offsets[i + 1]] for i in learn])
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets)[learn])])
        ratio = log_count_ratio(picked, ends, y[learn], size)
        rows = []
        for a, b in zip(ends[:-1], ends[1:]):
            value = ratio[picked[a:b]]
            rows.append((picked[a:b], value / max(np.sqrt(value @ value), 1e-12)))
        w = dual_coordinate_descent(rows, y[learn], size)
        self.ratio = ratio
        return np.stack([w[:-1] * ratio, ratio**2], axis=1), float(w[-1])

    @staticmethod
    def _margin(w: np.ndarray, b: float, places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        sums = segment_sum(w[places], offsets)
        return sums[:, 0] / np.maximum(np.sqrt(sums[:, 1]), 1e-12) + b

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.share)
        a, b = self.curve
        margin = self._margin(self.weights, self.intercept, *features(texts, self.bits))
        return 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))


def classify(docs: DataFrame, model, schema: str = "doc_id bigint, score double") -> DataFrame:
    """The model's score for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(shared.value.score(part.column("text")))],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = NbSvm(*labelled_sample(docs, labels, "quality", 2, 4))
    return classify(docs, model).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
