"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte model over words. A word is coded as
its bytes followed by an end mark (byte 0x20); the context of a byte is the up
to ``ORDER`` bytes before it in the same word, the longest first. A context
that was not seen in training is skipped free of charge; in a seen context the
byte costs its share of the symbol counts, or an escape (method C: one count
per distinct symbol) followed by the next shorter context; below the empty
context all 256 byte values are alike. The statistics are frozen after
training, so a word has one exact code length per language and a text's code
length is the sum over its words, whatever its length.

Code lengths are computed once per distinct word of a slice of texts (in
chunks of :data:`CHUNK` words), so memory does not grow with the text.

The models are fitted on a bounded sample of the labelled rows
(:data:`SAMPLE_DOCS` documents and :data:`SAMPLE_CHARS` characters a language,
both taken in hash order of the distinct texts), so the broadcast model has a proven size bound;
prediction reads every whole text.

Defined results: a null, empty or letterless text gets ``und`` with score 0;
ties go to the alphabetically first language; repeated rows are predicted
alike; with no training rows every text gets ``und``; extra columns of the
input are ignored, null ids are kept (held_out is then null).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Tokens, crc_bucket, has_letter, read_table, segment_sum, string_bytes, text_slices

ORDER = 4
SAMPLE_DOCS = 200
SAMPLE_CHARS = 250_000
#: Texts that the characters of a language's sample suffice for at least.
MIN_TEXTS = 10
CHUNK = 50_000
SLICE = 2 << 20
UNDETERMINED = "und"
END = 0x20

RESULT = "doc_id bigint, lang_pred string, score double, bits_per_byte double"


def training_sample(
    docs: DataFrame, max_docs: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS
) -> dict[str, list[str]]:
    """At most ``max_docs`` texts and about ``max_chars`` characters for each language.

    Equal texts count once, and of a text at most ``max_chars / MIN_TEXTS`` characters
    are taken (its whole words up to there), so a model rests on many texts. The
    result on the driver is bounded by languages x ``max_chars``.
    """
    most = max(max_chars // MIN_TEXTS, 1)
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    hashed = usable.select("lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    by_hash = Window.partitionBy("lang").orderBy("h", "n")
    # Two levels: the first of each language in 16 parts, then of the language,
    # so that no task ranks a whole language. The texts follow for the chosen only.
    parts = Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy("h", "n")
    few = hashed.distinct().withColumn("r", F.row_number().over(parts)).where(F.col("r") <= max_docs)
    few = few.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= max_docs)
    running = few.withColumn("upto", F.sum(F.least("n", F.lit(most))).over(by_hash.rowsBetween(Window.unboundedPreceding, 0)))
    kept = running.where(F.col("upto") <= max_chars).select("lang", "h", "n", "r")
    texts = usable.select(
        "lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"), F.substring("text", 1, most + 1).alias("text")
    )
    chosen = texts.join(F.broadcast(kept), ["lang", "h", "n"]).groupBy("lang", "r").agg(F.max("text").alias("text"))
    out: dict[str, list[str]] = defaultdict(list)
    for row in chosen.orderBy("lang", "r").collect():
        out[row["lang"]].append(_beginning(row["text"], most))
    return dict(out)


def _beginning(text: str, most: int) -> str:
    """The whole words of a text within ``most`` characters (a longer first word is cut)."""
    if len(text) <= most:
        return text
    cut = max(text.rfind(space, 0, most + 1) for space in " \t\n\v\f\r")
    return text[:cut] if cut > 0 else text[:most]


class PpmModel:
    """Frozen per-language byte statistics as sorted arrays, one set per order.

    ``keys[k]`` holds every (context of k bytes, symbol) seen in any language
    and ``logp[k]`` its log2 probability in each language when coding starts at
    that context, escapes and shorter contexts included. ``escape[k]`` holds
    each context's escape cost, for symbols that no language has seen in it.
    """

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.order = order
        self.langs = sorted(samples)
        n = len(self.langs)
        counts = [[Counter() for _ in range(order + 1)] for _ in self.langs]
        for i, lang in enumerate(self.langs):
            tokens = Tokens(pa.array(samples[lang], pa.string()))
            for word, times in zip(tokens.words.to_pylist(), np.bincount(tokens.codes).tolist()):
                symbols = word.encode() + bytes([END])
                for at in range(len(symbols)):
                    for k in range(min(order, at) + 1):
                        counts[i][k][symbols[at - k : at + 1]] += times
        self.keys, self.logp, self.contexts, self.escape = [], [], [], []
        shorter: dict[bytes, int] = {}
        for k in range(order + 1):
            grams = sorted({g for c in counts for g in c[k]})  # equal lengths: byte order is key order
            contexts = sorted({g[:-1] for g in grams})
            where = {c: j for j, c in enumerate(contexts)}
            of = np.array([where[g[:-1]] for g in grams], np.int64)
            seen = np.array([[c[k].get(g, 0) for c in counts] for g in grams], float).reshape(len(grams), n)
            total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                own = np.log2(seen) - np.log2((total + kinds)[of])
                # The escape is free where a language has not seen the context.
                escape = np.where(total > 0, np.log2(kinds) - np.log2(total + kinds), 0.0)
            below = self.logp[k - 1][[shorter[g[1:]] for g in grams]] if k and grams else -8.0
            self.logp.append(np.where(seen > 0, own, escape[of] + below))
            self.escape.append(escape)
            self.keys.append(np.array([_pack(g) for g in grams], np.uint64))
            self.contexts.append(np.array([_pack(c) for c in contexts], np.uint64))
            shorter = {g: j for j, g in enumerate(grams)}

    def word_log2(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """log2 probability of each word (with its end mark) per language, and its symbols."""
        parts = [self._word_log2(words.slice(i, CHUNK)) for i in range(0, len(words), CHUNK)]
        if not parts:
            return np.zeros((0, len(self.langs))), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _word_log2(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = string_bytes(words)
        length = np.diff(offsets)
        symbols = np.insert(data, offsets[1:], END).astype(np.uint64)  # each word, then the end mark
        starts = offsets[:-1] + np.arange(len(words))
        at = np.arange(len(symbols)) - np.repeat(starts, length + 1)  # place in the word
        logp = np.zeros((len(symbols), len(self.langs)))
        open_ = np.arange(len(symbols))
        for k in range(self.order, -1, -1):
            rows = open_[at[open_] >= k]
            context = np.ones(len(rows), np.uint64)
            for back in range(k, 0, -1):
                context = (context << np.uint64(8)) | symbols[rows - back]
            hit, found = _find(self.keys[k], (context << np.uint64(8)) | symbols[rows])
            logp[rows[found]] += self.logp[k][hit[found]]
            seat, known = _find(self.contexts[k], context[~found])
            logp[rows[~found][known]] += self.escape[k][seat[known]]
            done = np.zeros(len(symbols), bool)
            done[rows[found]] = True
            open_ = open_[~done[open_]]
        logp[open_] -= 8.0  # below the empty context: 256 equal byte values
        return segment_sum(logp, np.append(starts, len(symbols))), length + 1

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, its posterior under equal priors, and its bits per byte."""
        tokens = Tokens(texts)
        letters = has_letter(texts)
        n = len(tokens.offsets) - 1
        if not self.langs:
            return [UNDETERMINED] * n, np.zeros(n), np.full(n, np.nan)
        words, sizes = self.word_log2(tokens.words)
        total = np.stack([segment_sum(words[:, i][tokens.codes], tokens.offsets) for i in range(len(self.langs))], 1)
        size = segment_sum(sizes[tokens.codes].astype(float), tokens.offsets)
        best = total.argmax(axis=1)
        top = total[np.arange(n), best]
        score = 1.0 / np.exp2(np.maximum(total - top[:, None], -1000)).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = np.where(size > 0, -top / size, np.nan)
        langs = [self.langs[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
        return langs, np.where(letters, score, 0.0), bits


def _pack(gram: bytes) -> int:
    """Bytes as one integer, with a leading 1 that keeps the length."""
    return int.from_bytes(b"\x01" + gram, "big")


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def identify(docs: DataFrame, model: PpmModel) -> DataFrame:
    """Language, posterior and code length for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = shared.value
        for part in text_slices(batches, "text", SLICE):
            langs, posterior, bits = ppm.predict(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(langs, pa.string()), pa.array(posterior),
                 pa.array(bits, pa.float64(), from_pandas=True)],
                names=["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    return docs.select("doc_id", "text").mapInArrow(score, RESULT)


def fit(docs: DataFrame, held_out: int = 0, buckets: int = 5) -> PpmModel:
    """Train on the labelled rows outside the held-out bucket of ids."""
    learn = docs.where(crc_bucket(F.col("doc_id"), buckets) != held_out)
    return PpmModel(training_sample(learn))


def op7_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs))
    return found.select(
        "doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, min_score: float = 0.5) -> DataFrame:
    """Keep documents whose language is determined: not ``und`` and with a
    posterior of at least ``min_score``; all columns of documents are kept.

    A document is the row's text: ids may repeat, so the texts are scored in
    place and no join on ids is needed.
    """
    columns = docs.columns
    model = fit(docs)
    shared = spark.sparkContext.broadcast(model)
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = shared.value
        for part in text_slices(batches, "text", SLICE):
            langs, posterior, _ = ppm.predict(part.column("text"))
            accepted = [lang != UNDETERMINED and s >= min_score for lang, s in zip(langs, posterior)]
            yield part.filter(pa.array(accepted, pa.bool_()))

    return docs.select(*columns).mapInArrow(keep, schema)
