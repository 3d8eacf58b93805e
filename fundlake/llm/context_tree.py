"""Language-model scoring by context-tree weighting (CTW).

A text is coded as the bytes of its words, a word mark (0x20) behind each, and
an end mark (0x0A). Every byte is coded as eight binary decisions; the context
of a decision is the bits of the byte so far and the up to :data:`DEPTH` bytes
before it (end marks before the text's first byte). Each context of each
depth holds the counts of its zeros and ones and their Krichevsky-Trofimov
block probability, and is weighted half and half with the product of its
one-byte-longer contexts. CTW's block probability depends on counts alone, so
the trees are built from counts of the whole training corpus, in Spark; the
predictive probability of a decision under the frozen trees mixes the KT
estimates of all depths by their posterior weights. A decision whose longer
context never occurred is predicted by the last one that did.

How the work is dealt out (bounded memory, no text is shuffled):

* :func:`document_blocks` turns a block of documents into word numbers, with the
  block's own dictionaries of words and of (context, byte) integers. Only the
  dictionaries are joined with global tables; the values return by block and
  are summed there.
* the counts of byte contexts are partitioned by the last :data:`STEM` bytes of
  the context; deeper levels are one sorted pass over a chunk of whole stems, and
  the few shallow levels are DataFrame aggregations.

Defined results: null, empty and wordless texts consist of the end mark only;
repeated rows are scored each and count each in training; null ids are trained
on and scored (held_out is then null); without training rows counts are 0 and
all decisions are even; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Tokens, crc_bucket, read_table, release_memory, segment_sum, string_bytes, text_slices, unsliced
from fundlake.session import materialize

DEPTH = 5
STEM = 3
MARK, END = 0x20, 0x0A
SLICE = 32 << 20
PART = 1 << 20
WORDS = 4 << 20
CHUNK = 200_000
LOG10_2 = math.log10(2.0)
WORD, GRAM = 0, 1
#: Values of bytes travel as whole multiples of 1 / UNIT.
UNIT = 10_000_000


# --- documents as word numbers, in blocks -----------------------------------

BLOCKS = (
    "block bigint, item bigint, learn boolean, codes array<int>, "
    "words array<string>, counts array<bigint>, grams array<bigint>, gram_counts array<bigint>"
)


def unit_bytes(words: pa.Array, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the coded units: every word with its mark, the end
    mark, and the end marks that stand before a text."""
    data, offsets = string_bytes(words)
    marked = np.insert(data, offsets[1:], MARK)
    ends = offsets + np.arange(len(offsets))
    last = int(ends[-1])
    return np.concatenate([marked, np.full(1 + depth, END, np.uint8)]), np.append(ends, [last + 1, last + 1 + depth])


def gram_parts(
    words: pa.Array, codes: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, part: int = PART
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """The coded bytes of runs of whole documents, of about ``part`` bytes.

    Yields the run's first and last document, its distinct (context, byte)
    integers, the number of each coded byte among them and the documents'
    offsets. ``codes`` number words; ``len(words)`` is the end mark.
    """
    data, starts = unit_bytes(words, depth)
    size = np.diff(starts)
    length = np.concatenate([[0], np.cumsum(size[codes])])[offsets]
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(int(np.searchsorted(length, length[first] + part, side="right")) - 1, first + 1)
        own = codes[offsets[first] : offsets[last]]
        begins = offsets[first:last] - offsets[first]
        units = np.insert(own, begins, len(words) + 1)  # end marks before every text
        each = size[units]
        ends = np.cumsum(each)
        stream = data[np.repeat(starts[units] - (ends - each), each) + np.arange(ends[-1])]
        gram = np.zeros(len(stream), np.int64)
        for back in range(depth, -1, -1):
            gram <<= 8
            gram[back:] |= stream[: len(stream) - back]
        told = np.ones(len(stream), bool)
        at = begins + np.arange(last - first)
        told[np.repeat((ends - each)[at], depth) + np.tile(np.arange(depth), last - first)] = False
        encoded = pa.array(gram[told]).dictionary_encode()
        yield first, last, encoded.dictionary.to_numpy(), encoded.indices.to_numpy(), length[first : last + 1] - length[first]
        first = last


def numbered_words(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a slice of texts, the words' numbers and the texts'
    offsets; texts are cut into words a few megabytes at a time."""
    pieces, offsets = [], [np.zeros(1, np.int64)]
    for piece in text_slices(iter([part]), "text", WORDS):
        tokens = Tokens(piece.column("text"))
        pieces.append(pa.DictionaryArray.from_arrays(pa.array(tokens.codes, pa.int32()), tokens.words.cast(pa.string())))
        offsets.append(offsets[-1][-1] + tokens.offsets[1:])
    whole = pa.chunked_array(pieces).unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in whole.chunks])
    return whole.chunk(0).dictionary, codes, np.concatenate(offsets)


def summed_grams(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, distinct grams and the sums of their counts."""
    kinds, place = np.unique(np.concatenate(grams), return_inverse=True)
    return kinds, np.bincount(place, np.concatenate(counts), minlength=len(kinds)).astype(np.int64)


def document_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents: a row per document (item: doc_id) with its word numbers,
    and a row with the block's words and (context, byte) integers and how often
    its training documents hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part in text_slices(batches, "text", SLICE):
            words, codes, offsets = numbered_words(part)
            n = part.num_rows
            learn = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)
            # Frequent words get small numbers, which take little room.
            order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order))
            codes, known = np.insert(number[codes], offsets[1:], len(order)), words.take(pa.array(order))
            offsets = offsets + np.arange(n + 1)
            counts = np.bincount(codes[np.repeat(learn, np.diff(offsets))], minlength=len(known) + 1)
            kinds, times = [], []
            for first, last, grams, numbers, ends in gram_parts(known, codes, offsets):
                taught = np.repeat(learn[first:last], np.diff(ends))
                kinds.append(grams)
                times.append(np.bincount(numbers[taught], minlength=len(grams)))
                if sum(map(len, kinds[1:])) > len(kinds[0]):
                    kinds, times = [[v] for v in summed_grams(kinds, times)]
            grams, gram_counts = summed_grams(kinds, times)
            del kinds, times, numbers, taught
            words = pa.concat_arrays([known, pa.array([chr(END)])])
            yield _rows(
                [block] * n, part.column("doc_id").cast(pa.int64()), part.column("learn"),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(codes, pa.int32())),
                *[pa.nulls(n, t) for t in (pa.list_(pa.string()), *[pa.list_(pa.int64())] * 3)],
            )
            yield _rows(
                [block], pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.list_(pa.int32())),
                *[pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                  for v in (words, pa.array(counts), pa.array(grams), pa.array(gram_counts))],
            )
            block += 1

    return docs.mapInArrow(run, BLOCKS)


def _rows(block: list[int], *columns: pa.Array) -> pa.RecordBatch:
    names = ["block", "item", "learn", "codes", "words", "counts", "grams", "gram_counts"]
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), *columns], names=names)


def dictionary(blocks: DataFrame, units: str, counts: str, name: str) -> DataFrame:
    """(block, code, unit, count) of every block's dictionary of words or grams."""
    rows = blocks.where("words is not null").select("block", F.posexplode(F.arrays_zip(units, counts)).alias("code", "u"))
    return rows.select("block", "code", F.col(f"u.{units}").alias(name), F.col(f"u.{counts}").alias("count"))


SCORED = "item bigint, learn boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"


def score_blocks(blocks: DataFrame, values: DataFrame, log_total: float) -> DataFrame:
    """Sums over each document of its words' and bytes' values.

    ``values`` has block, kind, code (a word's number or a gram) and amount (a
    word's training count, a gram's log10 probability in units). A block's
    documents and its dictionaries' values meet in one task; a block is bounded.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        has_words = left.column("words").is_valid()
        head, items = left.filter(has_words), left.filter(left.column("codes").is_valid())
        if not items.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (
                ("item", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()))})
        words = head.column("words").combine_chunks().flatten()
        words = unsliced(words.slice(0, len(words) - 1).cast(pa.large_string()))
        grams = head.column("grams").combine_chunks().flatten().to_numpy()
        lists = items.column("codes").combine_chunks()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets, codes = offsets - offsets[0], lists.flatten().to_numpy()
        is_word = pc.equal(right.column("kind"), WORD)
        told = right.filter(is_word)
        base, known = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
        count = told.column("amount").to_numpy()
        base[told.column("code").to_numpy()] = np.log10(count + 1.0) - log_total
        known[told.column("code").to_numpy()] = count > 0
        told = right.filter(pc.invert(is_word))
        value = np.zeros(len(grams))
        value[np.searchsorted(grams, told.column("code").to_numpy())] = told.column("amount").to_numpy() / UNIT
        score, size = np.zeros(items.num_rows), np.zeros(items.num_rows, np.int64)
        own_base, own_known = np.zeros(items.num_rows), np.zeros(items.num_rows)
        for first, last, kinds, numbers, ends in gram_parts(words, codes, offsets):
            run_codes, within = codes[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            own_base[first:last] = segment_sum(base[run_codes], within)
            own_known[first:last] = segment_sum(known[run_codes], within)
            score[first:last] = segment_sum(value[np.searchsorted(grams, kinds)][numbers], ends)
            size[first:last] = np.diff(ends)
        release_memory()
        return pa.table({
            "item": items.column("item"), "learn": items.column("learn"), "n_tokens": pa.array(np.diff(offsets)),
            "n_known": pa.array(np.rint(own_known).astype(np.int64)),
            "base_score": pa.array(own_base), "score": pa.array(score), "n_bytes": pa.array(size),
        })

    left = blocks.select(F.col("block").alias("of"), "item", "learn", "codes", "words", "grams")
    return left.groupBy("of").cogroup(values.groupBy("block")).applyInArrow(run, SCORED)


# --- context trees -----------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln(gamma) for x >= 0.5: Stirling's series behind seven steps of the recurrence."""
    shift = np.ones_like(x)
    for i in range(7):
        shift = shift * (x + i)
    z = x + 7.0
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def log_kt_column(zeros: Column, ones: Column) -> Column:
    """The same as :func:`log_kt`, on columns."""

    def gamma(x: Column) -> Column:
        shift = x
        for i in range(1, 7):
            shift = shift * (x + i)
        z = x + F.lit(7.0)
        series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0))) - 1 / (1680 * F.pow(z, F.lit(7.0)))
        return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(shift)

    return gamma(zeros + 0.5) + gamma(ones + 0.5) - gamma(zeros + ones + F.lit(1.0)) - math.log(math.pi)


class Level:
    """The decisions of one context depth over sorted, distinct (context, byte) integers.

    For each of the eight bits, ``node`` numbers the (context, bits so far) of
    every gram; a node's grams are neighbours, so its counts are plain sums.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        byte = (grams & np.uint64(255)).astype(np.int64)
        context = grams >> np.uint64(8)
        fresh = np.ones(len(grams), bool)
        fresh[1:] = context[1:] != context[:-1]
        self.node, self.first, self.zeros, self.ones, self.bit = [], [], [], [], []
        for j in range(8):
            prefix = byte >> (8 - j)
            new = fresh.copy()
            new[1:] |= prefix[1:] != prefix[:-1]
            node = np.cumsum(new) - 1
            bit = (byte >> (7 - j)) & 1
            size = int(node[-1]) + 1 if len(node) else 0
            total = np.bincount(node, counts, minlength=size)
            ones = np.bincount(node, counts * bit, minlength=size)
            self.node.append(node)
            self.first.append(np.flatnonzero(new))
            self.zeros.append(total - ones)
            self.ones.append(ones)
            self.bit.append(bit)

    def shorter(self, depth: int) -> tuple["Level", np.ndarray]:
        """The level of contexts of ``depth`` bytes, and each gram's place in it."""
        short = self.grams & np.uint64((1 << (8 * (depth + 1))) - 1)
        grams, place = np.unique(short, return_inverse=True)
        return Level(grams, np.bincount(place, self.counts, minlength=len(grams))), place


class Trees:
    """The levels from ``depth`` down to ``stem`` bytes over the grams of whole stems.

    Contexts that only scored texts hold have no counts; their block
    probability is 1, which leaves the trees as they are, and they are not mixed in.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int = DEPTH, stem: int = STEM):
        order = np.argsort(grams)
        self.depth, self.stem = depth, stem
        self.levels = {depth: Level(grams[order], counts[order].astype(float))}
        self.up: dict[int, np.ndarray] = {}
        for d in range(depth - 1, stem - 1, -1):
            self.levels[d], self.up[d + 1] = self.levels[d + 1].shorter(d)
        self.order = order
        self.weighted: dict[int, list[np.ndarray]] = {}
        self.stop: dict[int, list[np.ndarray]] = {}
        for d in range(depth, stem - 1, -1):
            level = self.levels[d]
            self.weighted[d], self.stop[d] = [], []
            for j in range(8):
                own = log_kt(level.zeros[j], level.ones[j])
                if d == depth:
                    self.weighted[d].append(own)
                    self.stop[d].append(np.ones(len(own)))
                    continue
                below = self.levels[d + 1]
                parent = level.node[j][self.up[d + 1][below.first[j]]]
                longer = np.bincount(parent, self.weighted[d + 1][j], minlength=len(own))
                both = np.logaddexp(own, longer) - math.log(2)
                self.weighted[d].append(both)
                self.stop[d].append(np.exp(own - math.log(2) - both))

    def top(self) -> dict[str, np.ndarray]:
        """The nodes of the stem's own level: key (context and bits so far), counts, ln weighted."""
        level = self.levels[self.stem]
        out: dict[str, list[np.ndarray]] = {"key": [], "zeros": [], "ones": [], "weighted": []}
        for j in range(8):
            first = level.grams[level.first[j]]
            prefix = (np.uint64(1) << np.uint64(j)) | ((first & np.uint64(255)) >> np.uint64(8 - j))
            out["key"].append((first >> np.uint64(8) << np.uint64(8)) | prefix)
            out["zeros"].append(level.zeros[j])
            out["ones"].append(level.ones[j])
            out["weighted"].append(self.weighted[self.stem][j])
        return {k: np.concatenate(v) for k, v in out.items()}

    def log2(self, keys: np.ndarray, mixed: np.ndarray, rest: np.ndarray, last: np.ndarray) -> np.ndarray:
        """log2 probability of each gram's byte, in the order given to the constructor.

        ``keys`` (sorted; a stem's shorter context and bits so far) bring what the
        levels above the stem add up to: the probability of a one from the
        contexts already stopped at, the weight that is left, and the KT
        estimate of a one by the last context.
        """
        deep = self.levels[self.depth]
        total = np.zeros(len(deep.grams))
        shorter = (deep.grams >> np.uint64(8)) & np.uint64((1 << (8 * (self.stem - 1))) - 1)
        byte = deep.grams & np.uint64(255)
        for j in range(8):
            wanted = (shorter << np.uint64(8)) | (np.uint64(1) << np.uint64(j)) | (byte >> np.uint64(8 - j))
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            known = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            one = np.where(known, mixed[at], 0.0) if len(keys) else np.zeros(len(wanted))
            left = np.where(known, rest[at], 1.0) if len(keys) else np.ones(len(wanted))
            guess = np.where(known, last[at], 0.5) if len(keys) else np.full(len(wanted), 0.5)
            place = np.arange(len(deep.grams))
            chain = {self.depth: place}
            for d in range(self.depth - 1, self.stem - 1, -1):
                chain[d] = self.up[d + 1][chain[d + 1]]
            open_ = np.ones(len(wanted), bool)
            for d in range(self.stem, self.depth + 1):
                node = self.levels[d].node[j][chain[d]]
                zeros, ones = self.levels[d].zeros[j][node], self.levels[d].ones[j][node]
                open_ &= zeros + ones > 0
                here = (ones + 0.5) / (zeros + ones + 1.0)
                stop = self.stop[d][j][node]
                one = np.where(open_, one + left * stop * here, one)
                guess = np.where(open_, here, guess)
                left = np.where(open_, left * (1.0 - stop), left)
            one = one + left * guess
            total += np.log2(np.where(deep.bit[j] == 1, one, 1.0 - one))
        out = np.empty(len(total))
        out[self.order] = total
        return out


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of whole stems, of about ``size`` rows, from batches sorted by stem."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < size:
            continue
        table = pa.Table.from_batches(held)
        stems = table.column("stem").to_numpy()
        cut = int(np.searchsorted(stems, stems[-1], side="left"))
        if cut:
            yield table.slice(0, cut)
        held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if held and rows:
        yield pa.Table.from_batches(held)


NODES = "key bigint, zeros double, ones double, weighted double"


def stem_nodes(grams: DataFrame) -> DataFrame:
    """Nodes of the stems' own level, from sorted passes over (gram, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, CHUNK):
            gram = table.column("gram").to_numpy().view(np.uint64)
            top = Trees(gram, table.column("count").to_numpy()).top()
            yield pa.RecordBatch.from_arrays(
                [pa.array(top["key"].view(np.int64)), pa.array(top["zeros"]), pa.array(top["ones"]), pa.array(top["weighted"])],
                names=["key", "zeros", "ones", "weighted"],
            )

    stems = grams.select("gram", "count", stem_of("gram").alias("stem"))
    return stems.repartition("stem").sortWithinPartitions("stem").mapInArrow(run, NODES)


def stem_of(gram: str) -> Column:
    return F.expr(f"shiftright({gram}, 8) & {(1 << 8 * STEM) - 1}L")


def shallow_levels(top: DataFrame) -> DataFrame:
    """(key, mixed, rest, last) of the level above the stems.

    Bottom up, counts and weighted probabilities are summed level by level;
    top down, the mixture is carried from the empty context to the longer ones.
    The tables hold at most 255 rows per context of fewer than STEM bytes.
    """
    levels = []
    below = top
    for depth in range(STEM - 1, -1, -1):
        mask = (1 << 8 * (depth + 1)) - 1
        summed = below.groupBy(F.expr(f"key & {mask}L").alias("key")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("longer")
        ).withColumn("own", log_kt_column(F.col("zeros"), F.col("ones")))
        larger = F.greatest("own", "longer")
        both = larger + F.log(F.exp(F.col("own") - larger) + F.exp(F.col("longer") - larger)) - math.log(2)
        below = materialize(
            summed.withColumn("weighted", both).withColumn("stop", F.exp(F.col("own") - math.log(2) - F.col("weighted"))),
            f"level{depth}",
        )
        levels.append(below)
    state = None
    for depth, level in enumerate(reversed(levels)):
        here = level.withColumn("p", (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0))
        if state is None:
            joined = here.select("*", F.lit(0.0).alias("m"), F.lit(1.0).alias("r"), F.lit(0.5).alias("l"))
        else:
            mask = (1 << 8 * depth) - 1
            above = state.select(F.col("key").alias("parent"), F.col("mixed").alias("m"), F.col("rest").alias("r"), F.col("last").alias("l"))
            joined = here.withColumn("parent", F.expr(f"key & {mask}L")).join(above, "parent")
        # A context without counts passes on what it was given.
        seen = F.col("zeros") + F.col("ones") > 0
        state = joined.select(
            "key",
            (F.col("m") + F.when(seen, F.col("r") * F.col("stop") * F.col("p")).otherwise(0.0)).alias("mixed"),
            F.when(seen, F.col("r") * (1 - F.col("stop"))).otherwise(F.col("r")).alias("rest"),
            F.when(seen, F.col("p")).otherwise(F.col("l")).alias("last"),
        )
    return materialize(state, "shallow")


def gram_log10(grams: DataFrame) -> DataFrame:
    """(gram, value): log10 probability of each byte in its context, for seen and unseen grams."""
    above = shallow_levels(materialize(stem_nodes(grams), "stem_nodes"))
    stems = grams.select("gram", "count", stem_of("gram").alias("stem"))
    # Every stem gets the rows of its shorter context.
    short = (1 << 8 * (STEM - 1)) - 1
    contexts = above.withColumn("context", F.expr("shiftright(key, 8)"))
    brought = stems.select("stem").distinct().withColumn("context", F.expr(f"stem & {short}L")).join(contexts, "context")
    empty = F.lit(None).cast("bigint")
    rows = stems.select("stem", "gram", "count", empty.alias("key"), *[F.lit(None).cast("double").alias(c) for c in ("mixed", "rest", "last")])
    rows = rows.unionByName(brought.select("stem", empty.alias("gram"), empty.alias("count"), "key", "mixed", "rest", "last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, CHUNK):
            is_gram = table.column("gram").is_valid()
            own, priors = table.filter(is_gram), table.filter(table.column("key").is_valid())
            if not own.num_rows:
                continue
            keys, first = np.unique(priors.column("key").to_numpy().view(np.uint64), return_index=True)
            state = [priors.column(c).to_numpy()[first] for c in ("mixed", "rest", "last")]
            gram = own.column("gram").to_numpy().view(np.uint64)
            bits = Trees(gram, own.column("count").to_numpy()).log2(keys, *state)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(bits * LOG10_2)], names=["gram", "value"])

    return rows.repartition("stem").sortWithinPartitions("stem").mapInArrow(run, "gram bigint, value double")


def score_documents(docs: DataFrame, learn: Column) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): learn, tokens, known tokens, train_tokens,
    base_score, score (log10) and bits_per_byte of the text's words and marks."""
    rows = docs.select("doc_id", "text", F.coalesce(learn, F.lit(True)).alias("learn"))
    blocks = materialize(document_blocks(rows), "document_blocks", compression="zstd")
    # A word stands once in a block's dictionary, so a window over it holds as
    # many rows as there are blocks, and one shuffle serves counting and giving back.
    of_word = Window.partitionBy("word")
    counted = dictionary(blocks, "words", "counts", "word").select(
        "block", "code", "count", F.sum("count").over(of_word).alias("c"),
        (F.row_number().over(of_word.orderBy("block")) == 1).alias("first"),
    )
    counted = materialize(counted, "word_counts")
    total, kinds = counted.agg(
        F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum(F.expr("cast(first and c > 0 as int)")), F.lit(0))
    ).first()
    log_total = math.log10(int(total) + int(kinds) + 1)
    grams = dictionary(blocks, "grams", "gram_counts", "gram")
    gram_counts = materialize(grams.groupBy("gram").agg(F.sum("count").alias("count")), "gram_counts")
    gram_values = materialize(gram_log10(gram_counts), "gram_values")
    word_amounts = counted.select(
        "block", F.lit(WORD).alias("kind"), F.col("code").cast("bigint").alias("code"), F.col("c").alias("amount")
    )
    units = F.round(F.col("value") * UNIT).cast("bigint").alias("amount")
    gram_amounts = grams.select("block", "gram").join(gram_values.select("gram", units), "gram")
    amounts = word_amounts.unionAll(gram_amounts.select("block", F.lit(GRAM).alias("kind"), F.col("gram").alias("code"), "amount"))
    return score_blocks(blocks, amounts, log_total).select(
        F.col("item").alias("doc_id"), "learn", "n_tokens", "n_known", F.lit(int(total)).cast("bigint").alias("train_tokens"),
        "base_score", "score", (-F.col("score") / F.lit(LOG10_2) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = crc_bucket(F.col("doc_id"), 7) == 2
    return score_documents(docs, ~held).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "bits_per_byte",
    )
