"""Token ids of documents in wavelet-matrix shards.

Texts are encoded with a given tokenizer file, an end id is appended to every
document, and the ids are written in ascending doc_id order: documents are
range-partitioned by id, every partition writes shards of at most
:data:`SHARD_TOKENS` tokens (plus one document) into the shared folder, and
the files are read back with Spark's own file reader.

The tokenizer lower-cases, splits a text at white space and between runs of letters, single
digits and runs of other marks, and merges bytes within these parts only, so a document's ids
are its words' ids in order. Of the distinct words of a slice, those of plain letters,
digits and marks are cut into parts, and the distinct parts are encoded together by their
merge ranks; the other words go as they stand through the tokenizer. Nothing is kept from
slice to slice.

A shard's name has the partition and the number within it; a task that runs
again writes the same bytes under the same name.

Defined results: null and empty texts hold the end id only; repeated rows are
encoded again each, in the order of id, the text's hash and the text; null ids come first; no
rows give no shards and no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.llm.common import Tokens, read_table, release_memory, string_bytes, text_slices
from fundlake.llm.token_alignment import byte_level_alphabet
from fundlake.llm.wavelet import WaveletMatrix, encode_shard
from fundlake.session import materialize, scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARD_TOKENS = 2_000_000

#: Words that normalisation leaves alone but for case: letters of one code point in
#: U+00C0 to U+00FF, digits, ASCII marks other than the apostrophe (which begins endings
#: such as 's).
_PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+$"
#: What the byte of a plain word belongs to: a run of letters, a digit or a run of marks.
_LETTER, _DIGIT, _MARKS = 0, 1, 2
_KINDS = np.array([_DIGIT if chr(b).isdigit() else _LETTER if chr(b).isalpha() else _MARKS for b in range(128)] + [_LETTER] * 128, np.uint8)
#: Ends a part; no plain word holds it.
_MARK = "\x00"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of words.

    An entry ends its word if it has the file's end suffix. With a mark byte for that
    suffix, merging by rank of the joined bytes gives the file's ids: the mark goes to the
    last byte first, since entries of one byte have the lowest ranks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        first = len(vocabulary) - len(merges)
        self.ranked = bool(suffix) and all(vocabulary.get(x + y) == first + i for i, (x, y) in enumerate(merges))
        if not self.ranked:
            return
        from tiktoken import Encoding

        alphabet = byte_level_alphabet()
        ranks = {}
        for entry, rank in vocabulary.items():
            ends = entry.endswith(suffix)
            raw = bytes(alphabet[c] for c in entry.removesuffix(suffix))
            if _MARK.encode() not in raw or len(raw) == 1 and not ends:
                ranks[raw + _MARK.encode() if ends else raw] = rank
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[rank for raw, rank in ranks.items() if raw.endswith(_MARK.encode()) and len(raw) > 1]] = True
        self._ranks = Encoding("w", pat_str=f"[^{_MARK}]+{_MARK}", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words back to back, and the offsets."""
        special = pc.match_substring(words, "<|")  # as the tokenizer finds its special tokens
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), special).to_numpy(zero_copy_only=False)
        if not self.ranked:
            plain[:] = False
        ids, sizes = [], np.zeros(len(words), np.int64)
        if plain.any():
            found, offsets = self._plain(pc.utf8_lower(words.filter(pa.array(plain))))
            sizes[plain] = np.diff(offsets)
            ids.append(found)
        others = words.filter(pa.array(~plain)).to_pylist()
        for at in range(0, len(others), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch(others[at : at + 4096], add_special_tokens=False)]
            sizes[np.flatnonzero(~plain)[at : at + 4096]] = [len(f) for f in found]
            ids.append(np.array([i for f in found for i in f], np.uint32))
        # Plain words' ids, then the others': back to the order of the words.
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return runs(np.concatenate([np.zeros(0, np.uint32), *ids]), starts, sizes)

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain lower-case words back to back, and the offsets."""
        data, offsets = string_bytes(words)
        kinds = _KINDS[data]
        begins = np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)])
        begins[offsets[:-1]] = True
        cuts = np.append(np.flatnonzero(begins), len(data))
        parts = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        codes = parts.indices.to_numpy(zero_copy_only=False)
        # Every distinct part with its mark behind it; the ids of a part are up to the first that ends one.
        data, ends = string_bytes(parts.dictionary)
        text = np.insert(data, ends[1:], ord(_MARK)).tobytes().decode()
        found = np.array(self._ranks(text), np.uint32)
        ends = np.concatenate([[0], np.flatnonzero(self.ends[found]) + 1])
        found, ends = runs(found, ends[:-1][codes], np.diff(ends)[codes])
        return found, ends[np.searchsorted(cuts, offsets)]


def runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``data`` from ``starts`` on, back to back, and their offsets."""
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes)
    at += np.arange(len(at))
    return data[at], offsets


def encode_texts(texts: pa.Array, encoder: WordEncoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts back to back, the end id behind each, and the offsets."""
    tokens = Tokens(texts, lower=False)
    data, starts = encoder.words(tokens.words)
    # Every document's words, then the end mark as one more word.
    data, starts = np.append(data, np.uint32(END_ID)), np.append(starts, starts[-1] + 1)
    codes = np.insert(tokens.codes, tokens.offsets[1:], len(starts) - 2)
    offsets = tokens.offsets + np.arange(len(tokens.offsets))
    ids, ends = runs(data, starts[codes], np.diff(starts)[codes])
    return ids, ends[offsets]


def local_path(folder: str) -> str | None:
    """The path of a folder on a mounted file system, None for other stores."""
    if folder.startswith("file:"):
        return "/" + folder[len("file:") :].lstrip("/")
    return None if "://" in folder else folder


def write_file(folder: str, name: str, data: bytes) -> None:
    """Write one file of a shared folder whole or not at all."""
    mounted = local_path(folder)
    if mounted is not None:
        os.makedirs(mounted, exist_ok=True)
        draft = os.path.join(mounted, f"_{name}.{os.getpid()}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}")
        with open(draft, "wb") as out:
            out.write(data)
        os.replace(draft, os.path.join(mounted, name))
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(f"{folder}/{name}")
        with store.open_output_stream(path) as out:
            out.write(data)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, partitions: int) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) in the order of id, hash and text; returns
    (part, shard, size): one row per shard with its number of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        ids, names, sizes, held, written = [], [], [], 0, []
        encoder = WordEncoder(tokenizer)  # of this task: workers are reused and would keep it

        def flush() -> None:
            nonlocal ids, names, sizes, held
            if names:
                blob = encode_shard(np.concatenate(ids), np.concatenate(names), np.concatenate(sizes))
                shard = f"shard-{partition:06d}-{len(written):06d}.wm"
                write_file(folder, shard, blob)
                written.append((shard, held))
                ids, names, sizes, held = [], [], [], 0

        for part in text_slices(batches, "text", 4 << 20):
            found, offsets = encode_texts(part.column("text"), encoder)
            keys = part.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            first = 0
            while first < len(keys):
                room = offsets[first] + SHARD_TOKENS - held
                last = max(int(np.searchsorted(offsets, room, side="right")) - 1, first + 1)
                ids.append(found[offsets[first] : offsets[last]])
                names.append(keys[first:last])
                sizes.append(np.diff(offsets[first : last + 1]))
                held += int(offsets[last] - offsets[first])
                first = last
                if held >= SHARD_TOKENS or last < len(keys):
                    flush()
        flush()
        del encoder
        release_memory()
        yield pa.RecordBatch.from_arrays(
            [pa.array([partition] * len(written), pa.int64()), pa.array([w[0] for w in written], pa.string()),
             pa.array([w[1] for w in written], pa.int64())], names=["part", "shard", "size"])

    # Rows of one id go by their text's hash, so that no id is one task.
    hashed = docs.withColumn("_h", F.xxhash64("text"))
    ordered = hashed.repartitionByRange(partitions, "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")
    return materialize(ordered.mapInArrow(run, "part bigint, shard string, size bigint"), "token-shard-sizes")


#: Stands for a null id in a shard's list of ids.
NO_ID = -(1 << 63)


def shard_starts(sizes: DataFrame) -> DataFrame:
    """(shard, before): the ids of all shards before each. Sums within a writing task, then
    over the tasks (one row each)."""
    parts = sizes.groupBy("part").agg(F.sum("size").alias("of_part"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    earlier_parts = earlier.orderBy("part")
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(earlier_parts), F.lit(0)).alias("parts_before"))
    within = earlier.partitionBy("part").orderBy("shard")
    own = sizes.select("part", "shard", F.coalesce(F.sum("size").over(within), F.lit(0)).alias("own_before"))
    return own.join(parts, "part").select("shard", (F.col("own_before") + F.col("parts_before")).alias("before"))


def read_shards(spark: SparkSession, folder: str, sizes: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 (and shard, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                shard = WaveletMatrix(content.as_py())
                ids = shard.decode().astype("<u4")
                ends = np.cumsum(shard.doc_tokens)
                view = memoryview(ids).cast("B")
                starts = ends - shard.doc_tokens
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(crc)
                keys = pa.array(shard.doc_ids, mask=shard.doc_ids == NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.as_py().rpartition("/")[2]] * n), pa.array(np.arange(n)), keys,
                     pa.array(starts), pa.array(shard.doc_tokens), pa.array(crc, pa.int64())],
                    names=["shard", "place", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.wm").load(folder).select("path", "content")
    rows = files.mapInArrow(run, "shard string, place bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(shard_starts(sizes), "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")


STORED = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard string, place bigint"


def store_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` and return the per-document rows read from them."""
    folder = scratch_path(spark, "token-shards")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sizes = write_shards(docs, folder, tokenizer or tokenizer_path(), partitions)
    if sizes.isEmpty():
        return spark.createDataFrame([], STORED)
    return read_shards(spark, folder, sizes).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "place")


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_tokens(spark, read_table(spark, sf_dir, "documents"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the kept documents as token shards, one row per document."""
    return store_tokens(spark, docs)
