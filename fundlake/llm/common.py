"""Helpers shared by the operators of this subpackage: table reading, batch
slicing, dictionary-encoded tokens and 64-bit mixing on numpy arrays."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import ship_package

#: White space of the token rule (``[^\x20\x09-\x0D]+``) as a Java regex class.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's own reader (any store it can reach)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(buckets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed 64-bit seeds."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * GOLDEN)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches into row slices whose texts hold about ``max_bytes`` bytes.

    Memory per slice is bounded by ``max_bytes`` plus one row; a single very
    long text is its own slice and is never cut. At the end of a task freed
    memory goes back to the system, since Python workers are reused.
    """
    try:
        yield from _slices(batches, column, max_bytes)
    finally:
        release_memory()


def release_memory() -> None:
    """Give the allocators' unused memory back to the operating system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None  # glibc only
    if trim is not None:
        trim(0)


def _slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + max_bytes, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


class Tokens:
    """The words of a slice of texts, dictionary encoded.

    ``words`` holds the distinct words, ``codes`` one index per token in text
    order and ``offsets`` the token range of each row. Null texts are empty.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = unsliced(pc.fill_null(texts.cast(pa.large_string()), ""))
        if lower:
            texts = pc.ascii_lower(texts)  # A-Z only
        lists = pc.ascii_split_whitespace(texts)  # splits on 0x20, 0x09-0x0D
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        if not filled.all():  # leading, trailing or only white space
            before = np.concatenate([[0], np.cumsum(filled)])
            offsets = before[offsets]
            flat = flat.filter(pa.array(filled))
        encoded = flat.dictionary_encode()
        self.words: pa.Array = encoded.dictionary
        self.codes: np.ndarray = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.offsets: np.ndarray = offsets

    def word_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the distinct words back to back, and their offsets."""
        return string_bytes(self.words)


def unsliced(strings: pa.Array) -> pa.Array:
    """The same strings in buffers of their own: Arrow's ASCII kernels read a
    slice's characters from the start of the shared buffer."""
    return strings.take(pa.array(np.arange(len(strings))))


def string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array back to back, and the offsets."""
    big = strings.cast(pa.large_binary())
    offsets = np.frombuffer(big.buffers()[1], np.int64)[big.offset : big.offset + len(big) + 1]
    data = np.frombuffer(big.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit xxh3 hash of each word."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``offsets`` (0 for empty ones)."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


_LETTER = r"\p{L}"


def has_letter(texts: pa.Array) -> np.ndarray:
    """True where a text holds a Unicode letter (false for null)."""
    found = pc.match_substring_regex(texts.cast(pa.large_string()), _LETTER)
    return pc.fill_null(found, False).to_numpy(zero_copy_only=False)
