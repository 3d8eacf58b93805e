"""A Huffman-shaped wavelet matrix over token ids, as one file of bytes.

The ids of a shard get prefix codes by frequency. Plane l holds bit l of the
codes of all tokens that have one, in the order left by a stable partition on
the bits before (zeros first), so that access, rank and select walk the planes
from top to bottom. Codes are assigned such that the codes that end at a plane
are the last of its order; they leave the sequence there and no position of the
others changes. The planes take about the entropy of the ids and need no other
compression.

File: magic ``FLWM1`` and a newline, a JSON header line (symbols by code length,
counts, documents), then the planes as packed bits, then the documents' ids and
token counts as little-endian 64-bit integers.
"""

from __future__ import annotations

import heapq
import json

import numpy as np

MAGIC = b"FLWM1\n"
WORD = 512  # bits of a rank block
DENSE = 1 << 20  # largest id that is counted in a table


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code lengths; a single symbol gets one bit."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = np.zeros(2 * n - 1, np.int64)
    node = n
    while len(heap) > 1:
        a, x = heapq.heappop(heap)
        b, y = heapq.heappop(heap)
        parent[x] = parent[y] = node
        heapq.heappush(heap, (a + b, node))
        node += 1
    depth = np.zeros(2 * n - 1, np.int64)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[parent[i]] + 1
    return depth[:n]


def assign_codes(lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes (bit l of a code is its bit at plane l) and the symbols that end at each plane.

    The open prefixes are kept in the order of the planes; the last of them
    become the codes of that length, the others go on with 0 and then with 1.
    """
    codes = np.zeros(len(lengths), np.int64)
    leaves = []
    prefixes = np.zeros(1, np.int64)
    for level in range(int(lengths.max(initial=0))):
        prefixes = np.concatenate([prefixes, prefixes | (1 << level)])
        ending = np.flatnonzero(lengths == level + 1)
        keep = len(prefixes) - len(ending)
        codes[ending] = prefixes[keep:]
        leaves.append(ending)
        prefixes = prefixes[:keep]
    return codes, leaves


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids in order, the place of every id among them, and their counts. Ids
    up to :data:`DENSE` (those of any vocabulary) are counted in a table, without sorting."""
    if not len(ids) or int(ids.max()) > DENSE:
        symbols, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
        return symbols, places, counts
    table = np.bincount(ids)
    symbols = np.flatnonzero(table)
    order = np.zeros(len(table), np.int32)
    order[symbols] = np.arange(len(symbols), dtype=np.int32)
    return symbols, order[ids], table[symbols]


def encode_shard(ids: np.ndarray, doc_ids: np.ndarray, doc_tokens: np.ndarray) -> bytes:
    """The file for the token ids of consecutive documents."""
    symbols, places, counts = distinct(ids)
    lengths = code_lengths(counts)
    codes, leaves = assign_codes(lengths)
    deep = int(lengths.max(initial=0))
    row = codes.astype(np.uint32 if deep <= 32 else np.uint64)[places]
    planes, sizes = [], []
    for level in range(deep):
        ones = (row & row.dtype.type(1)).view(np.uint8)[:: row.dtype.itemsize].astype(bool)
        planes.append(np.packbits(ones).tobytes())
        sizes.append(len(row))
        row = np.concatenate([np.compress(~ones, row), np.compress(ones, row)])
        row = row[: len(row) - int(counts[leaves[level]].sum())] >> row.dtype.type(1)
    header = {
        "tokens": int(len(ids)),
        "planes": sizes,
        "leaves": [symbols[x].tolist() for x in leaves],
        "counts": [counts[x].tolist() for x in leaves],
        "documents": int(len(doc_ids)),
    }
    tail = np.asarray(doc_ids, "<i8").tobytes() + np.asarray(doc_tokens, "<i8").tobytes()
    return MAGIC + json.dumps(header).encode() + b"\n" + b"".join(planes) + tail


class WaveletMatrix:
    """Access, rank, count, select and full decoding of one file's bytes."""

    def __init__(self, blob: bytes):
        if not blob.startswith(MAGIC):
            raise ValueError("not a wavelet matrix file")
        end = blob.index(b"\n", len(MAGIC))
        head = json.loads(blob[len(MAGIC) : end])
        self.tokens, self.sizes = head["tokens"], head["planes"]
        self.leaves = [np.array(x, np.int64) for x in head["leaves"]]
        self.counts = [np.array(x, np.int64) for x in head["counts"]]
        at = end + 1
        self.planes = []
        for size in self.sizes:
            self.planes.append(np.frombuffer(blob, np.uint8, (size + 7) // 8, at))
            at += (size + 7) // 8
        n = head["documents"]
        self.doc_ids = np.frombuffer(blob, "<i8", n, at)
        self.doc_tokens = np.frombuffer(blob, "<i8", n, at + 8 * n)
        self._ranks: dict[int, np.ndarray] = {}
        self._codes: dict[int, tuple[int, int]] | None = None

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.sizes[level]).view(bool)

    def decode(self) -> np.ndarray:
        """All token ids, from the lowest plane up."""
        below = np.zeros(0, np.uint32)
        for level in range(len(self.sizes) - 1, -1, -1):
            ended = np.repeat(self.leaves[level].astype(np.uint32), self.counts[level])
            row = np.concatenate([below, ended])
            ones = self._bits(level)
            zeros = len(row) - int(np.count_nonzero(ones))
            below = np.empty_like(row)
            below[np.flatnonzero(~ones)] = row[:zeros]
            below[np.flatnonzero(ones)] = row[zeros:]
        return below

    def _rank1(self, level: int, at: int) -> int:
        """Ones of a plane before a position, by sampled counts."""
        if level not in self._ranks:
            plane = self.planes[level]
            padded = np.zeros(-(-len(plane) // (WORD // 8)) * (WORD // 8), np.uint8)
            padded[: len(plane)] = plane
            per_block = np.bitwise_count(padded).reshape(-1, WORD // 8).sum(axis=1, dtype=np.int64)
            self._ranks[level] = np.concatenate([[0], np.cumsum(per_block)])
        block, rest = divmod(at, WORD)
        count = int(self._ranks[level][block])
        if rest:
            part = self.planes[level][block * (WORD // 8) : block * (WORD // 8) + (rest + 7) // 8]
            count += int(np.unpackbits(part, count=rest).sum())
        return count

    def _zeros(self, level: int) -> int:
        return self.sizes[level] - self._rank1(level, self.sizes[level])

    def _kept(self, level: int) -> int:
        """Tokens that go on after a plane."""
        return self.sizes[level + 1] if level + 1 < len(self.sizes) else 0

    def access(self, at: int) -> int:
        """The token id at a position."""
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        for level in range(len(self.sizes)):
            bit = self._bit(level, at)
            ones = self._rank1(level, at)
            at = self._zeros(level) + ones if bit else at - ones
            if at >= self._kept(level):
                ends = np.cumsum(self.counts[level])
                return int(self.leaves[level][np.searchsorted(ends, at - self._kept(level), side="right")])
        raise AssertionError("a code without an end")

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3] >> (7 - (at & 7))) & 1

    def code(self, token: int) -> tuple[int, int] | None:
        """(code, length) of a token id, None if the shard does not hold it."""
        if self._codes is None:
            self._codes = {}
            prefixes = [0]
            for level, ending in enumerate(self.leaves):
                prefixes = prefixes + [p | (1 << level) for p in prefixes]
                keep = len(prefixes) - len(ending)
                self._codes.update((int(s), (p, level + 1)) for s, p in zip(ending, prefixes[keep:]))
                prefixes = prefixes[:keep]
        return self._codes.get(token)

    def rank(self, token: int, at: int) -> int:
        """Occurrences of a token before a position."""
        found = self.code(token)
        if found is None:
            return 0
        code, length = found
        low, high = 0, min(max(at, 0), self.tokens)
        for level in range(length):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if code >> level & 1:
                zeros = self._zeros(level)
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.tokens)

    def _find_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        low, high = 0, self.sizes[level]
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token; -1 if there is none."""
        if k < 0 or k >= self.count(token):
            return -1
        code, length = self.code(token)
        low = 0
        for level in range(length):
            ones = self._rank1(level, low)
            low = self._zeros(level) + ones if code >> level & 1 else low - ones
        at = low + k
        for level in range(length - 1, -1, -1):
            bit = code >> level & 1
            at = self._find_bit(level, bit, at - self._zeros(level) if bit else at)
        return at
