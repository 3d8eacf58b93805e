"""Alignment of two tokenizers' ids over the same text.

Every document is encoded by a byte-level BPE (A, over a space and the text)
and by a piece model (B, which adds that space itself). Byte offsets where an A
and a B token both end cut the tokens into groups; an A-B pair of tokens that
end together is a link.

A document is not walked token by token. Its anchors are the byte offsets at
which a space-marked token of both sides begins, which is a shared end of the
tokens before it, verified on the offsets. Anchors cut the ids into windows
(mostly words), and a window's alignment depends on its ids alone, so its groups
are written once per task and kept under the tuple of its A and B ids, in a memo of
at most :data:`MEMO_BYTES` bytes that starts anew when full.

How often an id pair is linked is counted over the whole corpus: every document
keeps its links' pair codes in a written table, tasks add them up, and the sums
come back to score each document's links. Tokens that end together hold one
another's bytes as a suffix, so the distinct pairs are limited by the two
vocabularies (at most :func:`pair_bound`, a few hundred thousand) whatever the
corpus; that table is checked against the bound and broadcast.

Long texts are encoded in parts of about :data:`PART_CHARS` characters, cut
before a single space between an ASCII letter, digit or mark and an ASCII letter.
Neither tokenizer has a token across such a place (B: checked on the vocabulary),
so the ids are those of the whole text.

Defined results: texts that are null, empty, or whose joined bytes of either
side differ from the space and the text have no tokens (zeros, an empty digest);
repeated rows are counted as rows; null ids stay; no rows give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import read_table, release_memory, segment_sum, text_slices
from fundlake.session import materialize

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Texts of one encoding call, in bytes; a text's parts, in characters.
SLICE_BYTES = 1 << 18
PART_CHARS = 1 << 16
#: Bytes of ids and results that a task's memo may hold, and of an entry's objects.
MEMO_BYTES = 96 << 20
ENTRY_BYTES = 200

#: A place no token of either side crosses.
_CUT = re.compile(r"(?<=[A-Za-z0-9.,;:!?)\]]) (?=[A-Za-z])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def tokenizer_paths(a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(a), public_tokenizers.path(b)


def byte_level_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level entry stands for: printable
    Latin-1 for itself, the other bytes in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Side:
    """One tokenizer: ids of texts and the bytes of every id."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.spaced = np.array([p.startswith(b" ") for p in pieces])

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


#: How byte-level files of this form split a text (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel(Side):
    """A byte-level BPE file of the tokenizers library; special tokens are plain text.

    A plain file (no normaliser, merged entries numbered in the order of their merges)
    is the same as a list of ranks, which tiktoken encodes four times faster to the same
    ids (tested over all code points); any other file is encoded by its own library, and
    so is a text that tiktoken's split gives up on (a million white spaces in a row)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model, alphabet = held["model"], byte_level_alphabet()
        special = {t["content"]: t["id"] for t in held["added_tokens"]}
        vocabulary = {e: i for e, i in model["vocab"].items() if e not in special}
        size = max([*vocabulary.values(), *special.values()]) + 1
        pieces = [b""] * size
        for entry, i in special.items():
            pieces[i] = entry.encode()
        for entry, i in vocabulary.items():
            pieces[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        super().__init__(pieces)
        self.path, self._library = path, None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        first = len(vocabulary) - len(merges)
        before = held["pre_tokenizer"] or {}
        self.plain = (
            held["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not model.get("dropout") and not model.get("ignore_merges")
            and all(model["vocab"].get(x + y) == first + i for i, (x, y) in enumerate(merges))
        )
        self.cuttable = self.plain  # a single space begins its word's token
        if self.plain:
            from tiktoken import Encoding

            ranks = {pieces[i]: i for i in vocabulary.values()}
            one = Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
            self._one = lambda text: one(text, disallowed_special=())

    def encode(self, texts: list[str]) -> list[Sequence[int]]:
        """Ids of texts that already begin with their space."""
        return [self._ranked(t) for t in texts] if self.plain else self._by_library(texts)

    def _ranked(self, text: str) -> Sequence[int]:
        try:
            return self._one(text)
        except ValueError:  # the split's stack is full
            return self._by_library([text])[0]

    def _by_library(self, texts: list[str]) -> list[list[int]]:
        if self._library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.encode_special_tokens = True
        return [e.ids for e in self._library.encode_batch(texts, add_special_tokens=False)]


class Pieces(Side):
    """A piece model that adds the leading space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__([self._bytes(e) for e in entries])
        # No piece holds a space behind another character: words never share one.
        self.cuttable = not any("▁" in e.lstrip("▁") for e in entries)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        single = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with their space (given to the model without it)."""
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def pair_bound(a: Side, b: Side) -> int:
    """No more than this many id pairs can ever end together: one side's bytes are a
    suffix of the other's, and a token has as many suffixes as bytes."""
    same = max(_most_equal(a.pieces), _most_equal(b.pieces))
    return same * int(a.lengths.sum() + b.lengths.sum())


def _most_equal(pieces: list[bytes]) -> int:
    counts: dict[bytes, int] = {}
    for p in pieces:
        counts[p] = counts.get(p, 0) + 1
    return max(counts.values(), default=1)


@dataclass
class Aligned:
    """One document: ids of both sides, its groups as text and its links' pair codes."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str  # a1,a2|b1;a3|b2,b3
    links: bytes  # pair codes, little-endian 64-bit


NOTHING = Aligned(0, 0, 0, "", b"")


class Aligner:
    """Aligns documents, remembering windows by their id tuples."""

    def __init__(self, a: Side, b: Side, memo_bytes: int = MEMO_BYTES):
        self.a, self.b, self.memo_bytes = a, b, memo_bytes
        self.memo: dict[bytes, str] = {}
        self.held = 0
        # Every id as text with the mark that may follow it.
        marks = ((a, ","), (a, "|"), (b, ","), (b, ";"))
        self.names = [f"{i}{mark}" for side, mark in marks for i in range(len(side.pieces))]

    def document(self, a: np.ndarray, b: np.ndarray) -> Aligned:
        """Align a document's ids (32-bit), whose bytes are known to be equal."""
        if not len(a):
            return NOTHING
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        marked = np.zeros(int(ends_a[-1]) + 1, bool)
        marked[ends_b] = True
        last_a = np.flatnonzero(marked[ends_a])  # the A and B tokens that end together
        marked[:] = False
        marked[ends_a] = True
        last_b = np.flatnonzero(marked[ends_b])
        links = (a[last_a].astype(np.int64) * len(self.b.pieces) + b[last_b]).astype("<i8").tobytes()
        # Anchors: shared ends behind which both sides go on with a space-marked token.
        anchors = np.flatnonzero(self.a.spaced[a[last_a[:-1] + 1]] & self.b.spaced[b[last_b[:-1] + 1]])
        cuts_a = np.concatenate([[0], last_a[anchors] + 1, [len(a)]])
        cuts_b = np.concatenate([[0], last_b[anchors] + 1, [len(b)]])
        # The ids of both sides window by window: a window's tuples are one stretch of bytes.
        both = np.empty(len(a) + len(b), np.int32)
        both[np.arange(len(a)) + np.repeat(cuts_b[:-1], np.diff(cuts_a))] = a
        both[np.arange(len(b)) + np.repeat(cuts_a[1:], np.diff(cuts_b))] = b + len(self.a.pieces)
        raw, known, cuts = both.tobytes(), self.memo.get, (cuts_a + cuts_b).tolist()
        windows = [raw[4 * i : 4 * x] for i, x in zip(cuts, cuts[1:])]
        found = [known(w) for w in windows]
        if None in found:
            named = self._named(a, b, last_a, last_b)
            for k, w in enumerate(windows):
                if found[k] is None:
                    found[k] = known(w) or self._keep(w, "".join(named[cuts[k] : cuts[k + 1]])[:-1])
        return Aligned(len(a), len(b), len(last_a), ";".join(found), links)

    def _named(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
        """The ids of both sides as text, group by group, each with the mark behind it."""
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)] = a
        order[np.arange(len(b)) + np.repeat(last_a + 1, size_b)] = b + 2 * len(self.a.pieces)
        order[last_a + last_b + 1 - size_b] += len(self.a.pieces)  # the last A token of a group
        order[last_a + last_b + 1] += len(self.b.pieces)  # its last B token
        return [self.names[i] for i in order.tolist()]

    def _keep(self, window: bytes, groups: str) -> str:
        """Remember a window's groups under its ids."""
        size = ENTRY_BYTES + len(window) + len(groups)
        if self.held + size > self.memo_bytes:
            self.memo.clear()
            self.held = 0
        if size <= self.memo_bytes:
            self.memo[window] = groups
            self.held += size
        return groups


def parts_of(text: str, size: int = PART_CHARS) -> list[str]:
    """A text (its space in front) in parts of about ``size`` characters, cut before
    spaces that begin a token on both sides."""
    if len(text) <= size:
        return [text]
    parts, at = [], 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if found is None:
            break
        parts.append(text[at : found.start()])
        at = found.start()
    return [*parts, text[at:]]


def encode_documents(side: Side, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text (32-bit); long ones are encoded part by part."""
    parts = [parts_of(t) if side.cuttable else [t] for t in texts]
    ids = [np.empty(0, np.int32)] * len(texts)
    short = [i for i, p in enumerate(parts) if len(p) == 1]
    for i, found in zip(short, side.encode([texts[i] for i in short])):
        ids[i] = np.array(found, np.int32)
    for i, several in enumerate(parts):
        if len(several) > 1:
            ids[i] = np.concatenate([np.array(side.encode([p])[0], np.int32) for p in several])
    return ids


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary"


def align_documents(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """One row per document: token and group counts, the digest of its groups and its
    links' pair codes; ``keep_groups`` adds the groups themselves (``groups``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteLevel(path_a), Pieces(path_b)
        aligner = Aligner(a, b)
        for part in text_slices(batches, "text", SLICE_BYTES):
            texts = [" " + t if t else "" for t in part.column("text").to_pylist()]
            filled = [i for i, t in enumerate(texts) if t]
            rows = [NOTHING] * len(texts)
            given = [texts[i] for i in filled]
            for i, text, ids_a, ids_b in zip(filled, given, encode_documents(a, given), encode_documents(b, given)):
                whole = text.encode()
                if a.joined(ids_a) == whole and b.joined(ids_b) == whole:
                    rows[i] = aligner.document(ids_a, ids_b)
            columns = [
                part.column("doc_id"),
                pa.array([r.n_a for r in rows], pa.int64()),
                pa.array([r.n_b for r in rows], pa.int64()),
                pa.array([r.n_groups for r in rows], pa.int64()),
                pa.array([len(r.links) // 8 for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "" for r in rows]),
                pa.array([r.links for r in rows], pa.binary()),
            ]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
            if keep_groups:
                columns.append(pa.array([r.groups for r in rows], pa.string()))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        del a, b, aligner
        release_memory()

    schema = ALIGNED + (", groups string" if keep_groups else "")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def link_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pair codes of a batch's ``links`` back to back, and the offsets."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view("<i8"), (offsets - offsets[0]) // 8


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, n): how many links of all documents hold each id pair. Every task sends
    one row per pair, so no pair's links are gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for part in text_slices(iter([batch]), "links"):
                found, n = np.unique(link_codes(part.column("links"))[0], return_counts=True)
                both = np.concatenate([codes, found])
                codes, back = np.unique(both, return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, n]), len(codes)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts)], names=["code", "n"])

    return aligned.select("links").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def score_links(spark: SparkSession, aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Adds n_best and count_sum to aligned documents (a written table), from the
    corpus-wide counts of their pairs."""
    a, b = ByteLevel(path_a), Pieces(path_b)
    bound, size_b = pair_bound(a, b), len(b.pieces)
    del a, b
    table = pair_counts(aligned).limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise ValueError(f"more than {bound} id pairs: the links are not those of these tokenizers")
    codes, counts = table["code"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    best = np.zeros(size_b, np.int64)
    np.maximum.at(best, codes % size_b, counts)
    held = spark.sparkContext.broadcast((codes, counts, counts == best[codes % size_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, is_best = held.value
        for batch in batches:
            for part in text_slices(iter([batch]), "links"):
                found, offsets = link_codes(part.column("links"))
                at = np.searchsorted(codes, found)
                best_sum = segment_sum(is_best[at], offsets).astype(np.int64)
                total = np.concatenate([[0], np.cumsum(counts[at])])
                keep = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(best_sum), pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64())],
                    names=[*kept, "n_best", "count_sum"],
                )

    kept = [c for c in aligned.columns if c != "links"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links")
    return aligned.mapInArrow(run, schema + ", n_best bigint, count_sum bigint")


def align_corpus(
    spark: SparkSession, docs: DataFrame, path_a: str | None = None, path_b: str | None = None, keep_groups: bool = False
) -> DataFrame:
    """Align every document of ``docs`` (doc_id, text) and score its links by the counts of all."""
    default_a, default_b = tokenizer_paths()
    path_a, path_b = path_a or default_a, path_b or default_b
    aligned = materialize(align_documents(docs, path_a, path_b, keep_groups), "aligned", compression="zstd")
    return score_links(spark, aligned, path_a, path_b)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_corpus(spark, read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
