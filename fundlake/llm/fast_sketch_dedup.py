"""Near-duplicate groups by fast similarity sketching.

A document's set is its distinct four-word shingles (64-bit hashes of whole
word sequences). The sketch of a set has :data:`SIZE` coordinates and is filled
in rounds: in each of the first SIZE rounds every element is hashed once and
dropped into one coordinate, which keeps the smallest (round, hash); a set
stops after the first round that leaves no coordinate empty. In the next SIZE
rounds (reached by very small sets only) all elements go to the coordinate of
the round's number, so that every coordinate fills for certain. The share of
equal coordinates estimates the Jaccard similarity with Chernoff-type bounds.

Banding (:data:`BANDS` bands of :data:`ROWS` coordinates) finds candidates: a
pair with similarity 0.8 shares no band with probability (1 - 0.8^4)^32 =
5e-8. Candidates are confirmed on full sets:

1. texts that are equal byte by byte are one class, sketched per class once;
2. every member of a band's bucket is paired with the bucket's smallest member
   (its hub), one row per member instead of all pairs, and confirmed;
3. members that are still not connected with others of the same hub are
   compared with them block by block (numpy, at most BLOCK x BLOCK members in
   memory); the sets travel as differences from the hub and a block returns
   only links that join something, so neither pairs nor groups are emitted;
4. components come from iterated joins over the confirmed links.

Every pair that shares a band is thereby confirmed or already connected.

Defined results: null, empty and wordless texts have n_shingles 0 and stand
alone; equal rows (same id and text) are one row; of an id with several texts
the first by key takes part, the others stand alone; a null id takes part in no
group and is returned with null component and kept = false; no rows give no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import GOLDEN, Tokens, mix64, read_table, seeds, text_slices, word_hashes
from fundlake.llm.components import connected_components
from fundlake.session import materialize

WORDS = 4
SIZE, BANDS, ROWS = 128, 32, 4
BLOCK = 512
#: Shared elements compared at a time in a block.
KINDS = 8192
#: Places of the bitmap of document ids (4 MB).
BITMAP = 1 << 25
MASK56 = np.uint64((1 << 56) - 1)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Fixed odd multipliers of the word places in a shingle.
PLACES = seeds(64, 4) | np.uint64(1)

SKETCHED = "doc_id bigint, text_key binary, n_shingles bigint, bands array<bigint>"


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, back to back, and the offsets."""
    tokens = Tokens(texts)
    hashes = word_hashes(tokens.words)[tokens.codes] if len(tokens.words) else np.zeros(0, np.uint64)
    sets, offsets = [], [0]
    with np.errstate(over="ignore"):
        joined = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
        for j in range(words):
            joined += hashes[j : j + len(joined)] * PLACES[j]
        joined = mix64(joined)
        for a, b in zip(tokens.offsets[:-1], tokens.offsets[1:]):
            if b - a >= words:
                own = np.unique(joined[a : b - words + 1])
            elif b > a:  # fewer words: the whole sequence is one shingle
                own = mix64((hashes[a:b] * PLACES[words : words + b - a]).sum(keepdims=True) + GOLDEN * np.uint64(b - a))
            else:
                own = joined[:0]
            sets.append(own)
            offsets.append(offsets[-1] + len(own))
    return (np.concatenate(sets) if sets else joined[:0]), np.array(offsets)


def sketch(elements: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` coordinates for each set.

    Coordinates of an empty set stay at the largest value.
    """
    n = len(offsets) - 1
    out = np.full((n, size), EMPTY, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    shift = np.uint64(64 - (size.bit_length() - 1))
    salt = seeds(2 * size, 11)
    for i in range(2 * size):
        if not len(owner):
            break
        with np.errstate(over="ignore"):
            z = mix64(elements ^ salt[i])
        value = (np.uint64(i) << np.uint64(56)) | (z & MASK56)
        place = (z >> shift).astype(np.int64) if i < size else np.full(len(z), i - size)
        np.minimum.at(flat, owner * size + place, value)
        open_ = (out == EMPTY).any(axis=1)[owner]
        if not open_.all():
            elements, owner = elements[open_], owner[open_]
    return out


def band_keys(sketches: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of the key."""
    with np.errstate(over="ignore"):
        parts = sketches.reshape(len(sketches), bands, rows) * PLACES[:rows]
        return mix64(parts.sum(axis=2, dtype=np.uint64) + seeds(bands, 12)).view(np.int64)


def text_keys(texts: pa.Array) -> pa.Array:
    """A 128-bit key of each exact text; null and empty texts share one."""
    import xxhash

    return pa.array([xxhash.xxh3_128_digest(t or b"") for t in texts.cast(pa.large_binary()).to_pylist()], pa.binary())


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, key of the exact text, set size and band keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            texts = part.column("text")
            elements, offsets = shingle_sets(texts)
            keys = band_keys(sketch(elements, offsets))
            sizes = np.diff(offsets)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, BANDS * len(keys) + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), text_keys(texts), pa.array(sizes), lists],
                names=["doc_id", "text_key", "n_shingles", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCHED)


def id_bitmap(ids: DataFrame, bits: int = BITMAP) -> np.ndarray:
    """A bitmap of ``bits`` hashed places of ids, summed up in Spark.

    Its size is fixed whatever the number of ids; a place is set for every id
    and, by chance, for others.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    rows = ids.select(place.alias("p")).groupBy(F.expr("p div 64").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b")
    )
    out = np.zeros(bits // 64, np.int64)
    for row in rows.toLocalIterator():
        out[row["w"]] = row["b"]
    return out.view(np.uint64)


def document_sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """id, key of the exact text and the sorted shingle hashes of the rows in a bitmap of ids."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for part in text_slices(batches, "text"):
            place = part.column("place").to_numpy().astype(np.uint64)
            part = part.filter(pa.array((bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)))
            if not part.num_rows:
                continue
            elements, offsets = shingle_sets(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").cast(pa.int64()), text_keys(part.column("text")),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(elements.view(np.int64)))],
                names=["id", "text_key", "elements"],
            )

    rows = docs.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(64 * len(wanted))).alias("place"))
    return rows.mapInArrow(run, "id bigint, text_key binary, elements array<bigint>")


def hub_pairs(classes: DataFrame) -> DataFrame:
    """(id, hub) for every class and the smallest member of each shared bucket.

    ``classes`` has id and bands. Buckets with one member are dropped before
    anything else; a hot bucket gives one row per member and is never gathered.
    """
    keyed = classes.select("id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    return keyed.join(shared.select("key", "hub"), "key").where("id > hub").select("id", "hub").distinct()


def _block_links(columns: list[np.ndarray], kinds: np.ndarray) -> np.ndarray:
    """0/1 incidence of each member's elements among ``kinds``."""
    out = np.zeros((len(columns), len(kinds)), np.float32)
    for i, own in enumerate(columns):
        at = np.searchsorted(kinds, own)
        ok = at < len(kinds)
        ok[ok] = kinds[at[ok]] == own[ok]
        out[i, at[ok]] = 1.0
    return out


def confirm_block(block: pd.DataFrame) -> pd.DataFrame:
    """Links inside one block of members of a hub, as a forest over components.

    Columns: id, root (component so far), side (0: unresolved rows, 1: the
    others; both sides hold unresolved rows of other blocks too), hub_size,
    added and removed (differences from the hub). Similarity is computed
    exactly: |x & y| = |hub| - |Dx u Dy| + |Ex & Ey|.
    """
    left, right = block[block["side"] == 0], block[block["side"] == 1]
    if left.empty or right.empty:
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    hub = int(block["hub_size"].iloc[0])

    def common(name: str) -> np.ndarray:
        """How many elements any two members share, over slices of the shared ones: memory is
        bounded by BLOCK x KINDS numbers a side, whatever the members add."""
        x, y = ([np.asarray(v, np.int64) for v in side[name]] for side in (left, right))
        kinds = np.intersect1d(np.concatenate(x), np.concatenate(y))
        total = np.zeros((len(x), len(y)), np.float32)
        for at in range(0, len(kinds), KINDS):
            part = kinds[at : at + KINDS]
            total += _block_links(x, part) @ _block_links(y, part).T
        return total

    def size(name: str) -> tuple[np.ndarray, np.ndarray]:
        return left[name].map(len).to_numpy(float)[:, None], right[name].map(len).to_numpy(float)[None, :]

    (ex, ey), (dx, dy) = size("added"), size("removed")
    inter = hub - (dx + dy - common("removed")) + common("added")
    union = (hub - dx + ex) + (hub - dy + ey) - inter
    differ = left["root"].to_numpy()[:, None] != right["root"].to_numpy()[None, :]
    i, j = np.nonzero((100 * inter >= 80 * union) & differ)
    ids = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
    links = pd.DataFrame({"a": ids[0], "b": ids[1], "u": left["root"].to_numpy()[i], "v": right["root"].to_numpy()[j]})
    # One link between each two components joins them as well as all of them.
    return links.drop_duplicates(["u", "v"])[["a", "b"]]


def near_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, root) components over ``classes (id, n_shingles, bands)``; singletons are absent."""
    sizes = classes.select("id", F.col("n_shingles").alias("n"))
    pairs = hub_pairs(classes.where("n_shingles > 0"))
    hubs = sizes.select(F.col("id").alias("hub"), F.col("n").alias("hub_size"))
    pairs = materialize(pairs.join(sizes, "id").join(hubs, "hub"), "hub_pairs")
    wanted = materialize(pairs.select("id").union(pairs.select("hub")).distinct(), "wanted")
    # The sets of wanted documents: a bitmap of fixed size leaves most others
    # out at the scan, so no text is shuffled; the join then is exact.
    own = wanted.join(classes.select("id", "text_key"), "id")
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    sets = document_sets(texts, id_bitmap(wanted)).join(own, ["id", "text_key"], "left_semi")
    sets = materialize(sets.dropDuplicates(["id", "text_key"]).drop("text_key"), "sets")

    hub_sets = sets.select(F.col("id").alias("hub"), F.col("elements").alias("hub_elements"))
    compared = (
        pairs.join(sets, "id")
        .join(hub_sets, "hub")
        .select(
            "id", "hub", "n", "hub_size",
            F.array_except("elements", "hub_elements").alias("added"),
            F.array_except("hub_elements", "elements").alias("removed"),
        )
        .withColumn("inter", F.col("n") - F.size("added"))
        .withColumn("linked", F.expr("100 * inter >= 80 * (n + hub_size - inter)"))
        # A member that is not linked with its hub can only be linked with
        # others of the hub when both keep enough in common with it; the
        # differences are carried on for that comparison.
        .drop("inter")
    )
    compared = materialize(compared, "compared")
    edges = compared.where("linked").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    first = connected_components(edges)

    # Hubs whose members are not yet in one component, and their members.
    rooted = (
        compared.join(first, "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
        .join(first.select(F.col("id").alias("hub"), F.col("root").alias("hub_root")), "hub", "left")
        .withColumn("hub_root", F.coalesce("hub_root", "hub"))
    )
    spread = rooted.groupBy("hub").agg(
        F.count("*").alias("members"), F.sum(F.expr("cast(root != hub_root as int)")).alias("loose")
    ).where("members > 1 and loose > 0")
    rooted = rooted.join(spread.select("hub", "members", "loose"), "hub")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    loose_blocks = F.ceil(F.col("loose") / BLOCK).cast("int")
    part = rooted.withColumn("h", F.xxhash64("id", "hub"))
    left = part.where("root != hub_root").select(
        "*", F.pmod("h", loose_blocks).alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"),
        F.lit(0).alias("side"),
    )
    right = part.select(
        "*", F.explode(F.sequence(F.lit(0), loose_blocks - 1)).alias("i"), F.pmod("h", blocks).alias("j"),
        F.lit(1).alias("side"),
    )
    columns = ["id", "hub", "i", "j", "side", "root", "hub_size", "added", "removed"]
    more = (
        left.select(*columns).union(right.select(*columns))
        # Dealt by block: by hub alone, all blocks of a hub would be one task's.
        .repartition("hub", "i", "j")
        .groupBy("hub", "i", "j")
        .applyInPandas(confirm_block, "a bigint, b bigint")
    )
    more = materialize(more, "block_links")
    return connected_components(edges.union(more))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every distinct row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketched = materialize(sketch_documents(docs), "sketched")
    # Several rows with the same id and text are one row.
    rows = sketched.groupBy("doc_id", "text_key").agg(F.first("n_shingles").alias("n_shingles"))
    # An id with several texts stands for its first text, by key.
    first = sketched.where("doc_id is not null").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    usable = sketched.join(first, ["doc_id", "text_key"], "left_semi")
    classes = materialize(
        usable.where("n_shingles > 0").groupBy("text_key").agg(
            F.min("doc_id").alias("id"), F.min("n_shingles").alias("n_shingles"), F.min("bands").alias("bands")
        ),
        "classes",
    )
    roots = near_links(docs.where("doc_id is not null"), classes)
    labelled = classes.select("text_key", "id").join(roots, "id", "left").select(
        "text_key", F.coalesce("root", "id").alias("root")
    )
    # The class of a hot text has one row here and a third of all rows there;
    # adaptive execution splits that side of the join.
    return rows.join(labelled, "text_key", "left").select(
        "doc_id",
        "n_shingles",
        F.expr("case when doc_id is not null then coalesce(root, doc_id) end").alias("component_id"),
        "text_key",
    ).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "text_key",
    )


def op4_fast_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group; repeated rows of an id are kept once.

    Rows without an id belong to no group and stay. The few ids that go are
    the joined side, so Spark broadcasts them when they are small.
    """
    state = near_duplicates(docs).where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = materialize(state.where("not kept").select("doc_id"), "gone")
    repeated = materialize(
        docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").join(gone, "doc_id", "left_anti").select("doc_id"),
        "repeated",
    )
    once = docs.join(gone.unionAll(repeated), "doc_id", "left_anti").select(*docs.columns)
    again = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return once.unionByName(again)
