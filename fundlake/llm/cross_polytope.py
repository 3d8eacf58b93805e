"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by pseudo-random rotations (three rounds of random
signs and a fast Hadamard transform) and named after the nearest signed axis,
the coordinate of largest absolute value with its sign. A table's hash joins as
many such names as :data:`BUCKET` vectors per bucket need at the number of
vectors at hand (the last name looks at the first coordinates only), so the
buckets stay small at every size. A query probes the buckets of each table whose
axes lose least against its own: :data:`PROBES` of them, or as many more as the
table at hand needs. That number is measured, not assumed: the true neighbours of
:data:`SAMPLE` queries are found by a scan, and probing goes so deep that
:data:`RECALL` of them lie in a probed bucket. Candidates are the distinct vectors of
the probed buckets, reranked exactly by cosine in double precision. A query with
fewer candidates than it may return neighbours is compared with all vectors.

Equal vectors are one entry of the index: it stands for its ids, and since no
query returns more than :data:`TOP` neighbours, the TOP + 1 smallest ids of an entry
are all that any query can return. A vector that a third of all rows share is
thus one candidate.

Vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows with null ids. An id given twice counts
once for the same vector; ties go to the smaller id; a query with fewer
candidates than TOP has fewer rows when the table itself has fewer; no rows
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from fundlake.llm.common import mix64, read_table, seeds
from fundlake.session import materialize

TOP = 5
TABLES = 48
PROBES = 16
BUCKET = 4
QUERY_EVERY = 50
#: Share of the sampled queries' true neighbours that the probed buckets must hold.
RECALL = 0.95
SAMPLE = 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix (length a power of two), normalised."""
    n = x.shape[1]
    h = 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.concatenate([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def rotate(x: np.ndarray, table: int, name: int) -> np.ndarray:
    """The pseudo-rotation of one name of one table: signs and Hadamard, three times."""
    n = 1 << (x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), n))
    padded[:, : x.shape[1]] = x
    for turn in range(3):
        bits = seeds(n, 1000 + table * 64 + name * 4 + turn) >> np.uint64(63)
        padded = hadamard(padded * (1.0 - 2.0 * bits))
    return padded


def name_sizes(vectors: int, dims: int, bucket: int = BUCKET) -> list[int]:
    """Coordinates looked at by each name, for about ``vectors / bucket`` buckets."""
    full = 1 << max(dims - 1, 0).bit_length()
    goal = max(vectors / bucket, 2.0)
    sizes = []
    while goal > 2 * full:
        sizes.append(full)
        goal /= 2 * full
    return [*sizes, min(full, max(1, math.ceil(goal / 2)))]


def probes(x: np.ndarray, table: int, sizes: list[int], count: int) -> np.ndarray:
    """The keys of the ``count`` best buckets of each row in one table; the first is its own."""
    keys, loss = np.zeros((len(x), 1), np.uint64), np.zeros((len(x), 1))
    for name, size in enumerate(sizes):
        y = rotate(x, table, name)[:, :size]
        signed = np.concatenate([y, -y], axis=1)
        few = min(count, signed.shape[1])
        best = np.argsort(-signed, axis=1, kind="stable")[:, :few]
        value = np.take_along_axis(signed, best, axis=1)
        missed = (value[:, :1] - value) ** 2
        # Both sides ascend, so a pair behind count others is none of the best.
        i, j = np.nonzero(np.arange(1, keys.shape[1] + 1)[:, None] * np.arange(1, few + 1) <= count)
        keys = keys[:, i] * np.uint64(2 * size) + best[:, j].astype(np.uint64)
        loss = loss[:, i] + missed[:, j]
        order = np.argsort(loss, axis=1, kind="stable")[:, :count]
        keys, loss = np.take_along_axis(keys, order, axis=1), np.take_along_axis(loss, order, axis=1)
    with np.errstate(over="ignore"):
        return mix64(keys + seeds(table + 1, 77)[-1])


def probes_needed(queries: np.ndarray, found: np.ndarray, owner: np.ndarray, sizes: list[int], tables: int, count: int) -> np.ndarray:
    """For each vector of ``found``, how many buckets a table its query (number ``owner``)
    must probe to meet it in some table; ``count`` + 1 if that many do not suffice."""
    needed = np.full(len(found), count + 1)
    step = max(1, (1 << 20) // count)
    for table in range(tables):
        home = probes(found, table, sizes, 1)
        for a in range(0, len(queries), step):
            own = np.flatnonzero((owner >= a) & (owner < a + step))
            same = probes(queries[a : a + step], table, sizes, count)[owner[own] - a] == home[own]
            needed[own] = np.where(same.any(axis=1), np.minimum(needed[own], same.argmax(axis=1) + 1), needed[own])
    return needed


def probes_for(
    queries: np.ndarray, found: np.ndarray, owner: np.ndarray, sizes: list[int], tables: int, least: int, recall: float = RECALL
) -> int:
    """The smallest number of probes, ``least`` or more, that meets ``recall`` of the true neighbours."""
    if not len(found):
        return least
    buckets, goal = math.prod(2 * s for s in sizes), math.ceil(recall * len(found)) - 1
    count = max(least, 16)
    while True:
        needed = np.sort(probes_needed(queries, found, owner, sizes, tables, count))
        if needed[goal] <= count or count >= buckets:
            return max(least, min(int(needed[goal]), buckets))
        count = min(count * 4, buckets)


def usable(table: DataFrame) -> DataFrame:
    """(id, vector as given) of the rows that take part, once each."""
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("vector")
    )
    fine = rows.where(
        "size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) "
        "and exists(vector, x -> x != 0)"
    )
    return fine


def entries(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(entry, vector, ids): one row per distinct vector with its top + 1 smallest ids."""
    keyed = rows.select("id", "vector", F.xxhash64("vector").alias("entry"))
    # Ranks run over parts of a hot vector's ids first.
    part = Window.partitionBy("entry", F.pmod(F.col("id"), F.lit(64))).orderBy("id")
    whole = Window.partitionBy("entry").orderBy("id")
    distinct = keyed.select("entry", "id").distinct()
    few = distinct.withColumn("r", F.row_number().over(part)).where(F.col("r") <= top + 1).drop("r")
    few = few.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= top + 1)
    ids = few.groupBy("entry").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return keyed.groupBy("entry").agg(F.first("vector").alias("vector")).join(ids, "entry")


def hashed(rows: DataFrame, key: str, sizes: list[int], tables: int, count: int) -> DataFrame:
    """(key, bucket) for ``count`` buckets in each of ``tables`` tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_at_once = max(1, min(1024, (1 << 14) // count))
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                column = part.column("vector")
                x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, -1)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                found = np.concatenate([probes(x, t, sizes, count) for t in range(tables)], axis=1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32()), pa.array(found.reshape(-1).view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([part.column(key), lists], names=[key, "buckets"])

    out = rows.select(key, "vector").mapInArrow(run, f"{key} bigint, buckets array<bigint>")
    return out.select(key, F.explode("buckets").alias("bucket"))


def true_neighbours(index: DataFrame, ids: list[int], x: np.ndarray, top: int) -> DataFrame:
    """(query, entry, vector) of the ``top`` other entries nearest to each row of ``x``, by a scan of the index."""
    shared = index.sparkSession.sparkContext.broadcast((np.array(ids, np.int64), x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                entry, column = part.column("entry").to_numpy(), part.column("vector")
                y = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, -1)
                score = queries @ (y / np.linalg.norm(y, axis=1, keepdims=True)).T
                score[own[:, None] == entry[None, :]] = -np.inf
                best = np.argsort(-score, axis=1, kind="stable")[:, :top]
                value = np.take_along_axis(score, best, axis=1)
                told = value > -np.inf
                place = pa.array(best[told])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, told.sum(axis=1))), pa.array(value[told]), part.column("entry").take(place),
                     column.cast(pa.list_(pa.float64())).take(place)],
                    names=["query", "score", "entry", "vector"],
                )

    scored = index.select("entry", "vector").mapInArrow(run, "query bigint, score double, entry bigint, vector array<double>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    return scored.withColumn("r", rank).where(F.col("r") <= top).select("query", "entry", "vector")


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def probe_depth(index: DataFrame, probing: DataFrame, sizes: list[int], top: int, tables: int, least: int) -> int:
    """Probes a table that find :data:`RECALL` of the true neighbours of a sample of the queries."""
    sample = probing.select("entry", "vector").orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).collect()
    if not sample:
        return least
    ids, x = [r["entry"] for r in sample], unit([r["vector"] for r in sample])
    found = true_neighbours(index, ids, x, top).collect()
    if not found:
        return least
    place = {entry: i for i, entry in enumerate(ids)}
    owner = np.array([place[r["query"]] for r in found])
    return probes_for(x, unit([r["vector"] for r in found]), owner, sizes, tables, least)


def cosines(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = np.stack(a.to_numpy()).astype(float), np.stack(b.to_numpy()).astype(float)
    dot = np.einsum("ij,ij->i", x, y)
    return pd.Series(dot / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y)))


def search(
    table: DataFrame, every: int = QUERY_EVERY, top: int = TOP, tables: int = TABLES, count: int = PROBES, bucket: int = BUCKET
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    rows = usable(table)
    sizes_seen = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes_seen is None:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims = sizes_seen["n"]
    rows = rows.where(F.size("vector") == dims)
    index = materialize(entries(rows, top), "entries")
    size = index.count()
    sizes = name_sizes(size, dims, bucket)
    asked = rows.where(F.pmod("id", F.lit(every)) == 0).select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("own"))
    # Queries with equal vectors probe once: the entries of queries are hashed.
    probing = index.join(asked.select(F.col("own").alias("entry")).distinct(), "entry", "left_semi")
    count = probe_depth(index, probing, sizes, top, tables, count)
    probed = hashed(probing.select(F.col("entry").alias("query"), "vector"), "query", sizes, tables, count)
    stored = hashed(index, "entry", sizes, tables, 1)
    pairs = materialize(probed.join(stored, "bucket").select("query", "entry").distinct(), "candidates")
    # A query is its own candidate; with fewer than top others it meets all vectors.
    short = pairs.groupBy("query").count().where(F.col("count") < min(top + 1, size)).select("query")
    if not short.isEmpty():
        pairs = pairs.unionByName(short.crossJoin(index.select("entry"))).distinct()
    vectors = index.select("entry", "vector")
    cosine = F.pandas_udf(cosines, DoubleType())
    scored = (
        pairs.join(vectors, "entry")
        .join(vectors.select(F.col("entry").alias("query"), F.col("vector").alias("query_vector")), "query")
        .select("query", "entry", cosine("query_vector", "vector").alias("score"))
    )
    # The best entries of a query, enough for its top neighbours even when it
    # is one of an entry's ids itself; then their ids.
    best = scored.withColumn("r", F.dense_rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("r") <= top + 1)
    told = best.join(index.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    answers = asked.distinct().join(told, asked["own"] == told["query"]).where("query_id != vec_id")
    ranked = answers.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))
