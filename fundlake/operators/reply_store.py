"""Landed replies (O-27, O-29..O-31): a store keyed by a hash of the call's input.

Replies of a paid model are worth more than the job that asks for them. Every
task writes its replies to the store as they come, in files of at most
:data:`FLUSH` replies, and also when it fails, so a job that is started again
calls only for inputs the store does not have; a task that runs again skips what its
earlier attempts wrote. A worker that dies without a chance to write loses at
most the replies since its last file.

The store is a folder of Parquet files (key, attempt, value, error, total_tokens).
Equal inputs share one call. Files are written whole or not at all; a key written
twice (by a task that ran twice at a time) counts once.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.enrich import RowFn, _call
from fundlake.schemas import RATE_LIMIT_MARKER
from fundlake.session import ship_package

FLUSH = 100
STORE = "key string, attempt int, value string, error string, total_tokens bigint"
_ARROW = pa.schema([("key", pa.string()), ("attempt", pa.int32()), ("value", pa.string()), ("error", pa.string()), ("total_tokens", pa.int64())])


def input_key(*cols: str) -> Column:
    """The hash of a call's input: names and values of its columns, nulls included."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """One row per key and attempt of the store (none, if there is no store yet)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], STORE)
    rows = spark.read.schema(STORE).option("pathGlobFilter", "*.parquet").parquet(store)
    return rows.groupBy("key", "attempt").agg(*[F.min(c).alias(c) for c in ("value", "error", "total_tokens")])


def _folder(store: str) -> tuple:
    from pyarrow import fs

    if "://" in store:
        return fs.FileSystem.from_uri(store)
    return fs.LocalFileSystem(), os.path.abspath(store.removeprefix("file:"))


def land_replies(todo: DataFrame, fn: RowFn, input_cols: Sequence[str], attempt: int, store: str,
                 concurrency: int = 1, flush: int = FLUSH) -> None:
    """Call ``fn`` for every row of ``todo`` (key and inputs) and write the replies to the store."""
    inputs, run_id = list(input_cols), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store_fs, folder = _folder(store)
        prefix = f"{run_id}-{attempt}-{task.partitionId():06d}-"
        done: set[str] = set()
        if task.attemptNumber() > 0:  # what this task's earlier attempts wrote
            from pyarrow import fs

            for info in store_fs.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.base_name.startswith(prefix):
                    with store_fs.open_input_file(info.path) as f:
                        done.update(pq.read_table(f, columns=["key"])["key"].to_pylist())
        held: list[tuple] = []
        files = 0

        def write() -> None:
            nonlocal files
            if not held:
                return
            store_fs.create_dir(folder, recursive=True)
            name = f"{prefix}{task.attemptNumber():02d}-{files:06d}"
            draft = f"{folder}/_{name}"
            with store_fs.open_output_stream(draft) as out:
                pq.write_table(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW), out)
            store_fs.move(draft, f"{folder}/{name}.parquet")
            files += 1
            held.clear()

        def call(row: dict) -> None:
            key = row.pop("key")
            held.append((key, attempt, *_call(fn, {**row, "attempt": attempt})))

        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        calls = 0
        try:
            for batch in batches:
                rows = [r for r in batch.select(["key", *inputs]).to_pylist() if r["key"] not in done]
                for at in range(0, len(rows), flush):
                    part = rows[at : at + flush]
                    for _ in (pool.map(call, part) if pool else map(call, part)):
                        calls += 1
                    write()
        finally:
            if pool:
                pool.shutdown(cancel_futures=True)
            write()
        yield pa.RecordBatch.from_arrays([pa.array([calls], pa.int64())], names=["calls"])

    ship_package(todo.sparkSession)
    todo.select("key", *inputs).mapInArrow(run, "calls bigint").agg(F.sum("calls")).collect()


def with_stored_replies(df: DataFrame, fn: RowFn, input_cols: Sequence[str], store: str, keep_cols: Sequence[str] = (),
                        marker: str = RATE_LIMIT_MARKER, concurrency: int = 1, flush: int = FLUSH) -> DataFrame:
    """O-27, O-28, O-30 over a store: ``keep_cols``, attempt, value, error and total_tokens of
    every row's final reply. Only inputs without a stored reply are called, and once more those
    whose first reply says ``marker``."""
    spark = df.sparkSession
    keyed = df.select(*dict.fromkeys([*keep_cols, *input_cols])).withColumn("key", input_key(*input_cols))
    calls = keyed.select("key", *input_cols).dropDuplicates(["key"])
    for attempt in (1, 2):
        stored = read_store(spark, store)
        todo = calls.join(stored.where(F.col("attempt") == attempt).select("key"), "key", "left_anti")
        if attempt == 2:
            limited = stored.where((F.col("attempt") == 1) & F.col("error").contains(marker)).select("key")
            todo = todo.join(limited, "key", "left_semi")
        land_replies(todo, fn, input_cols, attempt, store, concurrency, flush)
    reply = F.struct("value", "error", "total_tokens")
    final = read_store(spark, store).groupBy("key").agg(F.max_by(reply, "attempt").alias("r"), F.max("attempt").alias("attempt"))
    return keyed.join(final, "key").select(*keep_cols, "attempt", "r.value", "r.error", "r.total_tokens")
