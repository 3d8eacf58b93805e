"""Batched enrichment map with per-row error capture and retry (O-27..O-33).

The model / agent client is outside the engine: a user function takes one
row (a dict) and returns ``(json_text, total_tokens)`` or raises. Spark runs
it over Arrow batches with ``mapInArrow``; failures come back as values in
an ``error`` column instead of failing the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fundlake.schemas import RATE_LIMIT_MARKER
from fundlake.session import materialize, ship_package

RowFn = Callable[[dict], tuple[str, int]]
RESULT_SCHEMA = StructType([
    StructField("value", StringType()), StructField("error", StringType()), StructField("total_tokens", LongType()),
])


def _call(fn: RowFn, row: dict) -> tuple[str | None, str | None, int]:
    try:
        value, tokens = fn(row)
        return value, None, int(tokens or 0)
    except Exception as exc:  # noqa: BLE001 - errors are returned as data
        return None, f"{type(exc).__name__}: {exc}", 0


def batched_map(
    df: DataFrame,
    fn: RowFn,
    input_cols: Sequence[str],
    keep_cols: Sequence[str] = (),
    concurrency: int = 1,
) -> DataFrame:
    """O-27: apply ``fn`` to every row; output ``keep_cols`` + value, error,
    total_tokens. Kept columns pass through as Arrow arrays untouched, and the
    function gets Python values (None for NULL, exact integers).
    ``concurrency`` > 1 overlaps calls inside a batch (for a remote client);
    there is no barrier between batches, and the batch size is
    ``spark.sql.execution.arrow.maxRecordsPerBatch``."""
    inputs, kept = list(input_cols), list(dict.fromkeys(keep_cols))
    cols = list(dict.fromkeys([*kept, *inputs]))
    schema = StructType([*[df.schema[c] for c in kept], *RESULT_SCHEMA.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            for batch in batches:
                rows = batch.select(inputs).to_pylist()
                results = list(pool.map(lambda r: _call(fn, r), rows)) if pool else [_call(fn, r) for r in rows]
                values, errors, tokens = zip(*results) if results else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pa.array(values, pa.string()),
                     pa.array(errors, pa.string()), pa.array(tokens, pa.int64())],
                    names=[*kept, "value", "error", "total_tokens"],
                )
        finally:
            if pool:
                pool.shutdown()

    ship_package(df.sparkSession)
    return df.select(*cols).mapInArrow(run, schema)


def successes(results: DataFrame) -> DataFrame:
    """O-28: keep the rows that produced a value."""
    return results.where(F.col("error").isNull())


def with_retry(
    df: DataFrame,
    fn: RowFn,
    input_cols: Sequence[str],
    keep_cols: Sequence[str] = (),
    marker: str = RATE_LIMIT_MARKER,
    concurrency: int = 1,
) -> DataFrame:
    """O-30 + O-37: run once; rows whose error mentions ``marker`` run once
    more; the final outcome of every row, with an ``attempt`` column (the
    retried rows are appended after the first pass, bag union).

    Each pass is written once to the shared folder with its input columns, so
    every row is called once per pass whatever reads the result, and the second
    pass takes the written failures: no key is needed, and repeated or NULL keys
    are rows like any other."""
    carried = list(dict.fromkeys([*keep_cols, *input_cols]))
    inputs = [*input_cols, "attempt"]

    def one_pass(rows: DataFrame, attempt: int) -> DataFrame:
        rows = rows.select(*carried).withColumn("attempt", F.lit(attempt))
        return materialize(batched_map(rows, fn, inputs, [*carried, "attempt"], concurrency), f"replies{attempt}")

    first = one_pass(df, 1)
    limited = F.coalesce(F.col("error").contains(marker), F.lit(False))
    second = one_pass(first.where(limited), 2)
    wanted = [*keep_cols, "attempt", "value", "error", "total_tokens"]
    return first.where(~limited).select(*wanted).unionByName(second.select(*wanted))


def render_prompt(template: str, **cols: Column) -> Column:
    """O-32: interpolate row values into a prompt; ``{name}`` placeholders,
    ``{{``/``}}`` for literal braces (so schema text can be embedded)."""
    parts: list[Column] = []
    i, buf = 0, []
    while i < len(template):
        ch = template[i]
        if template.startswith("{{", i) or template.startswith("}}", i):
            buf.append(ch)
            i += 2
        elif ch == "{":
            end = template.index("}", i)
            parts.append(F.lit("".join(buf)))
            buf = []
            parts.append(F.coalesce(cols[template[i + 1:end]].cast("string"), F.lit("None")))
            i = end + 1
        else:
            buf.append(ch)
            i += 1
    parts.append(F.lit("".join(buf)))
    return F.concat(*parts)


def row_as_json(*cols: str) -> Column:
    """The company object handed to the enrichment step, as JSON text."""
    return F.to_json(F.struct(*cols))
