"""Reconciliation over arriving rows (O-54..O-56): keyed state folds each new element
into its (company, round name)'s summary.

The batch rule counts amounts and currencies from the first dated element on. Rows may
arrive in any order, so a later one can bring an earlier date; the state of a key is
therefore the summary from the first date on, and what stands before it reduced to
what an earlier date could still bring in: an element is kept only if it has a currency or
no later one of them has its amount or more. In order, a key holds its undated first
elements and one summary.

Every micro-batch returns the changed keys' merged rounds. :func:`land_rounds` writes them
under the batch's number (a repeated batch replaces itself) and :func:`current_rounds`
reads the latest of each key, equal to the batch result over all rows so far.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fundlake.operators import reconcile as R

Place = tuple[int, int]
Element = tuple[int, int, str | None, int, str | None]  # row_ord, pos, date, amount, currency


@dataclass
class RoundState:
    """What one (company, round name) keeps."""

    k: Place | None = None
    date: str | None = None
    amount: int | None = None
    cur: str | None = None
    cur_at: Place | None = None
    early: list[Element] = field(default_factory=list)  # undated, before k (or all, without one)

    def add(self, elements: list[Element]) -> None:
        dated = [e for e in elements if e[2] is not None]
        first = min(dated, default=None, key=lambda e: e[:2])
        if first is not None and (self.k is None or first[:2] < self.k):
            self.k, self.date = first[:2], first[2]
        pool = self.early + elements
        if self.k is None:
            self.early = needed(pool)
            return
        self.early = needed([e for e in pool if e[:2] < self.k])
        for row_ord, pos, _, amount, cur in pool:
            if (row_ord, pos) >= self.k:
                self.amount = amount if self.amount is None else max(self.amount, amount)
                if cur is not None and (self.cur_at is None or (row_ord, pos) < self.cur_at):
                    self.cur, self.cur_at = cur, (row_ord, pos)


def needed(early: list[Element]) -> list[Element]:
    """The undated elements that a date at or before them could still bring in."""
    kept, largest = [], None
    for e in sorted(early, key=lambda e: e[:2], reverse=True):
        if largest is None or e[3] > largest or e[4] is not None:
            kept.append(e)
        largest = e[3] if largest is None else max(largest, e[3])
    return kept[::-1]


PLACE = "row_ord bigint, pos int"
STATE = "k struct<row_ord: bigint, pos: int>, date string, amount bigint, cur string, cur_at struct<row_ord: bigint, pos: int>"
EARLY = f"{PLACE}, amount bigint, cur string"
MERGED = "company_name string, round_name string, k_row_ord bigint, k_pos int, date string, amount bigint, currency_symbol string"


def _text(value: Any) -> str | None:
    return None if value is None or value != value else value


class RoundProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summary = handle.getValueState("summary", STATE)
        self.early = handle.getListState("early", EARLY)

    def _load(self) -> RoundState:
        early = [(r[0], r[1], None, r[2], r[3]) for r in self.early.get()] if self.early.exists() else []
        if not self.summary.exists():
            return RoundState(early=early)
        k, date, amount, cur, cur_at = self.summary.get()
        return RoundState(tuple(k), date, amount, cur, tuple(cur_at) if cur_at is not None else None, early)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        state = self._load()
        for part in rows:
            state.add([(int(r), int(p), _text(d), int(a), _text(c)) for r, p, d, a, c in
                       zip(part["row_ord"], part["pos"], part["date"], part["famt"], part["cur"])])
        if state.early:
            self.early.put([(r, p, a, c) for r, p, _, a, c in state.early])
        else:
            self.early.clear()
        if state.k is not None:
            self.summary.update((state.k, state.date, state.amount, state.cur, state.cur_at))
            yield pd.DataFrame({
                "company_name": [key[0]], "round_name": [key[1]], "k_row_ord": [state.k[0]], "k_pos": [state.k[1]],
                "date": [state.date], "amount": [max(state.amount, 0)], "currency_symbol": [state.cur],
            })

    def close(self) -> None:
        pass


def rounds_stream(rows: DataFrame, key: str = "company_name", order_col: str = "row_ord", rounds_col: str = "funding_rounds") -> DataFrame:
    """The merged rounds of every key that new ``rows`` (a stream) change, in update mode."""
    rows = rows.where(F.col(key).isNotNull())
    ex = R.explode_elements(R.classify_rows(rows, rounds_col), key, order_col)
    elements = ex.where(F.col("kept") & F.col("bad").isNull()).select(F.col(key).alias("company_name"), "row_ord", "pos", "round_name", "date", "famt", "cur")
    return elements.groupBy("company_name", "round_name").transformWithStateInPandas(
        RoundProcessor(), outputStructType=MERGED, outputMode="Update", timeMode="None")


def land_rounds(merged: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every micro-batch's changes to ``path/batch=<number>``; needs the RocksDB state store."""

    def write(changes: DataFrame, number: int) -> None:
        changes.write.mode("overwrite").parquet(os.path.join(path, f"batch={number}"))

    return (merged.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def current_rounds(spark: SparkSession, path: str) -> DataFrame:
    """The latest merged rounds per company, ranked by their first dated place."""
    changes = spark.read.schema(f"{MERGED}, batch bigint").parquet(path)
    values = F.struct(*[F.col(c) for c in changes.columns if c not in ("company_name", "round_name", "batch")])
    latest = changes.groupBy("company_name", "round_name").agg(F.max_by(values, "batch").alias("v"))
    rank = F.row_number().over(Window.partitionBy("company_name").orderBy("v.k_row_ord", "v.k_pos")).cast("bigint")
    return latest.select("company_name", rank.alias("round_rank"), "round_name", "v.date", "v.amount", "v.currency_symbol")


#: What keyed state of this kind needs in the session.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
