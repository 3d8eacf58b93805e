"""Loose records to a table (O-06, O-21) and dense order numbers (O-22, O-60)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.session import materialize

#: A union of keys wider than this is an error: keys that are data, not names.
MAX_COLUMNS = 2000

#: Merged VARIANT types that become a column type; all others stay JSON text.
_SCALARS = {"BOOLEAN": "boolean", "BIGINT": "bigint", "DOUBLE": "double", "STRING": "string", "DATE": "date", "TIMESTAMP": "timestamp"}


def record_keys(records: DataFrame, text_col: str, order_cols: Sequence[str]) -> DataFrame:
    """(key, type, first): every key of the JSON objects in ``text_col`` with its merged type
    and the place (order columns, position in its record) it is first seen at.

    Tasks merge types and places before anything is shuffled; one row per key is left."""
    parsed = records.select(*order_cols, F.try_parse_json(text_col).alias("v"), F.json_object_keys(text_col).alias("names"))
    members = parsed.select(*order_cols, F.try_variant_get("v", "$", "map<string, variant>").alias("m"), "names")
    each = members.select(*order_cols, "m", F.posexplode("names").alias("pos", "key"))
    return each.groupBy("key").agg(
        F.schema_of_variant_agg(F.col("m")[F.col("key")]).alias("type"),
        F.min(F.struct(*order_cols, "pos")).alias("first"),
    )


def column_type(merged: str) -> str | None:
    """The column type of a merged VARIANT type, None for JSON text."""
    return "double" if merged.startswith("DECIMAL") or merged == "FLOAT" else _SCALARS.get(merged)


def records_table(records: DataFrame, text_col: str, order_cols: Sequence[str], keep_cols: Sequence[str] = (),
                  max_columns: int = MAX_COLUMNS) -> DataFrame:
    """O-06, O-21: ``keep_cols`` and one column per key of any record, in the order the keys are
    first seen; a record without a key has NULL there.

    Columns are typed by the merged type of their values; keys with values of several types,
    arrays or objects give JSON text. A key whose name (in any case) is taken gets ``_`` in front.
    Text that is no JSON object gives a row without values. The driver sees one row per key."""
    found = record_keys(records, text_col, order_cols).orderBy("first").limit(max_columns + 1).collect()
    if len(found) > max_columns:
        raise ValueError(f"more than {max_columns} keys in {text_col}")
    taken = {c.lower() for c in keep_cols}
    columns: list[Column] = []
    for row in found:
        name = row.key
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        value, to = F.col("__m")[F.lit(row.key)], column_type(row.type)
        columns.append((F.try_variant_get(value, "$", to) if to else F.to_json(value)).alias(name))
    members = F.try_variant_get(F.try_parse_json(text_col), "$", "map<string, variant>").alias("__m")
    return records.select(*keep_cols, members).select(*keep_cols, *columns)


def order_numbers(df: DataFrame, by: Sequence[str], name: str = "row_ord", first: int = 0) -> DataFrame:
    """``df`` with dense numbers ``first``, ``first`` + 1, ... in the order of ``by``, the same
    under any partitioning; rows equal in ``by`` should be equal, as their order is open.

    Rows are range-partitioned and sorted, and written once with their place in the
    partition; a partition's first number is the count of all before it (one small row
    per partition), so nothing but the range sort moves rows."""
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = ordered.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()})
    placed = materialize(placed, "order-numbers")
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))  # the lower bits count within the partition
    numbered = placed.join(F.broadcast(starts), "__part")
    return numbered.withColumn(name, F.col("__start") + place + F.lit(first)).drop("__part", "__place", "__start")
