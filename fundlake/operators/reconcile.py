"""Funding-round reconciliation per company (O-17, O-19, O-20, O-52..O-58).

Input: one row per (company, article) with the model's funding list as JSON
text. Output: one row per company holding its first row's columns and the
merged round list. Everything is built-in Spark; the plan is

    scan -> try_parse_json -> row checks -> posexplode_outer -> scalar normalisation
         -> summaries per (company, round, block of rows), folded (``summaries``)
         -> per-company list (at most one entry per vocabulary name)
         -> join with the first row per company (min_by, partial aggregate)

The JSON is parsed once: elements, first rows and quarantine are read from one
table. No (company, round) is folded in one piece, so a company holding a large
share of all rows never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions import dates, variant
from fundlake.functions import sql as S
from fundlake.operators.summaries import SEGMENT_BITS, merged_rounds, summarize
from fundlake.session import materialize
from fundlake.schemas import SCHEMA_ECHO_COLUMNS, UNKNOWN_ROUND

OK = "ok"
NULL_CELL = "null_cell"


@dataclass
class Reconciled:
    companies: DataFrame  # one row per company, funding_rounds ARRAY<STRUCT>
    rounds: DataFrame  # flat: company, rank, round_name, date, amount, currency
    quarantine: DataFrame  # rows / elements the original would abort on, with reason


# The element fields the stage reads, decoded in one cast.
ELEMENT_STRUCT = (
    "struct<type:variant,properties:variant,round_name:variant,"
    "date:variant,amount:variant,currency_symbol:variant>"
)


def classify_rows(df: DataFrame, rounds_col: str = "funding_rounds") -> DataFrame:
    """Add ``__arr`` (ARRAY<VARIANT>) and ``__status`` per input row.

    ``null_cell`` rows are the ones the original drops with ``notna`` (O-17),
    including a JSON ``null`` text. ``{}`` and ``""`` iterate as empty lists
    and stay. Malformed JSON and other top-level values are quarantined.
    """
    raw = F.col(rounds_col)
    staged = df.withColumn("__v", variant.parse(raw))
    staged = staged.withColumn("__arr", variant.as_array(F.col("__v"))).withColumn(
        "__t", F.when(F.col("__arr").isNull(), variant.vtype(F.col("__v")))
    )
    v, t, arr = F.col("__v"), F.col("__t"), F.col("__arr")
    status = (
        F.when(raw.isNull(), F.lit(NULL_CELL))
        .when(v.isNull(), F.lit("malformed_json"))
        .when(arr.isNotNull(), F.lit(OK))
        .when(t == "VOID", F.lit(NULL_CELL))
        .when(t == "OBJECT<>", F.lit(OK))
        .when((t == "STRING") & (F.try_variant_get(v, "$", "string") == ""), F.lit(OK))
        .otherwise(F.lit("not_a_list"))
    )
    return staged.withColumn("__status", status).drop("__v", "__t")


def explode_elements(classified: DataFrame, key: str, order_col: str, keep_raw: bool = False, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per array element with its fields decoded and checked.

    Columns: key, row_ord, pos, kept, bad (reason or NULL), round_name,
    date (MM/YY or NULL), famt (BIGINT), cur. Built in stages so every VARIANT
    type is derived once and the generated code stays small. ``carry`` adds
    columns of the row; rows without an element then stay, with a null ``pos``.
    """
    # Validity gates the generator instead of a Filter: a Filter on parse
    # results would be pushed below the parse into the scan and re-run it.
    explode = F.posexplode if carry is None else F.posexplode_outer
    ex = classified.select(
        F.col(key),
        F.col(order_col).alias("row_ord"),
        *[c.alias(n) for n, c in (carry or {}).items()],
        explode(F.when(F.col("__status") == OK, F.col("__arr"))).alias("pos", "e"),
    )
    k = [f"`{c}`" for c in [key, *(carry or {})]]
    # One VARIANT -> struct cast decodes every field (NULL for a non-object).
    ex = ex.selectExpr(*k, "row_ord", "pos", "e", f"try_variant_get(e, '$', '{ELEMENT_STRUCT}') AS f")
    ex = ex.selectExpr(
        *k, "row_ord", "pos", "e", "f IS NOT NULL AS is_obj", "f.type AS type_v", "f.properties AS props_v",
        "f.round_name AS rn_v", "f.date AS date_v", "f.amount AS amt_v", "f.currency_symbol AS cur_v",
    )
    ex = ex.selectExpr(
        "*", "schema_of_variant(type_v) AS type_t", "schema_of_variant(props_v) AS props_t",
        "schema_of_variant(rn_v) AS rn_t", "schema_of_variant(date_v) AS date_t",
        f"{S.amount_kind('schema_of_variant(amt_v)')} AS amt_k",
    )
    echo = f"(({S.truthy('type_v', 'type_t')}) AND ({S.truthy('props_v', 'props_t')}))"
    rn_is_str = "coalesce(rn_t = 'STRING', false)"
    bad_name = f"(rn_v IS NOT NULL AND NOT {rn_is_str} AND ({S.truthy('rn_v', 'rn_t')}))"
    ex = ex.selectExpr("*", f"{echo} AS echo", f"{bad_name} AS bad_name")
    ex = ex.selectExpr(
        *k, "row_ord", "pos",
        "is_obj AND NOT echo AS kept",
        f"""CASE WHEN pos IS NULL THEN NULL WHEN NOT is_obj THEN 'element_not_object' WHEN echo THEN NULL
                 WHEN bad_name THEN 'round_name_not_text'
                 WHEN {S.amount_out_of_range('amt_v', 'amt_k')} THEN 'amount_out_of_range' END AS bad""",
        f"CASE WHEN {rn_is_str} THEN try_variant_get(rn_v, '$', 'string') END AS rn_s",
        f"{S.scalar_text('rn_v', 'rn_t')} AS raw_name",
        "amt_k",
        f"CASE WHEN date_v IS NOT NULL AND date_t <> 'VOID' THEN {S.python_text('date_v', 'date_t')} END AS date_s",
        f"{S.coerce_amount('amt_v', 'amt_k')} AS famt",
        f"{S.scalar_text('cur_v', 'schema_of_variant(cur_v)')} AS cur",
        f"""CASE WHEN NOT is_obj OR bad_name OR {S.amount_out_of_range('amt_v', 'amt_k')}
                 THEN to_json(e) END AS element""",
    )
    ex = ex.selectExpr(
        "*", f"CASE WHEN rn_s IS NOT NULL THEN {S.fix_round_name('rn_s')} ELSE {S.lit(UNKNOWN_ROUND)} END AS round_name")
    out = dates.with_standardized_date(ex, "date_s", "date").drop("rn_s")
    if keep_raw:
        return out.withColumnRenamed("date_s", "raw_date")
    return out.drop("date_s", "raw_name", "amt_k")


def merge_rounds(elements: DataFrame, key: str, bits: Sequence[int] = SEGMENT_BITS) -> DataFrame:
    """O-55: merge a company's rounds by normalised name.

    For each (company, name): k = first position whose date normalises to a
    value; rounds before k are discarded; date = date at k; amount =
    max(0, floored amounts at positions >= k); currency = first non-null at
    positions >= k. Names with no dated round disappear.
    """
    return merged_rounds(summarize(elements, key, bits))


def round_lists(merged: DataFrame, key: str) -> DataFrame:
    """O-56: per company, the merged rounds ordered by first dated position.

    At most one entry per vocabulary name, so the collected list is bounded.
    """
    entry = F.struct(
        F.col("k"),
        F.struct(
            F.col("currency_symbol"), F.col("date"), F.col("amount"), F.col("round_name")
        ).alias("r"),
    )
    return merged.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["r"]).alias("funding_rounds")
    )


def first_rows(rows: DataFrame, key: str, others: Sequence[str]) -> DataFrame:
    """O-53: the first row (by ``row_ord``) of each company, nulls included."""
    picked = F.min_by("row", "row_ord").alias("row")
    return rows.groupBy(key).agg(picked).select(key, *[F.col(f"row.{c}").alias(c) for c in others])


def reconcile_funding(
    df: DataFrame,
    key: str = "company_name",
    order_col: str = "row_ord",
    rounds_col: str = "funding_rounds",
    drop_columns: tuple[str, ...] = SCHEMA_ECHO_COLUMNS,
    materialize_elements: bool = True,
    bits: Sequence[int] = SEGMENT_BITS,
) -> Reconciled:
    """Reconcile duplicate funding rounds per company (the step-3 stage).

    ``order_col`` (a whole number) must give the input row order (the original
    relies on file order, which Spark does not keep). Rows with a null key are
    dropped as a group-by on a null key does; rows the original would abort on
    go to ``quarantine`` instead. With ``materialize_elements`` the parsed
    elements are written once to the shared folder and all three results read
    them; without, each result parses the rows itself.
    """
    base = df.where(F.col(key).isNotNull())
    classified = classify_rows(base, rounds_col)
    others = [c for c in df.columns if c not in (key, rounds_col)]
    rejected = ~F.col("__status").isin(OK, NULL_CELL)
    parsed = explode_elements(classified, key, order_col, carry={
        "status": F.col("__status"),
        "cell": F.when(rejected, F.col(rounds_col)),
        "row": F.struct(*[F.col(c) for c in others]),
    })
    # The row's own columns stand with its first element only.
    first = F.coalesce("pos", F.lit(0)) == 0
    parsed = parsed.withColumn("row", F.when(first, F.col("row")))
    if materialize_elements:
        parsed = materialize(parsed, "funding-elements")
    elements = parsed.where(F.col("kept") & F.col("bad").isNull())
    lists = round_lists(merge_rounds(elements, key, bits), key)

    companies = (
        first_rows(parsed.where(first & (F.col("status") == OK)), key, others).join(lists, key, "left")
        .withColumn(
            "funding_rounds",
            F.coalesce(F.col("funding_rounds"), F.array().cast(lists.schema["funding_rounds"].dataType)),
        )
        .drop(*[c for c in drop_columns if c in others])
    )
    flat = lists.select(key, F.posexplode("funding_rounds").alias("pos", "r")).select(
        F.col(key),
        (F.col("pos") + 1).cast("bigint").alias("round_rank"),
        F.col("r.round_name").alias("round_name"),
        F.col("r.date").alias("date"),
        F.col("r.amount").alias("amount"),
        F.col("r.currency_symbol").alias("currency_symbol"),
    )
    bad_rows = parsed.where(~F.col("status").isin(OK, NULL_CELL)).select(
        F.col(key), "row_ord", F.lit(None).cast("int").alias("pos"), F.col("cell").alias("value"), F.col("status").alias("reason"),
    )
    bad_elements = parsed.where(F.col("bad").isNotNull()).select(
        F.col(key), "row_ord", "pos", F.col("element").alias("value"), F.col("bad").alias("reason")
    )
    return Reconciled(companies=companies, rounds=flat, quarantine=bad_rows.unionByName(bad_elements))
