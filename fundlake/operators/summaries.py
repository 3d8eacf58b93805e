"""Round summaries: an ordered monoid over segments of a company's elements (O-55).

The merge rule looks back: amounts and currencies count from the first dated element
on. A segment of consecutive elements keeps what any segment before or after it could need:

    at      place of its first element (row_ord, pos)
    k       place of its first dated element, null if it has none
    date    the date at k
    amount  largest amount from k on        whole_amount    of the whole segment
    cur     first currency from k on        whole_cur       of the whole segment

Two neighbours combine into the summary of both, associatively, so a company's
elements can be folded in any cuts: rows by blocks of 2**16 order numbers, blocks by
2**32, then the rest. Each fold collects at most one block's elements or 2**16
summaries of a (company, name), which bounds memory for a company of any size (up to
2**48 order numbers), and no join takes the first dates back to the elements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the order number that one fold after the other leaves out.
SEGMENT_BITS = (16, 32)

SINGLE = """named_struct('at', named_struct('row_ord', row_ord, 'pos', pos),
    'k', CASE WHEN date IS NOT NULL THEN named_struct('row_ord', row_ord, 'pos', pos) END, 'date', date,
    'amount', CASE WHEN date IS NOT NULL THEN famt END, 'cur', CASE WHEN date IS NOT NULL THEN cur END,
    'whole_amount', famt, 'whole_cur', cur)"""


def combine(a: str, b: str) -> str:
    """The summary of segment ``a`` and the segment ``b`` behind it, as a SQL expression."""
    return f"""named_struct('at', {a}.at, 'k', coalesce({a}.k, {b}.k),
    'date', if({a}.k IS NULL, {b}.date, {a}.date),
    'amount', if({a}.k IS NULL, {b}.amount, greatest({a}.amount, {b}.whole_amount)),
    'cur', if({a}.k IS NULL, {b}.cur, coalesce({a}.cur, {b}.whole_cur)),
    'whole_amount', greatest({a}.whole_amount, {b}.whole_amount),
    'whole_cur', coalesce({a}.whole_cur, {b}.whole_cur))"""


#: All summaries of a group in the order of their places, combined into one.
FOLD = f"""aggregate(slice(s, 2, greatest(size(s) - 1, 0)), s[0], (a, b) -> {combine('a', 'b')})"""


def summarize(elements: DataFrame, key: str, bits: Sequence[int] = SEGMENT_BITS) -> DataFrame:
    """(key, round_name, s): one summary per company and round name of the elements
    (key, row_ord, pos, round_name, date, famt, cur)."""
    groups = [key, "round_name"]
    found = elements.select(*groups, F.expr("CAST(row_ord AS BIGINT)").alias("row_ord"), F.expr(SINGLE).alias("s"))
    for shift in bits:
        segment = F.shiftright("row_ord", shift).alias("segment")
        found = fold(found.select(*groups, segment, "s"), [*groups, "segment"])
        found = found.withColumn("row_ord", F.col("s.at.row_ord"))
    # The last folds of one company meet on one task, with its few names.
    return fold(found.select(*groups, "s").repartition(key), groups)


def fold(summaries: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One summary per group, whose segments are the rows."""
    ordered = summaries.groupBy(*groups).agg(F.array_sort(F.collect_list("s")).alias("s"))
    return ordered.select(*groups, F.expr(FOLD).alias("s"))


def merged_rounds(summaries: DataFrame) -> DataFrame:
    """The merged rounds of summaries: names without a dated element disappear."""
    return summaries.where("s.k IS NOT NULL").select(
        *[c for c in summaries.columns if c != "s"],
        F.col("s.k").alias("k"),
        F.col("s.date").alias("date"),
        F.greatest(F.col("s.amount"), F.lit(0).cast("bigint")).alias("amount"),
        F.col("s.cur").alias("currency_symbol"),
    )
