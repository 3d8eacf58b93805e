"""Lookup joins: update-by-key (O-24), organisation lookup (O-25) and text
search over a documents table (O-26, the re-aimed search tools)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.schemas import ORGANIZATION_FIELDS

# Word characters for tokenising search text: letters and digits, any script.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def add_missing_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """O-21: add every listed column not already present, as NULL strings."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def update_join(
    rows: DataFrame,
    results: DataFrame,
    key: str,
    value_col: str,
    order_col: str,
    target_col: str,
) -> DataFrame:
    """O-24: set ``target_col`` on every row whose ``key`` has a result.

    The latest result per key (highest ``order_col``) wins; rows without a
    result keep their previous value. Results are reduced per key with a
    partial aggregate first, so a key with many results never sends them all
    to one task, and the join side has one row per key.
    """
    rows = add_missing_columns(rows, [target_col])
    latest = results.groupBy(key).agg(
        F.max_by(F.col(value_col), F.col(order_col)).alias("__new"),
        F.lit(True).alias("__hit"),
    )
    joined = rows.join(latest, key, "left")
    return joined.withColumn(
        target_col, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(target_col))
    ).drop("__new", "__hit")


def organization_lookup(
    names: DataFrame,
    organizations: DataFrame,
    name_col: str = "company_name",
    facet: str = "company",
    fields: Sequence[str] = ORGANIZATION_FIELDS,
) -> DataFrame:
    """O-25: look each name up among organisations with ``facet`` in
    ``facet_ids`` and ``identifier`` equal to the name; project the
    organisation fields. The facet predicate is applied before the join, so
    it prunes the lookup side at the scan. Unmatched names keep NULL fields.
    The join strategy is left to Spark: a file-backed lookup table carries
    size statistics, so it is broadcast only when below the threshold."""
    orgs = organizations.where(F.array_contains("facet_ids", facet)).select(
        F.col("identifier").alias("__identifier"), *[F.col(f).alias(f"org_{f}") for f in fields]
    )
    return names.join(orgs, names[name_col] == orgs["__identifier"], "left").drop("__identifier")


def occurrences(text: Column, needle: Column) -> Column:
    """Non-overlapping occurrences of ``needle`` in ``text``."""
    return ((F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.length(needle)).cast("bigint")


def text_search(
    queries: DataFrame,
    documents: DataFrame,
    k: int = 3,
    query_id: str = "item_id",
    query_text: str = "text",
    doc_id: str = "doc_id",
    doc_text: str = "text",
    topk_buckets: int = 64,
) -> DataFrame:
    """O-26: for each query passage, the top ``k`` documents containing it,
    scored by occurrence count, ties by document id.

    Exact and without a cross join: a document containing the passage
    contains every *interior* token of the passage (one with a separator on
    both sides inside the passage) as a whole token. Each passage is anchored
    on its interior token found in the fewest documents; candidates come from
    an equi-join on that token, and the real substring count confirms them.
    A passage without an interior token (one or two words) is anchored on the
    document tokens that contain its longest token: its rarest character
    n-gram finds them in the vocabulary. A passage without any token (marks
    only) is compared with every document, as a stated query set; an empty or
    NULL passage has no answer.
    """
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_text).alias("qtext"))
    q = q.withColumn("__toks", F.split("qtext", TOKEN_SPLIT))
    q = q.withColumn(
        "__interior",
        F.filter(F.slice("__toks", 2, F.greatest(F.size("__toks") - 2, F.lit(0))), lambda t: t != ""),
    )
    q = q.where(F.length("qtext") > 0)
    short = q.where(F.size("__interior") == 0).withColumn(
        "piece", F.array_max(F.transform(F.filter("__toks", lambda t: t != ""), lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    )
    q_tokens = q.select("qid", F.explode("__interior").alias("token")).distinct()
    all_tokens = documents.select(F.col(doc_id).alias("did"), F.explode(F.split(F.col(doc_text), TOKEN_SPLIT)).alias("token"))
    short_tokens = tokens_containing(short.where(F.col("piece").isNotNull()).select("qid", "piece"), all_tokens.select("token").distinct())

    # Document tokens, restricted to tokens some query uses (the query side
    # is the small side; Spark picks the join strategy from its size).
    wanted = q_tokens.select("token").union(short_tokens.select("token")).distinct()
    d_tokens = all_tokens.join(wanted, "token", "left_semi").distinct()
    doc_freq = d_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    anchors = (
        q_tokens.join(doc_freq, "token")
        .groupBy("qid")
        .agg(F.min_by("token", F.struct("df", "token")).alias("token"))
    )
    candidates = (
        anchors.join(d_tokens, "token").select("qid", "did")
        .union(short_tokens.join(d_tokens, "token").select("qid", "did").distinct())
        .union(
            documents.select(F.col(doc_id).alias("did"), F.col(doc_text).alias("dtext"))
            .join(short.where(F.col("piece").isNull()).select("qid", "qtext"), F.col("dtext").contains(F.col("qtext")))
            .select("qid", "did")
        )
    )
    scored = (
        candidates.join(q.select("qid", "qtext"), "qid")
        .join(documents.select(F.col(doc_id).alias("did"), F.col(doc_text).alias("dtext")), "did")
        .select("qid", "did", occurrences(F.col("dtext"), F.col("qtext")).alias("score"))
        .where(F.col("score") > 0)
    )
    # Top-k in two levels so a passage found in a large share of all
    # documents never sorts all its matches in one task: first per (passage,
    # document bucket), then over at most buckets * k survivors per passage.
    # Exact: every global top-k row is in the top k of its own bucket.
    order = [F.col("score").desc(), F.col("did")]
    bucket = F.pmod(F.xxhash64("did"), F.lit(topk_buckets))
    local = (scored.withColumn("__b", bucket)
             .withColumn("__r", F.row_number().over(Window.partitionBy("qid", "__b").orderBy(*order)))
             .where(F.col("__r") <= k).drop("__b", "__r"))
    w = Window.partitionBy("qid").orderBy(*order)
    top = local.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
    return top.select(F.col("qid").alias(query_id), F.col("did").alias(doc_id), "score", "rank")


def tokens_containing(pieces: DataFrame, vocabulary: DataFrame, n: int = 3) -> DataFrame:
    """(qid, token): the tokens of ``vocabulary`` that contain each ``(qid, piece)``.

    Joined on the piece's n-gram that the fewest tokens hold (the whole piece,
    if shorter), then confirmed."""
    def grams(text: str, size: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(F.col(text), i, size))

    own = pieces.withColumn("size", F.least(F.lit(n), F.length("piece")))
    own = own.select("qid", "piece", F.explode(F.array_distinct(grams("piece", F.col("size")))).alias("gram"))
    of_size = [F.when(F.length("token") >= k, grams("token", F.lit(k))).otherwise(F.array().cast("array<string>")) for k in range(1, n + 1)]
    held = vocabulary.where("token <> ''").select("token", F.explode(F.array_distinct(F.concat(*of_size))).alias("gram"))
    held = held.join(own.select("gram").distinct(), "gram", "left_semi")
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = own.join(counts, "gram").groupBy("qid", "piece").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    return rarest.join(held, "gram").where(F.col("token").contains(F.col("piece"))).select("qid", "token")
