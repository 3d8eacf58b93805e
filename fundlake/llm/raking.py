"""Mixing sources to target weights by iterative proportional fitting
(DataFrame functions only).

Documents are counted into cells (source, language, topic) with their token
weights. Raking multiplies the cells in turn so that the sums by source, by
language and by topic meet their targets, :data:`SWEEPS` times over the three
margins. The targets are tempered shares: a source or language gets a share in
proportion to the square root of its tokens, topics get equal shares. Then a
document of a cell is sampled with probability min(1, k * raked weight /
tokens), where k is calibrated such that the expected number of sampled tokens
is :data:`RATE` of all tokens. The sampling number of a document is a hash of
its id, so a rerun samples the same documents.

The topic of a document is a column expression; by default one of
:data:`TOPICS` buckets of its alphabetically last word, since the tables have
no topic column.

The cells are a table that stays distributed: each margin is a partial
aggregation and a join back; only k (a number) comes to the driver.

Defined results: null and empty texts have no tokens and are never sampled
(probability 0, topic -1); null sources and languages are groups of their own,
named ''; equal rows get equal probabilities and share one sampling number;
no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import SPACE_CLASS, read_table
from fundlake.session import materialize

SWEEPS = 10
TOPICS = 8
RATE = 0.8
TEMPER = 0.5
MARGINS = ("source", "lang", "topic")


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def last_word_topic(words: Column, topics: int = TOPICS) -> Column:
    """A bucket of the alphabetically last word; -1 without words."""
    bucket = F.conv(F.substring(F.md5(F.array_max(words)), 1, 4), 16, 10).cast("int") % topics
    return F.coalesce(bucket, F.lit(-1))


def sampling_number(doc_id: Column) -> Column:
    """A number in [0, 1) from the id alone."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def document_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, margins and token count of each row."""
    split = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
        words(F.col("text")).alias("words"),
    )
    return split.select(
        "doc_id", "source", "lang", last_word_topic(F.col("words")).alias("topic"),
        F.size("words").cast("bigint").alias("n_tokens"),
    )


def rake(cells: DataFrame, sweeps: int = SWEEPS, temper: float = TEMPER) -> DataFrame:
    """``cells`` (margins, tokens > 0) with their raked weight; the weights sum to 1."""
    for margin in MARGINS:
        power = 0.0 if margin == "topic" else temper
        share = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("s"))
        whole = share.agg(F.sum("s").alias("all"))
        share = share.crossJoin(F.broadcast(whole)).select(margin, (F.col("s") / F.col("all")).alias(f"to_{margin}"))
        cells = cells.join(share, margin)
    cells = materialize(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for _ in range(sweeps):
        for margin in MARGINS:
            now = cells.groupBy(margin).agg(F.sum("weight").alias("now"))
            cells = cells.join(now, margin).withColumn("weight", F.col("weight") * F.col(f"to_{margin}") / F.col("now")).drop("now")
        cells = materialize(cells, "cells")
    return cells


def calibrate(cells: DataFrame, rate: float = RATE) -> float:
    """k such that sum(tokens * min(1, k * weight / tokens)) = rate * sum(tokens)."""
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return 0.0
    k = 0.0
    capped = F.lit(k) * F.col("weight") >= F.col("tokens")
    while True:
        full, free = cells.agg(
            F.coalesce(F.sum(F.when(capped, F.col("tokens"))), F.lit(0)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if not free:
            return k
        after = (rate * total - full) / free
        if after <= k * (1 + 1e-12):
            return k
        k = after
        capped = F.lit(k) * F.col("weight") >= F.col("tokens")


def mix(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, margins, n_tokens, probability and sampled for every row."""
    counted = materialize(document_tokens(docs), "document_tokens")
    cells = counted.where("n_tokens > 0").groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    raked = rake(materialize(cells, "cells"))
    k = calibrate(raked, rate)
    chance = raked.select(*MARGINS, F.least(F.lit(1.0), F.lit(k) * F.col("weight") / F.col("tokens")).alias("p"))
    chance = materialize(chance, "chances")
    joined = counted.join(chance, list(MARGINS), "left")
    return joined.select(
        "doc_id", *MARGINS, "n_tokens", F.round(F.coalesce("p", F.lit(0.0)), 6).alias("probability")
    ).withColumn("sampled", sampling_number(F.col("doc_id")) < F.col("probability"))


def op2_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the sampled documents.

    The probability of a row follows from its own columns and its cell, so it is
    looked up by cell and the texts are not shuffled by id.
    """
    counted = materialize(document_tokens(docs), "document_tokens")
    cells = counted.where("n_tokens > 0").groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    raked = rake(materialize(cells, "cells"))
    k = calibrate(raked)
    chance = materialize(
        raked.select(*MARGINS, F.round(F.least(F.lit(1.0), F.lit(k) * F.col("weight") / F.col("tokens")), 6).alias("p")), "chances"
    )
    # The documents' own margins meet the chances, so that rows without id are sampled like others.
    told = docs.withColumns({
        "__source": F.coalesce("source", F.lit("")), "__lang": F.coalesce("lang", F.lit("")),
        "__topic": last_word_topic(words(F.col("text"))),
    })
    chance = chance.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("p").alias("__p"))
    taken = told.join(chance, [f"__{m}" for m in MARGINS]).where(sampling_number(F.col("doc_id")) < F.col("__p"))
    return taken.select(*docs.columns)


def oracle_parts(table: str = "documents", sweeps: int = SWEEPS) -> list[str]:
    """DuckDB common table expressions up to ``sampled`` (one row per document)."""
    parts = [
        "ws as (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, "
        "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words "
        f"from {table})",
        "counted as (select doc_id, source, lang, coalesce(cast('0x' || substr(md5(list_max(words)), 1, 4) as int) "
        f"% {TOPICS}, -1) as topic, len(words) as n_tokens from ws)",
        "c0 as (select source, lang, topic, sum(n_tokens)::double as tokens from counted where n_tokens > 0 group by all)",
    ]
    for margin in MARGINS:
        power = 0.0 if margin == "topic" else TEMPER
        parts.append(
            f"t_{margin} as (select {margin}, s / sum(s) over () as goal from "
            f"(select {margin}, pow(sum(tokens), {power}) as s from c0 group by 1))"
        )
    parts.append("r0 as materialized (select *, tokens as weight from c0)")
    at = 0
    for _ in range(sweeps):
        for margin in MARGINS:
            parts.append(
                f"r{at + 1} as materialized (select r.source, r.lang, r.topic, r.tokens, "
                f"r.weight * t.goal / sum(r.weight) over (partition by r.{margin}) as weight "
                f"from r{at} r join t_{margin} t using ({margin}))"
            )
            at += 1
    parts += [
        # Cells are capped from the largest weight / tokens on; k follows from the rest.
        f"ranked as (select *, weight / tokens as ratio, "
        "coalesce(sum(tokens) over (order by weight / tokens desc, source, lang, topic rows between unbounded preceding and 1 preceding), 0) as full_tokens, "
        "sum(weight) over (order by weight / tokens desc, source, lang, topic rows between current row and unbounded following) as free_weight "
        f"from r{at})",
        f"ks as (select ({RATE} * (select sum(tokens) from c0) - full_tokens) / free_weight as k, ratio from ranked)",
        "best as (select arg_max(k, ratio) as k from ks where k * ratio < 1)",
        "chances as (select source, lang, topic, least(1.0, (select k from best) * weight / tokens) as p "
        f"from r{at})",
        "sampled as (select d.doc_id, d.source, d.lang, d.topic, cast(d.n_tokens as bigint) as n_tokens, "
        "round(coalesce(c.p, 0.0), 6) as probability, "
        "cast('0x' || substr(md5(coalesce(cast(d.doc_id as varchar), '')), 1, 13) as bigint) / 4503599627370496.0 "
        "< round(coalesce(c.p, 0.0), 6) as sampled "
        "from counted d left join chances c using (source, lang, topic))",
    ]
    return parts


def oracle() -> str:
    return "with " + ",\n".join(oracle_parts()) + "\nselect doc_id, source, lang, topic, n_tokens, probability, sampled from sampled"
