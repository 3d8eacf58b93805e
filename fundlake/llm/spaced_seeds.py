"""Benchmark decontamination by spaced-seed hashing (DataFrame functions only).

A fixed mask picks :data:`WEIGHT` of :data:`SPAN` neighbouring words and ignores
the others, so a substituted word under an ignored place does not hide a copied
passage. For every mask the seeds of the benchmark items are joined with those
of the documents; each hit fixes an alignment of a document with an item, and
every alignment is verified on the words themselves: a window of
:data:`WINDOW` words (the item's length, if shorter) with at least 80 % equal
words marks the pair as an overlap.

Items with fewer than :data:`SHORT` words are too short for the masks. They are cut into
runs of words, one more than the verification lets substituted words be, of which at least
one is thus copied as it is; runs are joined by hash, so no overlap of such an item is missed.

Documents are read in segments of :data:`SEGMENT` words with SPAN - 1 words of
the next one, so a very long text needs no long row; nothing is cut off. The
seeds of the benchmark are broadcast behind a check of their number
(:data:`BROADCAST_SEEDS`); beyond it Spark joins by shuffling.

Defined results: null or empty texts and items without words give
no rows; repeated rows of a document give one row per document and item; no
rows on either side give no rows; rows with null ids are ignored; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import SPACE_CLASS, read_table
from fundlake.session import materialize

SPAN = 10
#: Word places looked at by each mask (fixed values); all begin at 0 and end at 9. Whichever
#: two words of a window are substituted, one mask at one place ignores both.
MASKS = ((0, 1, 2, 4, 7, 9), (0, 2, 5, 6, 8, 9), (0, 3, 4, 6, 7, 9), (0, 1, 3, 5, 6, 9))
WEIGHT = 6
WINDOW = 13
SHARE = 80
SEGMENT = 4096
BROADCAST_SEEDS = 1_000_000
#: Items of fewer words are searched by runs of words.
SHORT = 15


def words(text: Column) -> Column:
    """The words of a text, lower case; white space is 0x20 and 0x09-0x0D."""
    return F.split(F.lower(text), SPACE_CLASS)


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def seeds_of(table: DataFrame, key: str) -> DataFrame:
    """(key, at, seed) for every mask and word position; ``table`` has key and text."""
    hashed = table.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, word_hashes(F.col("text")).alias("h"))
    segments = hashed.select(
        key, "h", F.explode(F.expr(f"sequence(0L, cast((size(h) - 1) div {SEGMENT} as bigint))")).alias("s")
    ).select(key, "s", F.expr(f"slice(h, cast(s * {SEGMENT} + 1 as int), {SEGMENT + SPAN - 1})").alias("h"))
    views = [f"slice(h, {i + 1}, {SEGMENT}) as w{i}" for i in range(SPAN)]
    zipped = segments.selectExpr(key, "s", *views).selectExpr(
        key, "s", f"posexplode(arrays_zip({', '.join(f'w{i}' for i in range(SPAN))})) as (p, w)"
    )
    whole = zipped.where(f"w.w{SPAN - 1} is not null")
    hashed = F.array(*[F.xxhash64(F.lit(m), *[F.col(f"w.w{i}") for i in mask]) for m, mask in enumerate(MASKS)])
    return whole.select(key, (F.col("s") * SEGMENT + F.col("p")).alias("at"), F.explode(hashed).alias("seed"))


def item_hashes(items: DataFrame) -> DataFrame:
    """(item_id, iw, n, short): an item's word hashes; white space around a short item is no word of it."""
    split = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        "item_id", words(F.col("text")).alias("raw"), F.filter(words(F.col("text")), lambda w: w != "").alias("real")
    )
    short = F.size("real") < SHORT
    return split.select(
        "item_id", F.transform(F.when(short, F.col("real")).otherwise(F.col("raw")), lambda w: F.xxhash64(w)).alias("iw"),
        F.size("real").alias("n"), short.alias("short"),
    )


def short_runs(n: int) -> tuple[int, list[int]]:
    """Length and beginnings of the runs of an item of ``n`` words: one run more than a window
    may have substituted words, all of them in every window of the item."""
    window = min(WINDOW, n)
    runs = window - -(-SHARE * window // 100) + 1
    size = (window - (n - window)) // runs
    return size, [n - window + i * size for i in range(runs)]


def short_hits(docs: DataFrame, items: DataFrame, broadcast_seeds: int) -> DataFrame | None:
    """Distinct (doc_id, item_id, shift) for the runs of short items; None without such items."""
    short = item_hashes(items).where("short and n > 0")
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())
    if not lengths:
        return None
    runs = [(n, *short_runs(n)) for n in lengths]
    pieces = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(size).alias("size"), F.lit(at).alias("at")) for n, size, ats in runs for at in ats])
    known = short.select("item_id", "iw", "n", F.explode(F.filter(pieces, lambda p: p["n"] == F.col("n"))).alias("p")).selectExpr(
        "item_id", "p.at as item_at", "p.size as size", "xxhash64(slice(iw, p.at + 1, p.size)) as seed"
    )
    known = materialize(known, "short_item_runs")
    sizes = sorted({size for _, size, _ in runs})
    longest = sizes[-1]
    hashed = docs.where("doc_id is not null and text is not null").select("doc_id", word_hashes(F.col("text")).alias("h"))
    segments = hashed.select(
        "doc_id", "h", F.explode(F.expr(f"sequence(0L, cast((size(h) - 1) div {SEGMENT} as bigint))")).alias("s")
    ).select("doc_id", "s", F.expr(f"slice(h, cast(s * {SEGMENT} + 1 as int), {SEGMENT + longest - 1})").alias("h"))
    placed = segments.selectExpr(
        "doc_id", f"s * {SEGMENT} as base", "h", f"explode(sequence(1, least(size(h), {SEGMENT}))) as p"
    ).select(
        "doc_id", (F.col("base") + F.col("p") - 1).alias("at"),
        F.explode(F.array(*[
            F.struct(F.lit(size).alias("size"), F.expr(f"if(p + {size - 1} <= size(h), xxhash64(slice(h, p, {size})), null)").alias("seed"))
            for size in sizes
        ])).alias("r"),
    ).selectExpr("doc_id", "at", "r.size as size", "r.seed as seed")
    few = known.count() <= broadcast_seeds
    found = placed.join(F.broadcast(known) if few else known, ["size", "seed"])
    return found.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


def seed_hits(docs: DataFrame, items: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """Distinct (doc_id, item_id, shift): word i of the item lies at word i + shift of the text."""
    long = items.join(item_hashes(items).where("not short").select("item_id").distinct(), "item_id", "left_semi")
    known = materialize(
        seeds_of(long, "item_id").select("item_id", F.col("at").alias("item_at"), "seed").distinct(), "item_seeds"
    )
    few = known.count() <= broadcast_seeds
    found = seeds_of(docs, "doc_id").join(F.broadcast(known) if few else known, "seed")
    hits = found.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    short = short_hits(docs, items, broadcast_seeds)
    return hits if short is None else hits.unionByName(short)


def overlaps(docs: DataFrame, items: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(doc_id, item_id, matched, window, start) for every verified overlap.

    ``matched`` is the largest number of equal words in a window, ``start`` the
    word of the document at which the first word of the item lies, of the best
    alignment (the first, if several are as good; negative when the item's
    beginning is missing).
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    hits = materialize(seed_hits(docs, items, broadcast_seeds), "seed_hits")
    item_words = item_hashes(items).select("item_id", "iw")
    doc_words = docs.join(hits.select("doc_id").distinct(), "doc_id", "left_semi").select(
        "doc_id", word_hashes(F.col("text")).alias("dw")
    )
    aligned = hits.join(doc_words, "doc_id").join(item_words, "item_id")
    # 1 where a word of the item equals the word of the text it lies on.
    equal = aligned.select(
        "doc_id", "item_id", "shift",
        F.expr(
            "transform(iw, (w, i) -> cast(coalesce(try_element_at(dw, "
            "cast(if(i + shift < 0, null, i + shift + 1) as int)) = w, false) as int))"
        ).alias("eq"),
    ).withColumn("window", F.least(F.lit(WINDOW), F.size("eq")))
    best = equal.withColumn(
        "matched",
        F.expr("array_max(transform(sequence(1, size(eq) - window + 1), i -> aggregate(slice(eq, i, window), 0, (a, x) -> a + x)))"),
    )
    sure = best.where(f"100 * matched >= {SHARE} * window")
    return sure.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("matched"), -F.col("shift"), F.col("window"))).alias("b")
    ).selectExpr("doc_id", "item_id", "b.matched as matched", "b.window as window", "-b.col2 as start")


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no passage of the benchmark."""
    found = overlaps(docs, read_table(spark, sf_dir, "benchmark"))
    bad = materialize(found.select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def oracle() -> str:
    """DuckDB SQL for :func:`op6_spaced_seeds`, without masks: a window with at most two
    substituted words of 13 holds a run of four that are copied as they are, so runs of four
    words give all alignments (items of 13 words or more), and every window is compared."""
    def side(table: str, key: str) -> str:
        return (
            f"select {key}, unnest(ws) as w, unnest(range(len(ws))) as p from "
            f"(select {key}, regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+') as ws from {table} "
            f"where text is not null and {key} is not null)"
        )

    def runs(table: str, key: str) -> str:
        leads = ", ".join(f"lead(w, {i}) over (partition by {key} order by p) as w{i}" for i in range(4))
        return f"select * from (select {key}, p, {leads} from {table}) where w3 is not null"

    return f"""
with d as ({side('documents', 'doc_id')}), b as ({side('benchmark', 'item_id')}),
dw as ({runs('d', 'doc_id')}), bw as ({runs('b', 'item_id')}),
hits as (select distinct d.doc_id, b.item_id, d.p - b.p as shift from dw d join bw b using (w0, w1, w2, w3)),
sizes as (select item_id, count(*) as n from b group by item_id),
eq as (
  select h.doc_id, h.item_id, h.shift, b.p, least({WINDOW}, s.n) as win, s.n,
         case when d.w = b.w then 1 else 0 end as same
  from hits h join b on b.item_id = h.item_id join sizes s on s.item_id = h.item_id
  left join d on d.doc_id = h.doc_id and d.p = b.p + h.shift),
sums as (
  select *, sum(same) over (partition by doc_id, item_id, shift order by p
                            rows between {WINDOW - 1} preceding and current row) as m from eq),
best as (
  select doc_id, item_id, shift, max(m) as matched, max(win) as win from sums
  where p >= win - 1 group by all),
ranked as (
  select *, row_number() over (partition by doc_id, item_id order by matched desc, shift) as r
  from best where 100 * matched >= {SHARE} * win)
select doc_id, item_id, cast(matched as int) as matched, cast(win as int) as "window", shift as start from ranked where r = 1
"""
