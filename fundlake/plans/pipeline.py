"""End-to-end composition: pages -> articles -> companies -> funding -> reconciled.

A run has one id, its UTC time, which every row of every stage carries
(``timestamp``) and under which :func:`land` writes the stages; a run that is repeated
replaces itself. Rows keep the order of (listing page, position of the card), as dense
numbers that do not depend on partitioning. Rows that a stage drops are in ``rejected`` with
the stage and the reason. With a reply store (``replies``) a run that is started again asks the
models only for what it has not got yet.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions import variant
from fundlake.operators import enrich, html_extract as H, lookup, reconcile, reply_store, responses
from fundlake.schemas import COMPANY_FIELDS
from fundlake.session import materialize
from fundlake.sinks.stages import new_run_id, write_run
from fundlake.sources.records import order_numbers


@dataclass
class PipelineResult:
    index: DataFrame
    articles: DataFrame
    companies: DataFrame
    enriched: DataFrame
    reconciled: reconcile.Reconciled
    rejected: DataFrame  # stage, url (or uuid), error, and the whole reply if there was one
    run_id: str


def _rejected(rows: DataFrame, stage: str, key: str = "url") -> DataFrame:
    reply = F.col("reply") if "reply" in rows.columns else F.lit(None).cast("string")
    return rows.select(F.lit(stage).alias("stage"), F.col(key).alias("url"), "error", reply.alias("reply"))


def scrape(listing_pages: DataFrame, article_pages: DataFrame, listing_spec: H.ListingSpec = H.ListingSpec(),
           article_spec: H.ArticleSpec = H.ArticleSpec(), run_id: str | None = None,
           status_col: str | None = "status") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Step 0: listing cards -> index (O-10..O-12); the index's urls drive the
    article pages (O-15) -> article fields (O-13, O-14); both stamped (O-09). The
    third table has what was dropped: pages not fetched, cards and articles at fault.

    ``index_ord`` numbers the index in the order of (page, position); listing pages without
    a column ``page`` go by their url."""
    run_id = run_id or new_run_id(listing_pages.sparkSession)
    page = "page" if "page" in listing_pages.columns else "url"
    listings = H.successful_pages(listing_pages, status_col)
    cards = materialize(H.extract_listings(listings, listing_spec, keys=dict.fromkeys((page, "url"))), "cards")
    index = order_numbers(H.ok_rows(cards), [page, "pos"], "index_ord")
    index = index.select("index_ord", "title", F.col("url_found").alias("url"), "author", "publication_date", F.lit(run_id).alias("timestamp"))
    fetched = H.index_to_articles(index, H.successful_pages(article_pages, status_col), keep_cols=["index_ord"])
    parsed = materialize(H.extract_articles(fetched, article_spec, keys=("index_ord", "url")), "articles")
    articles = H.ok_rows(parsed).withColumn("timestamp", F.lit(run_id))
    known = H.successful_pages(article_pages, status_col).select("url").distinct()
    missing = index.join(known, "url", "left_anti").select("url", F.lit("not fetched").alias("error"))
    rejected = (
        _rejected(H.failed_pages(listing_pages, status_col), "listing page")
        .unionByName(_rejected(H.rejected_rows(cards), "listing card"))
        .unionByName(_rejected(missing, "article page"))
        .unionByName(_rejected(H.rejected_rows(parsed), "article"))
    )
    return index, articles, rejected


def _replies(rows: DataFrame, extractor: enrich.RowFn, inputs: list[str], keep: list[str], concurrency: int, store: str | None) -> DataFrame:
    if store is None:
        return enrich.with_retry(rows, extractor, inputs, keep_cols=keep, concurrency=concurrency)
    return reply_store.with_stored_replies(rows, extractor, inputs, store, keep_cols=keep, concurrency=concurrency)


def extract_companies(articles: DataFrame, extractor: enrich.RowFn, agent_envelope: bool = False,
                      concurrency: int = 1, run_id: str | None = None, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Step 1 (O-27..O-30, O-29, O-38, O-41, O-18, O-22): run the extractor on
    (title, author, publication_date, content, url), keep successes, decode
    the company object, attach url / timestamp / uuid (deterministic)."""
    run_id = run_id or new_run_id(articles.sparkSession)
    if "index_ord" not in articles.columns:
        articles = order_numbers(articles, ["url", "title", "author", "publication_date", "content"], "index_ord")
    res = _replies(articles, extractor, ["title", "author", "publication_date", "content", "url"], ["index_ord", "url"], concurrency, store)
    ok = enrich.successes(res)
    if agent_envelope:  # the agent's text: repaired and classified, then unwrapped
        replies = responses.with_classified_response(ok, "value")
        decoded = replies.select("index_ord", "url", "value", F.col("obj").alias("__obj"))
    else:
        decoded = ok.select("index_ord", "url", "value", F.try_parse_json("value").alias("__obj"))
    usable = F.coalesce(F.schema_of_variant("__obj").startswith("OBJECT"), F.lit(False))
    company = [variant.scalar_text(variant.field(F.col("__obj"), name)).alias(name) for name, _ in COMPANY_FIELDS]
    companies = decoded.where(usable).select("index_ord", "url", "value", *company)
    for name, types in COMPANY_FIELDS:
        if "boolean" in types:
            companies = companies.withColumn(name, F.col(name).try_cast("boolean"))
    # O-60: the row number follows the index (equal urls stay different rows), whatever the partitions.
    companies = order_numbers(companies, ["index_ord", "url", "value"]).drop("index_ord", "value")
    companies = companies.withColumns({
        "timestamp": F.lit(run_id),
        "uuid": F.sha2(F.concat_ws("\u0001", F.col("url"), F.col("company_name"), F.col("row_ord").cast("string")), 256),
    })
    if agent_envelope:
        companies = responses.drop_schema_echo_names(companies)
    failed = res.where(F.col("error").isNotNull()).select("url", "error", F.lit(None).cast("string").alias("reply"))
    unreadable = decoded.where(~usable).select(
        "url", F.when(F.col("value").isNull(), "no reply").otherwise("unparseable reply").alias("error"), F.col("value").alias("reply")
    )
    return companies, failed.unionByName(unreadable)


def add_funding(companies: DataFrame, extractor: enrich.RowFn, concurrency: int = 1,
                store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Step 2 (O-31, O-32, O-21, O-24): the funding extractor sees the company
    row as JSON; its ``funding_rounds`` list updates the row by uuid (latest
    result wins); rows without a result keep NULL."""
    # The run's stamp is no part of the question: a repeated run asks the same.
    asked = [c for c in companies.columns if c not in ("row_ord", "timestamp")]
    payload = companies.withColumn("company_json", enrich.row_as_json(*asked))
    res = _replies(payload, extractor, ["company_json", "uuid"], ["uuid"], concurrency, store)
    replies = enrich.successes(res).select(
        "uuid", "attempt", "value", variant.field(F.try_parse_json("value"), "funding_rounds").alias("rounds")
    )
    # A reply without the field changes nothing and is rejected with its whole text.
    ok = replies.where(F.col("rounds").isNotNull()).select("uuid", F.to_json("rounds").alias("value"), F.col("attempt").alias("result_ord"))
    unreadable = replies.where(F.col("rounds").isNull()).select(
        "uuid", F.when(F.col("value").isNull(), "no reply").otherwise("unparseable reply").alias("error"), F.col("value").alias("reply")
    )
    enriched = materialize(lookup.update_join(companies, ok, "uuid", "value", "result_ord", "funding_rounds"), "enriched")
    failed = res.where(F.col("error").isNotNull()).select("uuid", "error", F.lit(None).cast("string").alias("reply"))
    return enriched, failed.unionByName(unreadable)


def run(listing_pages: DataFrame, article_pages: DataFrame, company_extractor: enrich.RowFn,
        funding_extractor: enrich.RowFn, listing_spec: H.ListingSpec = H.ListingSpec(),
        article_spec: H.ArticleSpec = H.ArticleSpec(), agent_envelope: bool = False, run_id: str | None = None,
        replies: str | None = None, status_col: str | None = "status") -> PipelineResult:
    run_id = run_id or new_run_id(listing_pages.sparkSession)
    stores = [None, None] if replies is None else [os.path.join(replies, part) for part in ("companies", "funding")]
    index, articles, bad0 = scrape(listing_pages, article_pages, listing_spec, article_spec, run_id, status_col)
    companies, bad1 = extract_companies(articles, company_extractor, agent_envelope, run_id=run_id, store=stores[0])
    enriched, bad2 = add_funding(companies, funding_extractor, store=stores[1])
    reconciled = reconcile.reconcile_funding(enriched)  # step 3 (O-52..O-56, O-20)
    rejected = bad0.unionByName(_rejected(bad1, "company")).unionByName(_rejected(bad2, "funding", "uuid"))
    return PipelineResult(index, articles, companies, enriched, reconciled, rejected, run_id)


def land(result: PipelineResult, folder: str) -> None:
    """Write every stage of a run under its id (``folder/<stage>/run_id=<run>``)."""
    stages = {f.name: getattr(result, f.name) for f in fields(result) if f.name not in ("reconciled", "run_id")}
    stages |= {f"reconciled_{f.name}": getattr(result.reconciled, f.name) for f in fields(result.reconciled)}
    for name, rows in stages.items():
        write_run(rows, os.path.join(folder, name), result.run_id)
