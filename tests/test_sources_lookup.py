"""Stage readers/writers (O-01, O-03..O-09) and lookups (O-24..O-26)."""

import os

import pytest
from pyspark.sql import functions as F

from fundlake.functions.text import split_trim
from fundlake.operators import lookup
from fundlake.session import scratch_path
from fundlake.sinks.stages import run_timestamp, stamp, write_stage_csv
from fundlake.sources import stages as S


def test_csv_roundtrip_na_tokens(spark):
    df = spark.createDataFrame(
        [(1, 'multi\nline, "quoted"', "NA"), (2, "null", "x"), (3, "", "None")], "id long, a string, b string")
    path = scratch_path(spark, "csv-test")
    write_stage_csv(df, path)
    back = S.read_stage_csv(spark, path, "id long, a string, b string")
    got = {r.id: (r.a, r.b) for r in back.collect()}
    assert got == {1: ('multi\nline, "quoted"', None), 2: (None, "x"), 3: (None, None)}
    assert "row_ord" in back.columns
    with pytest.raises(ValueError):
        write_stage_csv(df, "")


def test_saved_page_and_urls(spark):
    d = scratch_path(spark, "saved")
    local = d[len("file:"):] if d.startswith("file:") else d
    os.makedirs(local)
    with open(os.path.join(local, "articles_page.txt"), "w") as fh:
        fh.write("<html>\n<body>x</body></html>")
    pages = S.read_saved_pages(spark, local).collect()
    assert len(pages) == 1 and pages[0].html.startswith("<html>\n") and pages[0].status == 200
    urls = [r.url for r in S.page_urls(spark, "https://site/cat", 2, "climate").orderBy("page").collect()]
    assert urls == ["https://site/cat/page/0/?s=climate", "https://site/cat/page/1/?s=climate"]
    assert S.page_urls(spark, "https://site", 1).first().url == "https://site/page/0/"


def test_until_first_empty(spark):
    counts = spark.createDataFrame([(0, 5), (1, 3), (2, 0), (3, 4), (4, None)], "page long, n_rows long")
    assert [r.page for r in S.until_first_empty(counts).orderBy("page").collect()] == [0, 1]
    full = spark.createDataFrame([(0, 5), (1, 3)], "page long, n_rows long")
    assert S.until_first_empty(full).count() == 2


def test_records_guards_and_stamp(spark):
    t = S.records_to_table(spark, [{"a": "1"}, {"b": "2", "a": "3"}])
    assert t.columns == ["a", "b"] and t.where(F.col("b").isNull()).count() == 1
    with pytest.raises(ValueError):
        S.require_nonempty(t.where("false"), "nothing")
    with pytest.raises(ValueError):
        S.require_value("", "filename")
    ts = stamp(t, "2024-01-02T03:04:05").select("timestamp").distinct().collect()
    assert [r.timestamp for r in ts] == ["2024-01-02T03:04:05"]
    assert len(spark.range(1).select(run_timestamp().alias("t")).first().t) == 19


def test_split_trim(spark):
    df = spark.createDataFrame([(" a, b ,c ",)], "s string")
    assert df.select(split_trim(F.col("s")).alias("x")).first().x == ["a", "b", "c"]


def test_update_join_latest_wins(spark):
    rows = spark.createDataFrame([("u1", "old"), ("u2", None), ("u3", "keep")], "uuid string, funding_rounds string")
    res = spark.createDataFrame([("u1", "[1]", 1), ("u1", "[2]", 2), ("u2", "null", 1)], "uuid string, v string, o long")
    out = {r.uuid: r.funding_rounds for r in lookup.update_join(rows, res, "uuid", "v", "o", "funding_rounds").collect()}
    assert out == {"u1": "[2]", "u2": "null", "u3": "keep"}
    fresh = lookup.update_join(rows.drop("funding_rounds"), res, "uuid", "v", "o", "funding_rounds")
    assert {r.uuid: r.funding_rounds for r in fresh.collect()}["u3"] is None


def test_org_lookup_facet_filter(spark):
    from fundlake.schemas import ORGANIZATION_SCHEMA
    orgs = spark.createDataFrame(
        [tuple({"identifier": "Acme", "facet_ids": ["company"], "uuid": "a"}.get(f.name) for f in ORGANIZATION_SCHEMA),
         tuple({"identifier": "Beta", "facet_ids": ["person"], "uuid": "b"}.get(f.name) for f in ORGANIZATION_SCHEMA)],
        ORGANIZATION_SCHEMA)
    names = spark.createDataFrame([("Acme",), ("Beta",), ("Zed",)], "company_name string")
    got = {r.company_name: r.org_uuid for r in lookup.organization_lookup(names, orgs).collect()}
    assert got == {"Acme": "a", "Beta": None, "Zed": None}


def test_text_search_exact(spark):
    docs = spark.createDataFrame(
        [(1, "x the quick brown fox y the quick brown fox"), (2, "the quick brown"), (3, "quick brown fox")],
        "doc_id long, text string")
    qs = spark.createDataFrame([(10, "the quick brown fox"), (11, "fox")], "item_id long, text string")
    top = lookup.text_search(qs, docs, k=3)
    got = [(r.item_id, r.doc_id, r.score, r.rank) for r in top.orderBy("item_id", "rank").collect()]
    assert got == [(10, 1, 2, 1), (11, 1, 2, 1), (11, 3, 1, 2)]


def test_text_search_short_passages(spark):
    docs = spark.createDataFrame(
        [(1, "Big acme solar farm; acme!"), (2, "acmesolar"), (3, "the acme solarium"), (4, "a -- b"), (5, None)],
        "doc_id long, text string")
    asked = [(1, "acme"), (2, "acme solar"), (3, "me s"), (4, "a"), (5, "--"), (6, ""), (7, None), (8, "zzz")]
    top = lookup.text_search(spark.createDataFrame(asked, "item_id long, text string"), docs, k=10)
    got = {(r.item_id, r.doc_id, r.score) for r in top.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {(q, d, t.count(p)) for q, p in asked if p for d, t in texts.items() if t and p in t}
    assert got == want
