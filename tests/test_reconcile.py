"""Merge goldens (FIXTURES §4) and a property test against a plain fold."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fundlake.operators.reconcile import reconcile_funding


def _el(name, cur, date, amount, **extra):
    d = {"round_name": name, "currency_symbol": cur, "date": date, "amount": amount}
    d.update(extra)
    return d


def _run(spark, rows, **opts):
    """rows: list of (company, row_ord, funding_rounds text)."""
    df = spark.createDataFrame(rows, "company_name string, row_ord long, funding_rounds string")
    df = df.withColumn("uuid", F.concat(F.lit("u"), F.col("row_ord").cast("string")))
    return reconcile_funding(df, **opts)


def _rounds_of(res, company):
    out = res.companies.where(F.col("company_name") == company).collect()
    assert len(out) == 1
    return [(r.round_name, r.currency_symbol, r.date, r.amount) for r in out[0].funding_rounds]


MERGE_CASES = {
    "M1": ([[_el("Seed", "$", None, 9000000), _el("Seed", "€", "03/21", 5000000), _el("Seed", "£", None, 7000000)]],
           [("Seed", "€", "03/21", 7000000)]),
    "M2": ([[_el("Seed", "$", "unknown", 3)]], []),
    "M3": ([[_el("Seed", None, "2021", "5M")]], [("Seed", None, "01/21", 0)]),
    "M4": ([[_el("Series A", "$", "2021", 2), _el("Seed", "$", "2020", 1)]],
           [("Series A", "$", "01/21", 2), ("Seed", "$", "01/20", 1)]),
    "M5": ([[_el("Seed", "$", "2021", 1.7), _el("Seed", "$", "2021", 1.2)]], [("Seed", "$", "01/21", 1)]),
    "M6": ([[_el("Seed", "$", "2021", -5)]], [("Seed", "$", "01/21", 0)]),
    "M7": ([[_el("Seed", "$", "2021", True)]], [("Seed", "$", "01/21", 1)]),
    "M8": ([[_el("Seed", "$", "2021", 1), _el("Seed", "$", "05/22", 2)]], [("Seed", "$", "01/21", 2)]),
    "M9": ([[_el("seed", "$", "2021", 1), _el("Pre Seed", "€", "2022", 4)]], [("Seed", "$", "01/21", 4)]),
    "M10": ([[_el(None, "$", "2021", 1), _el("Debt", "€", "2022", 4)]], [("Unknown", "$", "01/21", 4)]),
    "M11": ([[_el("Seed", None, "2021", 1), _el("Seed", "€", None, 2)]], [("Seed", "€", "01/21", 2)]),
    "M12": ([[_el("Seed", "", "2021", 1), _el("Seed", "€", "2021", 2)]], [("Seed", "", "01/21", 2)]),
    "M13": ([[_el("Seed", "$", "2021", 5, type="array", properties={"a": 1}), _el("Seed", "€", "2020", 1)]],
            [("Seed", "€", "01/20", 1)]),
    "M14": ([[_el("Seed", "$", "2021", 5, type="array"), _el("Series A", "$", "2021", 1, type="x", properties={})]],
            [("Seed", "$", "01/21", 5), ("Series A", "$", "01/21", 1)]),
    "two_rows": ([[_el("Seed", None, None, 100)], [_el("Seed", "$", "2021", 1), _el("Series B", "€", "3/5/2021", 7)]],
                 [("Seed", "$", "01/21", 1), ("Series B", "€", "03/21", 7)]),
}


@pytest.mark.parametrize("case", sorted(MERGE_CASES))
def test_merge_goldens(spark, case):
    lists, want = MERGE_CASES[case]
    rows = [("acme", i, json.dumps(lst)) for i, lst in enumerate(lists)]
    res = _run(spark, rows)
    assert _rounds_of(res, "acme") == want


def test_quarantine_and_null_cells(spark):
    rows = [
        ("a", 1, '[{"round_name":"Seed","amount":NaN,"date":"2021"}]'),
        ("b", 2, '{"a":1}'), ("c", 3, "[1]"), ("d", 4, "5"), ("e", 5, "not json"),
        ("f", 6, "null"), ("g", 7, None), ("h", 8, "[]"), ("i", 9, "{}"), ("j", 10, '""'),
        ("k", 11, '[{"round_name":5,"date":"2021"}]'), ("l", 12, '[{"round_name":0,"date":"2021"}]'),
        (None, 13, "[]"),
    ]
    res = _run(spark, rows)
    q = {r.company_name: r.reason for r in res.quarantine.collect()}
    assert q == {"a": "malformed_json", "b": "not_a_list", "c": "element_not_object", "d": "not_a_list",
                 "e": "malformed_json", "k": "round_name_not_text"}
    companies = {r.company_name: r.funding_rounds for r in res.companies.collect()}
    # Rows with a rejected element stay; only that element is quarantined.
    assert set(companies) == {"c", "h", "i", "j", "k", "l"}
    assert companies["h"] == [] and companies["i"] == [] and companies["c"] == []
    assert [(r.round_name, r.date) for r in companies["l"]] == [("Unknown", "01/21")]


def test_first_row_columns(spark):
    df = spark.createDataFrame(
        [("acme", 2, "[]", "second", "x"), ("acme", 1, "[]", None, "y")],
        "company_name string, row_ord long, funding_rounds string, note string, type string",
    )
    res = reconcile_funding(df)
    row = res.companies.collect()[0]
    assert row.note is None and row.row_ord == 1
    assert "type" not in res.companies.columns


def _by_rule(lists):
    """The merge rule read off directly: for each name, in the order of first
    dated entries, the entries from that one on give the date, the first
    currency and the largest amount (0 at least)."""
    entries = [e for part in lists for e in part]
    merged = []
    for name in dict.fromkeys(e[0] for e in entries if e[2] is not None):
        own = [e for e in entries if e[0] == name]
        k = min(i for i, e in enumerate(own) if e[2] is not None)
        currencies = [e[1] for e in own[k:] if e[1] is not None]
        merged.append((name, next(iter(currencies), None), own[k][2], max([0, *(e[3] for e in own[k:])])))
    return merged


def test_property_against_rule(spark):
    rng = random.Random(7)
    names = ["Seed", "Series A", "Series B", "Other"]
    dates_ = [None, "01/20", "05/21", "12/19"]
    curs = [None, "$", "€", ""]
    rows, expected = [], {}
    for c in range(40):
        lists = []
        for _ in range(rng.randint(1, 4)):
            lists.append([(rng.choice(names), rng.choice(curs), rng.choice(dates_), rng.randint(-3, 50))
                          for _ in range(rng.randint(0, 4))])
        expected[f"c{c}"] = _by_rule(lists)
        order = list(range(len(lists)))
        rng.shuffle(order)  # input partitions / row arrival order must not matter
        for pos in order:
            lst = lists[pos]
            rows.append((f"c{c}", c * 100 + pos, json.dumps([_el(*t) for t in lst])))
    res = _run(spark, rows)
    got = {r.company_name: [(x.round_name, x.currency_symbol, x.date, x.amount) for x in r.funding_rounds]
           for r in res.companies.collect()}
    assert got == expected
    # Any cuts into segments give the same answer.
    for bits in ((), (1,), (2, 5), (1, 3, 4, 9)):
        res2 = _run(spark, rows, bits=bits, materialize_elements=False)
        got2 = {r.company_name: [(x.round_name, x.currency_symbol, x.date, x.amount) for x in r.funding_rounds]
                for r in res2.companies.collect()}
        assert got2 == expected


def test_summaries_combine_in_any_cuts(spark):
    """Random sequences, cut at random places and combined in random order of neighbours."""
    from fundlake.operators import summaries as S

    rng = random.Random(11)
    rows, cuts = [], []
    for c in range(60):
        n = rng.randint(1, 12)
        for i in range(n):
            rows.append((f"c{c}", "Seed", i, 0, rng.choice([None, "01/20", "02/21"]), rng.randint(-2, 30), rng.choice([None, "$", "€"])))
        cuts += [(f"c{c}", i, rng.randint(0, 2), rng.randint(0, 1)) for i in range(n)]
    els = spark.createDataFrame(rows, "company_name string, round_name string, row_ord long, pos int, date string, famt long, cur string")
    whole = S.summarize(els, "company_name", bits=())
    # Segment numbers that grow along the sequence in random steps, on two levels.
    steps = spark.createDataFrame(cuts, "company_name string, row_ord long, a int, b int")
    from pyspark.sql import Window
    w = Window.partitionBy("company_name").orderBy("row_ord")
    marked = els.join(steps, ["company_name", "row_ord"]).withColumns({"g1": F.sum("a").over(w), "s": F.expr(S.SINGLE)})
    groups = ["company_name", "round_name"]
    first = S.fold(marked, [*groups, "g1"])
    second = S.fold(first.withColumn("g2", F.shiftright("g1", 1)), [*groups, "g2"])
    as_rows = lambda df: sorted(map(str, df.select(*groups, "s").collect()))
    assert as_rows(S.fold(second, groups)) == as_rows(whole)


def test_the_csv_query_bounds_the_rows_of_its_files(spark, tmp_path, monkeypatch):
    """One task reads a whole file of quoted lines, so files grow in number and not in size."""
    from fundlake import session
    from fundlake.plans import queries
    from sf_dirs import SF_SMALL

    expected = sorted(map(tuple, queries.q_reconciled_csv(spark, SF_SMALL).collect()), key=str)
    monkeypatch.setattr(session, "scratch_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "CSV_RECORDS", 100)
    found = sorted(map(tuple, queries.q_reconciled_csv(spark, SF_SMALL).collect()), key=str)
    assert found == expected and len(found) > 100
    for folder in ("in", "out/companies", "out/quarantine"):
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "funding-csv" / folder))
        sizes = [r["count"] for r in rows.groupBy("_metadata.file_name").count().collect()]
        assert max(sizes) <= 100
        assert folder != "in" or len(sizes) > 4
