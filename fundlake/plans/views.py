"""Stage-shaped views derived from the driver tables.

The pipeline's real inputs (landed pages, model responses, stage CSVs) are
stood in for by deterministic views over the driver's parquet tables, so every
registered query reads those tables and its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.schemas import MONTH_NAMES

# FIXED VALUES of the synthetic funding view (FIXTURES.md §5), as JSON text.
ROUND_NAME_CYCLE = (
    '"Pre-Seed"', '"seed round"', '"Series A"', '"series b extension"', '"Series C"',
    '"SERIES D"', '"Series E"', '"Series F"', '"another"', '"Debt Financing"',
    '"Pre Seed"', "null",
)
CURRENCY_CYCLE = ('"$"', '"€"', "null", '""')
ECHO_ELEMENT = (
    '{"type":"array","properties":{"a":1},"round_name":"Seed","amount":999999999,"date":"01/20"},'
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(narrow: DataFrame, key: str) -> DataFrame:
    """The raw rows dealt over the session's shuffle partitions by a unique key.

    A file of one row group is one scan task whatever the split size, and all work
    before the next exchange would stay in it. The views deal their few raw columns
    unconditionally, at every size, before the wide parse."""
    return narrow.repartition(int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _pick(index: Column, values: tuple[str, ...] | list[Column]) -> Column:
    """CASE index WHEN 0 THEN values[0] ... (index already reduced)."""
    expr = None
    for i, value in enumerate(values):
        val = value if isinstance(value, Column) else F.lit(value)
        expr = (F.when if expr is None else expr.when)(index == i, val)
    return expr


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cycle(index_sql: str, values) -> str:
    return "CASE " + " ".join(f"WHEN {index_sql} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _element_sql(i: str) -> str:
    """One funding element as JSON text (FIXTURES.md §5), as a SQL expression."""
    q = lambda x: f"concat('\"', {x}, '\"')"
    name = _cycle(f"({i}) % 12", [_sql(v) for v in ROUND_NAME_CYCLE])
    amount = (f"CASE ({i}) % 7 WHEN 0 THEN '\"5M\"' WHEN 1 THEN 'null' WHEN 2 THEN 'true' "
              f"WHEN 3 THEN concat(amt_s, '.5') ELSE amt_s END")
    date = _cycle(f"({i}) % 11", [
        q("m, '/', substring(y, 3, 2)"), q("y"), q("y, '-', m"), q("y, '-', m, '-', dd"),
        q("m, '/', dd, '/', y"), q("month_name, ' ', day, ', ', y"),
        q("y, '-', m, '-', dd, 'T10:00:00'"), "y", "'null'", "'\"unknown\"'", q("m, '.', y"),
    ])
    cur = _cycle(f"({i}) % 4", [_sql(v) for v in CURRENCY_CYCLE])
    return (f"concat('{{\"round_name\":', {name}, ',\"amount\":', {amount}, ',\"date\":', {date}, "
            f"',\"currency_symbol\":', {cur}, '}}')")


def funding_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched-company stage stand-in: (row_ord, company_name, uuid, funding_rounds).

    One row per order; the company is the ordering customer, so each company
    has several rows whose rounds must be reconciled.
    """
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # Built as SQL expressions (one JVM call per stage); staged so each piece
    # is computed once per row.
    months = _cycle("CAST(m AS INT) - 1", [_sql(mn) for mn in MONTH_NAMES])
    parts = orders.selectExpr("o_orderkey", "o_custkey", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS d",
                              "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS amt_s")
    parts = parts.selectExpr("o_orderkey", "o_custkey", "substring(d, 1, 4) AS y", "substring(d, 6, 2) AS m",
                             "substring(d, 9, 2) AS dd", "amt_s")
    parts = parts.selectExpr("*", "CAST(CAST(dd AS INT) AS STRING) AS day", f"{months} AS month_name")
    parts = parts.selectExpr("o_orderkey", "o_custkey", f"{_element_sql('o_orderkey')} AS e1",
                             f"{_element_sql('o_orderkey + 5')} AS e2")
    rounds = F.expr(
        "CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 17 = 0 THEN '[]' "
        f"ELSE concat('[', CASE WHEN o_orderkey % 19 = 0 THEN {_sql(ECHO_ELEMENT)} ELSE '' END, e1, ',', e2, ']') END"
    )
    k = F.col("o_orderkey")
    return parts.join(customer, parts.o_custkey == customer.c_custkey, "inner").select(
        k.alias("row_ord"),
        F.col("c_name").alias("company_name"),
        F.md5(k.cast("string")).alias("uuid"),
        rounds.alias("funding_rounds"),
    )


# Landed replies. The texts are written once, in SQL that Spark and DuckDB read alike.

#: A final answer of an event, cut or continued in eight ways.
CUT_REPLY_SQL = """'Final Answer": {"properties":{"event_type":"' || CASE event_id % 8
  WHEN 1 THEN substr(event_type, 1, 2)
  WHEN 2 THEN event_type || '","k"'
  WHEN 3 THEN event_type || '", "k": '
  WHEN 4 THEN event_type || '","k":' || event_id || ',"tags":["x",'
  WHEN 5 THEN event_type || '","k":' || event_id || ',"tags":["x"],"note":{"t":"it is ' || chr(92)
  WHEN 6 THEN event_type || '","k":' || event_id || ',"tags":["x"]}} I hope this helps'
  WHEN 7 THEN event_type || '","k":' || event_id || ',"tags":["x"}, "note": {}'
  ELSE event_type || '","k":' || event_id || ',"tags":["x"]}}}' END"""

#: A company reply per customer: whole, or with one of twelve faults.
COMPANY_REPLY_SQL = """CASE c_custkey % 13 WHEN 11 THEN '["' || c_name || '"]' WHEN 12 THEN 'I am not sure about ' || c_name ELSE
  '{"company_name":' || CASE c_custkey % 13 WHEN 10 THEN 'null' ELSE '"' || c_name || '"' END
  || CASE c_custkey % 13 WHEN 1 THEN '' ELSE ',"founders":"Ann, Bob"' END
  || ',"is_climate_related":' || CASE c_custkey % 13 WHEN 2 THEN '"yes"' WHEN 4 THEN 'false' ELSE 'true' END
  || ',"climate_sectors":' || CASE c_custkey % 13 WHEN 3 THEN 'null' WHEN 4 THEN 'null' WHEN 5 THEN '"Energy, Space ,Mars"' ELSE '"Energy, Forestry"' END
  || ',"location":' || CASE c_custkey % 13 WHEN 6 THEN '"Atlantis"' ELSE '"Europe"' END
  || ',"living_status":"' || CASE c_custkey % 13 WHEN 7 THEN lower(c_mktsegment) ELSE 'living' END || '"'
  || ',"has_pivoted":null,"year_founded":' || CASE c_custkey % 13 WHEN 9 THEN '2015' ELSE '"2015"' END
  || CASE c_custkey % 13 WHEN 1 THEN '' ELSE ',"year_died":null' END
  || ',"idea_summary":"' || c_mktsegment || '","reason_for_demise":null'
  || CASE c_custkey % 13 WHEN 8 THEN ',"website":"x","extra":{"a":1}' ELSE '' END || '}' END"""

#: A funding reply per order: two rounds, the second one whole or at fault.
FUNDING_REPLY_SQL = """'{"funding_rounds":' || CASE o_orderkey % 9 WHEN 7 THEN 'null' ELSE
  '[{"round_name":"Seed","amount":' || o_orderkey || ',"date":"01/20","currency_symbol":"$"},' || CASE o_orderkey % 9
    WHEN 1 THEN '{"round_name":"' || o_orderpriority || '","amount":1.5,"date":null}'
    WHEN 2 THEN '{"amount":null}'
    WHEN 3 THEN '{"round_name":null,"amount":"5M","date":2020}'
    WHEN 4 THEN '7'
    WHEN 5 THEN '{"round_name":"Series A","amount":1,"date":"","lead":"x"}'
    ELSE '{"round_name":"Series B","amount":2,"date":"03/21"}' END || ']' END
  || CASE o_orderkey % 9 WHEN 6 THEN ',"note":1' ELSE '' END || '}'"""


#: An event's properties with keys that come and go: numbers, texts, a list, an object, and a key
#: that is a number here and a text there.
LOOSE_RECORD_SQL = """'{"k":' || CASE WHEN event_type = 'view' THEN '"' || event_id || '"' ELSE '' || event_id END || CASE event_type
  WHEN 'purchase' THEN ',"cents":' || CAST(floor(value) AS BIGINT) || ',"user":{"id":' || user_id || '}'
  WHEN 'error' THEN ',"code":"E' || user_id || '"'
  WHEN 'click' THEN ',"tags":["a",' || user_id || '],"first":' || CASE WHEN user_id > 7 THEN 'true' ELSE 'false' END
  ELSE '' END || '}'"""


#: A stage's funding cell, some of them broken (``k``: the row's number).
STAGE_CELL_SQL = """CASE WHEN k % 23 = 0 THEN 'not json' WHEN k % 29 = 0 THEN '{"a":1}' WHEN k % 31 = 0 THEN 'null'
  WHEN k % 37 = 0 THEN '[7,{"round_name":5,"date":"2020"}]' ELSE funding_rounds END"""


#: A comma list with white space of several kinds around its items (no-break, em and
#: ideographic space, tab, line break, unit separator).
SPACED_LIST_SQL = """chr(9) || 'Energy' || chr(160) || ',\u2003' || c_mktsegment || chr(10) || ', ' || chr(31)
  || CASE c_custkey % 3 WHEN 0 THEN 'Water and Oceans' WHEN 1 THEN '' ELSE 'Forestry' || chr(160) || 'x' END || '\u3000'"""
