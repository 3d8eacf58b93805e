"""Plan assertions: the reconciliation stays in built-in
operators, merges without a join, and reads only the element columns it needs."""

from fundlake.operators.reconcile import reconcile_funding
from fundlake.plans.views import funding_raw

from sf_dirs import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reconcile_plan_shape(spark):
    res = reconcile_funding(funding_raw(spark, SF_SMALL))
    plan = _plan(res.rounds)
    for python_node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert python_node not in plan
    assert "Join" not in plan
    assert "partial_collect_list" in plan
    # The materialised element scans never read the raw JSON column.
    scan_lines = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scan_lines and all("funding_rounds" not in line for line in scan_lines)


def test_no_filter_on_parse_results_reaches_the_scan(spark):
    raw = funding_raw(spark, SF_SMALL)
    res = reconcile_funding(raw, materialize_elements=False)
    optimized = res.rounds._jdf.queryExecution().optimizedPlan().toString()
    # Validity gates the generator; no parse-based predicate is pushed into
    # the orders scan (which would re-run try_parse_json per row).
    scan_filters = [line for line in optimized.splitlines() if "Filter" in line and "parse_json" in line]
    assert not scan_filters
