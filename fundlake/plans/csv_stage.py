"""CSV in, reconciled CSV out (O-01, O-17, O-20, O-35, O-40, O-52..O-56) as one call."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from fundlake.operators.reconcile import reconcile_funding
from fundlake.sinks.stages import write_stage_csv
from fundlake.sources.records import order_numbers
from fundlake.sources.stages import read_stage_csv, require_value

QUARANTINE = "company_name string, row_ord bigint, pos int, value string, reason string"


def reconcile_csv(spark: SparkSession, source: str, target: str, schema: str, key: str = "company_name",
                  rounds_col: str = "funding_rounds", max_records_per_file: int | None = None) -> None:
    """Reconcile the CSV files under ``source`` into ``target/companies`` (sorted by name, the
    merged list as JSON, echo columns gone) and ``target/quarantine`` (cells and elements that
    could not be read).

    Rows count in the order of (file name, place in the file), as dense numbers, so the result does
    not depend on how files are split over tasks."""
    require_value(source, "source folder")
    rows = read_stage_csv(spark, source, schema, order_col="__place")
    rows = order_numbers(rows, ["__place"]).drop("__place")
    found = reconcile_funding(rows, key=key, rounds_col=rounds_col)
    write_stage_csv(found.companies.drop("row_ord"), os.path.join(target, "companies"), sort_by=key, max_records_per_file=max_records_per_file)
    write_stage_csv(found.quarantine, os.path.join(target, "quarantine"), max_records_per_file=max_records_per_file)


def read_reconciled(spark: SparkSession, target: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The companies and the quarantine that ``reconcile_csv`` wrote."""
    companies = read_stage_csv(spark, os.path.join(target, "companies"), schema, order_col=None)
    return companies, read_stage_csv(spark, os.path.join(target, "quarantine"), QUARANTINE, order_col=None)
