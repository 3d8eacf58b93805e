"""Run metrics and the funding-by-year report (O-36, O-61, O-62, O-63, O-64)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fundlake.functions.amounts import to_millions


def funding_year(mm_yy: F.Column) -> F.Column:
    """Four-digit year from an ``MM/YY`` date: 69-99 -> 19xx, 00-68 -> 20xx
    (the POSIX two-digit-year pivot)."""
    yy = F.substring(mm_yy, -2, 2).try_cast("int")
    return (F.when(yy >= 69, F.lit(1900)).otherwise(F.lit(2000)) + yy).cast("int")


def amount_by_year(rounds: DataFrame, date_col: str = "date", amount_col: str = "amount") -> DataFrame:
    """O-64: total reconciled amount per funding year, also in millions
    (O-61), sorted by year (O-36). One partial aggregate; the result has one
    row per year, so the final sort is over a tiny table."""
    return (
        rounds.groupBy(funding_year(F.col(date_col)).alias("year"))
        .agg(
            F.sum(amount_col).cast("bigint").alias("amount"),
            F.round(to_millions(F.sum(amount_col)), 6).alias("amount_millions"),
            F.count(F.lit(1)).alias("n_rounds"),
        )
        .orderBy("year")
    )


def observe_run(results: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """O-63: run counters gathered while the results are written (no extra
    pass): rows, true request count, successes, failures and tokens. Read
    ``observation.get`` after the action."""
    obs = Observation(name)
    attempts = F.col("attempt") if "attempt" in results.columns else F.lit(1)
    observed = results.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.sum(attempts).alias("requests"),
        F.count(F.when(F.col("error").isNull(), 1)).alias("successes"),
        F.count(F.when(F.col("error").isNotNull(), 1)).alias("failures"),
        F.sum("total_tokens").alias("tokens"),
    )
    return observed, obs
