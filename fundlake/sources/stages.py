"""Stage readers (O-01..O-07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.schemas import NA_TOKENS


def normalize_na(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the CSV missing-value tokens (``""``, ``null``, ``NA``, ``nan`` …)
    into NULL, as a pandas reader would."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in columns})


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                   order_col: str | None = "row_ord") -> DataFrame:
    """O-01: read a stage CSV (header, quoted multi-line cells, ``"``-doubling)
    with an explicit schema, normalise NA tokens and, when ``order_col`` is
    given, add a file-order key (file name, position) for order-aware steps."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    df = normalize_na(df)
    if order_col:
        df = df.withColumn(order_col, F.struct(F.input_file_name().alias("file"),
                                               F.monotonically_increasing_id().alias("pos")))
    return df


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The engine's own stage format: parquet."""
    return spark.read.parquet(path)


def read_saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """O-03: a saved page per file, read whole (url = file path)."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("url"), F.lit(200).alias("status"), F.col("value").alias("html"))


def page_urls(spark: SparkSession, base_url: str, n_pages: int, search_term: str = "") -> DataFrame:
    """O-04: listing page urls ``{base}/page/{n}/`` (+ ``?s=term``), n from 0."""
    suffix = f"?s={search_term}" if search_term else ""
    return spark.range(n_pages).select(
        F.col("id").alias("page"),
        F.concat(F.lit(f"{base_url}/page/"), F.col("id").cast("string"), F.lit(f"/{suffix}")).alias("url"),
    )


def until_first_empty(listings_per_page: DataFrame, page_col: str = "page", n_col: str = "n_rows",
                      sources: Sequence[str] = ()) -> DataFrame:
    """O-05: of every source (all rows are one without ``sources``) keep the pages before the
    first that yielded no rows (or failed, n NULL); the scan stops there.

    The first empty page is a minimum, partial in every task, then one row per source that
    is joined back; a source with many pages is split like any skewed join side. Nothing
    goes through the driver."""
    keys = [f"__s{i}" for i in range(len(sources))]
    rows = listings_per_page.select("*", *[F.col(s).alias(k) for s, k in zip(sources, keys)])
    empty = F.coalesce(F.col(n_col), F.lit(0)) == 0
    stops = rows.groupBy(*keys).agg(F.min(F.when(empty, F.col(page_col))).alias("__stop"))
    if not keys:  # one row
        joined = rows.join(F.broadcast(stops), how="cross")
    else:
        renamed = stops.toDF(*[f"{k}r" for k in keys], "__stop")
        same = [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys]
        joined = rows.join(renamed, on=same)
    kept = joined.where(F.col("__stop").isNull() | (F.col(page_col) < F.col("__stop")))
    return kept.select(*listings_per_page.columns)


def records_to_table(spark: SparkSession, records: list[dict], schema: T.StructType | None = None) -> DataFrame:
    """O-06: small driver-side records (e.g. a fixture) to a table; missing
    keys become NULL. Pipeline data never goes through here."""
    if schema is None:
        names: list[str] = []
        for r in records:
            names.extend(k for k in r if k not in names)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """O-07: raise when a stage produced nothing (one cheap probe)."""
    if df.isEmpty():
        raise ValueError(f"No data was successfully processed: {what}")
    return df


def require_value(value: str | None, what: str) -> str:
    if not value:
        raise ValueError(f"{what} must be given")
    return value


def col_or_null(df: DataFrame, name: str) -> Column:
    """O-16: a named argument column, NULL when the stage lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")
