"""Stage writers (O-08, O-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.schemas import RUN_TS_FORMAT


def run_timestamp() -> F.Column:
    """O-59: the run's UTC time as ``yyyy-MM-ddTHH:mm:ss`` (one value per
    query: current_timestamp is fixed at planning)."""
    return F.date_format(F.current_timestamp(), RUN_TS_FORMAT)


def new_run_id(spark: SparkSession) -> str:
    """O-09, O-59: the run's UTC time, taken once; all outputs of a run carry it."""
    return spark.range(1).select(run_timestamp()).first()[0]


def stamp(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """O-09: attach the run stamp that ties a run's outputs together."""
    return df.withColumn("timestamp", F.lit(run_ts) if run_ts else run_timestamp())


def write_stage_csv(df: DataFrame, path: str, mode: str = "errorifexists",
                    sort_by: str | None = None, max_records_per_file: int | None = None) -> None:
    """O-08: CSV with header, UTF-8, ``"``-doubling; nested columns as JSON (O-40);
    ``max_records_per_file`` bounds the files, each of which is read back by one task.
    ``sort_by`` orders the written rows (O-35: reconciled companies come out
    by ascending name); sorting happens only here, at the sink."""
    if not path:
        raise ValueError("Need to provide a filename to save")
    if sort_by:
        df = df.orderBy(sort_by)
    flat = df.select(*[
        F.to_json(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
        for f in df.schema.fields
    ])
    (flat.write.mode(mode).option("header", True).option("escape", '"')
     .option("encoding", "UTF-8").option("maxRecordsPerFile", max_records_per_file or 0).csv(path))


def write_stage(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists") -> None:
    """The engine's own stage format: parquet, optionally partitioned by run."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """O-09: a run's rows of one stage under ``path/run_id=<run>``. Only that partition is
    replaced, so a run that is repeated, after a failure too, stands once, and others stay."""
    if not path or not run_id:
        raise ValueError("Need to provide a folder and a run to save")
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The rows of one run of a stage (only its partition is read)."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/run_id={run_id.replace(':', '%3A')}")
    return rows.drop("run_id")
