"""Session helpers: configuration and the shared folder for materialised data."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Many small files share a task less readily; a row group is never split (see views.spread).
    "spark.sql.files.openCostInBytes": "262144",
    # Fall back to per-expression codegen for a stage whose fused method is
    # too large for the JIT (the JVM does not compile methods over 8000 bytes
    # of bytecode and would interpret them).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, app: str = "fundlake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session. Only a local-mode session without one (a
    test) gets a private folder; a cluster without a shared folder is an error
    because a node-local path would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fundlake-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back (one job; an RDD checkpoint would compute the
    data twice). Survives executor loss, unlike a local checkpoint, and the
    stored table is cheap to count. ``options`` go to the Parquet writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fundlake`` importable on executors (needed by the operators that
    run Python per batch): zip the package into the shared folder once per
    application and register it with ``addPyFile``."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (Connect): the package must be installed
        return
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pyfiles") + ".zip"
    local = target[len("file:"):] if target.startswith("file:") else target
    if "://" in local:  # a remote shared folder: build locally, then let Spark ship it
        local = os.path.join(tempfile.mkdtemp(prefix="fundlake-zip-"), "fundlake.zip")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.join("fundlake", os.path.relpath(full, pkg_dir)))
    sc.addPyFile(local)
    _SHIPPED.add(app)
