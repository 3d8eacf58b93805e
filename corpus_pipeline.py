"""Corpus pipeline: from documents to token shards, stage by stage.

Each stage reads what its predecessor kept, takes its decisions on whole texts
and returns the columns of documents; the last returns one row per document
from the token files. Every stage's output is written as Parquet to the shared
folder and read again, so a lost executor costs at most its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlake.llm.fast_sketch_dedup import dedup_stage
from fundlake.llm.ppm_langid import language_stage
from fundlake.llm.raking import mixing_stage
from fundlake.llm.spaced_seeds import decontaminate_stage
from fundlake.llm.token_store import token_stage
from fundlake.session import materialize, ship_package

STAGES = [
    ("language", language_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontaminate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL expresses neither the language model nor the encoder; tests compare the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
