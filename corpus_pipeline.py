"""From `documents` to training pieces in five stages; each result is written as Parquet and read again as the next stage's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusops.llm import dedup_minmax, mixing, quality, secrets, sentencepieces
from corpusops.llm.store import Workspace

STAGES = [
    ("quality_rules", quality.stage),
    ("minhash_near_dedup", dedup_minmax.stage),
    ("secret_scans", secrets.stage),
    ("mixing", mixing.stage),
    ("sentencepiece", sentencepieces.stage),
]
# SQL can express neither the near-duplicate groups nor the pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
