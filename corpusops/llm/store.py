"""Tables written to the folder that all executors share, to cut lineage between the steps of an operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`. Unset, it is an error on a cluster; a local session gets a scratch folder, set for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="corpusops-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Workspace:
    """A new folder below the shared one. `keep` writes a frame there and returns it reread, so later failures do not recompute it."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
