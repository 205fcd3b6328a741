"""Tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share. Only where all is one process and
    none is named, one of its own is made and named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lectern-cut-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df as a written table: evaluated once, and readable after any executor is lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lectern/{spark.sparkContext.applicationId}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
