"""Whether a path exists, in whatever store Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
