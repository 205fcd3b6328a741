"""Shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, event_type, value, sec (whole seconds)."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.floor(F.col("ts").cast("timestamp").cast("double")).cast("long").alias("sec"))


#: The same in SQL.
EVENTS = "(SELECT event_id, user_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events)"
