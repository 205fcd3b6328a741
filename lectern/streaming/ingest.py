"""Incremental loads: a stream of files appended once per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.paths import exists


def read(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def first_of_key(stream: DataFrame, keys: list[str], at: str | None = None, late: str = "1 day") -> DataFrame:
    """Rows whose keys weren't seen before. With a time column the state of keys is dropped once they are late."""
    if at:
        return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def append(stream: DataFrame, path: str, checkpoint: str, keys: list[str], buckets: int = 64):
    """Appends each batch without the keys that the table at path holds; replays of a batch add nothing. The table is
    partitioned by a hash of the keys, so a batch is held against the buckets that its keys fall into."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        fresh = batch.dropDuplicates(keys).withColumn("bucket", bucket)
        if exists(spark, path):
            fresh = fresh.join(spark.read.parquet(path).select("bucket", *keys), ["bucket", *keys], "left_anti")
        fresh.write.mode("append").partitionBy("bucket").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts(stream: DataFrame, at: str, size: str, late: str, by: str) -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.window(at, size), by).agg(F.count(F.lit(1)).alias("n"))
