"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked; the fractional rank (2 rank - 1) / (2 n)
of a source of n rows spreads it evenly over (0, 1). All rows in the order of that fraction are cut into
runs of equal length, so that each run holds every source in its share of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Rows that one window task should hold, and buckets there are at least, so that small tables are spread, too.
ROWS_PER_BUCKET, MIN_BUCKETS = 20_000, 128


def interleave(rows: DataFrame, n_shards: int, stratum: str, order: list[str], seed: int = 17) -> DataFrame:
    """rows plus rank (1.. within the stratum), position (0.. over all), shard and slot (0.. in the shard).

    Shard sizes differ by one row at most. The shuffle key is the MD5 of the seed and the columns in
    order. Ranks are counted in two levels, over hash buckets of about ROWS_PER_BUCKET rows, so that no
    task holds a whole stratum. A null stratum is a stratum of its own. Rows that agree in all columns of
    order are interchangeable; an empty table gives an empty result. Added columns replace columns of
    the same name.
    """
    added = ("rank", "position", "shard", "slot")
    rows = rows.drop(*[c for c in added if c not in (stratum, *order)])
    names = rows.columns
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("r"), F.col(f"`{stratum}`").alias("s"), F.md5(F.to_json(F.struct(F.lit(seed).alias("seed"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order)]))).alias("h"))
    packed = common.materialise(packed, "interleave")
    total = packed.count()
    buckets = max(MIN_BUCKETS, -(-total // ROWS_PER_BUCKET))
    packed = packed.withColumn("b", F.expr(f"cast(conv(substring(h, 1, 8), 16, 10) as bigint) * {buckets} div {1 << 32}"))

    per = packed.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("s").alias("s2"), F.col("b").alias("b2"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"), F.sum("n").over(Window.partitionBy("s")).alias("of"))
    ranked = packed.join(per, F.col("s").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")))
    within = Window.partitionBy("s", "b").orderBy("h")
    ranked = ranked.select("r", "s", "h", "of", (F.col("ahead") + F.row_number().over(within)).alias("rank"))
    ranked = ranked.withColumn("part", (2 * F.col("rank") - 1).cast("double") / (2 * F.col("of")))
    ranked = common.materialise(ranked.withColumn("b", F.floor(F.col("part") * buckets).cast("long")), "interleave")
    common.discard(packed)

    per = ranked.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    per = per.select(F.col("b").alias("b2"), F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    placed = ranked.join(per, F.col("b") == F.col("b2"))
    within = Window.partitionBy("b").orderBy("part", "s", "h")
    placed = placed.withColumn("position", F.col("ahead") + F.row_number().over(within) - 1)
    shard = F.expr(f"cast(position * {n_shards} div {max(total, 1)} as int)")
    start = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("shard", shard).select("r.*", "rank", "position", "shard", (F.col("position") - start).alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """Per row: id, source, size (UTF-8 bytes plus 1), text_crc32, rank, position, shard, slot. See interleave().

    Null text counts as no bytes. The text is read once, for its size and checksum, and is not shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), (F.length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    return interleave(slim, n_shards, "source", ["id", "text_crc32", "size"], seed).withColumnRenamed("id", id_col)
