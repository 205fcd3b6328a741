"""Operators over ordered rows: flags, groups, blocks, timelines, sliding windows.

Every operator takes key columns and order columns; the order must be total within a key, for nothing
here relies on the order in which rows arrive. All are windows or folds within a key.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a key that one window should hold, where a key may have most of the rows.
ROWS_PER_BUCKET = 1_000_000


def over(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def running(keys: list[str], order: list[str]):
    return over(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def total_before(df: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """name: the sum of value over the rows of the key before the row, in order of one number that is distinct in a key. Counted
    in two levels, over buckets of the order and inside them, so that a key with most of the rows fills no task."""
    low, high, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    buckets = -(-(n or 1) // ROWS_PER_BUCKET)
    if buckets == 1 or low == high:
        return df.withColumn(name, F.coalesce(F.sum(value).over(over(keys, [order]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = df.withColumn("_b", F.width_bucket(F.col(order).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))).withColumn("_v", value)
    sums = rows.groupBy(*keys, "_b").agg(F.sum("_v").alias("_t"))
    sums = sums.withColumn("_a", F.coalesce(F.sum("_t").over(over(keys, ["_b"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    inside = F.coalesce(F.sum("_v").over(over([*keys, "_b"], [order]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sums, [*keys, "_b"]).withColumn(name, F.col("_a") + inside).drop("_b", "_v", "_a")


def carry_forward(df: DataFrame, keys: list[str], order: list[str], marker: Column, name: str) -> DataFrame:
    """The last marker that isn't null, up to and with the row (page numbers, cue times)."""
    return df.withColumn(name, F.last(marker, ignorenulls=True).over(running(keys, order)))


def until_stop(df: DataFrame, keys: list[str], order: list[str], stop: Column) -> DataFrame:
    """Drops rows from the first stop on."""
    return df.withColumn("_s", F.sum(stop.cast("int")).over(running(keys, order))).where("_s = 0").drop("_s")


def from_start(df: DataFrame, keys: list[str], order: list[str], start: Column) -> DataFrame:
    """Drops rows before the first start."""
    return df.withColumn("_s", F.sum(start.cast("int")).over(running(keys, order))).where("_s > 0").drop("_s")


def predicate_groups(df: DataFrame, keys: list[str], order: list[str], start: Column, name: str) -> DataFrame:
    """A group starts at each start and takes the rows that follow; rows before the first are dropped."""
    return df.withColumn(name, F.sum(start.cast("int")).over(running(keys, order)).cast("long")).where(F.col(name) > 0)


def chained_groups(df: DataFrame, keys: list[str], order: list[str], value: str, gap: float, name: str) -> DataFrame:
    """A new group where a value is over gap from the one before."""
    far = F.abs(F.col(value) - F.lag(value).over(over(keys, order))) > gap
    df = df.withColumn("_n", F.coalesce(far, F.lit(True)).cast("int"))
    return df.withColumn(name, F.sum("_n").over(running(keys, order)).cast("long")).drop("_n")


def anchored_groups(df: DataFrame, keys: list[str], order: list[str], value: str, gap: float, name: str, placed: bool = False) -> DataFrame:
    """A new group where a value is over gap from the first of the current group: each group's extent depends on
    where it began, so rows are numbered in one pass over them in order. Only the current anchor is held.
    placed: df comes from a window over these keys, so that a key's rows are in one partition and aren't shuffled again."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    at, own = df.columns.index(value), [df.columns.index(k) for k in keys]

    def run(batches):
        key, anchor, group = None, 0.0, 0
        for b in batches:
            out = []
            for k, v in zip(zip(*(b.column(i).to_pylist() for i in own), strict=True), b.column(at).to_pylist(), strict=True):
                if k != key:
                    key, anchor, group = k, None, 0
                if v is not None and (anchor is None or abs(v - anchor) > gap):
                    anchor, group = v, group + 1
                out.append(group)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], schema.names)

    rows = df if placed else df.repartition(*keys)
    return rows.sortWithinPartitions(*keys, *[c for c in order if c not in keys]).mapInArrow(run, schema)


def run_blocks(df: DataFrame, keys: list[str], order: str, role: str, text: str, separator: str = " ") -> DataFrame:
    """Runs of equal role: block number, role, first and last order value, rows, the texts joined in order."""
    change = F.col(role).eqNullSafe(F.lag(role).over(over(keys, [order]))) & (F.row_number().over(over(keys, [order])) > 1)
    df = df.withColumn("block", F.sum((~change).cast("int")).over(running(keys, [order])).cast("long"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"])
    return df.groupBy(*keys, "block").agg(F.first(role).alias(role), F.min(order).alias("first_row"), F.max(order).alias("last_row"), F.count(F.lit(1)).alias("n_rows"), F.array_join(parts, separator).alias(text))


def qa_units(turns: DataFrame, keys: list[str], order: str = "turn", role: str = "role", text: str = "text", question: str = "user", answer: str = "assistant", least: int = 20, need_mark: bool = False) -> DataFrame:
    """Question and answer units: a question block and the answer blocks up to the next question, as one text.
    A question without its mark is skipped with its answers if need_mark; both sides have least characters."""
    blocks = run_blocks(turns.where(F.col(role).isin(question, answer)), keys, order, role, text).where(F.length(F.trim(text)) > 0)
    unit = F.sum((F.col(role) == question).cast("int")).over(running(keys, ["block"]))
    blocks = blocks.withColumn("_u", unit).where("_u > 0")
    answers = F.transform(F.array_sort(F.collect_list(F.when(F.col(role) == answer, F.struct("block", text)))), lambda x: x[text])
    units = blocks.groupBy(*keys, "_u").agg(F.max(F.when(F.col(role) == question, F.col(text))).alias("question"), F.array_join(answers, " ").alias("answer"))
    if need_mark:
        units = units.where(F.col("question").contains("?"))
    units = units.where((F.length("question") >= least) & (F.length("answer") >= least))
    return units.withColumn("unit", F.row_number().over(over(keys, ["_u"])).cast("long")).select(*keys, "unit", "question", "answer")


def ranges(df: DataFrame, keys: list[str], order: list[str], size: str, first: int = 2) -> DataFrame:
    """Cumulative ranges: each row takes size numbers after those before it, from first on."""
    before = F.coalesce(F.sum(size).over(over(keys, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumns({"range_start": (first + before).cast("long"), "range_end": (first + before + F.col(size) - 1).cast("long")})


def gap_timeline(df: DataFrame, keys: list[str], order: list[str], duration: str, gap: int) -> DataFrame:
    """start and end of rows that follow one another with a gap, but none after the last."""
    w = over(keys, order)
    df = df.withColumn("gap", F.when(F.lead(duration).over(w).isNull(), 0).otherwise(gap).cast("long"))
    start = F.coalesce(F.sum(F.col(duration) + F.col("gap")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("start_at", start.cast("long")).withColumn("end_at", (F.col("start_at") + F.col(duration)).cast("long"))


def proportional_timeline(df: DataFrame, keys: list[str], order: str, weight: str, total: int) -> DataFrame:
    """Shares of total by weight, in order of a number; ends are rounded half to even, the last end is total."""
    sums = df.groupBy(*keys).agg(F.sum(weight).alias("_w"), F.max(order).alias("_l"))
    rows = total_before(df, keys, order, F.col(weight), "_before").join(sums, keys)
    share = lambda c: F.bround(F.lit(float(total)) * c / F.col("_w")).cast("long")
    end = F.when(F.col(order) == F.col("_l"), F.lit(total).cast("long")).otherwise(share(F.col("_before") + F.col(weight)))
    return rows.withColumn("end_at", end).withColumn("start_at", F.when(F.col("_before") == 0, F.lit(0).cast("long")).otherwise(share(F.col("_before")))).drop("_before", "_w", "_l")


def rescale_timeline(df: DataFrame, keys: list[str], order: str, total: int) -> DataFrame:
    """start_at and end_at stretched so that the last end is total and the first start 0."""
    ends = df.groupBy(*keys).agg(F.min(order).alias("_f"), F.max(order).alias("_l"), F.max("end_at").alias("_e"))
    scaled = lambda c: F.bround(F.col(c) * (F.lit(float(total)) / F.col("_e")))
    start = F.when(F.col(order) == F.col("_f"), 0).otherwise(scaled("start_at"))
    end = F.when(F.col(order) == F.col("_l"), total).otherwise(scaled("end_at"))
    return df.join(ends, keys).withColumns({"new_start": start.cast("long"), "new_end": end.cast("long")}).drop("_f", "_l", "_e")


def sliding_windows(df: DataFrame, keys: list[str], at: str, length: int, step: int) -> DataFrame:
    """Rows times the windows that hold them: windows start at the first row of a key and every step after it,
    are closed at both ends, and end no later than the last row. Window numbers come from arithmetic on
    each row, so no join is needed."""
    whole = Window.partitionBy(*keys)
    df = df.withColumn("_first", F.min(at).over(whole)).withColumn("_last", F.max(at).over(whole))
    off = F.col(at) - F.col("_first")
    low = F.greatest(F.ceil((off - length) / step), F.lit(0))
    high = F.least(F.floor(off / step), F.floor((F.col("_last") - F.col("_first") - length) / step))
    df = df.withColumn("_i", F.when(low <= high, F.sequence(low.cast("long"), high.cast("long"))))
    df = df.withColumn("window_no", F.explode("_i")).withColumn("window_start", (F.col("_first") + F.col("window_no") * step).cast("long"))
    return df.drop("_first", "_last", "_i")


def round_robin(df: DataFrame, keys: list[str], order: str, n: Column, name: str) -> DataFrame:
    """(i - 1) mod n for the i-th row of a key, in order of a number; null where n is 0."""
    rows = total_before(df, keys, order, F.lit(1), "_i")
    return rows.withColumn(name, F.when(n > 0, F.col("_i") % n).cast("long")).drop("_i")


def spacing(df: DataFrame, keys: list[str], order: list[str], value: str, least: float) -> DataFrame:
    """Rows closer than least to the row before, with the difference."""
    return df.withColumn("spacing", F.col(value) - F.lag(value).over(over(keys, order))).where(F.col("spacing") < least)


def toggle(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Alternating open and close over the rows of a key."""
    return df.withColumn(name, F.when(F.row_number().over(over(keys, order)) % 2 == 1, "open").otherwise("close"))
