"""Scans: what a row gets depends on the rows of its key before it, by a state that goes from row to row.

Rows are dealt by key and bucket of the order, and a task streams over its rows in order, so that a key with most of
the rows runs spread. Two ways to give each bucket the state it begins with:

carried_states: a machine of few states. Each row is a function from state to state; a bucket's functions are composed to one,
and a bucket begins with what those before it make of the first state. Two passes, whatever the data.

settled: any state. Buckets run from a guess, and run again while the bucket before them ends elsewhere than guessed, until
all agree; then every bucket has begun where its predecessor ended. Buckets that agree aren't run again. Layouts and groups forget their
beginning soon, so that few rounds do; at worst a round settles one more bucket of each key.

The order is a whole number, distinct within a key; null keys are a key of their own, a null order comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import quotes
from .cutting import cut as cut_
from .sequence import over

#: Rows that one bucket should hold, over all keys.
ROWS_PER_BUCKET = 1_000_000


def dealt(df: DataFrame, keys: list[str], order: str) -> tuple[DataFrame, int]:
    """df with _b, the bucket of its order from 0 on, and the number of buckets. Only keys of more rows than a bucket should hold are
    cut: in a table of many short keys every row would be a bucket of its own."""
    low, high, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    one = F.lit(0).cast("long")
    if buckets == 1 or low == high:
        return df.withColumn("_b", one), 1
    long_ = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ROWS_PER_BUCKET).drop("_n").collect()  # fewer than buckets
    if not long_:
        return df.withColumn("_b", one), 1
    b = F.coalesce(F.width_bucket(F.col(order).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets)) - 1, one)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cut = reduce(or_, (reduce(and_, (F.col(k).eqNullSafe(F.lit(r[k]).cast(kinds[k])) for k in keys)) for r in long_))
    return df.withColumn("_b", F.when(cut, b).otherwise(one).cast("long")), buckets + 1


def _streamed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.repartition(*keys, "_b").sortWithinPartitions(*keys, "_b", order)


def _segments(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Runs of a batch with equal names: what they are, the first row and the one behind the last."""
    rows = list(zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True))
    lo = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i] != rows[lo]:
            yield rows[lo], lo, i
            lo = i


def carried_states(df: DataFrame, keys: list[str], order: str, step: Column, n_states: int, name: str, first: int = 0) -> DataFrame:
    """df with name, the state before each row. step: an array that gives for each state the one behind the row."""
    rows, buckets = dealt(df.withColumn("_f", step), keys, order)
    at = [*keys, "_b"]
    if buckets > 1:
        key_fields = [f for f in rows.schema.fields if f.name in at]
        order_of = [f.name for f in key_fields]

        def compose(batches):
            held, f = None, list(range(n_states))
            for b in batches:
                steps, ended = b.column("_f").to_pylist(), []
                for k, lo, hi in _segments(b, order_of):
                    if k != held:
                        if held is not None:
                            ended.append((*held, f))
                        held, f = k, list(range(n_states))
                    for g in steps[lo:hi]:
                        f = [g[s] for s in f]
                last = b
                if ended:
                    yield _rows(b, order_of, ended)
            if held is not None:
                yield _rows(last, order_of, [(*held, f)])

        def _rows(b, names, rows):
            kinds = [*(b.schema.field(n).type for n in names), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [*names, "_g"])

        whole = _streamed(rows.select(*at, order, "_f") if order not in at else rows.select(*at, "_f"), keys, order).mapInArrow(compose, T.StructType([*key_fields, T.StructField("_g", T.ArrayType(T.IntegerType()))]))
        listed = whole.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_b", "_g"))).alias("_l"))
        begins = F.aggregate("_l", F.struct(F.lit(first).alias("s"), F.array().cast("array<struct<_b:bigint,_start:int>>").alias("out")), lambda a, x: F.struct(F.get(x["_g"], a["s"]).alias("s"), F.array_append(a["out"], F.struct(x["_b"].alias("_b"), a["s"].alias("_start"))).alias("out")), lambda a: a["out"])
        starts = listed.select(*keys, F.inline(begins))
        rows = rows.alias("x").join(starts.alias("y"), [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in at]).select("x.*", "y._start")
    else:
        rows = rows.withColumn("_start", F.lit(first))

    def run(batches):
        held, s = None, first
        for b in batches:
            steps, starts, out = b.column("_f").to_pylist(), b.column("_start").to_pylist(), []
            for k, lo, hi in _segments(b, at):
                if k != held:
                    held, s = k, starts[lo]
                for g in steps[lo:hi]:
                    out.append(s)
                    s = g[s]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], [*b.schema.names, name])

    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.IntegerType())])
    return _streamed(rows, keys, order).mapInArrow(run, schema).drop("_f", "_b", "_start")


def smart_quotes(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """df with curly quotes in text; a quote that a row opens is closed in the rows after it."""
    rows = carried_states(df, keys, order, quotes.steps(text), quotes.STATES, "_state", quotes.START)
    return rows.withColumn(text, quotes.curly(text, "_state")).drop("_state")


#: advance(memory, rows) -> (memory behind them, how far the count went, for each row the count so far and more numbers).
Advance = Callable[[float | None, list[tuple]], tuple[float | None, int, list[tuple]]]
#: Writes a table and reads it back.
Cut = Callable[[DataFrame], DataFrame]


def settled(df: DataFrame, keys: list[str], order: str, values: list[str], advance: Advance, first: float | None, count: str, more: list[str], cut: Cut = cut_) -> DataFrame:
    """df with the column count and those of more, by advance() over each key's rows, which remembers one number (at the beginning
    first) and counts. Counts don't change what is remembered: they are added up over the buckets when all agree."""
    rows, buckets = dealt(df, keys, order)
    at = [*keys, "_b"]
    fields = {f.name: f for f in rows.schema.fields}
    start = F.lit(first).cast("double")

    def matches(x: str, y: str) -> list[Column]:
        return [F.col(f"{x}.{k}").eqNullSafe(F.col(f"{y}.{k}")) for k in at]

    def streamed(batches):  # per batch: it, of each segment its key and what is remembered and counted behind it, and the rows, advanced
        held, memory, counted = None, None, 0
        for b in batches:
            rows = list(zip(*(b.column(v).to_pylist() for v in values), strict=True))
            memories, counts, behind, out = b.column("_m").to_pylist(), b.column("_n").to_pylist(), [], []
            for k, lo, hi in _segments(b, at):
                if k != held:
                    held, memory, counted = k, memories[lo], counts[lo]
                memory, n, got = advance(memory, rows[lo:hi])
                out += [(counted + o[0], *o[1:]) for o in got]
                counted += n
                behind.append((k, memory, counted))
            yield b, behind, out

    def ends(batches):
        last, schema = None, None
        for b, behind, _ in streamed(batches):
            schema, ended = b.schema, []
            for segment in behind:
                if last is not None and last[0] != segment[0]:
                    ended.append(last)
                last = segment
            if ended:
                yield end(schema, ended)
        if last is not None:
            yield end(schema, [last])

    def end(schema, ended):
        kinds = [*(schema.field(n).type for n in at), pa.float64(), pa.int64()]
        columns = zip(*((*k, memory, counted) for k, memory, counted in ended), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*at, "_e", "_c"])

    if buckets > 1:
        end_schema = T.StructType([*[fields[k] for k in at], T.StructField("_e", T.DoubleType()), T.StructField("_c", T.LongType())])
        own = list(dict.fromkeys([*at, order, *values]))
        w = over(keys, ["_b"])
        begun = cut(rows.select(*at).distinct().select(*at, start.alias("_m"), F.lit(True).alias("_new")))
        known = None
        while True:
            again = rows.select(*own).alias("x").join(begun.where("_new").alias("y"), matches("x", "y")).select("x.*", "y._m", F.lit(0).cast("long").alias("_n"))
            found = _streamed(again, keys, order).mapInArrow(ends, end_schema)
            if known is not None:
                found = known.alias("x").join(begun.where("_new").alias("y"), matches("x", "y"), "left_anti").select("x.*").unionByName(found)
            known = cut(found)
            both = begun.alias("x").join(known.alias("y"), matches("x", "y")).select("x.*", "y._e", "y._c")
            before = F.when(F.lag(F.lit(1)).over(w).isNull(), start).otherwise(F.lag("_e").over(w))
            counts = F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
            begun = cut(both.select(*at, before.alias("_m"), counts.alias("_n"), (~before.eqNullSafe(F.col("_m"))).alias("_new")))
            if begun.where("_new").isEmpty():
                break
        ready = rows.alias("x").join(begun.alias("y"), matches("x", "y")).select("x.*", "y._m", "y._n")
    else:
        ready = rows.select("*", start.alias("_m"), F.lit(0).cast("long").alias("_n"))
    schema = T.StructType([*ready.schema.fields, T.StructField(count, T.LongType()), *[T.StructField(c, T.DoubleType()) for c in more]])

    def run(batches):
        for b, _, out in streamed(batches):
            if out:
                got = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got[0], pa.int64()), *[pa.array(c, pa.float64()) for c in got[1:]]], schema.names)

    return _streamed(ready, keys, order).mapInArrow(run, schema).drop("_b", "_m", "_n")


def flow_layout(df: DataFrame, keys: list[str], order: str, y: str, lead: str, top: float, bottom: float, cut: Cut = cut_) -> DataFrame:
    """Rows (y, lead) set one below the other: each at its y or below the last one's lead, on a new page if full;
    new_page and new_y."""

    def advance(cursor, rows):
        page, out = 0, []
        for at, own in rows:
            at = max(at, cursor)
            if at + own > bottom:
                page, at = page + 1, top
            out.append((page, at))
            cursor = at + own
        return cursor, page, out

    return settled(df, keys, order, [y, lead], advance, top, "new_page", ["new_y"], cut)


def anchored_groups(df: DataFrame, keys: list[str], order: str, value: str, gap: float, name: str, cut: Cut = cut_) -> DataFrame:
    """A new group where a value is over gap from the first of the current group; rows with a null value stay in it (in group 0
    before the first). order: a whole number that sorts a key's rows, by value."""

    def advance(anchor, rows):
        group, out = 0, []
        for (v,) in rows:
            if v is not None and (anchor is None or abs(v - anchor) > gap):
                group, anchor = group + 1, v
            out.append((group,))
        return anchor, group, out

    return settled(df, keys, order, [value], advance, None, name, [], cut)
