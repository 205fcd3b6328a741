"""Joins, aggregates, selections and set operations in the forms that document audits need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import over

# --- joins


def must_match(rows: DataFrame, dim: DataFrame, key: str, probe: str) -> DataFrame:
    """N:1 join that fails on a key that dim lacks; probe is a column of dim that is never null."""
    out = rows.join(dim, key, "left")
    return out.withColumn(probe, F.when(F.col(probe).isNull(), F.raise_error(F.concat(F.lit(f"no {key} "), F.col(key).cast("string")))).otherwise(F.col(probe)))


def left_default(rows: DataFrame, dim: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Left join; columns that stay null or empty take defaults."""
    out = rows.join(dim, key, "left")
    kinds = dict(out.dtypes)
    return out.withColumns({c: F.coalesce(F.when(F.col(c) != "", F.col(c)) if kinds[c] == "string" else F.col(c), F.lit(v)) for c, v in defaults.items()})


def lookup_distinct(keys: list[DataFrame], results: DataFrame, key: str) -> DataFrame:
    """The distinct keys of several one-column tables, each looked up once."""
    out = keys[0]
    for k in keys[1:]:
        out = out.union(k)
    return out.where(F.col(key).isNotNull()).distinct().join(results, key, "left")


def range_after(df: DataFrame, keys: list[str], order: str, opener: Column, at: str, reach: float) -> DataFrame:
    """Each opener with the rows after it that lie within reach and before the next opener of its key.

    The opener of a row is the last one before it, so this is one window and no self-join."""
    w = over(keys, [order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_o", F.last(F.when(opener, F.struct(F.col(order).alias("id"), F.col(at).alias("at"))), ignorenulls=True).over(w))
    return df.where(~opener & F.col("_o").isNotNull() & (F.col(at) - F.col("_o.at") <= reach)).withColumn("opener", F.col("_o.id")).drop("_o")


def neighbours(df: DataFrame, keys: list[str], order: list[str], match: Column, value: str) -> DataFrame:
    """The value of the nearest matching row before and after each row."""
    w = over(keys, order)
    hit = F.when(match, F.col(value))
    return df.withColumns({
        "previous": F.last(hit, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "next": F.first(hit, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
    })


def islands(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose two neighbours agree with each other and not with the row."""
    w = over(keys, order)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    return df.withColumns({"_b": before, "_a": after}).where((F.col("_b") == F.col("_a")) & (F.col(value) != F.col("_b"))).withColumn("around", F.col("_b")).drop("_a", "_b")


def priority_union(tables: list[DataFrame], key: str, order: str) -> DataFrame:
    """One row a key: from the first table that has it, and there the last in order."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("_p", F.lit(i))
        out = t if out is None else out.unionByName(t)
    w = Window.partitionBy(key).orderBy("_p", F.col(order).desc())
    return out.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_p")


def band_join(points: DataFrame, at: str, bands: DataFrame, start: str, length: int, keys: list[str]) -> DataFrame:
    """Points with the bands [start, start + length] that hold them, closed at both ends. Both sides are cut into
    cells of length: a band lies in two cells at most, so this is an equality join."""
    cell = lambda c: F.floor(c / length).cast("long")
    b = bands.withColumn("_c", F.explode(F.sequence(cell(F.col(start)), cell(F.col(start) + length))))
    return points.withColumn("_c", cell(F.col(at))).join(b, [*keys, "_c"]).where((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(start) + length)).drop("_c")


def templates(rows: DataFrame, column: str, forms: list[str], name: str) -> DataFrame:
    """Rows times query templates, in which {} stands for the column."""
    return rows.withColumn("_t", F.explode(F.array(*[F.lit(f) for f in forms]))).withColumn(name, F.replace("_t", F.lit("{}"), F.col(column))).drop("_t")


def union_with_rest(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All of first, and of second what first lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti").select(*second.columns))


def sync(rows: DataFrame, fresh: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns take the fresh value where there is one; changed says whether any did."""
    new = fresh.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(new, key, "left")
    merged = {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}
    changed = F.lit(False)
    for c, m in merged.items():
        changed = changed | ~m.eqNullSafe(F.col(c))
    return out.withColumn("changed", changed).withColumns(merged).drop(*[f"_{c}" for c in columns])


# --- aggregates


def sets_to_lists(df: DataFrame, keys: list[str], columns: dict[str, str], separator: str = ";") -> DataFrame:
    """Distinct values of each column, sorted and joined."""
    return df.groupBy(*keys).agg(*[F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), separator).alias(n) for n, c in columns.items()])


def role_lists(df: DataFrame, keys: list[str], role: str, value: str, roles: list[str], order: str) -> DataFrame:
    """One ordered list of values for each role."""
    pick = lambda r: F.transform(F.array_sort(F.collect_list(F.when(F.col(role) == r, F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))), lambda x: x["v"])
    return df.groupBy(*keys).agg(*[pick(r).alias(f"{r}_list") for r in roles])


def weighted_top(df: DataFrame, keys: list[str], value: str, weight: Column, n: int) -> DataFrame:
    """The n values of greatest total weight in each key; ties by value."""
    sums = df.groupBy(*keys, value).agg(F.sum(weight).alias("weight"))
    w = Window.partitionBy(*keys).orderBy(F.col("weight").desc(), value)
    return sums.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= n)


def deviation(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, and the greatest distance from it, from sums in one pass."""
    out = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.min(value).alias("_l"), F.max(value).alias("_h"))
    return out.withColumn("max_deviation", F.greatest(F.col("_h") - F.col("mean"), F.col("mean") - F.col("_l"))).drop("_l", "_h")


def upper_median(value: str) -> Column:
    """The middle of the sorted values, the upper one of two: no interpolation."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)")  # from counts of values, with partial sums


def median_gap(df: DataFrame, keys: list[str], order: list[str], value: str, low: float, high: float, default: float) -> DataFrame:
    """The median of differences between neighbours that lie in [low, high], or a default."""
    gaps = df.withColumn("_g", F.col(value) - F.lag(value).over(over(keys, order)))
    return gaps.groupBy(*keys).agg(F.coalesce(F.median(F.when(F.col("_g").between(low, high), F.col("_g"))), F.lit(default)).alias("median_gap"))


def duplicates(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys found more than once, with their count and the least value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("first_value")).where("n > 1")


def unique_or_ambiguous(df: DataFrame, pattern: str, target: str) -> DataFrame:
    """Patterns with their number of distinct targets; one target makes a pattern unique."""
    out = df.groupBy(pattern).agg(F.count_distinct(target).alias("targets"), F.min(target).alias("least_target"))
    return out.withColumn("kind", F.when(F.col("targets") == 1, "unique").otherwise("ambiguous"))


def ordinal_suffix(df: DataFrame, keys: list[str], base: str, order: str, name: str) -> DataFrame:
    """base, and for a repeated base its number from the second on, in order of a number."""
    from .sequence import total_before

    n = F.col("_i") + 1
    rows = total_before(df, [*keys, base], order, F.lit(1), "_i")
    return rows.withColumn(name, F.when(n == 1, F.col(base)).otherwise(F.concat_ws("-", F.col(base), n.cast("string")))).drop("_i")


# --- selection


def pick(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, name: str | None = None) -> DataFrame:
    """The first n rows of each key in an order that ends with a tie-break."""
    out = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("_n") <= n)
    return out.withColumnRenamed("_n", name) if name else out.drop("_n")


def queue(df: DataFrame, order: list[Column], limit: int = 0, offset: int = 0) -> DataFrame:
    """Sorted rows from offset on; limit 0 is no limit."""
    out = df.orderBy(*order)
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit else out


def two_way_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("side", F.lit("right")))
