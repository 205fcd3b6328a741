"""Writers: CSV with a fixed header, append logs, JSON reports, text per key, rewritten line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escape_concat, escape_ffmetadata, escape_html, escape_quoted


def csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    df.select(*columns).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append_log(df: DataFrame, path: str, columns: list[str], keys: list[str]) -> None:
    """Appends rows whose keys the log doesn't hold yet; other columns are left out."""
    spark = df.sparkSession
    from .readers import csv as read
    from .readers import or_empty

    schema = ", ".join(f"{c} string" for c in columns)
    old = or_empty(spark, path, lambda: read(spark, path, columns), schema)
    csv(df.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"), path, columns, "append")


def union_of_keys(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*sorted(out.columns))


def json_report(df: DataFrame, path: str, counts: dict) -> None:
    """One object a row, and one with the counts."""
    total = df.agg(*[c.alias(n) for n, c in counts.items()]).select(F.to_json(F.struct("*")).alias("value"), F.lit(0).alias("o"))
    rows = df.select(F.to_json(F.struct("*")).alias("value"), F.lit(1).alias("o"))
    total.unionByName(rows).sort("o").select("value").write.mode("overwrite").text(path)


def text_per_key(df: DataFrame, path: str, keys: list[str], text: str) -> None:
    df.select(*keys, F.col(text).alias("value")).write.mode("overwrite").partitionBy(*keys).text(path)


def update(rows: DataFrame, fresh: DataFrame, key: str, columns: list[str], path: str) -> None:
    """Writes the documents with fresh values where there are any as JSON under path: a new version, for the one that is
    read must stay."""
    from ..operators.relations import sync

    sync(rows, fresh, key, columns).drop("changed").write.mode("errorifexists").json(path)


def markdown_report(df: DataFrame, path: str, title: str, counts: dict, columns: list[str], order: list[str], most: int | None = None) -> None:
    """A heading, one line for each count, and a table of the rows in order, or of the first of them."""
    total = df.agg(*[c.cast("string").alias(n) for n, c in counts.items()]).first().asDict()  # one row
    cell = lambda c: F.regexp_replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\s+", " ")
    first = df if most is None else df.orderBy(*order).limit(most)
    rows = first.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |")).alias("value"), F.row_number().over(Window.orderBy(*order)).alias("o"))
    head = [f"# {title}", "", *[f"- {n}: {v}" for n, v in total.items()], "", f"| {' | '.join(columns)} |", "|" + "---|" * len(columns)]
    top = df.sparkSession.createDataFrame([(line, i - len(head)) for i, line in enumerate(head)], "value string, o int")
    top.unionByName(rows).coalesce(1).sortWithinPartitions("o").select("value").write.mode("overwrite").text(path)


def concat_list(df: DataFrame, keys: list[str], order: str, file: str) -> DataFrame:
    """value: the files of a key in order, as a list for concatenation."""
    part = F.concat(F.lit("file '"), escape_concat(F.col(file)), F.lit("'"))
    body = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("p")))), lambda x: x["p"])
    return df.groupBy(*keys).agg(F.concat(F.array_join(body, "\n"), F.lit("\n")).alias("value"))


def chapters_csv(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of a chapter table: number, start, end, duration and the gap after, in milliseconds."""
    w = Window.partitionBy(*keys).orderBy(order)
    gap = F.coalesce(F.lead("start_at").over(w) - F.col("end_at"), F.lit(0))
    return df.select(*keys, F.row_number().over(w).alias("chapter"), F.col("start_at").alias("start_ms"), F.col("end_at").alias("end_ms"), (F.col("end_at") - F.col("start_at")).alias("duration_ms"), gap.cast("long").alias("post_chapter_gap_ms"), "title")


def html_index(df: DataFrame, keys: list[str], order: str, href: str, title: str) -> DataFrame:
    """value: a list of links for each key, in order."""
    item = F.concat(F.lit('<li><a href="'), escape_html(F.col(href)), F.lit('">'), escape_html(F.col(title)), F.lit("</a></li>"))
    body = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("p")))), lambda x: x["p"])
    return df.groupBy(*keys).agg(F.concat(F.lit("<ul>\n"), F.array_join(body, "\n"), F.lit("\n</ul>\n")).alias("value"))


def toml(fields: dict) -> Column:
    """Lines name = value: text between quotes, numbers and booleans bare."""
    line = lambda n, c, text: F.concat(F.lit(f"{n} = "), F.concat(F.lit('"'), escape_quoted(c), F.lit('"')) if text else c.cast("string"))
    return F.concat_ws("\n", *[line(n, c, text) for n, (c, text) in fields.items()])


def to_copy(source: DataFrame, target: DataFrame) -> DataFrame:
    """Of files by name and hash (readers.hashes()), those that the target lacks or has with another content."""
    there = target.select("name", F.col("sha256").alias("_there"))
    return source.join(there, "name", "left").where(~F.col("sha256").eqNullSafe(F.col("_there"))).drop("_there")


def rewrite_lines(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """file and text of files in which a line differs: changes has file, line_no, new_line."""
    out = rows.join(changes, ["file", "line_no"], "left").withColumn("_l", F.coalesce("new_line", "line"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "_l"))), lambda x: x["_l"])
    return out.groupBy("file").agg(F.array_join(parts, "\n").alias("text"), F.bool_or(~F.col("_l").eqNullSafe(F.col("line"))).alias("changed")).where("changed").drop("changed")


def chapters(df: DataFrame, keys: list[str]) -> DataFrame:
    """ffmetadata text of a timeline: start_at and end_at in milliseconds, title."""
    esc = escape_ffmetadata(F.col("title"))
    part = F.concat(F.lit("[CHAPTER]\nTIMEBASE=1/1000\nSTART="), F.col("start_at").cast("string"), F.lit("\nEND="), F.col("end_at").cast("string"), F.lit("\ntitle="), esc)
    body = F.transform(F.array_sort(F.collect_list(F.struct("start_at", part.alias("p")))), lambda x: x["p"])
    return df.groupBy(*keys).agg(F.concat(F.lit(";FFMETADATA1\n"), F.array_join(body, "\n"), F.lit("\n")).alias("value"))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "unit") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
