"""Rules over positioned spans (see sources.readers.spans): lines, neighbours, findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from . import relations, sequence

BODY = ("file", "line_no", "page", "x", "y", "font", "size", "color", "text")


def body_only(spans: DataFrame, top: float = 45.0, bottom: float = 785.0, away: tuple[str, ...] = ("C767171",)) -> DataFrame:
    """Without headers, footers and running heads."""
    return spans.where(F.col("y").between(top, bottom) & ~F.col("color").isin(*away))


def role(question: Column, answer: Column, stop: Column) -> Column:
    """The first that holds; null if none does."""
    return F.when(stop, "stop").when(question, "question").when(answer, "answer")


def visual_lines(spans: DataFrame, tolerance: float = 1.2, anchored: bool = False) -> DataFrame:
    """Spans of a page with the number of their line: a new one where y moves by more than the tolerance, from the
    span before (chained) or from the line's first span (anchored)."""
    group = sequence.anchored_groups if anchored else sequence.chained_groups
    return group(spans, ["file", "page"], ["y", "x", "line_no"], "y", tolerance, "row")


def line_texts(rows: DataFrame) -> DataFrame:
    parts = F.transform(F.array_sort(F.collect_list(F.struct("x", "line_no", "text"))), lambda s: s["text"])
    return rows.groupBy("file", "page", "row").agg(F.min("y").alias("y"), F.min("x").alias("x"), F.max(F.col("x") + F.col("w")).alias("right"), F.max("size").alias("size"), F.array_join(parts, " ").alias("text"))


def finding(spans: DataFrame, issue: str, detail: Column | None = None, override: Column | None = None) -> DataFrame:
    """The nine fields of a span, the issue and a detail; override stands in the place of the text."""
    if override is not None:
        spans = spans.withColumn("text", F.coalesce(override, "text"))
    return spans.select(*BODY, F.lit(issue).alias("issue"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))


def findings(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def style_islands(rows: DataFrame) -> DataFrame:
    """Spans whose style differs from both neighbours on their line, which agree."""
    style = F.concat_ws("|", "font", F.bround("size", 2).cast("string"), "color")
    found = relations.islands(rows.withColumn("style", style), ["file", "page", "row"], ["x", "line_no"], "style")
    return finding(found, "style_island", F.col("around"))


def size_drift(rows: DataFrame, keys: list[str], most: float = 0.45) -> DataFrame:
    """Spans whose size is off the upper median of their keys."""
    typical = rows.groupBy(*keys).agg(relations.upper_median("size").alias("_m"))
    found = rows.join(typical, keys).where(F.abs(F.col("size") - F.col("_m")) > most)
    return finding(found, "size_drift", X.fixed(F.col("_m"), 2))


def tight_rows(lines: DataFrame, least: float = 8.0) -> DataFrame:
    """Lines closer to the one before than least."""
    return sequence.spacing(lines, ["file", "page"], ["y", "row"], "y", least)


def off_centre(lines: DataFrame, keys: list[str], most: float) -> DataFrame:
    """Groups of lines whose centres stray from their mean."""
    return relations.deviation(lines.withColumn("centre", (F.col("x") + F.col("right")) / 2), keys, "centre").where(F.col("max_deviation") > most)


def missing_targets(links: DataFrame, anchors: DataFrame, key: str = "anchor") -> DataFrame:
    """Links to anchors that a file lacks, and anchors that it has more than once."""
    lost = links.join(anchors, ["file", key], "left_anti").select("file", key, F.lit("missing").alias("issue")).distinct()
    twice = anchors.groupBy("file", key).count().where("count > 1").select("file", key, F.lit("duplicate").alias("issue"))
    return lost.unionByName(twice)


def reading_order(spans: DataFrame) -> DataFrame:
    w = Window.partitionBy("file").orderBy("page", "y", "x", "line_no")
    return spans.withColumn("ord", F.row_number().over(w))
