"""Rectangles on pages: which overlap, and which points lie inside which.

Pages are cut into cells. A rectangle goes to each cell that it touches, so that only what shares a cell meets, and a pair is
reported by one cell alone: that of the upper left corner of what they have in common. Null sizes and positions touch nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(c: Column, side: float) -> Column:
    return F.floor(c / side).cast("long")


def _celled(df: DataFrame, keys: list[str], side: float, right: Column, bottom: Column) -> DataFrame:
    """df with a row for each cell from (x, y) to (right, bottom); df's own columns as one struct."""
    rows = df.where(F.col("x").isNotNull() & F.col("y").isNotNull() & right.isNotNull() & bottom.isNotNull())
    rows = rows.select(*keys, F.struct(*df.columns, right.alias("_right"), bottom.alias("_bottom")).alias("r"))
    rows = rows.withColumn("_cx", F.explode(F.sequence(_cell(F.col("r.x"), side), _cell(F.col("r._right"), side))))
    return rows.withColumn("_cy", F.explode(F.sequence(_cell(F.col("r.y"), side), _cell(F.col("r._bottom"), side))))


def overlaps(boxes: DataFrame, keys: list[str], id_: str, side: float = 64.0) -> DataFrame:
    """keys, a, b (ids, a before b), width and height of what each two boxes (x, y, w, h) of a key have in common; boxes that
    touch don't overlap. ids are distinct within a key."""
    rows = _celled(boxes.where("w > 0 and h > 0"), keys, side, F.col("x") + F.col("w"), F.col("y") + F.col("h"))
    at = [F.col(f"p.{k}") == F.col(f"q.{k}") for k in [*keys, "_cx", "_cy"]]
    left, top = F.greatest("p.r.x", "q.r.x"), F.greatest("p.r.y", "q.r.y")
    right, bottom = F.least("p.r._right", "q.r._right"), F.least("p.r._bottom", "q.r._bottom")
    own = (_cell(left, side) == F.col("p._cx")) & (_cell(top, side) == F.col("p._cy"))
    both = rows.alias("p").join(rows.alias("q"), [*at, F.col(f"p.r.{id_}") < F.col(f"q.r.{id_}"), left < right, top < bottom, own])
    return both.select(*[F.col(f"p.{k}") for k in keys], F.col(f"p.r.{id_}").alias("a"), F.col(f"q.r.{id_}").alias("b"), (right - left).alias("width"), (bottom - top).alias("height"))


def inside(points: DataFrame, boxes: DataFrame, keys: list[str], side: float = 64.0) -> DataFrame:
    """The rows of points (x, y) that lie in a box (x, y, w, h) of their key, its edges included, with box: that box's row."""
    cells = _celled(boxes.where("w >= 0 and h >= 0"), keys, side, F.col("x") + F.col("w"), F.col("y") + F.col("h"))
    own = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumns({"_cx": _cell(F.col("x"), side), "_cy": _cell(F.col("y"), side)})
    at = [F.col(f"p.{k}") == F.col(f"q.{k}") for k in [*keys, "_cx", "_cy"]]
    held = F.col("p.x").between(F.col("q.r.x"), F.col("q.r._right")) & F.col("p.y").between(F.col("q.r.y"), F.col("q.r._bottom"))
    return own.alias("p").join(cells.alias("q"), [*at, held]).select(*[F.col(f"p.{c}") for c in points.columns], F.struct(*[F.col(f"q.r.{c}") for c in boxes.columns]).alias("box"))
