"""Question and answer units from positioned text: spans with a role, lines, blocks of one role, pairs.

Spans are as in operators.layout. A file's spans are read in the order of its lines up to a stop heading, then set in reading order. All
are windows and sums within a file; no row is compared with more than its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tex
from . import sequence

#: What questions and answers are set in, where the running foot begins, headings that end an interview.
QUESTION = {"colors": ("C1F8135",), "font": "Lato", "least_size": 11.0}
ANSWER = {"colors": ("C000000", "C1A1718", "C222222"), "font": "Cormorant", "least_size": 12.4}
FOOT, RIGHT, SAME_LINE = 785.0, 540.0, 1.2
STOPS = ("references", "bibliography")
#: Characters that stand tight behind a piece, and that the next piece stands tight behind.
TIGHT_BEHIND, TIGHT_BEFORE = ".,;:!?)]}%", "([{/`"


def set_in(style: dict) -> Column:
    return F.col("color").isin(*style["colors"]) & F.contains("font", F.lit(style["font"])) & (F.col("size") >= style["least_size"]) & (F.col("x") < RIGHT)


def role(text: Column, stops: tuple[str, ...] = STOPS, running: tuple[str, ...] = (), not_asked: tuple[str, ...] = ("ttps://", "https://")) -> Column:
    """question, answer, stop or null."""
    low = F.regexp_replace(F.lower(F.trim(text)), "^[ :]+|[ :]+$", "")
    asked = set_in(QUESTION)
    for p in not_asked:
        asked = asked & ~F.startswith(low, F.lit(p))
    said = F.when(low.isin(*stops), "stop").when(asked, "question").when(set_in(ANSWER) & ~set_in(QUESTION), "answer")
    return F.when((text != "") & (F.col("y") < FOOT) & ~low.isin(*running, ""), said)


def lines(spans: DataFrame, text: Column | None = None, **how) -> DataFrame:
    """file, line (from 1 on, in reading order), page, y, role, text of each line: neighbours on a page, of one role and one height. text: the
    spans' text as plain text (TeX commands rewritten, if not given)."""
    rows = spans.withColumn("text", tex.tex_text(F.col("text"), tex.RUNNING) if text is None else text)
    rows = rows.withColumn("role", role(F.col("text"), **how)).where("role is not null")
    w = Window.partitionBy("file").orderBy("page", "y", "x", "line_no")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # in the order that lines need, so that rows are sorted once
    rows = rows.withColumn("_stop", F.min(F.when(F.col("role") == "stop", F.col("line_no"))).over(whole)).where("_stop is null or line_no < _stop").drop("_stop")
    last = lambda c: F.lag(c).over(w)
    same = (F.col("page") == last("page")) & (F.col("role") == last("role")) & (F.abs(F.col("y") - last("y")) <= SAME_LINE)
    rows = rows.withColumn("_new", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = F.array_sort(F.collect_list(F.struct("x", "line_no", "text")))
    rows = rows.groupBy("file", "_g", "role").agg(F.max("page").alias("page"), F.max("y").alias("y"), pieces.alias("_p"))
    before = lambda i: F.right(F.get("_p", i - 1)["text"], F.lit(1))
    tight = lambda p, i: before(i).isin(" ", *TIGHT_BEFORE) | F.left(p["text"], F.lit(1)).isin(" ", *TIGHT_BEHIND)
    parts = F.transform("_p", lambda p, i: F.concat(F.when(before(i).isNull() | tight(p, i), "").otherwise(" "), p["text"]))
    out = rows.withColumn("text", F.trim(F.regexp_replace(F.array_join(parts, ""), r"\s+", " "))).where("text <> ''")
    return out.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("_g")).cast("long")).select("file", "line", "page", "y", "role", "text")


def joined(pieces: Column) -> Column:
    """Pieces as one text, without blanks before stops."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.array_join(pieces, " "), r"\s+([.,;:!?])", "$1"), r"\s+", " "))


def blocks(of_lines: DataFrame) -> DataFrame:
    """file, block, role, text: runs of lines of one role from the first question on. A hyphen at the end of a line is a blank, if the next
    one goes on with a small letter."""
    rows = sequence.from_start(of_lines, ["file"], ["line"], F.col("role") == "question")
    w = Window.partitionBy("file").orderBy("line")
    change = F.coalesce(F.col("role") != F.lag("role").over(w), F.lit(True)).cast("int")
    rows = rows.withColumn("_c", change).withColumn("block", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    follows = F.lead("text").over(Window.partitionBy("file", "block").orderBy("line"))
    cut = F.endswith("text", F.lit("-")) & F.coalesce(follows.rlike(r"^\p{Ll}"), F.lit(False))
    rows = rows.withColumn("_t", F.when(cut, F.regexp_replace("text", "-$", "")).otherwise(F.col("text")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line", "_t"))), lambda p: p["_t"])
    return rows.groupBy("file", "block", "role").agg(joined(parts).alias("text")).where("text <> ''")


def units(of_blocks: DataFrame, least: int = 20) -> DataFrame:
    """file, unit, question, answer: question blocks that ask, with the answer block behind them; both of least characters."""
    w = Window.partitionBy("file").orderBy("block")
    rows = of_blocks.withColumns({"_r": F.lead("role").over(w), "answer": F.lead("text").over(w)})
    rows = rows.where((F.col("role") == "question") & F.contains("text", F.lit("?")) & (F.col("_r") == "answer") & (F.length("text") >= least) & (F.length("answer") >= least))
    return rows.withColumn("unit", F.row_number().over(w).cast("long")).select("file", "unit", F.col("text").alias("question"), "answer")
