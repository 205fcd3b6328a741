"""Pull quotes on pages: their blocks, whether marks and text stand as they should, and where to put them.

A block is an opening mark, the lines of text below it and a closing mark. Spans are as in operators.layout. A page is at most
what a page holds; all of it are joins on file and page, with windows over lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sequence
from .cutting import cut as cut_

#: What quotes are set in, the page, and how far marks, lines and neighbours may stand from each other.
STYLE = {"font": "Lato", "sizes": (13.0, 18.5), "colors": ("C000000", "C595959", "C7F7F7F"), "not": ("", "References", "PullQuoteOpen", "PullQuoteClose")}
PAGE = {"centre": 297.5, "top": 60.0, "bottom": 760.0, "grey": "C767171"}
GAP, OPEN_BEFORE, CLOSE_AFTER, LEADS, LINES, BREAK = 18.0, 18.0, 4.0, (16.5, 24.0), (12.0, 30.0), 42.0
ABOVE, BELOW, NEXT_PAGE = 10.0, 220.0, 150.0
OPEN, CLOSE = "PullQuoteOpen", "PullQuoteClose"


def quote_text(style: dict = STYLE) -> Column:
    return F.contains("font", F.lit(style["font"])) & F.col("size").between(*style["sizes"]) & F.col("color").isin(*style["colors"]) & ~F.col("text").isin(*style["not"]) & ~F.contains("text", F.lit("http"))


def _marks(spans: DataFrame, text: str, name: str) -> DataFrame:
    return spans.where(F.col("text") == text).select("file", "page", F.col("line_no").alias(name), F.col("x").alias(f"{name}_x"), F.col("y").alias(f"{name}_y"))


#: Pairs of marks on a page up to which one fold matches them; fuller pages are matched in rounds. The result is the same.
FOLD_PAIRS = 10_000


def matched_marks(spans: DataFrame, cut=cut_) -> DataFrame:
    """Openers with the closer each takes: of the closers after it on its page and not far off in height, the nearest in
    height that no opener before it takes."""
    near = (F.col("close") > F.col("open")) & (F.col("close_y") - F.col("open_y")).between(-ABOVE, BELOW)
    pairs = cut(_marks(spans, OPEN, "open").join(_marks(spans, CLOSE, "close"), ["file", "page"]).where(near))
    full = cut(pairs.groupBy("file", "page").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FOLD_PAIRS).select("file", "page"))
    if full.isEmpty():
        return matched_by_fold(pairs)
    few = matched_by_fold(pairs.join(full, ["file", "page"], "left_anti"))
    return few.unionByName(matched_in_rounds(cut(pairs.join(full, ["file", "page"], "left_semi")), cut))


def matched_by_fold(pairs: DataFrame) -> DataFrame:
    """A page's openers in order, each with its closers from the nearest on; the closers taken so far go along."""
    offer = F.array_sort(F.collect_list(F.struct(F.abs(F.col("close_y") - F.col("open_y")).alias("d"), "close", "close_x", "close_y")))
    pairs = pairs.repartition("file", "page")  # for openers and pages alike
    opened = pairs.groupBy("file", "page", "open", "open_x", "open_y").agg(offer.alias("offers"))
    whole = opened.groupBy("file", "page").agg(F.array_sort(F.collect_list(F.struct("open", "open_x", "open_y", "offers"))).alias("l"))
    best = lambda a, o: F.get(F.filter(o["offers"], lambda c: ~F.exists(a, lambda t: t["c"]["close"] == c["close"])), F.lit(0))
    taken = F.struct(F.col("l")[0]["open"].alias("open"), F.col("l")[0]["open_x"].alias("open_x"), F.col("l")[0]["open_y"].alias("open_y"), F.col("l")[0]["offers"][0].alias("c"))
    none = F.filter(F.array(taken), lambda t: F.lit(False))
    fold = F.aggregate("l", none, lambda a, o: F.concat(a, F.filter(F.array(F.struct(o["open"].alias("open"), o["open_x"].alias("open_x"), o["open_y"].alias("open_y"), best(a, o).alias("c"))), lambda t: t["c"].isNotNull())))
    return whole.select("file", "page", F.inline(fold)).select("file", "page", "open", "open_x", "open_y", "c.close", "c.close_x", "c.close_y")


def matched_in_rounds(left: DataFrame, cut=cut_) -> DataFrame:
    """In rounds: an opener takes its nearest closer if no earlier opener that is still free could take it, so that every page gives
    at least one pair a round."""
    kept: list[DataFrame] = []
    own, other = Window.partitionBy("file", "open"), Window.partitionBy("file", "close")
    while True:
        best = F.min(F.struct(F.abs(F.col("close_y") - F.col("open_y")), "close")).over(own)["close"]
        won = cut(left.withColumn("_b", best).withColumn("_f", F.min("open").over(other)).where("_b = close and _f = open").drop("_b", "_f"))
        if won.isEmpty():
            return reduce(DataFrame.unionByName, kept, won).select("file", "page", "open", "open_x", "open_y", "close", "close_x", "close_y")
        kept.append(won)
        left = cut(left.join(won.select("file", "open"), ["file", "open"], "left_anti").join(won.select("file", "close"), ["file", "close"], "left_anti"))


def blocks(spans: DataFrame, cut=cut_) -> DataFrame:
    """The lines of text of each block: file, page, open, close and their places, line_no, x, y, w, size, row (from 1 on, lines of one
    height). A block ends at a gap of more than BREAK; marks without text are no block."""
    pairs = matched_marks(spans, cut)
    text = spans.where(quote_text()).select("file", "page", "line_no", "x", "y", "w", "size")
    low = F.greatest(F.col("close_y"), F.col("open_y")) + 60.0
    rows = pairs.join(text, ["file", "page"]).where(F.col("y").between(F.col("open_y") - 2.0, low) & (F.col("x") >= F.col("open_x") + 4.0))
    rows = sequence.chained_groups(rows, ["file", "page", "open"], ["y", "x", "line_no"], "y", BREAK, "_g").where("_g = 1").drop("_g")
    return sequence.anchored_groups(rows, ["file", "page", "open"], ["y", "x", "line_no"], "y", 1.0, "row", placed=True)


def neighbours(spans: DataFrame, extents: DataFrame) -> DataFrame:
    """extents (file, page, open, top, bottom) with above and below: the heights of the nearest text over and under each."""
    text = spans.where(~F.col("text").isin("", OPEN, CLOSE) & (F.col("color") != PAGE["grey"]) & F.col("y").between(PAGE["top"], PAGE["bottom"])).select("file", "page", F.col("y").alias("_y"))
    far = extents.join(text, ["file", "page"], "left")
    found = far.groupBy("file", "page", "open").agg(F.max(F.when(F.col("_y") < F.col("top"), F.col("_y"))).alias("above"), F.min(F.when(F.col("_y") > F.col("bottom"), F.col("_y"))).alias("below"))
    return extents.join(found, ["file", "page", "open"])


def shift_within(least: Column, most: Column) -> Column:
    """The smallest move that keeps both gaps: at least least (the gap above), at most most (the gap below); where both
    can't be kept the room there is decides, from above first."""
    up = F.when(most < 0, F.greatest(most, F.least(F.lit(0.0), least))).otherwise(F.lit(0.0))
    return F.when(up < least, F.least(least, F.greatest(up, most))).otherwise(up)


def planned(spans: DataFrame, cut=cut_) -> tuple[DataFrame, DataFrame]:
    """Where each span of each block should stand (file, page, line_no, open, new_x, new_y, moved), and per block what can't be had
    (file, page, open, rows, shift, tight_above, tight_below: the gaps that are too small, else null).

    Rows are centred, one lead below the other; the block moves up or down by the least that leaves a gap to its neighbours."""
    spans = cut(spans.select("file", "page", "line_no", "x", "y", "w", "size", "color", "font", "text"))  # read four times
    lines = cut(blocks(spans, cut))
    first = F.min(F.struct("y", "x", "line_no", "size"))
    rows = lines.repartition("file", "page", "open")  # for the rows of a block and their steps alike
    rows = rows.groupBy("file", "page", "open", "row").agg(F.max("y").alias("bottom"), first["y"].alias("row_y"), first["size"].alias("row_size"))
    step = F.col("row_y") - F.lag("row_y").over(Window.partitionBy("file", "page", "open").orderBy("row"))
    rows = rows.withColumn("_step", F.when(step.between(*LINES), step))
    whole = rows.groupBy("file", "page", "open").agg(F.count(F.lit(1)).alias("rows"), F.max("bottom").alias("bottom"), F.min("row_y").alias("top"), F.coalesce(F.min("_step"), F.min_by("row_size", "row") * 1.22).alias("_l"))
    whole = whole.withColumn("lead", F.greatest(F.lit(LEADS[0]), F.least(F.lit(LEADS[1]), "_l"))).drop("_l")
    whole = neighbours(spans, cut(whole))
    foot = F.col("top") + F.col("lead") * F.col("rows")
    least, most = F.coalesce(F.col("above") + GAP - F.col("top"), F.lit(-999.0)), F.coalesce(F.col("below") - GAP - foot, F.lit(999.0))
    whole = cut(whole.withColumn("shift", shift_within(least, most)))
    over_, under = F.col("top") + F.col("shift") - F.col("above"), F.col("below") - foot - F.col("shift")
    report = whole.select("file", "page", "open", "rows", "shift", F.when(over_ < GAP, over_).alias("tight_above"), F.when(under < GAP, under).alias("tight_below"))
    same = Window.partitionBy("file", "page", "open", "row")
    text = lines.repartition("file", "page", "open").withColumns({"left": F.min("x").over(same), "right": F.max(F.col("x") + F.col("w")).over(same)})
    text = text.join(whole.select("file", "page", "open", "top", "lead", "shift", "rows"), ["file", "page", "open"])
    text = text.withColumns({"new_x": F.col("x") + PAGE["centre"] - (F.col("left") + F.col("right")) / 2, "new_y": F.col("top") + F.col("shift") + F.col("lead") * (F.col("row") - 1)})
    frame = text.groupBy("file", "page", "open", "close", "open_x", "open_y", "close_x", "close_y").agg(F.min("new_x").alias("l"), F.max(F.col("new_x") + F.col("w")).alias("r"), F.min("new_y").alias("t"), F.max(F.col("top") + F.col("shift") + F.col("lead") * (F.col("rows") - 1)).alias("b"))
    mark = lambda n, x, y: F.struct(F.col(n).alias("line_no"), F.col(f"{n}_x").alias("x"), F.col(f"{n}_y").alias("y"), x.alias("new_x"), y.alias("new_y"))
    marks = frame.select("file", "page", "open", F.inline(F.array(mark("open", F.col("l") - OPEN_BEFORE, F.col("t")), mark("close", F.col("r") + CLOSE_AFTER, F.col("b")))))
    every = text.select("file", "page", "open", "line_no", "x", "y", "new_x", "new_y").unionByName(marks)
    moved = (F.abs(F.col("x") - F.col("new_x")) > 0.01) | (F.abs(F.col("y") - F.col("new_y")) > 0.01)
    return every.select("file", "page", "line_no", "open", "new_x", "new_y", moved.alias("moved")), report


def closed_on_page(spans: DataFrame) -> DataFrame:
    """Openers with the last closer before the next opener of their page, near in height; close is null without one."""
    w = Window.partitionBy("file", "page").orderBy("open")
    heads = _marks(spans, OPEN, "open").withColumn("next_open", F.lead("open").over(w))
    near = (F.col("close") > F.col("open")) & (F.col("next_open").isNull() | (F.col("close") < F.col("next_open"))) & (F.col("close_y") - F.col("open_y")).between(-ABOVE, BELOW)
    found = heads.join(_marks(spans, CLOSE, "close"), ["file", "page"]).where(near).groupBy("file", "open").agg(F.max(F.struct("close", "close_x", "close_y")).alias("c"))
    return heads.join(found, ["file", "open"], "left").select("file", "page", "open", "open_x", "open_y", "next_open", "c.*")


def frame_findings(spans: DataFrame, reach: float = 165.0) -> DataFrame:
    """file, line_no (of the opener), issue, value: where a quote's marks and text aren't in line."""
    heads = closed_on_page(spans)
    text = spans.where(quote_text()).select("file", "page", "line_no", "x", "y", "w")
    later = (F.col("line_no") > F.col("open")) & (F.col("next_open").isNull() | (F.col("line_no") < F.col("next_open")))
    rows = heads.join(text, ["file", "page"], "left").withColumn("_in", later & F.col("y").between(F.col("open_y") - 1, F.col("open_y") + reach) & (F.col("x") >= F.col("open_x") + 5))
    held = F.col("_in") & (F.col("y") <= F.col("close_y") + 1.6)
    when = lambda c, v: F.when(c, v)
    centre = F.col("x") + F.col("w") / 2
    sums = rows.groupBy("file", "open", "open_y", "close", "close_x", "close_y").agg(F.min(when(F.col("_in"), F.col("y"))).alias("first"), F.max(when(held, F.col("y"))).alias("last"), F.max(when(held, F.col("x") + F.col("w"))).alias("right"), F.avg(when(held, centre)).alias("centre"), F.max(when(held, centre)).alias("most"), F.min(when(held, centre)).alias("least"))
    none = F.col("close").isNull()
    drift = F.greatest(F.col("most") - F.col("centre"), F.col("centre") - F.col("least"))
    rules = [
        ("no-text", F.col("first").isNull(), F.lit(None).cast("double")),
        ("opener-off", F.abs(F.col("first") - F.col("open_y")) > 1.1, F.col("first") - F.col("open_y")),
        ("no-closer", F.col("first").isNotNull() & none, F.lit(None).cast("double")),
        ("not-enclosed", F.col("first").isNotNull() & ~none & F.col("last").isNull(), F.lit(None).cast("double")),
        ("closer-off", (F.col("close_y") < F.col("last") - 1.1) | (F.abs(F.col("close_y") - F.col("last")) > 1.6), F.col("close_y") - F.col("last")),
        ("closer-overlaps", F.col("close_x") < F.col("right") + 1.0, F.col("close_x") - F.col("right")),
        ("centres-drift", drift > 2.0, drift),
        ("off-centre", F.abs(F.col("centre") - PAGE["centre"]) > 2.0, F.col("centre") - PAGE["centre"]),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("issue"), v.alias("value"))) for n, c, v in rules]))
    return sums.select("file", F.col("open").alias("line_no"), F.inline(found))


def brought_back(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes whose end stands at the top of the next page, brought back where they fit: (file, line_no, open, new_page, new_x, new_y,
    sort_key) of every span that is set anew, and (file, open, page, moved, shift) of each quote.

    sort_key orders the lines of a file: lines from the next page come right after the last one of theirs on the opener's page, so
    nothing else is renumbered. Of openers that want one closer the first gets it; what has too little room is left out."""
    heads = closed_on_page(spans).where("close is null").select("file", "page", "open", "open_x", "open_y")
    ends = _marks(spans, CLOSE, "close").where(F.col("close_y") <= NEXT_PAGE).withColumn("page", F.col("page") - 1)
    pairs = heads.join(ends, ["file", "page"]).groupBy("file", "page", "open", "open_x", "open_y").agg(F.min(F.struct("close_y", "close")).alias("c")).select("file", "page", "open", "open_x", "open_y", "c.close", "c.close_y")
    pairs = pairs.withColumn("_f", F.min("open").over(Window.partitionBy("file", "close"))).where("_f = open").drop("_f")
    text = spans.where(quote_text()).select("file", F.col("page").alias("_p"), "line_no", "x", "y", "w")
    rows = pairs.join(text, "file").where(F.col("_p").between(F.col("page"), F.col("page") + 1))
    here = (F.col("_p") == F.col("page")) & (F.col("line_no") > F.col("open")) & (F.col("x") >= F.col("open_x") + 4) & F.col("y").between(F.col("open_y") - 2, F.lit(PAGE["bottom"]))
    there = (F.col("_p") > F.col("page")) & F.col("y").between(F.lit(PAGE["top"]), F.col("close_y") + 2)
    order = Window.partitionBy("file", "open").orderBy("_p", "y", "x", "line_no")
    rows = rows.where(here | there).withColumn("i", F.row_number().over(order) - 1)
    step = F.col("y") - F.lag("y").over(Window.partitionBy("file", "open", "_p").orderBy("y", "x", "line_no"))
    rows = rows.withColumn("_step", F.when(step.between(6.0, 32.0), step))
    own = F.col("_p") == F.col("page")
    whole = rows.groupBy("file", "page", "open", "open_y", "close").agg(F.count(F.lit(1)).alias("n"), F.sum(own.cast("int")).alias("n_here"), F.coalesce(F.median("_step"), F.lit(18.0)).alias("gap"), F.min(F.when(own, F.col("y"))).alias("top"), F.max(F.when(own, F.col("line_no"))).alias("after"), F.min(F.lit(PAGE["centre"]) - F.col("w") / 2).alias("l"), F.max(F.lit(PAGE["centre"]) + F.col("w") / 2).alias("r")).where("n_here > 0 and n_here < n")
    other = spans.where(~F.col("text").isin("", OPEN, CLOSE) & (F.col("color") != PAGE["grey"])).select("file", "page", F.col("line_no").alias("_l"), F.col("y").alias("_y"))
    block = rows.where(own).select("file", "open", F.col("line_no").alias("_l"))
    over_ = whole.join(other, ["file", "page"]).where(F.col("_y") < F.col("open_y")).join(block, ["file", "open", "_l"], "left_anti").groupBy("file", "open").agg(F.max("_y").alias("above"))
    whole = whole.join(over_, ["file", "open"], "left").withColumn("shift", F.least(F.lit(0.0), F.lit(PAGE["bottom"]) - F.col("top") - F.col("gap") * F.col("n")))
    whole = whole.where(-F.col("shift") <= F.coalesce(F.col("top") - F.col("above") - GAP, F.lit(999.0)) + 0.1)
    first = F.col("top") + F.col("shift")
    placed = rows.select("file", "open", "_p", "line_no", "w", "i").join(whole, ["file", "open"])
    key = F.when(F.col("_p") == F.col("page"), F.col("line_no").cast("double")).otherwise(F.col("after") + (F.col("i") + 1) / (F.col("n") + 2))
    lines = placed.select("file", "line_no", "open", F.col("page").alias("new_page"), (PAGE["centre"] - F.col("w") / 2).alias("new_x"), (first + F.col("gap") * F.col("i")).alias("new_y"), key.alias("sort_key"))
    mark = lambda n, x, y, k: F.struct(F.col(n).alias("line_no"), x.alias("new_x"), y.alias("new_y"), k.alias("sort_key"))
    marks = whole.select("file", "open", F.col("page").alias("new_page"), F.inline(F.array(mark("open", F.col("l") - OPEN_BEFORE, first, F.col("open").cast("double")), mark("close", F.col("r") + CLOSE_AFTER, first + F.col("gap") * (F.col("n") - 1), F.col("after") + (F.col("n") + 1) / (F.col("n") + 2)))))
    return lines.unionByName(marks.select(*lines.columns)), whole.select("file", "open", "page", (F.col("n") - F.col("n_here") + 1).cast("long").alias("moved"), "shift")
