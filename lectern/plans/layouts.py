"""Queries over spans: scans of their lines, filters, projections, style and layout rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rewrite as R
from ..operators import audit, coverage
from ..operators import boxes as B
from ..operators import layout as L
from ..operators import pullquotes as Q
from ..sources import readers
from .derived import QUOTED, quoted, spans, with_spans

QUOTE_COLORS = ("C000000", "C595959", "C7F7F7F")
FAMILIES = [(("lato", "light"), "LatoLight"), (("lato", "italic"), "LatoItalic"), (("lato",), "LatoRegular"), (("cormorant", "italic"), "CormorantItalic"), (("cormorant",), "CormorantRegular"), (("symbol",), "SymbolFallback")]


def _keys(rows, *more):
    return rows.select("file", "line_no", *more)


def _lines(spark, d):
    """Spans as lines of a document, with a page marker every thirteenth line."""
    s = spans(spark, d)
    cut = lambda c: F.format_string("%.2f", c)
    command = F.concat(F.lit(r"\TstPlacedTextContent{"), F.concat_ws("}{", cut("x"), cut("y"), cut("w"), "color", "font", cut("size"), "text"), F.lit("}"))
    marker = F.concat(F.lit("% Page "), (F.col("line_no") % 40).cast("string"))
    return s.select("file", "line_no", F.when(F.col("line_no") % 13 == 0, marker).otherwise(command).alias("line"))


def s01_span_scan(spark, d):
    return readers.spans(_lines(spark, d))


def s02_first_page_scan(spark, d):
    rows = _lines(spark, d).withColumn("line", F.when(F.col("line_no") % 30 == 7, r"\end{tikzpicture}").otherwise(F.col("line")))
    return _keys(readers.spans(readers.before(rows)))


def s08_visible_text(spark, d):
    return readers.visible_text(_lines(spark, d)).select("file", F.md5("text").alias("digest"))


def p03_boxes(spark, d):
    return _keys(L.boxes(spans(spark, d, lines=True)), "right", "centre", "gap")


def p04_style_key(spark, d):
    rows = spans(spark, d).select(L.style_key().alias("s"), "text")
    return rows.groupBy("s").agg(F.sum(F.length("text")).cast("long").alias("chars")).select("s.font", "s.size", "s.color", "chars")


def p05_findings(spark, d):
    s = spans(spark, d)
    return audit.findings([audit.finding(s.where("size > 17"), "large", F.format_string("%.1f", "size")), audit.finding(s.where("text = ' ,'"), "blank", override=F.trim("text"))])


def p10_colour_names(spark, d):
    v = F.col("line_no") * 7919 % 16777216
    part = lambda k: (F.col("line_no") * k % 300).cast("double") / 256 - 0.05
    return spans(spark, d).select("line_no", L.color_name(F.when(F.col("line_no") % 9 == 0, F.col("line_no") % 20).otherwise(v)).alias("name"), L.rgb_name(part(3), part(5), F.when(F.col("line_no") % 10 > 0, part(7))).alias("drawn"))


def f01_footer_or_head(spark, d):
    return _keys(spans(spark, d).where(L.footer_or_head()))


def f02_movable(spark, d):
    return _keys(spans(spark, d).where(L.movable()))


def f03_question_spans(spark, d):
    return _keys(spans(spark, d).where(L.question()))


def f08_contact_text(spark, d):
    return _keys(spans(spark, d).where(L.contact() & ~L.allowed_symbol()))


def f09_marks(spark, d):
    return _keys(spans(spark, d), L.own_doi().alias("own_doi"), L.citation_start().alias("citation"), L.punctuation_token().alias("token"), L.skipped_text().alias("skipped")).where("own_doi or citation or token or skipped")


def f11_spacing_pairs(spark, d):
    p = L.pairs(spans(spark, d, lines=True)).where(L.spacing_allowed(-60.0, 120.0))
    return p.where((L.style_boundary() | L.punctuation_boundary()) & L.needs_space()).select("file", "page", F.col("left_line_no").alias("left"), F.col("right_line_no").alias("right"), "gap")


def c01_roles(spark, d):
    s = spans(spark, d)
    role = audit.role(L.question(), (F.col("color") == "C000000") & F.contains("font", F.lit("Cormorant")), F.col("text") == "References")
    return _keys(s, role.alias("role")).where("role is not null")


def c09_title_drift(spark, d):
    return L.title_drift(spans(spark, d))


def c09_question_drift(spark, d):
    s = spans(spark, d, lines=True)
    wanted = (F.col("color") == L.QUESTION) & (F.col("size") >= 10.5) & ~L.footer_or_head() & ~L.contact() & ~L.allowed_symbol()
    return L.line_style_drift(s, wanted, "Lato", "question", 0.45)


def c09_answer_drift(spark, d):
    s = spans(spark, d, lines=True)
    wanted = F.col("color").isin(*L.BODY) & (F.col("size") >= 12.0) & ~L.footer_or_head() & ~L.contact() & ~L.allowed_symbol()
    return L.line_style_drift(s, wanted, "Cormorant", "answer", 0.55, ~F.contains("font", F.lit("Italic")))


def c10_opener_targets(spark, d):
    return L.opener_targets(spans(spark, d), F.col("text") == "PullQuoteOpen", QUOTE_COLORS)


def c09_pullquote_drift(spark, d):
    s = spans(spark, d, lines=True)
    wanted = F.col("color").isin(*QUOTE_COLORS) & F.col("size").between(14.5, 18.0) & ~L.footer_or_head() & (F.trim("text") != "References")
    return L.line_style_drift(s, wanted, "Lato", "pullquote", 0.45)


def c10_quote_frame(spark, d):
    return Q.frame_findings(quoted(spark, d)).select("file", "line_no", "issue", F.round("value", 4).alias("value"))


def c10_overlaps(spark, d):
    s = quoted(spark, d).withColumn("h", F.col("size"))
    return B.overlaps(s, ["file", "page"], "line_no").select("file", "page", "a", "b", F.round("width", 3).alias("width"), F.round("height", 3).alias("height"))


def c10_in_panel(spark, d):
    """Text that stands on a file's citation panel."""
    s = spans(spark, d).where("page = 1")
    box = L.panel(spans(spark, d), L.citation_start(), L.own_doi()).select("file", "x", "y", F.col("width").alias("w"), F.col("height").alias("h"))
    return B.inside(s, box, ["file"]).select("file", "line_no", F.round(F.col("x") - F.col("box.x"), 3).alias("dx"), F.round(F.col("y") - F.col("box.y"), 3).alias("dy"))


def c11_dead_space(spark, d):
    """Quotes after which the rest of the page stays empty, for the next upright text stands on a later one."""
    s = quoted(spark, d)
    q = L.after_quotes(s.where("text = 'PullQuoteOpen'"), s.where(L.movable(top=60.0) & (F.col("font") == "FontCormorantRegular")))
    return q.where(L.dead_space() > 95.0).select("file", "line_no", F.round(L.dead_space(), 3).alias("dead_space"))


def c11_quotes_off_centre(spark, d):
    s = quoted(spark, d).where("text = 'PullQuoteOpen'")
    return s.where(F.abs(F.col("x") - L.centred_x(F.col("w"))) > 0.1).select("file", "line_no", (F.col("x") - L.centred_x(F.col("w"))).alias("off"))


def c16_planned_quotes(spark, d):
    moves, _ = Q.planned(quoted(spark, d))
    return moves.select("file", "page", "line_no", "open", F.round("new_x", 3).alias("new_x"), F.round("new_y", 3).alias("new_y"), "moved")


def c16_tight_quotes(spark, d):
    """Blocks that can't have a gap above and below."""
    _, report = Q.planned(quoted(spark, d))
    tight = [F.round(c, 3).alias(c) for c in ("shift", "tight_above", "tight_below")]
    return report.where("tight_above is not null or tight_below is not null").select("file", "page", "open", "rows", *tight)


def c16_brought_back(spark, d):
    lines, _ = Q.brought_back(quoted(spark, d))
    return lines.select("file", "line_no", "open", "new_page", F.round("new_x", 3).alias("new_x"), F.round("new_y", 3).alias("new_y"), F.round("sort_key", 6).alias("sort_key"))


def c10_off_centre(spark, d):
    s = spans(spark, d, lines=True).withColumn("right", F.col("x") + F.col("w"))
    return audit.off_centre(s, ["file", "page", "y"], 60.0).select("file", "page", "y", F.round("max_deviation", 4).alias("deviation"))


def c11_unasked_quotes(spark, d):
    s = spans(spark, d)
    return L.unasked_quotes(s.where("text = 'PullQuoteOpen'"), s, L.question())


def c12_font_family(spark, d):
    return spans(spark, d).select(L.font_family(F.col("font"), FAMILIES, "CormorantRegular").alias("family")).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


def c15_citation_panel(spark, d):
    return L.panel(spans(spark, d), L.citation_start(), L.own_doi())


def c17_quote_geometry(spark, d):
    text = F.concat_ws(r" \\ ", F.col("text"), F.col("font"), F.when(F.col("line_no") % 2 == 0, F.lit("more")))
    s = spans(spark, d)
    return s.select("line_no", L.quote_height(text).alias("height"), F.round(L.line_lead(), 6).alias("lead"), L.centred_x(F.col("w")).alias("x"))


def c18_line_skip(spark, d):
    s = spans(spark, d).select("line_no", "y", F.col("y").alias("y0"), (F.col("y") + F.col("size")).alias("y1"), F.when(F.col("line_no") % 17 == 0, F.col("page").cast("string")).otherwise(F.col("text")).alias("text"))
    return s.where(L.skipped_line(F.lit(800.0), "Cite as")).select("line_no")


def w22_shift_flow(spark, d):
    page, y = L.shift_flow(F.col("page"), F.col("y"), (F.col("line_no") % 2000).cast("double"), F.lit(1))
    return spans(spark, d).select("line_no", page.cast("long").alias("page"), y.alias("y"))


def g09_mean_and_max(spark, d):
    return spans(spark, d).groupBy("file").agg(F.round(F.avg("size"), 6).alias("mean"), F.max("size").alias("most"))


def g13_margins(spark, d):
    return L.margins(spans(spark, d), F.col("color") == L.QUESTION)


def g14_first_seen(spark, d):
    seen = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "font"))), lambda x: x["font"]))
    return spans(spark, d).groupBy("file").agg(F.array_join(seen, ",").alias("fonts"))


def g19_page_count(spark, d):
    return L.span_pages(spans(spark, d))


def g04_sorted_lists(spark, d):
    rows = spans(spark, d).groupBy("file", "page").agg(F.array_sort(F.collect_list(F.struct("y", "x", "line_no"))).alias("l"))
    return rows.select("file", "page", F.size("l").cast("long").alias("n"), F.array_join(F.transform("l", lambda x: x["line_no"].cast("string")), ",").alias("order"))


def j14_adjacent_pairs(spark, d):
    return L.pairs(spans(spark, d, lines=True)).select("file", "page", F.col("left_line_no").alias("left"), F.col("right_line_no").alias("right"))


def j18_issue_ranges(spark, d):
    pages = L.span_pages(spans(spark, d)).withColumn("issue", F.substring("file", 1, 2))
    return coverage.page_ranges(pages, "issue", "file", "pages")


def j19_first_card(spark, d):
    s = spans(spark, d).select("font", F.col("line_no").alias("card"))
    return coverage.first_by(s, "font", "card", s.where("card % 1000 = 7").groupBy("font").agg(F.max("card").alias("card")))


def o04_reading_order(spark, d):
    return audit.reading_order(spans(spark, d)).select("file", "line_no", F.col("ord").cast("long").alias("ord"))


def o08_fixpoint(spark, d):
    """Blank lines give way, one after another, until each stands below the one before it."""
    rows = spans(spark, d, lines=True).groupBy("file", "page", "y").agg(F.min("line_no").alias("line_no"), F.max("size").alias("size"))
    rows = rows.select("file", "line_no", (F.col("size") * 2).cast("long").alias("v"))
    step = lambda df: df.select("file", "line_no", F.when(F.col("v") > 20, F.col("v") - 5).otherwise(F.col("v")).alias("v"), (F.col("v") > 20).alias("moved"))
    done, n = L.fixpoint(rows, step, F.col("moved"), 50)
    return done.groupBy("v").agg(F.count(F.lit(1)).alias("n")).withColumn("steps", F.lit(n).cast("long"))


def t31_coordinate_rewrite(spark, d):
    line = R.set_argument(F.col("line"), "TstPlacedTextContent", 2, (F.col("line_no") % 700).cast("double") / 8)
    return _lines(spark, d).select("file", "line_no", line.alias("line"))


def t34_line_breaks(spark, d):
    text = F.concat_ws(r" \\", F.col("text"), F.lit(""), F.col("font"))
    return spans(spark, d).select("line_no", F.array_join(R.display_lines(text), "|").alias("parts"), R.unbroken(text).alias("whole"))


def t35_regions(spark, d):
    lines = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    rows = spans(spark, d).groupBy("file").agg(lines.alias("l"))
    kept = F.array_join(R.without_region(F.col("l"), "PullQuoteOpen", "Then it went on."), "\n")
    return rows.select("file", F.md5(R.ensured(kept, "References", "References\n")).alias("digest"))


QUERIES = {f.__name__: f for f in (s01_span_scan, s02_first_page_scan, s08_visible_text, p03_boxes, p04_style_key, p05_findings, p10_colour_names, f01_footer_or_head, f02_movable, f03_question_spans, f08_contact_text, f09_marks, f11_spacing_pairs, c01_roles, c09_title_drift, c09_question_drift, c09_answer_drift, c09_pullquote_drift, c10_opener_targets, c10_quote_frame, c10_overlaps, c10_in_panel, c10_off_centre, c11_unasked_quotes, c11_dead_space, c11_quotes_off_centre, c16_planned_quotes, c16_tight_quotes, c16_brought_back, c12_font_family, c15_citation_panel, c17_quote_geometry, c18_line_skip, w22_shift_flow, g04_sorted_lists, g09_mean_and_max, g13_margins, g14_first_seen, g19_page_count, j14_adjacent_pairs, j18_issue_ranges, j19_first_card, o04_reading_order, o08_fixpoint, t31_coordinate_rewrite, t34_line_breaks, t35_regions)}

_FOOT = "(color = 'C767171' OR y > 760 OR y < 45)"
_CONTACT = r"regexp_matches(text, '(?i)https?://|www\.|doi\.org|@|[A-Za-z0-9-]+\.[A-Za-z]{2,}')"
_QUESTION = "(color = 'C1F8135' AND contains(font, 'Lato') AND size BETWEEN 11 AND 14.5 AND y BETWEEN 60 AND 760 AND NOT contains(text, 'doi.org'))"
_SYMBOL = "contains(font, 'SymbolFallback')"
_CITE = "(contains(text, 'Citation:') OR regexp_matches(trim(text), '(?i)Cite\\s+as:') OR trim(text) = 'Cite')"
_OWN = "((contains(text, 'ttps://doi.org/10.34700/') OR contains(text, 'ttps://doi.org/10.5281/') OR contains(text, 'href{https://doi.org/10.') OR regexp_matches(text, '(?i)doi:\\s*10\\.34700/')) AND NOT contains(text, '10.1038/'))"
_NEXT = ", p AS (SELECT file, page, y, x, w, color, font, text, line_no, lead(line_no) OVER o AS r_line, lead(x) OVER o AS r_x, lead(color) OVER o AS r_color, lead(font) OVER o AS r_font, lead(text) OVER o AS r_text FROM s WINDOW o AS (PARTITION BY file, page, y ORDER BY x, line_no))"
_TEXLINE = r"CASE WHEN line_no % 13 = 0 THEN '% Page ' || (line_no % 40) ELSE '\TstPlacedTextContent{' || printf('%.2f', x) || '}{' || printf('%.2f', {y}) || '}{' || printf('%.2f', w) || '}{' || color || '}{' || font || '}{' || printf('%.2f', size) || '}{' || text || '}' END"


def _drift(wanted: str, font: str, issue: str, most: float, plain: str) -> str:
    return with_spans(f""", q AS (SELECT *, contains(font, '{font}') AS own FROM s WHERE {wanted}),
b AS (SELECT *, own AND {plain} AS base FROM q),
m AS (SELECT file, page, y, bool_or(own) AS any_own, list_sort(list(round(size, 3)) FILTER (WHERE base)) AS l FROM b GROUP BY 1, 2, 3),
r AS (SELECT b.*, l[len(l) // 2 + 1] AS mid, any_own, l FROM b JOIN m USING (file, page, y))
SELECT file, line_no, page, '{issue}-' || CASE WHEN NOT own THEN 'style' ELSE 'size' END || '-drift' AS issue, CASE WHEN own THEN mid END AS median
FROM r WHERE any_own AND len(l) > 0 AND (NOT own OR (base AND abs(size - mid) > {most}))""", lines=True)


SQL = {
    "s01_span_scan": with_spans(" SELECT file, line_no, page, x, y, w, size, color, font, text FROM (SELECT * EXCLUDE (page), CAST(coalesce(last_value(CASE WHEN line_no % 13 = 0 THEN line_no % 40 END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no), 1) AS INT) AS page FROM s) WHERE line_no % 13 <> 0"),
    "s02_first_page_scan": with_spans(", e AS (SELECT file, min(line_no) AS e FROM s WHERE line_no % 30 = 7 GROUP BY file) SELECT file, line_no FROM s LEFT JOIN e USING (file) WHERE line_no % 13 <> 0 AND line_no < coalesce(e, 1000000000000)"),
    "s08_visible_text": with_spans(" SELECT file, md5(string_agg(text, ' ' ORDER BY line_no)) AS digest FROM s WHERE line_no % 13 <> 0 GROUP BY file"),
    "p03_boxes": with_spans(" SELECT file, line_no, x + w AS right, x + w / 2 AS centre, lead(x) OVER (PARTITION BY file, page, y ORDER BY x, line_no) - (x + w) AS gap FROM s", lines=True),
    "p04_style_key": with_spans(" SELECT font, round_even(size, 2) AS size, color, CAST(sum(length(text)) AS BIGINT) AS chars FROM s GROUP BY 1, 2, 3"),
    "p05_findings": with_spans(" SELECT file, line_no, page, x, y, font, size, color, text, 'large' AS issue, printf('%.1f', size) AS detail FROM s WHERE size > 17 UNION ALL SELECT file, line_no, page, x, y, font, size, color, trim(text), 'blank', '' FROM s WHERE text = ' ,'"),
    "p10_colour_names": with_spans(", v AS (SELECT line_no, CASE WHEN line_no % 9 = 0 THEN line_no % 20 ELSE line_no * 7919 % 16777216 END AS v, greatest(0, least(255, CAST(round_even((CAST(line_no * 3 % 300 AS DOUBLE) / 256 - 0.05) * 255, 0) AS BIGINT))) AS r, greatest(0, least(255, CAST(round_even((CAST(line_no * 5 % 300 AS DOUBLE) / 256 - 0.05) * 255, 0) AS BIGINT))) AS g, greatest(0, least(255, CAST(round_even((CAST(line_no * 7 % 300 AS DOUBLE) / 256 - 0.05) * 255, 0) AS BIGINT))) AS b FROM s) SELECT line_no, 'C' || lpad(upper(to_hex(CASE WHEN v <= 15 THEN 0 ELSE v END)), 6, '0') AS name, CASE WHEN line_no % 10 > 0 THEN 'C' || lpad(upper(to_hex(r * 65536 + g * 256 + b)), 6, '0') ELSE 'black' END AS drawn FROM v"),
    "f01_footer_or_head": with_spans(f" SELECT file, line_no FROM s WHERE {_FOOT}"),
    "f02_movable": with_spans(" SELECT file, line_no FROM s WHERE color <> 'C767171' AND y BETWEEN 45 AND 760 AND trim(text) NOT IN ('', 'PullQuoteOpen', 'PullQuoteClose')"),
    "f03_question_spans": with_spans(f" SELECT file, line_no FROM s WHERE {_QUESTION}"),
    "f08_contact_text": with_spans(f" SELECT file, line_no FROM s WHERE {_CONTACT} AND NOT {_SYMBOL}"),
    "f09_marks": with_spans(f", m AS (SELECT file, line_no, {_OWN} AS own_doi, {_CITE} AS citation, regexp_matches(trim(text), '^([,.;:)]|\\\\&)$') AS token, trim(text) = '' OR regexp_matches(text, 'https?://|doi\\.org|@') AS skipped FROM s) SELECT * FROM m WHERE own_doi OR citation OR token OR skipped"),
    "f11_spacing_pairs": with_spans(_NEXT + r""", g AS (SELECT *, rtrim(text) AS l, ltrim(r_text) AS r, r_x - x - w AS gap FROM p WHERE r_line IS NOT NULL)
SELECT file, page, line_no AS "left", r_line AS "right", gap FROM g
WHERE gap BETWEEN -60 AND 120 AND color <> 'C767171' AND r_color <> 'C767171' AND y BETWEEN 60 AND 760 AND NOT contains(text || r_text, 'http') AND NOT contains(text || r_text, 'doi.org')
AND ((font <> r_font AND (contains(font, 'Italic') OR contains(r_font, 'Italic'))) OR (regexp_matches(l, '[,;:.?!]$') AND regexp_matches(r, '^[A-Za-z0-9«‘“''"]') AND NOT (regexp_matches(l, '\b[A-Z],$') AND regexp_matches(r, '^[A-Z](\b|[-,])'))))
AND l <> '' AND r <> '' AND NOT (regexp_matches(l, '[(\[{/–—-]$') OR regexp_matches(r, '^[.,;:!?)\]}/–—-]'))
AND ((regexp_matches(l, '[A-Za-z0-9)\]»''"]$') AND regexp_matches(r, '^[A-Za-z0-9«''"]')) OR (regexp_matches(l, '[,;:.?!]$') AND regexp_matches(r, '^[A-Za-z0-9«‘“''"]')))""", lines=True),
    "c01_roles": with_spans(f", r AS (SELECT file, line_no, CASE WHEN text = 'References' THEN 'stop' WHEN {_QUESTION} THEN 'question' WHEN color = 'C000000' AND contains(font, 'Cormorant') THEN 'answer' END AS role FROM s) SELECT * FROM r WHERE role IS NOT NULL"),
    "c09_title_drift": with_spans(f", m AS (SELECT *, max(size) OVER (PARTITION BY file, page, y) AS m FROM s) SELECT file, line_no, page, 'title-style-drift' AS issue FROM m WHERE page = 1 AND y BETWEEN 55 AND 175 AND m >= 14 AND NOT {_CONTACT} AND (NOT contains(font, 'Lato') OR color <> 'C000000')"),
    "c09_question_drift": _drift(f"color = 'C1F8135' AND size >= 10.5 AND NOT {_FOOT} AND NOT {_CONTACT} AND NOT {_SYMBOL}", "Lato", "question", 0.45, "true"),
    "c09_answer_drift": _drift(f"color = 'C000000' AND size >= 12 AND NOT {_FOOT} AND NOT {_CONTACT} AND NOT {_SYMBOL}", "Cormorant", "answer", 0.55, "NOT contains(font, 'Italic')"),
    "c10_opener_targets": with_spans(", o AS (SELECT file, page, line_no AS opener, x AS ox, y AS oy FROM s WHERE text = 'PullQuoteOpen'), c AS (SELECT o.file, opener, oy AS y, min(s.y) AS target FROM o JOIN s ON s.file = o.file AND s.page = o.page AND line_no > opener AND s.y BETWEEN oy - 1 AND oy + 165 AND x >= ox + 5 WHERE contains(font, 'Lato') AND size BETWEEN 13 AND 18.5 AND color IN ('C000000', 'C595959', 'C7F7F7F') AND trim(text) NOT IN ('', 'References') AND NOT contains(text, 'http') GROUP BY 1, 2, 3) SELECT * FROM c WHERE abs(target - y) > 0.5"),
    "c10_off_centre": with_spans(", m AS (SELECT file, page, y, x + w / 2 AS c, avg(x + w / 2) OVER (PARTITION BY file, page, y) AS a FROM s) SELECT file, page, y, round(max(abs(c - a)), 4) AS deviation FROM m GROUP BY 1, 2, 3 HAVING max(abs(c - a)) > 60", lines=True),
    "c11_unasked_quotes": with_spans(f", q AS (SELECT file, min(line_no) AS first FROM s WHERE {_QUESTION} GROUP BY file) SELECT s.file, line_no FROM s LEFT JOIN q USING (file) WHERE text = 'PullQuoteOpen' AND (first IS NULL OR first > line_no)"),
    "c12_font_family": with_spans(" SELECT CASE font WHEN 'FontLatoLight' THEN 'LatoLight' WHEN 'FontLatoItalic' THEN 'LatoItalic' WHEN 'FontCormorantItalic' THEN 'CormorantItalic' WHEN 'FontCormorantRegular' THEN 'CormorantRegular' ELSE 'SymbolFallback' END AS family, count(*) AS n FROM s GROUP BY 1"),
    "c15_citation_panel": with_spans(f""", c AS (SELECT file, arg_min(x, line_no) AS cx, arg_min(y, line_no) AS cy FROM s WHERE {_CITE} GROUP BY file),
w AS (SELECT file, cx, cy, coalesce(min(CASE WHEN x > cx + 235 AND y BETWEEN cy - 65 AND cy + 100 THEN x END), cx + 320) AS col FROM s JOIN c USING (file) GROUP BY 1, 2, 3),
g AS (SELECT file, cx, cy, greatest(245.0, least(col - 10, cx + 312, 520.0) - cx) AS width FROM w),
b AS (SELECT file, cx, cy, width, min(CASE WHEN (y > cy AND trim(text) = 'Abstract') OR (y > cy AND x < cx + width + 8 AND color = 'C1F8135' AND NOT {_OWN}) OR (y > cy + 20 AND y < 760 AND x < cx + width + 8 AND NOT contains(font, 'Lato') AND NOT (color = 'C767171' OR y > 760)) THEN y END) AS b FROM s JOIN g USING (file) GROUP BY 1, 2, 3, 4),
h AS (SELECT *, least(coalesce(b, cy + 124), cy + 124) AS boundary FROM b)
SELECT file, cx AS x, cy AS y, width, boundary, greatest(46.0, least(92.0, boundary - cy - 8)) AS height FROM h"""),
    "c17_quote_geometry": with_spans(" SELECT line_no, CAST(18 * (2 + CASE WHEN line_no % 2 = 0 THEN 1 ELSE 0 END) + 8 AS DOUBLE) AS height, round(CASE WHEN trim(text) IN ('PullQuoteOpen', 'PullQuoteClose') OR size >= 30 THEN 18.0 ELSE greatest(9.0, least(24.0, size * 1.22::DOUBLE)) END, 6) AS lead, 297.5::DOUBLE - w / 2 AS x FROM s"),
    "c18_line_skip": with_spans(", t AS (SELECT line_no, y, size, trim(CASE WHEN line_no % 17 = 0 THEN CAST(page AS VARCHAR) ELSE text END) AS t FROM s) SELECT line_no FROM t WHERE t = '' OR y + size < 54 OR y > 767 OR regexp_matches(t, '^\\d{1,3}$') OR contains(t, 'Cite as')"),
    "w22_shift_flow": with_spans(", f AS (SELECT line_no, (page - 1) * 842.0::DOUBLE + y - line_no % 2000 AS flow FROM s), g AS (SELECT line_no, 1 + floor(flow / 842) AS p, flow - floor(flow / 842) * 842 AS v FROM f), h AS (SELECT line_no, CASE WHEN v < 60 THEN p - 1 ELSE p END AS p, CASE WHEN v < 60 THEN v + 842 ELSE v END AS v FROM g), i AS (SELECT line_no, CASE WHEN v > 760 THEN p + 1 ELSE p END AS p, CASE WHEN v > 760 THEN v - 842 ELSE v END AS v FROM h) SELECT line_no, CAST(greatest(p, 1) AS BIGINT) AS page, CASE WHEN p < 1 THEN greatest(60.0::DOUBLE, v) ELSE v END AS y FROM i"),
    "g04_sorted_lists": with_spans(" SELECT file, page, count(*) AS n, string_agg(line_no, ',' ORDER BY y, x, line_no) AS \"order\" FROM s GROUP BY 1, 2"),
    "g09_mean_and_max": with_spans(" SELECT file, round(avg(size), 6) AS mean, max(size) AS most FROM s GROUP BY 1"),
    "g13_margins": with_spans(" SELECT file, coalesce(min(x) FILTER (WHERE color = 'C1F8135'), 70.0::DOUBLE) AS \"left\", coalesce(max(x + w) FILTER (WHERE color = 'C1F8135'), 525.0::DOUBLE) AS \"right\" FROM s GROUP BY 1"),
    "g14_first_seen": with_spans(", f AS (SELECT file, font, min(line_no) AS first FROM s GROUP BY 1, 2) SELECT file, string_agg(font, ',' ORDER BY first) AS fonts FROM f GROUP BY 1"),
    "g19_page_count": with_spans(" SELECT file, max(page) AS pages FROM s GROUP BY 1"),
    "j14_adjacent_pairs": with_spans(_NEXT + " SELECT file, page, line_no AS \"left\", r_line AS \"right\" FROM p WHERE r_line IS NOT NULL", lines=True),
    "j18_issue_ranges": with_spans(", p AS (SELECT file, max(page) AS pages, left(file, 2) AS issue FROM s GROUP BY 1) SELECT *, CAST(2 + coalesce(sum(pages) OVER (PARTITION BY issue ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_page, CAST(1 + sum(pages) OVER (PARTITION BY issue ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS last_page FROM p"),
    "j19_first_card": with_spans(" SELECT font, coalesce(max(line_no) FILTER (WHERE line_no % 1000 = 7), min(line_no)) AS card FROM s GROUP BY 1"),
    "o04_reading_order": with_spans(" SELECT file, line_no, row_number() OVER (PARTITION BY file ORDER BY page, y, x, line_no) AS ord FROM s"),
    "o08_fixpoint": with_spans(", r AS (SELECT CAST(max(size) * 2 AS BIGINT) AS v FROM s GROUP BY file, page, y), e AS (SELECT v, greatest(0, CAST(ceil((v - 20) / 5.0) AS BIGINT)) AS k FROM r) SELECT v - 5 * k AS v, count(*) AS n, (SELECT max(k) FROM e) AS steps FROM e GROUP BY 1", lines=True),
    "t31_coordinate_rewrite": with_spans(" SELECT file, line_no, " + _TEXLINE.replace("{y}", "X").replace("printf('%.2f', X)", "printf('%.3f', CAST(line_no % 700 AS DOUBLE) / 8)") + " AS line FROM s"),
    "t34_line_breaks": with_spans(" SELECT line_no, trim(text) || '|' || font AS parts, trim(regexp_replace(text || ' \\\\ \\\\' || font, '\\s*\\\\\\\\\\s*', ' ', 'g')) AS whole FROM s"),
    "t35_regions": with_spans(", m AS (SELECT *, last_value(CASE WHEN text IN ('PullQuoteOpen', 'Then it went on.') THEN text END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no) AS last, last_value(CASE WHEN text IN ('PullQuoteOpen', 'Then it went on.') THEN text END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s), k AS (SELECT file, string_agg(text, chr(10) ORDER BY line_no) FILTER (WHERE last IS DISTINCT FROM 'PullQuoteOpen' AND NOT (text = 'Then it went on.' AND before IS NOT DISTINCT FROM 'PullQuoteOpen')) AS t FROM m GROUP BY file) SELECT file, md5(CASE WHEN contains(coalesce(t, ''), 'References') THEN t ELSE 'References' || chr(10) || coalesce(t, '') END) AS digest FROM k"),
    "c09_pullquote_drift": _drift(f"color IN ('C000000', 'C595959', 'C7F7F7F') AND size BETWEEN 14.5 AND 18 AND NOT {_FOOT} AND trim(text) <> 'References'", "Lato", "pullquote", 0.45, "true"),
    "c10_overlaps": f"""WITH s AS (SELECT *, x + w AS r, y + size AS b FROM {QUOTED})
SELECT p.file, p.page, p.line_no AS a, q.line_no AS b, round(least(p.r, q.r) - greatest(p.x, q.x), 3) AS width, round(least(p.b, q.b) - greatest(p.y, q.y), 3) AS height
FROM s p JOIN s q ON p.file = q.file AND p.page = q.page AND p.line_no < q.line_no AND p.x < q.r AND q.x < p.r AND p.y < q.b AND q.y < p.b""",
    "c11_dead_space": f"""WITH s AS (SELECT *, text = 'PullQuoteOpen' AS q, color <> 'C767171' AND y BETWEEN 60 AND 760 AND trim(text) NOT IN ('', 'PullQuoteOpen', 'PullQuoteClose') AND font = 'FontCormorantRegular' AS m FROM {QUOTED}),
n AS (SELECT *, first_value(CASE WHEN m THEN page END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p FROM s)
SELECT file, line_no, round(760 - (y + 26), 3) AS dead_space FROM n WHERE q AND p > page AND 760 - (y + 26) > 95""",
    "c11_quotes_off_centre": f"SELECT file, line_no, x - (297.5 - w / 2) AS off FROM {QUOTED} WHERE text = 'PullQuoteOpen' AND abs(x - (297.5 - w / 2)) > 0.1",
    "c10_quote_frame": f"""WITH s AS (SELECT * FROM {QUOTED}),
t AS (SELECT * FROM s WHERE contains(font, 'Lato') AND size BETWEEN 13 AND 18.5 AND color IN ('C000000', 'C595959', 'C7F7F7F') AND text NOT IN ('', 'References', 'PullQuoteOpen', 'PullQuoteClose')),
o AS (SELECT file, page, line_no, x, y, lead(line_no, 1, 9000000000000000) OVER (PARTITION BY file, page ORDER BY line_no) AS nx FROM s WHERE text = 'PullQuoteOpen'),
c AS (SELECT o.file, o.line_no, arg_max(s.x, s.line_no) AS cx, arg_max(s.y, s.line_no) AS cy FROM o JOIN s ON s.file = o.file AND s.page = o.page AND s.text = 'PullQuoteClose' AND s.line_no > o.line_no AND s.line_no < nx AND s.y - o.y BETWEEN -10 AND 220 GROUP BY 1, 2),
b AS (SELECT o.file, o.line_no, t.x, t.y, t.w FROM o JOIN t ON t.file = o.file AND t.page = o.page AND t.line_no > o.line_no AND t.line_no < nx AND t.y - o.y BETWEEN -1 AND 165 AND t.x >= o.x + 5),
g AS (SELECT o.file, o.line_no, any_value(o.y) AS oy, any_value(cx) AS cx, any_value(cy) AS cy, min(b.y) AS f, max(b.y) FILTER (WHERE b.y <= cy + 1.6) AS l, max(b.x + b.w) FILTER (WHERE b.y <= cy + 1.6) AS r, avg(b.x + b.w / 2) FILTER (WHERE b.y <= cy + 1.6) AS m, max(b.x + b.w / 2) FILTER (WHERE b.y <= cy + 1.6) AS hi, min(b.x + b.w / 2) FILTER (WHERE b.y <= cy + 1.6) AS lo
  FROM o LEFT JOIN c ON c.file = o.file AND c.line_no = o.line_no LEFT JOIN b ON b.file = o.file AND b.line_no = o.line_no GROUP BY 1, 2),
u AS (SELECT file, line_no, 'no-text' AS issue, CAST(NULL AS DOUBLE) AS v FROM g WHERE f IS NULL UNION ALL SELECT file, line_no, 'opener-off', f - oy FROM g WHERE abs(f - oy) > 1.1
  UNION ALL SELECT file, line_no, 'no-closer', NULL FROM g WHERE f IS NOT NULL AND cy IS NULL UNION ALL SELECT file, line_no, 'not-enclosed', NULL FROM g WHERE f IS NOT NULL AND cy IS NOT NULL AND l IS NULL
  UNION ALL SELECT file, line_no, 'closer-off', cy - l FROM g WHERE cy < l - 1.1 OR abs(cy - l) > 1.6 UNION ALL SELECT file, line_no, 'closer-overlaps', cx - r FROM g WHERE cx < r + 1
  UNION ALL SELECT file, line_no, 'centres-drift', greatest(hi - m, m - lo) FROM g WHERE greatest(hi - m, m - lo) > 2 UNION ALL SELECT file, line_no, 'off-centre', m - 297.5 FROM g WHERE abs(m - 297.5) > 2)
SELECT file, line_no, issue, round(v, 4) AS value FROM u""",
}
SQL["c10_in_panel"] = f"""WITH pan AS ({SQL["c15_citation_panel"]}), sp AS ({with_spans(" SELECT * FROM s")})
SELECT sp.file, line_no, round(sp.x - pan.x, 3) AS dx, round(sp.y - pan.y, 3) AS dy FROM sp JOIN pan ON sp.file = pan.file WHERE sp.page = 1 AND sp.x BETWEEN pan.x AND pan.x + pan.width AND sp.y BETWEEN pan.y AND pan.y + pan.height"""
