"""Spans, records and plans derived from the test tables by expressions that Spark and the oracle read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table

_ONE = {
    "line_no": "o_orderkey",
    "file": "concat('d', CAST(floor(o_custkey / 8) AS BIGINT))",
    "page": "CAST(1 + floor((o_orderkey % 100) / 20) AS BIGINT)",
    "x": "CAST(60 + (o_orderkey % 8) * 25 AS DOUBLE)",
    "y": "CAST(20 + CAST(floor(o_totalprice) AS BIGINT) % 780 AS DOUBLE)",
    "row_y": "CAST(60 + 20 * (o_orderkey % 7) AS DOUBLE)",
    "w": "CAST(20 + o_orderkey % 90 AS DOUBLE)",
    "size": "CAST(o_orderkey % 21 AS DOUBLE) / 2 + 8",
    "color": "CASE o_orderstatus WHEN 'F' THEN 'C000000' WHEN 'O' THEN 'C1F8135' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'C767171' ELSE 'C595959' END END",
    "font": "CASE o_orderpriority WHEN '1-URGENT' THEN 'FontLatoLight' WHEN '2-HIGH' THEN 'FontLatoItalic' WHEN '3-MEDIUM' THEN 'FontCormorantRegular' WHEN '4-NOT SPECIFIED' THEN 'FontCormorantItalic' ELSE 'FontSymbolFallback' END",
    "nm": "split_part('Olsen,Meyer,Duarte,Haas,Novak,Lindqvist,Ferrari,Okafor', ',', CAST(1 + o_custkey % 8 AS INT))",
    "nn": "split_part('Brandt,Castro,Dahl,Egger,Fontana', ',', CAST(1 + o_orderkey % 5 AS INT))",
    "yr": "1990 + o_orderkey % 4",
}
_TEXT = """CASE CAST(o_orderkey % 12 AS INT)
 WHEN 0 THEN concat('as ', nm, ', ', yr, ' said, and ', nm, ' and ', nn, ' (', yr, ') too')
 WHEN 1 THEN concat(nm, ', A. (', yr, '). Title of ', o_orderkey, '.')
 WHEN 2 THEN CASE WHEN o_orderkey % 24 = 2 THEN 'References' ELSE 'See https://doi.org/10.5281/zenodo.77. It holds' END
 WHEN 3 THEN concat('doi: 10.1234/abc.', o_orderkey % 50, '.')
 WHEN 4 THEN concat('(https://doi.org/10.5555/', o_orderkey % 40, '-)')
 WHEN 5 THEN 'PullQuoteOpen'
 WHEN 6 THEN 'Cite as: this work'
 WHEN 7 THEN concat('words, of ', nn, ' et al. (', yr, ')')
 WHEN 8 THEN ' ,'
 WHEN 9 THEN concat(nm, ', B., & ', nn, ', C. (', yr, '). Work.')
 WHEN 10 THEN 'mail me@site.org' ELSE 'Then it went on.' END"""
SPAN_COLUMNS = ["file", "line_no", "page", "x", "y", "row_y", "w", "size", "color", "font", "text"]
_INNER = ", ".join(f"{e} AS {c}" for c, e in _ONE.items()) + ", o_orderkey"
#: The spans in SQL; row_y is the y of few lines, on which many spans stand.
SPANS = f"(SELECT {', '.join(c for c in SPAN_COLUMNS if c != 'text')}, {_TEXT} AS text FROM (SELECT {_INNER} FROM orders))"


def spans(spark: SparkSession, d: str, lines: bool = False) -> DataFrame:
    """The same in Spark; lines: with row_y as y."""
    rows = table(spark, d, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _ONE.items()], "o_orderkey")
    rows = rows.selectExpr(*[c for c in SPAN_COLUMNS if c != "text"], f"{_TEXT} AS text")
    return rows.drop("y").withColumnRenamed("row_y", "y") if lines else rows.drop("row_y")


def with_spans(body: str, lines: bool = False) -> str:
    """SQL with the spans as s."""
    y = "row_y AS y" if lines else "y"
    return f"WITH s AS (SELECT file, line_no, page, x, {y}, w, size, color, font, text FROM {SPANS})" + body


# --- pages with pull quotes: an order's lines are a block, and each order gives a line of other text

_LINES = "(SELECT l_orderkey AS k, l_linenumber AS n, max(l_quantity) AS q, max(l_partkey) AS p, 60 + (l_orderkey % 40) * 17 + 17 * l_linenumber AS y0, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS a, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS z FROM lineitem GROUP BY l_orderkey, l_linenumber)"
_QUOTES = f"""SELECT concat('q', CAST(floor(k / 400) AS BIGINT)) AS file, CAST(k * 8 + n AS BIGINT) AS line_no,
 CAST(1 + floor((k % 400) / 40) + CASE WHEN y0 > 770 THEN 1 ELSE 0 END AS BIGINT) AS page,
 CAST(CASE WHEN n = a THEN 90 WHEN n = z THEN 420 ELSE 100 + p % 120 END AS DOUBLE) AS x,
 CAST(y0 - CASE WHEN y0 > 770 THEN 700 ELSE 0 END AS DOUBLE) + CAST(q AS BIGINT) % 3 * CAST(0.5 AS DOUBLE) AS y, CAST(40 + p % 200 AS DOUBLE) AS w,
 CAST(13.5 AS DOUBLE) + p % 9 * CAST(0.5 AS DOUBLE) AS size, CASE WHEN p % 4 = 1 THEN 'C595959' WHEN p % 4 = 2 THEN 'C7F7F7F' ELSE 'C000000' END AS color,
 CASE WHEN p % 11 = 0 THEN 'FontCormorantRegular' ELSE 'FontLatoLight' END AS font,
 CASE WHEN n = a THEN 'PullQuoteOpen' WHEN n = z AND k % 5 > 0 THEN 'PullQuoteClose' ELSE concat('words ', p % 100) END AS text FROM {_LINES}"""
_OTHERS = """SELECT concat('q', CAST(floor(o_orderkey / 400) AS BIGINT)) AS file, CAST(o_orderkey * 8 AS BIGINT) AS line_no, CAST(1 + floor((o_orderkey % 400) / 40) AS BIGINT) AS page,
 CAST(70 AS DOUBLE) AS x, CAST(62 + o_orderkey * 37 % 690 AS DOUBLE) AS y, CAST(300 AS DOUBLE) AS w, CAST(12 AS DOUBLE) AS size, CASE WHEN o_orderkey % 9 = 0 THEN 'C767171' ELSE 'C000000' END AS color, CASE WHEN o_orderkey % 40 = 0 THEN 'FontCormorantRegular' ELSE 'FontCormorantItalic' END AS font, 'Then it went on.' AS text FROM orders"""
QUOTED = f"(SELECT * FROM ({_QUOTES}) UNION ALL SELECT * FROM ({_OTHERS}))"


def quoted(spark: SparkSession, d: str) -> DataFrame:
    """The same in Spark."""
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    lines = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey").repartition("l_orderkey")  # once, for lines and their windows
    return spark.sql(QUOTED.replace("FROM lineitem", "FROM {lineitem}").replace("FROM orders", "FROM {orders}").removeprefix("(").removesuffix(")"), lineitem=lines, orders=orders)
