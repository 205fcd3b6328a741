"""Queries that write tables with a sink and read them back, formats of lists and chapters, and repairs of text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import python as P
from ..functions import text as X
from ..operators import sequence as S
from ..operators.cutting import shared_folder
from ..sources import readers, sinks
from .common import table


def _folder(spark, name):
    return f"{shared_folder(spark)}/lectern/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _customers(spark, d):
    """With marks that a format has to keep."""
    n = F.col("c_custkey")
    return table(spark, d, "customer").select(n.cast("string").alias("key"), F.concat(F.lit('a "b", '), F.col("c_name"), F.when(n % 3 == 0, "\nnext").otherwise("")).alias("name"), F.when(n % 4 > 0, F.col("c_mktsegment")).alias("segment"), F.lit("left out").alias("more"))


def k01_csv_round_trip(spark, d):
    path = _folder(spark, "csv")
    sinks.csv(_customers(spark, d), path, ["key", "name", "segment"])
    return readers.csv(spark, path, ["key", "name", "segment"])


def k02_append_log(spark, d):
    """Two appends of rows that overlap: each key stays as it was first written."""
    path, rows = _folder(spark, "log"), _customers(spark, d)
    sinks.append_log(rows.where("key % 2 = 0").withColumn("name", F.lit("first")), path, ["key", "name"], ["key"])
    sinks.append_log(rows.withColumn("name", F.lit("second")), path, ["key", "name"], ["key"])
    return readers.csv(spark, path, ["key", "name"])


def k03_union_of_keys(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("b"))
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("a"))
    return sinks.union_of_keys([n, r])


def k06_text_per_source(spark, d):
    path = _folder(spark, "text")
    sinks.text_per_key(table(spark, d, "documents").where("text is not null").select("source", F.translate("text", "\n\r", "  ").alias("text")), path, ["source"], "text")
    return spark.read.text(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).cast("long").alias("chars"))


def _timeline(spark, d):
    t = table(spark, d, "conversations").withColumn("dur", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    rows = S.gap_timeline(t, ["conv_id"], ["turn"], "dur", 900)
    return rows.select("conv_id", "turn", "start_at", "end_at", F.concat("role", F.lit(" #"), F.col("turn").cast("string"), F.lit("; a=b")).alias("title"), F.concat(F.lit("it's "), F.col("turn").cast("string"), F.lit(".wav")).alias("file"))


def k09_concat_list(spark, d):
    return sinks.concat_list(_timeline(spark, d), ["conv_id"], "turn", "file")


def k09_chapters(spark, d):
    return sinks.chapters(_timeline(spark, d), ["conv_id"])


def k09_chapter_table(spark, d):
    return sinks.chapters_csv(_timeline(spark, d), ["conv_id"], "turn").select("conv_id", F.col("chapter").cast("long").alias("chapter"), "start_ms", "end_ms", "duration_ms", "post_chapter_gap_ms", "title")


def k10_html_index(spark, d):
    return sinks.html_index(_timeline(spark, d), ["conv_id"], "turn", "file", "title")


def s15_captions(spark, d):
    """Each turn as a cue with a word of its own time."""
    at = F.format_string("%02d:%02d", F.floor(F.col("turn") / 60).cast("int"), (F.col("turn") % 60).cast("int"))
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("file"), "turn", F.posexplode(F.array(F.concat(at, F.lit(".000 --> 99:00.000")), F.concat(F.lit("<c>"), F.col("role"), F.lit("</c> said <00:"), at, F.lit(".500><c>it</c>")))).alias("i", "line"))
    return readers.captions(rows.select("file", (F.col("turn") * 2 + F.col("i")).alias("line_no"), "line")).select("file", "start", "word")


def t33_captions_clean(spark, d):
    return table(spark, d, "customer").select("c_custkey", P.caption_text(F.concat(F.lit("<c.x>"), "c_name", F.lit("</c> &amp;  [Music] &lt;"), "c_mktsegment")).alias("text"))


def t10_mojibake(spark, d):
    return table(spark, d, "customer").select("c_custkey", P.repair_mojibake(F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, "nÃ© â€“ Ã¼").otherwise("né – ü"))).alias("text"))


def t04_unhyphenated(spark, d):
    return table(spark, d, "customer").select("c_custkey", P.unhyphenated(F.concat(F.lit("exam-\n ple so­ft é well-known A-\nB "), "c_name")).alias("text"))


def t23_joined_tokens(spark, d):
    words = F.split("p_name", " ")
    return table(spark, d, "part").select("p_partkey", X.join_tokens(F.concat(words, F.array(F.lit(","), F.lit("("), F.col("p_brand"), F.lit(")"), F.lit(".")))).alias("text"))


QUERIES = {f.__name__: f for f in (k01_csv_round_trip, k02_append_log, k03_union_of_keys, k06_text_per_source, k09_concat_list, k09_chapters, k09_chapter_table, k10_html_index, s15_captions, t33_captions_clean, t10_mojibake, t04_unhyphenated, t23_joined_tokens)}

_CUSTOMERS = """(SELECT CAST(c_custkey AS VARCHAR) AS key, 'a "b", ' || c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || 'next' ELSE '' END AS name, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE '' END AS segment, c_custkey FROM customer)"""
_TIMELINE = """WITH t AS (SELECT conv_id, turn, role, coalesce(length(text), 0) AS dur FROM conversations), g AS (SELECT *, CASE WHEN lead(dur) OVER w IS NULL THEN 0 ELSE 900 END AS gap FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
h AS (SELECT *, CAST(coalesce(sum(dur + gap) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a FROM g),
l AS (SELECT conv_id, turn, a, CAST(a + dur AS BIGINT) AS z, CAST(dur AS BIGINT) AS dur, gap, role || ' #' || turn || '; a=b' AS title, 'it' || chr(39) || 's ' || turn || '.wav' AS file FROM h)"""

SQL = {
    "k01_csv_round_trip": f"SELECT key, name, segment FROM {_CUSTOMERS}",
    "k02_append_log": f"SELECT key, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS name FROM {_CUSTOMERS}",
    "k03_union_of_keys": "SELECT NULL AS a, n_name AS b, n_nationkey AS key FROM nation UNION ALL SELECT r_name, NULL, r_regionkey FROM region",
    "k06_text_per_source": "SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents WHERE text IS NOT NULL GROUP BY source",
    "k09_concat_list": _TIMELINE + " SELECT conv_id, string_agg('file ' || chr(39) || 'it' || chr(39) || '\\' || chr(39) || chr(39) || 's ' || turn || '.wav' || chr(39), chr(10) ORDER BY turn) || chr(10) AS value FROM l GROUP BY 1",
    "k09_chapters": _TIMELINE + " SELECT conv_id, ';FFMETADATA1' || chr(10) || string_agg('[CHAPTER]' || chr(10) || 'TIMEBASE=1/1000' || chr(10) || 'START=' || a || chr(10) || 'END=' || z || chr(10) || 'title=' || replace(replace(replace(title, '#', '\\#'), ';', '\\;'), '=', '\\='), chr(10) ORDER BY a, title) || chr(10) AS value FROM l GROUP BY 1",
    "k09_chapter_table": _TIMELINE + " SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS chapter, a AS start_ms, z AS end_ms, dur AS duration_ms, CAST(gap AS BIGINT) AS post_chapter_gap_ms, title FROM l",
    "k10_html_index": _TIMELINE + """ SELECT conv_id, '<ul>' || chr(10) || string_agg('<li><a href="' || file || '">' || title || '</a></li>', chr(10) ORDER BY turn) || chr(10) || '</ul>' || chr(10) AS value FROM l GROUP BY 1""",
    "s15_captions": "SELECT DISTINCT conv_id AS file, turn + CASE WHEN w = 2 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS start, CASE w WHEN 0 THEN role WHEN 1 THEN 'said' ELSE 'it' END AS word FROM conversations, range(3) r(w)",
    "t33_captions_clean": "SELECT c_custkey, c_name || ' & <' || c_mktsegment AS text FROM customer",
    "t10_mojibake": "SELECT c_custkey, c_name || 'né – ü' AS text FROM customer",
    "t04_unhyphenated": "SELECT c_custkey, 'example soft é well-known A-' || chr(10) || 'B ' || c_name AS text FROM customer",
    "t23_joined_tokens": "SELECT p_partkey, p_name || ', (' || p_brand || ').' AS text FROM part",
}
