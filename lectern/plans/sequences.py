"""Queries over ordered rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scans
from ..operators import sequence as S
from .common import EVENTS, events, table

USER, TIME = ["user_id"], ["sec", "event_id"]
DAY = 86_400


def s03_qa_units(spark, d):
    return S.qa_units(table(spark, d, "conversations"), ["conv_id"])


def w01_carry_forward(spark, d):
    e = S.carry_forward(events(spark, d), USER, TIME, F.when(F.col("event_type") == "signup", F.col("event_id")), "marker")
    return e.select("event_id", "marker")


def w02_stop_flag(spark, d):
    return S.until_stop(events(spark, d), USER, TIME, F.col("event_type") == "error").select("user_id", "event_id")


def w03_start_flag(spark, d):
    return S.from_start(events(spark, d), USER, TIME, F.col("event_type") == "click").select("user_id", "event_id")


def w04_chained_gap_groups(spark, d):
    g = S.chained_groups(events(spark, d), USER, TIME, "sec", 6 * 3600, "grp")
    return g.groupBy("user_id", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def w05_anchored_gap_groups(spark, d):
    g = S.anchored_groups(events(spark, d).select("user_id", "sec", "event_id"), USER, TIME, "sec", 6 * 3600, "grp")
    return g.groupBy("user_id", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("sec").alias("first_sec"))


def w05_one_key_groups(spark, d):
    """All events as one key."""
    e = events(spark, d).select(F.lit(0).alias("all"), "sec", (F.col("sec") * (1 << 31) + F.col("event_id")).alias("o"))
    g = scans.anchored_groups(e, ["all"], "o", "sec", 6 * 3600, "grp")
    return g.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("sec").alias("first_sec"))


def w06_role_blocks(spark, d):
    b = S.run_blocks(table(spark, d, "conversations"), ["conv_id"], "turn", "role", "text")
    return b.select("conv_id", "block", "role", "first_row", "last_row", "n_rows", F.length("text").cast("long").alias("n_chars"))


def w07_page_ranges(spark, d):
    o = table(spark, d, "orders").withColumn("pages", (F.col("o_orderkey") % 7 + 1).cast("long"))
    return S.ranges(o, ["o_custkey"], ["o_orderkey"], "pages").select("o_custkey", "o_orderkey", "range_start", "range_end")


def w08_gap_timeline(spark, d):
    t = table(spark, d, "conversations").withColumn("dur", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return S.gap_timeline(t, ["conv_id"], ["turn"], "dur", 900).select("conv_id", "turn", "start_at", "end_at", "gap")


def _timeline(spark, d):
    t = table(spark, d, "documents").select("doc_id", "source", F.regexp_count("text", F.lit("[a-z]+")).cast("long").alias("words"))
    return S.proportional_timeline(t, ["source"], "doc_id", "words", 3_600_000)


def w09_proportional_timeline(spark, d):
    return _timeline(spark, d).select("source", "doc_id", "start_at", "end_at")


def w10_rescale_timeline(spark, d):
    return S.rescale_timeline(_timeline(spark, d), ["source"], "doc_id", 1_234_567).select("source", "doc_id", "new_start", "new_end")


def w11_sliding_windows(spark, d):
    w = S.sliding_windows(events(spark, d), USER, "sec", 14 * DAY, 7 * DAY)
    return w.groupBy("user_id", "window_no", "window_start").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def w16_round_robin(spark, d):
    n = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(n, F.col("n_regionkey") == F.col("r"))
    return S.round_robin(c, ["n_regionkey"], "c_custkey", F.col("n"), "place").select("c_custkey", "n_regionkey", "place")


def w17_row_spacing(spark, d):
    r = S.spacing(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity", -20.0)
    return r.select("l_orderkey", "l_linenumber", F.round("spacing", 4).alias("spacing"))


def w18_toggle(spark, d):
    return S.toggle(events(spark, d).where("event_type = 'view'"), USER, TIME, "side").select("event_id", "side")


def w20_start_predicate_groups(spark, d):
    g = S.predicate_groups(events(spark, d), USER, TIME, F.col("event_type") == "purchase", "grp")
    return g.groupBy("user_id", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("least_event"))


QUERIES = {f.__name__: f for f in (s03_qa_units, w01_carry_forward, w02_stop_flag, w03_start_flag, w04_chained_gap_groups, w05_anchored_gap_groups, w05_one_key_groups, w06_role_blocks, w07_page_ranges, w08_gap_timeline, w09_proportional_timeline, w10_rescale_timeline, w11_sliding_windows, w16_round_robin, w17_row_spacing, w18_toggle, w20_start_predicate_groups)}

_RUN = "OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING)"
_TL = """t AS (SELECT doc_id, source, len(regexp_extract_all(text, '[a-z]+')) AS words FROM documents),
e AS (SELECT *, CASE WHEN lead(words) OVER w IS NULL THEN 3600000 ELSE CAST(round_even(3600000.0::DOUBLE * sum(words) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) / sum(words) OVER (PARTITION BY source), 0) AS BIGINT) END AS end_at FROM t WINDOW w AS (PARTITION BY source ORDER BY doc_id)),
s AS (SELECT *, lag(end_at, 1, 0) OVER (PARTITION BY source ORDER BY doc_id) AS start_at FROM e)"""
_BLOCKS = """f AS (SELECT *, CASE WHEN role IS NOT DISTINCT FROM lag(role) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS x FROM {0} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(x) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS block FROM f),
b AS (SELECT conv_id, CAST(block AS BIGINT) AS block, min(role) AS role, min(turn) AS first_row, max(turn) AS last_row, count(*) AS n_rows, coalesce(string_agg(text, ' ' ORDER BY turn), '') AS text FROM g GROUP BY conv_id, block)"""

SQL = {
    "s03_qa_units": f"""WITH t AS (SELECT * FROM conversations WHERE role IN ('user', 'assistant')), {_BLOCKS.format("t")},
u AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY block ROWS UNBOUNDED PRECEDING) AS u FROM b WHERE length(trim(text)) > 0),
q AS (SELECT conv_id, u, max(text) FILTER (WHERE role = 'user') AS question, coalesce(string_agg(text, ' ' ORDER BY block) FILTER (WHERE role = 'assistant'), '') AS answer FROM u WHERE u > 0 GROUP BY conv_id, u)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY u) AS unit, question, answer FROM q WHERE length(question) >= 20 AND length(answer) >= 20""",
    "w01_carry_forward": f"SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) {_RUN} AS marker FROM {EVENTS}",
    "w02_stop_flag": f"SELECT user_id, event_id FROM (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) {_RUN} AS s FROM {EVENTS}) WHERE s = 0",
    "w03_start_flag": f"SELECT user_id, event_id FROM (SELECT *, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) {_RUN} AS s FROM {EVENTS}) WHERE s > 0",
    "w04_chained_gap_groups": f"""WITH l AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) <= 21600 THEN 0 ELSE 1 END AS x FROM {EVENTS}),
g AS (SELECT *, CAST(sum(x) {_RUN} AS BIGINT) AS grp FROM l) SELECT user_id, grp, count(*) AS n, min(event_id) AS first_event FROM g GROUP BY 1, 2""",
    "w05_anchored_gap_groups": f"""WITH RECURSIVE o AS (SELECT user_id, sec, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS rn FROM {EVENTS}),
r AS (SELECT user_id, rn, sec AS anchor, CAST(1 AS BIGINT) AS grp, sec FROM o WHERE rn = 1
UNION ALL SELECT o.user_id, o.rn, CASE WHEN o.sec - r.anchor > 21600 THEN o.sec ELSE r.anchor END, CASE WHEN o.sec - r.anchor > 21600 THEN r.grp + 1 ELSE r.grp END, o.sec FROM r JOIN o ON o.user_id = r.user_id AND o.rn = r.rn + 1)
SELECT user_id, grp, count(*) AS n, min(sec) AS first_sec FROM r GROUP BY 1, 2""",
    "w05_one_key_groups": f"""WITH RECURSIVE e AS {EVENTS}, r AS (SELECT min(sec) AS a, CAST(1 AS BIGINT) AS g FROM e UNION ALL SELECT min(e.sec), r.g + 1 FROM r JOIN e ON e.sec > r.a + 21600 GROUP BY r.g)
SELECT g AS grp, count(*) AS n, min(sec) AS first_sec FROM (SELECT sec, g FROM e ASOF JOIN r ON e.sec >= r.a) GROUP BY g""",
    "w06_role_blocks": f"WITH {_BLOCKS.format('conversations')} SELECT conv_id, block, role, first_row, last_row, n_rows, CAST(length(text) AS BIGINT) AS n_chars FROM b",
    "w07_page_ranges": """WITH p AS (SELECT o_custkey, o_orderkey, o_orderkey % 7 + 1 AS pages FROM orders),
b AS (SELECT *, coalesce(sum(pages) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM p)
SELECT o_custkey, o_orderkey, CAST(2 + s AS BIGINT) AS range_start, CAST(2 + s + pages - 1 AS BIGINT) AS range_end FROM b""",
    "w08_gap_timeline": """WITH t AS (SELECT conv_id, turn, coalesce(length(text), 0) AS dur FROM conversations),
g AS (SELECT *, CASE WHEN lead(dur) OVER w IS NULL THEN 0 ELSE 900 END AS gap FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT *, coalesce(sum(dur + gap) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM g)
SELECT conv_id, turn, CAST(a AS BIGINT) AS start_at, CAST(a + dur AS BIGINT) AS end_at, CAST(gap AS BIGINT) AS gap FROM s""",
    "w09_proportional_timeline": f"WITH {_TL} SELECT source, doc_id, CAST(start_at AS BIGINT) AS start_at, CAST(end_at AS BIGINT) AS end_at FROM s",
    "w10_rescale_timeline": f"""WITH {_TL}, k AS (SELECT *, 1234567.0::DOUBLE / max(end_at) OVER (PARTITION BY source) AS f, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY source) AS c FROM s)
SELECT source, doc_id, CASE WHEN rn = 1 THEN 0 ELSE CAST(round_even(start_at * f, 0) AS BIGINT) END AS new_start, CASE WHEN rn = c THEN 1234567 ELSE CAST(round_even(end_at * f, 0) AS BIGINT) END AS new_end FROM k""",
    "w11_sliding_windows": f"""WITH e AS {EVENTS}, b AS (SELECT user_id, min(sec) AS lo, max(sec) AS hi FROM e GROUP BY 1),
w AS (SELECT user_id, unnest(range(0, CAST(floor((hi - lo - 1209600) / 604800.0) AS BIGINT) + 1)) AS window_no, lo FROM b WHERE hi - lo >= 1209600)
SELECT w.user_id, window_no, lo + window_no * 604800 AS window_start, count(*) AS n, min(event_id) AS first_event FROM w JOIN e ON e.user_id = w.user_id AND sec BETWEEN lo + window_no * 604800 AND lo + window_no * 604800 + 1209600 GROUP BY ALL""",
    "w16_round_robin": """SELECT c_custkey, n_regionkey, (row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey) - 1) % n AS place
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (SELECT n_regionkey AS r, count(*) AS n FROM nation GROUP BY 1) ON r = n_regionkey""",
    "w17_row_spacing": "SELECT l_orderkey, l_linenumber, round(s, 4) AS spacing FROM (SELECT *, l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS s FROM lineitem) WHERE s < -20",
    "w18_toggle": f"SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) % 2 = 1 THEN 'open' ELSE 'close' END AS side FROM {EVENTS} WHERE event_type = 'view'",
    "w20_start_predicate_groups": f"SELECT user_id, CAST(grp AS BIGINT) AS grp, count(*) AS n, min(event_id) AS least_event FROM (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) {_RUN} AS grp FROM {EVENTS}) WHERE grp > 0 GROUP BY 1, 2",
}
