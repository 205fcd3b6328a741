"""Queries that join, aggregate, select and compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import relations as R
from .common import EVENTS, events, table


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


def j01_must_match(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return R.must_match(table(spark, d, "customer"), n, "c_nationkey", "n_name").select("c_custkey", "n_name")


def j02_left_default(spark, d):
    labels = table(spark, d, "labels").withColumn("mark", F.when(F.col("quality") == 1, "good").otherwise("poor")).select("doc_id", "mark")
    return R.left_default(_docs(spark, d), labels, "doc_id", {"mark": "unknown"}).select("doc_id", "mark")


def j07_lookup_distinct(spark, d):
    keys = [table(spark, d, t).select(F.col(c).alias("doc_id")) for t, c in (("labels", "doc_id"), ("pages", "page_id"))]
    return R.lookup_distinct(keys, _docs(spark, d).select("doc_id", "source"), "doc_id")


def j09_opener_body_range(spark, d):
    r = R.range_after(events(spark, d), ["user_id"], "event_id", F.col("event_type") == "signup", "sec", 3 * 86_400)
    return r.where(F.col("sec") >= 0).select("event_id", "opener")


def j11_band_join(spark, d):
    e = events(spark, d)
    bands = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("band"), F.col("sec").alias("start"))
    return R.band_join(e.select("user_id", "event_id", "sec"), "sec", bands, "start", 86_400, ["user_id"]).groupBy("band").agg(F.count(F.lit(1)).alias("n"))


def j12_prev_next_neighbour(spark, d):
    n = R.neighbours(events(spark, d), ["user_id"], ["sec", "event_id"], F.col("event_type") == "click", "event_id")
    return n.select("event_id", "previous", "next")


def j13_isolated_islands(spark, d):
    return R.islands(events(spark, d), ["user_id"], ["sec", "event_id"], "event_type").select("event_id", "event_type", "around")


def j15_priority_alias(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"))
    return R.priority_union([c, s], "nation", "id")


def j16_semi(spark, d):
    return _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left_semi").select("doc_id", "source")


def j17_anti(spark, d):
    return _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left_anti").select("doc_id", "source")


def j21_cross_templates(spark, d):
    return R.templates(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_name", ["{} interview", "{} lecture", "talk by {}"], "query").select("n_nationkey", "query")


def j22_union_with_anti(spark, d):
    a = table(spark, d, "labels").select("doc_id", F.lit("label").alias("origin"))
    b = _docs(spark, d).select("doc_id", F.lit("document").alias("origin"))
    return R.union_with_rest(a, b, "doc_id")


def j23_sync_changes(spark, d):
    rows = _docs(spark, d).select("doc_id", "source", F.lit(1).alias("quality"))
    return R.sync(rows, table(spark, d, "labels"), "doc_id", ["quality"])


def g01_status_counts(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def g02_conditional_counts(spark, d):
    x = table(spark, d, "lineitem")
    return x.groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") > 25).alias("large"), F.count_if(F.col("l_discount") == 0).alias("full_price"), F.bool_or(F.col("l_tax") > 0.07).alias("any_high_tax"), F.every(F.col("l_quantity") > 0).alias("all_positive"))


def g05_sets_to_lists(spark, d):
    return R.sets_to_lists(_docs(spark, d), ["lang"], {"sources": "source"})


def g06_role_pivot(spark, d):
    t = R.role_lists(table(spark, d, "conversations"), ["conv_id"], "role", "turn", ["user", "assistant"], "turn")
    j = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return t.select("conv_id", j("user_list").alias("user_turns"), j("assistant_list").alias("assistant_turns"))


def g07_weighted_counter_topk(spark, d):
    return R.weighted_top(_docs(spark, d), ["lang"], "source", F.col("n_chars"), 12)


def g10_mean_deviation(spark, d):
    r = R.deviation(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return r.select("l_returnflag", "l_linestatus", F.round("mean", 6).alias("mean"), F.round("max_deviation", 6).alias("max_deviation"))


def g11_median_gap(spark, d):
    return R.median_gap(events(spark, d), ["user_id"], ["sec", "event_id"], "sec", 60, 86_400, 18.0)


def g12_upper_median(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(R.upper_median("l_quantity").alias("upper_median"))


def g15_duplicates(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    return R.duplicates(t, ["digest"], "doc_id")


def g16_unique_vs_ambiguous(spark, d):
    t = table(spark, d, "documents").select("source", F.lower(F.regexp_extract("text", "^([A-Za-z]+)", 1)).alias("pattern")).where("pattern <> ''")
    return R.unique_or_ambiguous(t, "pattern", "source")


def g18_ordinal_suffix(spark, d):
    return R.ordinal_suffix(_docs(spark, d), ["lang"], "source", "doc_id", "slug").select("doc_id", "slug")


def w12_top1_first_max(spark, d):
    return R.pick(_docs(spark, d), ["source"], [F.col("n_chars").desc(), F.col("doc_id")]).select("source", "doc_id", "n_chars")


def w13_last_row(spark, d):
    return R.pick(events(spark, d), ["user_id", "event_type"], [F.col("sec").desc(), F.col("event_id").desc()]).select("user_id", "event_type", "event_id")


def w14_first_row(spark, d):
    return R.pick(events(spark, d), ["user_id", "event_type"], [F.col("sec"), F.col("event_id")]).select("user_id", "event_type", "event_id")


def w15_rank_in_query(spark, d):
    return R.pick(_docs(spark, d), ["lang"], [F.col("n_chars").desc(), F.col("doc_id")], 10, "place").select("lang", "place", "doc_id")


def o01_multi_sort_topn(spark, d):
    return R.queue(table(spark, d, "part").select("p_brand", "p_retailprice", "p_partkey"), [F.col("p_brand"), F.col("p_retailprice").desc(), F.col("p_partkey")], 50)


def o03_offset_limit(spark, d):
    return R.queue(table(spark, d, "supplier").select("s_suppkey", "s_name"), [F.col("s_suppkey")], 20, 10)


def e01_two_way_difference(spark, d):
    a = table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return R.two_way_difference(a, table(spark, d, "pages").select(F.col("page_id").alias("id")), "id")


def e05_subset(spark, d):
    sets = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    allowed = F.array(*[F.lit(x) for x in ("view", "click", "signup", "purchase")])
    return sets.select("user_id", (F.size(F.array_except("kinds", allowed)) == 0).alias("within"))


def e06_ordered_intersection(spark, d):
    sets = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    return sets.select("user_id", F.array_join(F.array_intersect("kinds", F.array(F.lit("purchase"), F.lit("error"))), ";").alias("blocking"))


def f12_id_ranges(spark, d):
    wanted = spark.range(1).select(F.explode(X.id_ranges(F.lit("1, 3-7, 40-60, 5"))).alias("doc_id"))
    return _docs(spark, d).join(wanted, "doc_id", "left_semi").select("doc_id", "source")


QUERIES = {f.__name__: f for f in (j01_must_match, j02_left_default, j07_lookup_distinct, j09_opener_body_range, j11_band_join, j12_prev_next_neighbour, j13_isolated_islands, j15_priority_alias, j16_semi, j17_anti, j21_cross_templates, j22_union_with_anti, j23_sync_changes, g01_status_counts, g02_conditional_counts, g05_sets_to_lists, g06_role_pivot, g07_weighted_counter_topk, g10_mean_deviation, g11_median_gap, g12_upper_median, g15_duplicates, g16_unique_vs_ambiguous, g18_ordinal_suffix, w12_top1_first_max, w13_last_row, w14_first_row, w15_rank_in_query, o01_multi_sort_topn, o03_offset_limit, e01_two_way_difference, e05_subset, e06_ordered_intersection, f12_id_ranges)}

_W = "PARTITION BY user_id ORDER BY sec, event_id"

SQL = {
    "j01_must_match": "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "j02_left_default": "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unknown' WHEN quality = 1 THEN 'good' ELSE 'poor' END AS mark FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "j07_lookup_distinct": "SELECT k.doc_id, d.source FROM (SELECT doc_id FROM labels UNION SELECT page_id FROM pages) k LEFT JOIN documents d ON d.doc_id = k.doc_id",
    "j09_opener_body_range": f"""WITH e AS {EVENTS}, o AS (SELECT *, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS opener, last_value(CASE WHEN event_type = 'signup' THEN sec END IGNORE NULLS) OVER w AS since
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) SELECT event_id, opener FROM o WHERE event_type <> 'signup' AND opener IS NOT NULL AND sec - since <= 259200 AND sec >= 0""",
    "j11_band_join": f"WITH e AS {EVENTS} SELECT b.event_id AS band, count(*) AS n FROM e b JOIN e p ON p.user_id = b.user_id AND p.sec BETWEEN b.sec AND b.sec + 86400 WHERE b.event_type = 'purchase' GROUP BY 1",
    "j12_prev_next_neighbour": f"""WITH e AS {EVENTS} SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous,
first_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM e""",
    "j13_isolated_islands": f"WITH e AS {EVENTS}, n AS (SELECT event_id, event_type, lag(event_type) OVER w AS b, lead(event_type) OVER w AS a FROM e WINDOW w AS ({_W})) SELECT event_id, event_type, b AS around FROM n WHERE a = b AND event_type <> b",
    "j15_priority_alias": """WITH u AS (SELECT c_nationkey AS nation, c_custkey AS id, 'customer' AS kind, 0 AS p FROM customer UNION ALL SELECT s_nationkey, s_suppkey, 'supplier', 1 FROM supplier)
SELECT nation, id, kind FROM u QUALIFY row_number() OVER (PARTITION BY nation ORDER BY p, id DESC) = 1""",
    "j16_semi": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "j17_anti": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "j21_cross_templates": "SELECT n_nationkey, replace(t, '{}', n_name) AS query FROM nation, (VALUES ('{} interview'), ('{} lecture'), ('talk by {}')) v(t)",
    "j22_union_with_anti": "SELECT doc_id, 'label' AS origin FROM labels UNION ALL SELECT doc_id, 'document' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "j23_sync_changes": "SELECT d.doc_id, d.source, coalesce(l.quality, 1) AS quality, coalesce(l.quality, 1) <> 1 AS changed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "g01_status_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2",
    "g02_conditional_counts": "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_discount = 0) AS full_price, bool_or(l_tax > 0.07) AS any_high_tax, bool_and(l_quantity > 0) AS all_positive FROM lineitem GROUP BY 1",
    "g05_sets_to_lists": "SELECT lang, string_agg(DISTINCT source, ';' ORDER BY source) AS sources FROM documents GROUP BY 1",
    "g06_role_pivot": "SELECT conv_id, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (WHERE role = 'user'), '') AS user_turns, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS assistant_turns FROM conversations GROUP BY 1",
    "g07_weighted_counter_topk": "WITH s AS (SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS weight FROM documents GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, source) AS place FROM s QUALIFY place <= 12",
    "g10_mean_deviation": "SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS mean, round(greatest(max(l_quantity) - avg(l_quantity), avg(l_quantity) - min(l_quantity)), 6) AS max_deviation FROM lineitem GROUP BY 1, 2",
    "g11_median_gap": f"WITH g AS (SELECT user_id, sec - lag(sec) OVER ({_W}) AS g FROM {EVENTS}) SELECT user_id, CAST(coalesce(median(g) FILTER (WHERE g BETWEEN 60 AND 86400), 18.0) AS DOUBLE) AS median_gap FROM g GROUP BY 1",
    "g12_upper_median": "SELECT l_orderkey, list_sort(list(l_quantity))[len(list(l_quantity)) // 2 + 1] AS upper_median FROM lineitem GROUP BY 1",
    "g15_duplicates": "SELECT md5(coalesce(text, '')) AS digest, count(*) AS n, min(doc_id) AS first_value FROM documents GROUP BY 1 HAVING count(*) > 1",
    "g16_unique_vs_ambiguous": "WITH t AS (SELECT source, lower(regexp_extract(text, '^([A-Za-z]+)', 1)) AS pattern FROM documents) SELECT pattern, count(DISTINCT source) AS targets, min(source) AS least_target, CASE WHEN count(DISTINCT source) = 1 THEN 'unique' ELSE 'ambiguous' END AS kind FROM t WHERE pattern <> '' GROUP BY 1",
    "g18_ordinal_suffix": "SELECT doc_id, CASE WHEN n = 1 THEN source ELSE source || '-' || n END AS slug FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS n FROM documents)",
    "w12_top1_first_max": "SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1",
    "w13_last_row": f"SELECT user_id, event_type, event_id FROM {EVENTS} QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY sec DESC, event_id DESC) = 1",
    "w14_first_row": f"SELECT user_id, event_type, event_id FROM {EVENTS} QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY sec, event_id) = 1",
    "w15_rank_in_query": "SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS place, doc_id FROM documents QUALIFY place <= 10",
    "o01_multi_sort_topn": "SELECT p_brand, p_retailprice, p_partkey FROM part ORDER BY p_brand, p_retailprice DESC, p_partkey LIMIT 50",
    "o03_offset_limit": "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 20 OFFSET 10",
    "e01_two_way_difference": "SELECT DISTINCT doc_id AS id, 'left' AS side FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages) UNION ALL SELECT DISTINCT page_id, 'right' FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)",
    "e05_subset": "SELECT user_id, bool_and(event_type IN ('view', 'click', 'signup', 'purchase')) AS within FROM events GROUP BY 1",
    "e06_ordered_intersection": "SELECT user_id, coalesce(string_agg(DISTINCT event_type, ';' ORDER BY event_type) FILTER (WHERE event_type IN ('purchase', 'error')), '') AS blocking FROM events GROUP BY 1",
    "f12_id_ranges": "SELECT doc_id, source FROM documents WHERE doc_id = 1 OR doc_id BETWEEN 3 AND 7 OR doc_id BETWEEN 40 AND 60",
}
