"""Queries of text functions, scores and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import python as P
from ..functions import speech, tex
from ..functions import text as X
from ..operators import matching, scans
from ..operators import score as C
from .common import events, table


def _docs(spark, d):
    return table(spark, d, "documents")


def t01_collapse(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(X.collapse(F.col("text"))).alias("digest"))


def t02_normalize(spark, d):
    t = table(spark, d, "part")
    return t.select("p_partkey", X.normalize(F.concat_ws(" / ", "p_name", "p_type")).alias("name"))


def t05_slug(spark, d):
    return table(spark, d, "part").select("p_partkey", X.slug(F.concat_ws(" & ", "p_name", "p_brand")).alias("slug"), X.slug(F.col("p_type"), "-").alias("dashed"))


def t09_replace_chain(spark, d):
    pairs = [("the", "THE"), ("THE ", "<the> "), ("&", " and "), ("\n", " / ")]
    return _docs(spark, d).select("doc_id", F.md5(X.replace_all(F.col("text"), pairs)).alias("digest"))


def t12_sentence_chunks(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(X.sentence_chunks(F.col("text"), 200)).alias("no", "chunk"))


def t13_word_chunks(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(X.word_chunks(F.col("text"), 120)).alias("no", "chunk"))


def t17_url_tokens(spark, d):
    t = table(spark, d, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))).alias("href"))
    return t.groupBy("href").agg(F.count(F.lit(1)).alias("pages"), F.min("page_id").alias("first_page"))


def t18_id_from_url(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", F.coalesce(X.first_match(u, [r"[?&]page=(\d+)", r"/(\d+)\.html", r"/(\d+)"]), F.lit("")).alias("id"))


def t18_video_id(spark, d):
    k = F.format_string("vid_%06d", F.col("page_id"))
    kind = F.col("page_id") % 4
    url = F.when(kind == 0, F.concat(F.lit("https://v.org/watch?list=x&v="), k, F.lit("&t=3"))).when(kind == 1, F.concat(F.lit("https://youtu.be/"), k, F.lit("?si=a"))).when(kind == 2, F.concat(F.lit("https://v.org/shorts/"), k)).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", F.coalesce(X.video_id(url), F.lit("")).alias("id"))


def t27_escapes(spark, d):
    """Documents escaped for each format that isn't HTML."""
    forms = {"tex": X.escape_tex, "meta": X.escape_ffmetadata, "listed": X.escape_concat, "quoted": X.escape_quoted}
    return _docs(spark, d).select("doc_id", *[F.md5(f(F.col("text"))).alias(n) for n, f in forms.items()])


def t29_speaker_segments(spark, d):
    t = table(spark, d, "part").select("p_partkey", F.concat(F.col("p_name"), F.lit(". A.B. Olsen: "), F.col("p_brand"), F.lit(", said A. C. Meyer-Li: "), F.col("p_type")).alias("text"))
    return t.select("p_partkey", F.posexplode(X.speaker_segments(F.col("text")))).select("p_partkey", F.col("pos").cast("long").alias("pos"), "col.speaker", "col.text")


def t30_aliases(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.array_join(X.aliases(F.concat(F.lit("Ana Bo "), F.col("c_mktsegment"))), "|").alias("names"))


def t20_year(spark, d):
    t = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("Key "), F.col("o_orderkey") % 3000, F.when(F.col("o_orderkey") % 2 == 0, " (1998b)").otherwise("")).alias("text"))
    return t.select("o_orderkey", X.year(F.col("text")).alias("year"))


def t24_word_count(spark, d):
    return _docs(spark, d).groupBy("source").agg(F.sum(X.word_count(F.col("text"))).alias("words"))


def t25_truncate(spark, d):
    return _docs(spark, d).select("doc_id", X.truncate(F.replace("text", F.lit("\n"), F.lit(" ")), 60).alias("short"))


def t26_ascii_fold(spark, d):
    return _docs(spark, d).select("doc_id", F.length(X.ascii_only(F.col("text"))).cast("long").alias("n"))


def t27_escape_html(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(X.escape_html(F.col("text"))).alias("digest"))


def t36_split_list(spark, d):
    t = table(spark, d, "nation").select("n_nationkey", F.concat(F.col("n_name"), F.lit(";;"), F.col("n_regionkey").cast("string"), F.lit(";")).alias("flags"))
    return t.select("n_nationkey", F.array_join(X.split_list(F.col("flags")), "|").alias("items"), F.size(X.split_list(F.col("flags"))).cast("long").alias("n"))


def f16_codepoint_filter(spark, d):
    t = _docs(spark, d).select("doc_id", F.array_join(X.odd_characters(F.col("text"), r"À-ÿ"), "").alias("odd"))
    return t.where("odd <> ''")


def f17_bad_patterns(spark, d):
    t = _docs(spark, d).select("doc_id", F.array_join(X.found_patterns(F.col("text"), ["***", "&&&", "$$$", "%%%", " | "]), ",").alias("bad"))
    return t.where("bad <> ''")


def m02_timecodes(spark, d):
    e = events(spark, d).select("event_id", F.format_string("%02d:%02d:%02d.%03d", F.floor(F.col("sec") % 86400 / 3600).cast("int"), F.floor(F.col("sec") % 3600 / 60).cast("int"), (F.col("sec") % 60).cast("int"), (F.col("event_id") % 1000).cast("int")).alias("code"))
    return e.select("event_id", F.round(X.seconds(F.col("code")), 3).alias("seconds"))


def m04_safe_number(spark, d):
    return table(spark, d, "events").select("event_id", X.number(F.get_json_object("props", "$.k")).alias("number"))


def c02_candidate_score(spark, d):
    t = _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    rules = [(F.col("lang") == "en", 35), (F.col("quality") == 1, 70), (F.col("n_chars").between(500, 5000), 25), (F.col("toxic") == 1, -30), (F.col("n_chars") < 100, -100)]
    s = C.points(rules)
    why = C.notes([(F.col("quality") == 1, "quality"), (F.col("toxic") == 1, "toxic"), (F.col("n_chars") < 100, "short")])
    return t.select("doc_id", s.alias("score"), C.decision(s, [(85, "strong"), (55, "review")], "weak").alias("decision"), why.alias("notes"))


def c03_window_score(spark, d):
    w = F.regexp_count("text", F.lit("[A-Za-z]+"))
    s = C.points([(F.lit(True), 100), (w < 25, -40), (w > 400, -20), (F.col("text").contains("["), -15), (~F.col("text").rlike(r"[.!?]$"), -10)], low=0)
    return _docs(spark, d).select("doc_id", s.alias("score"))


def c04_gate(spark, d):
    t = _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    flags = F.array_compact(F.array(F.when(F.col("quality").isNull(), "unlabelled"), F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 0, "poor"), F.when(F.col("n_chars") > 20000, "long")))
    return t.select("doc_id", F.array_join(flags, ";").alias("flags"), C.gate(flags, ["toxic", "poor"]).alias("gate"))


def c05_first_failure(spark, d):
    t = _docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    checks = [(F.col("quality").isNull(), "missing_label"), (F.col("quality") == 0, "poor_quality"), (F.col("toxic") == 1, "toxic"), (F.col("n_chars") < 200, "too_short")]
    return t.select("doc_id", C.first_failure(checks).alias("status"))


def c06_pace(spark, d):
    t = table(spark, d, "conversations").groupBy("conv_id").agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))).cast("long").alias("words"), F.count(F.lit(1)).alias("turns"))
    wpm, status = C.pace(F.col("words"), F.col("turns") * 30.0, 125, 165)
    return t.select("conv_id", "words", F.round(wpm, 3).alias("wpm"), status.alias("status"))


def c13_clip_start(spark, d):
    e = table(spark, d, "events").select("event_id", "value", "event_type")
    share = F.when(F.col("event_type") == "view", 0.25).otherwise(0.18)
    return e.select("event_id", F.round(C.clamp(F.col("value") * share, 5.0, 90.0), 4).alias("start"))


def t03_accent_fold(spark, d):
    return _docs(spark, d).select("doc_id", P.accent_fold("text").alias("text")).select("doc_id", F.md5("text").alias("digest"))


def _pairs(spark, d):
    """Each benchmark item with the next: candidates come from the order of a small table, not from all pairs."""
    w = Window.orderBy("item_id")
    t = table(spark, d, "benchmark").select(F.col("item_id").alias("left_id"), F.col("text").alias("x"), F.lead("item_id").over(w).alias("right_id"), F.lead("text").over(w).alias("y"))
    return t.where("right_id is not null")


def t14_similarity(spark, d):
    return _pairs(spark, d).select("left_id", "right_id", F.round(P.similarity(False)("x", "y"), 6).alias("ratio"))


def t15_diff_chunks(spark, d):
    return _pairs(spark, d).select("left_id", "right_id", P.diff_chunks()("x", "y").alias("chunks"))


def _phrases(spark, d):
    """Of each benchmark item its first two and three words, and its fourth and fifth, as patterns of one key."""
    t = table(spark, d, "benchmark").select("item_id", F.split("text", " ").alias("w"))
    some = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    ps = F.filter(F.array(some(1, 2), some(1, 3), some(4, 2)), lambda p: p != "")
    return t.select(F.lit("all").alias("key"), F.explode(ps).alias("pattern"), F.col("item_id").cast("string").alias("value"))


def _phrases_found(spark, d):
    return matching.occurrences(_docs(spark, d).select("doc_id", F.lit("all").alias("key"), "text"), _phrases(spark, d), "key", "doc_id")


def j08_phrases_in_texts(spark, d):
    """Whole documents and all phrases as one automaton: how many phrases each holds, and where the first stands."""
    return _phrases_found(spark, d).select("doc_id", F.size(F.array_distinct(F.transform("found", lambda f: f["pattern"]))).cast("long").alias("n_patterns"), F.get("found", F.lit(0))["first"].cast("long").alias("first"))


def o06_greedy_intervals(spark, d):
    return _phrases_found(spark, d).select("doc_id", F.to_json(P.greedy_spans("found")).alias("links"))


def o09_line_breaks(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.array_join(P.line_breaks(3)("text"), "\n").alias("lines"))


def j10_one_to_one(spark, d):
    e = events(spark, d).where("event_type in ('signup', 'purchase')")
    e = e.select("user_id", F.struct("sec", "event_id").alias("_o"), "event_id", "sec", F.when(F.col("event_type") == "signup", "open").otherwise("close").alias("side"))
    return P.one_to_one(e.select("user_id", "event_id", "sec", "side"), ["user_id"], "event_id", "side", "sec", 86_400)


def w21_flow_layout(spark, d):
    t = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("lead"))
    return scans.flow_layout(t.withColumn("y", F.col("l_linenumber") * 10.0), ["l_orderkey"], "l_linenumber", "y", "lead", 0.0, 120.0).select("l_orderkey", "l_linenumber", "new_page", "new_y")


def w21_one_flow(spark, d):
    """All lines of all orders as one text, one below the other."""
    t = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 90 + 10).cast("double").alias("lead"), ((F.col("o_orderkey") % 37) * 20.0).alias("y"), F.lit(0).alias("all"))
    r = scans.flow_layout(t, ["all"], "o_orderkey", "y", "lead", 60.0, 760.0)
    return r.groupBy("new_page").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_order"), F.max("new_y").alias("lowest"))


def t28_smart_quotes(spark, d):
    """Every source's documents as one text: a quote that one opens is closed in a later one."""
    text = F.replace(F.replace("text", F.lit(" a"), F.lit(" 'a")), F.lit("n "), F.lit('n" '))
    r = scans.smart_quotes(_docs(spark, d).select("source", "doc_id", text.alias("text")), ["source"], "doc_id", "text")
    return r.select("doc_id", F.md5("text").alias("digest"))


def _tex(text):
    return F.concat(F.lit(r"\textit{a \emph{b} \href{http://u/}{"), text, F.lit(r"}} \& \mbox{\textbf{c}}~\x{d}\RefAnchor{k}"))


def t06_tex_text(spark, d):
    """The texts of documents inside commands, in each variant."""
    t = F.translate("text", "\\{}~[]", "//////")
    text = _tex(t)
    cols = {"body": tex.BODY, "inline": tex.INLINE, "width": tex.LENGTH, "running": tex.RUNNING, "citing": tex.CITING, "record": tex.RECORD}
    return _docs(spark, d).where("text is not null").select("doc_id", *[F.md5(tex.tex_text(text, v)).alias(n) for n, v in cols.items()])


def t07_nested_commands(spark, d):
    """Texts as deep in commands as their number says."""
    n = (F.col("doc_id") % 200 + 1).cast("int")
    nested = F.concat(F.repeat(F.lit(r"\x{"), n), F.translate("text", "\\{}", "///"), F.repeat(F.lit("}"), n), F.lit(r"\y{1}{2}\x{"))
    return _docs(spark, d).where("text is not null").select("doc_id", F.md5(tex.without_command(nested, "x", True)).alias("kept"), tex.without_command(nested, "x").alias("dropped"), F.length(tex.rewritten(nested, {"x": (1, (0,)), "y": (2, (1, "-", 0))})).cast("long").alias("n"))


def t08_spoken(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(speech.spoken(F.concat("text", F.lit(" (see fig. 2) [so]")))).alias("digest"))


QUERIES = {f.__name__: f for f in (t01_collapse, t02_normalize, t05_slug, t09_replace_chain, t12_sentence_chunks, t13_word_chunks, t17_url_tokens, t18_id_from_url, t18_video_id, t27_escapes, t29_speaker_segments, t30_aliases, t20_year, t24_word_count, t25_truncate, t26_ascii_fold, t27_escape_html, t36_split_list, f16_codepoint_filter, f17_bad_patterns, m02_timecodes, m04_safe_number, c02_candidate_score, c03_window_score, c04_gate, c05_first_failure, c06_pace, c13_clip_start, t03_accent_fold, t14_similarity, t15_diff_chunks, j08_phrases_in_texts, o06_greedy_intervals, o09_line_breaks, j10_one_to_one, w21_flow_layout, w21_one_flow, t28_smart_quotes, t06_tex_text, t07_nested_commands, t08_spoken)}

_LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"

SQL = {
    "t01_collapse": r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents",
    "t02_normalize": "SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS name FROM part",
    "t05_slug": "SELECT p_partkey, trim(regexp_replace(lower(p_name || ' & ' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS slug, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS dashed FROM part",
    "t09_replace_chain": "SELECT doc_id, md5(replace(replace(replace(replace(text, 'the', 'THE'), 'THE ', '<the> '), '&', ' and '), chr(10), ' / ')) AS digest FROM documents",
    "t17_url_tokens": """WITH h AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS href FROM pages) SELECT href, count(*) AS pages, min(page_id) AS first_page FROM h GROUP BY 1""",
    "t18_id_from_url": r"SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), ''), nullif(regexp_extract(url, '/(\d+)\.html', 1), ''), regexp_extract(url, '/(\d+)', 1)) AS id FROM pages",
    "t18_video_id": "SELECT page_id, CASE WHEN page_id % 4 < 3 THEN 'vid_' || lpad(CAST(page_id AS VARCHAR), 6, '0') ELSE '' END AS id FROM pages",
    "t27_escapes": r"""SELECT doc_id, md5(regexp_replace(replace(text, '\', '\textbackslash '), '([%&_#${}])', '\\\1', 'g')) AS tex, md5(regexp_replace(text, '([=;#\\\n])', '\\\1', 'g')) AS meta, md5(replace(text, chr(39), chr(39) || '\' || chr(39) || chr(39))) AS listed,
md5(replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')) AS quoted FROM documents""",
    "t29_speaker_segments": """SELECT p_partkey, CAST(pos AS BIGINT) AS pos, CASE pos WHEN 1 THEN 'A.B. Olsen' WHEN 2 THEN 'A. C. Meyer-Li' END AS speaker, CASE pos WHEN 0 THEN p_name || '.' WHEN 1 THEN p_brand || ', said' ELSE p_type END AS text FROM part, range(3) t(pos)""",
    "t30_aliases": "SELECT c_custkey, 'Ana Bo ' || c_mktsegment || '|A.B. ' || c_mktsegment || '|A.B.' || c_mktsegment || '|' || c_mktsegment AS names FROM customer",
    "t20_year": r"SELECT o_orderkey, coalesce(nullif(regexp_extract(t, '\((1[89]\d\d|20\d\d)[a-z]?\)', 1), ''), nullif(regexp_extract(t, '\b(1[89]\d\d|20\d\d)[a-z]?\b', 1), '')) AS year FROM (SELECT o_orderkey, 'Key ' || (o_orderkey % 3000) || CASE WHEN o_orderkey % 2 = 0 THEN ' (1998b)' ELSE '' END AS t FROM orders)",
    "t24_word_count": "SELECT source, CAST(sum(len(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS BIGINT) AS words FROM documents GROUP BY 1",
    "t25_truncate": r"SELECT doc_id, CASE WHEN length(t) <= 60 THEN t ELSE regexp_replace(t[1:57], '\s+\S*$', '') || '...' END AS short FROM (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents)",
    "t26_ascii_fold": r"SELECT doc_id, CAST(length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS BIGINT) AS n FROM documents",
    "t27_escape_html": """SELECT doc_id, md5(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS digest FROM documents""",
    "t36_split_list": "SELECT n_nationkey, n_name || '|' || n_regionkey AS items, CAST(2 AS BIGINT) AS n FROM nation",
    "f16_codepoint_filter": r"SELECT doc_id, odd FROM (SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[\x{00C0}-\x{00FF}]'))), '') AS odd FROM documents) WHERE odd <> ''",
    "f17_bad_patterns": "SELECT doc_id, bad FROM (SELECT doc_id, array_to_string(list_sort(list_filter(['***', '&&&', '$$$', '%%%', ' | '], lambda p: contains(text, p))), ',') AS bad FROM documents) WHERE bad <> ''",
    "m02_timecodes": "SELECT event_id, round((s % 86400) + (event_id % 1000) / 1000.0::DOUBLE, 3) AS seconds FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)",
    "m04_safe_number": "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0::DOUBLE) AS number FROM events",
    "c02_candidate_score": f"""WITH s AS (SELECT d.doc_id, CAST((CASE WHEN lang = 'en' THEN 35 ELSE 0 END) + (CASE WHEN quality = 1 THEN 70 ELSE 0 END) + (CASE WHEN n_chars BETWEEN 500 AND 5000 THEN 25 ELSE 0 END) + (CASE WHEN toxic = 1 THEN -30 ELSE 0 END) + (CASE WHEN n_chars < 100 THEN -100 ELSE 0 END) AS BIGINT) AS score,
array_to_string(list_filter([CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 100 THEN 'short' END], lambda x: x IS NOT NULL), ';') AS notes FROM {_LABELLED})
SELECT doc_id, score, CASE WHEN score >= 85 THEN 'strong' WHEN score >= 55 THEN 'review' ELSE 'weak' END AS decision, notes FROM s""",
    "c03_window_score": r"""SELECT doc_id, CAST(greatest(0, 100 - (CASE WHEN w < 25 THEN 40 ELSE 0 END) - (CASE WHEN w > 400 THEN 20 ELSE 0 END) - (CASE WHEN contains(text, '[') THEN 15 ELSE 0 END) - (CASE WHEN NOT regexp_matches(text, '[.!?]$') THEN 10 ELSE 0 END)) AS BIGINT) AS score
FROM (SELECT doc_id, text, len(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM documents)""",
    "c04_gate": f"""WITH f AS (SELECT d.doc_id, list_filter([CASE WHEN quality IS NULL THEN 'unlabelled' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 0 THEN 'poor' END, CASE WHEN n_chars > 20000 THEN 'long' END], lambda x: x IS NOT NULL) AS f FROM {_LABELLED})
SELECT doc_id, array_to_string(f, ';') AS flags, CASE WHEN list_has_any(f, ['toxic', 'poor']) THEN 'fail' WHEN len(f) > 0 THEN 'warn' ELSE 'pass' END AS gate FROM f""",
    "c05_first_failure": f"SELECT d.doc_id, CASE WHEN quality IS NULL THEN 'missing_label' WHEN quality = 0 THEN 'poor_quality' WHEN toxic = 1 THEN 'toxic' WHEN n_chars < 200 THEN 'too_short' ELSE 'ok' END AS status FROM {_LABELLED}",
    "c06_pace": r"""WITH t AS (SELECT conv_id, CAST(sum(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)) AS BIGINT) AS words, count(*) * 30.0::DOUBLE AS secs FROM conversations GROUP BY 1)
SELECT conv_id, words, round(words * 60.0::DOUBLE / secs, 3) AS wpm, CASE WHEN words * 60.0::DOUBLE / secs < 125 THEN 'slow' WHEN words * 60.0::DOUBLE / secs > 165 THEN 'fast' ELSE 'ok' END AS status FROM t""",
    "c13_clip_start": "SELECT event_id, round(greatest(5.0::DOUBLE, least(90.0::DOUBLE, value * CASE WHEN event_type = 'view' THEN 0.25::DOUBLE ELSE 0.18::DOUBLE END)), 4) AS start FROM events",
    "w21_flow_layout": """WITH RECURSIVE o AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS lead, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM lineitem GROUP BY 1, 2),
r AS (SELECT l_orderkey, l_linenumber, rn, CASE WHEN y + lead > 120 THEN 1 ELSE 0 END AS page, CASE WHEN y + lead > 120 THEN 0.0::DOUBLE ELSE y END AS z, lead FROM (SELECT *, l_linenumber * 10.0::DOUBLE AS y FROM o WHERE rn = 1)
UNION ALL SELECT o.l_orderkey, o.l_linenumber, o.rn, CASE WHEN greatest(o.l_linenumber * 10.0::DOUBLE, r.z + r.lead) + o.lead > 120 THEN r.page + 1 ELSE r.page END, CASE WHEN greatest(o.l_linenumber * 10.0::DOUBLE, r.z + r.lead) + o.lead > 120 THEN 0.0::DOUBLE ELSE greatest(o.l_linenumber * 10.0::DOUBLE, r.z + r.lead) END, o.lead
FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.rn = r.rn + 1)
SELECT l_orderkey, l_linenumber, CAST(page AS BIGINT) AS new_page, z AS new_y FROM r""",
    "t06_tex_text": r"""WITH t AS (SELECT doc_id, translate(text, '\{}~[]', '//////') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5('a b ' || t || ' & c dk') AS body, md5('a b ' || t || ' & c dk') AS inline, md5(' \& ~') AS width,
md5(trim(regexp_replace('a b ' || t || ' & c d k', '\s+', ' ', 'g'))) AS running, md5(trim(regexp_replace('a b http://u/' || t || ' & c~d', '\s+', ' ', 'g'))) AS citing, md5('a b http://u/{' || t || '} & c~dk') AS record FROM t""",
    "t07_nested_commands": r"""WITH t AS (SELECT doc_id, translate(text, '\{}', '///') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(t || '\y{1}{2}\x{') AS kept, '\y{1}{2}\x{' AS dropped, CAST(length(t) + 6 AS BIGINT) AS n FROM t""",
    "j08_phrases_in_texts": """WITH b AS (SELECT string_split(text, ' ') AS w FROM benchmark),
p AS (SELECT DISTINCT p FROM (SELECT unnest([array_to_string(w[1:2], ' '), array_to_string(w[1:3], ' '), array_to_string(w[4:5], ' ')]) AS p FROM b) WHERE p <> ''),
f AS (SELECT doc_id, strpos(text, p) - 1 AS k FROM documents JOIN p ON contains(text, p))
SELECT doc_id, count(*) AS n_patterns, min(k) AS first FROM f GROUP BY doc_id""",
    "t03_accent_fold": r"SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents",
}
