"""Queries from plans and profiles to a work queue, of keys and paths, of nested records and of small document formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rewrite as R
from ..functions import text as X
from ..operators import arrays as A
from ..operators import coverage as C
from ..operators import score as S
from ..sources import readers
from .common import table


def _plans(spark, d):
    """A plan of each supplier: its voices in order, and how many units it has."""
    n = F.col("s_suppkey")
    slug = lambda k: F.concat(F.lit("v"), (n % k).cast("string"))
    return table(spark, d, "supplier").select(n.alias("plan"), F.array(slug(7), slug(11), slug(7), F.lit("")).alias("slugs"), (n % 5).alias("units"), F.when(n % 4 == 0, "yes").when(n % 4 == 1, "no").alias("rendered"))


def _profiles(spark, d):
    n = F.col("n_nationkey")
    flags = F.array_compact(F.array(F.when(n % 5 == 3, F.lit("no_audio")), F.when(n % 3 == 0, F.lit("too_long"))))
    return table(spark, d, "nation").where("n_nationkey < 9").select(F.concat(F.lit("v"), n.cast("string")).alias("slug"), F.when(n % 2 == 0, "working").otherwise("candidate").alias("profile_status"), flags.alias("blocking"), F.when(n != 4, F.concat(F.lit("a"), n.cast("string"))).alias("audio"), (n * 3).cast("string").alias("sha"))


def _status(spark, d):
    return _plans(spark, d).join(C.voice_status(_plans(spark, d), _profiles(spark, d).select("slug", "profile_status", "blocking"), "plan", "slugs"), "plan")


def j03_name_fallback(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("own "), F.col("o_orderkey").cast("string"))).alias("name"))
    names = table(spark, d, "customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return rows.join(names, "o_custkey", "left").select("o_orderkey", R.first_given(F.col("name"), F.col("c_name")).alias("name"))


def j04_voice_status(spark, d):
    return _status(spark, d).select("plan", "missing", "failures", "candidate_only", C.renderable(F.col("missing"), F.col("units")).alias("renderable"))


def j05_changed_profiles(spark, d):
    slug = F.concat(F.lit("v"), (F.col("o_orderkey") % 11).cast("string"))
    then = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit"), slug.alias("slug"), F.when(F.col("o_orderkey") % 11 != 4, F.concat(F.lit("a"), ((F.col("o_orderkey") % 11) + F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0)).cast("string"))).alias("audio"), (F.col("o_orderkey") % 11 * 3 + F.when(F.col("o_orderkey") % 17 == 0, 1).otherwise(0)).cast("string").alias("sha"))
    return C.changed_profiles(then, _profiles(spark, d), "unit", ["audio", "sha"])


def j24_apply_latest(spark, d):
    n = F.col("o_orderkey")
    new = table(spark, d, "orders").select(F.concat(F.lit("v"), (n % 13).cast("string")).alias("slug"), n.alias("at"), F.concat(F.lit("new"), n.cast("string")).alias("audio"), n.cast("string").alias("sha"))
    return C.apply_latest(_profiles(spark, d).drop("blocking"), new, "at", ["audio", "sha"])


def j25_verified(spark, d):
    files = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 40).alias("unit"), (F.col("o_totalprice") * 100).cast("long").alias("bytes"))
    manifests = table(spark, d, "customer").select(F.col("c_custkey").alias("unit"), F.when(F.col("c_custkey") % 3 == 0, "passed").otherwise("failed").alias("asr"))
    return C.verified(files, manifests, "unit").groupBy("unit").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def f13_in_list(spark, d):
    inside, outside = [x for x in "BUILDING, FURNITURE,,MACHINERY".replace(" ", "").split(",") if x], [3, 7]
    return table(spark, d, "customer").where(F.col("c_mktsegment").isin(*inside) & ~F.col("c_nationkey").isin(*outside)).select("c_custkey")


def f14_work_queue(spark, d):
    rows = _status(spark, d).withColumn("renderable", C.renderable(F.col("missing"), F.col("units")))
    return C.queue(rows, "plan", "units", most_units=3, limit=20).select("plan", "units")


def f15_status_prefix(spark, d):
    return table(spark, d, "orders").where(F.startswith("o_orderpriority", F.lit("4-")) | F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


def f18_under_root(spark, d):
    n = F.col("o_orderkey")
    path = F.concat(F.lit("/work/a/"), F.when(n % 4 == 0, "../").when(n % 4 == 1, "../../").when(n % 4 == 2, "./b//").otherwise("b/../../ab/"), n.cast("string"))
    return table(spark, d, "orders").select("o_orderkey", R.normalized_path(path).alias("path"), R.under(path, "/work/a").alias("inside"))


def o02_queue_limit(spark, d):
    rows = _status(spark, d).withColumn("renderable", C.renderable(F.col("missing"), F.col("units")))
    return C.queue(rows, "plan", "units", limit=0, again=True).select("plan", "units")


def o05_largest_file(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("name"), F.floor(F.col("o_totalprice") / 50000).cast("long").alias("bytes"))
    return C.largest(rows, "o_custkey", "bytes", "name")


def g22_total_size(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.sum(F.length(F.col("text").cast("binary"))).cast("long").alias("bytes"))


def c14_scaffold(spark, d):
    wanted = table(spark, d, "nation").select(F.concat(F.lit("v"), F.col("n_nationkey").cast("string")).alias("slug"), "n_name")
    return C.scaffold(wanted, _profiles(spark, d), "slug", {"profile_status": F.lit("new"), "audio": F.concat(F.lit("refs/"), "n_name"), "sha": F.lit("")})


def p01_composite_key(spark, d):
    issue = F.concat(F.lit("Issue"), F.lpad((F.col("o_orderkey") % 23).cast("string"), 2, "0"))
    return table(spark, d, "orders").select("o_orderkey", R.composite_key(issue, F.col("o_orderstatus")).alias("key"), R.issue_number(issue).alias("issue"))


def p02_unit_of_path(spark, d):
    path = F.concat(F.lit("/root/Interviews/"), "r_name", F.lit("/x_"), F.col("r_regionkey").cast("string"), F.lit("/text.tex"))
    return table(spark, d, "region").select("r_regionkey", R.unit_of_path(path, "/root/Interviews/").alias("unit"))


def p06_public_manifest(spark, d):
    """A part of a nested record: fields of two structs and of a list."""
    o = table(spark, d, "orders")
    audit = F.transform(F.sequence(F.lit(0).cast("long"), F.col("o_orderkey") % 3), lambda i: F.struct(F.concat(F.lit("v"), i.cast("string")).alias("slug"), i.alias("secret"), F.when(i % 2 == 0, "pass").otherwise("warn").alias("gate")))
    nested = o.select("o_orderkey", F.struct(F.lit("mp3").alias("codec"), F.col("o_totalprice").alias("seconds"), F.lit("x").alias("sha256")).alias("mp3"), audit.alias("audit"))
    return nested.select("o_orderkey", F.col("mp3.codec").alias("codec"), F.col("mp3.seconds").alias("seconds"), F.to_json(F.transform("audit", lambda a: F.struct(a["slug"].alias("slug"), a["gate"].alias("gate")))).alias("voices"))


def p07_coalesce_chain(spark, d):
    n = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", R.first_given(F.when(n % 3 == 0, "").when(n % 3 == 1, F.concat(F.lit("w"), n.cast("string"))), F.when(n % 2 == 0, F.lower("c_name")), F.when(n % 5 == 0, F.lit("last"))).alias("url"))


def p09_paths(spark, d):
    n = F.col("c_custkey")
    path = F.when(n % 2 == 0, F.concat(F.lit("/base/p/"), n.cast("string"))).otherwise(F.concat(F.lit("p/"), n.cast("string")))
    return table(spark, d, "customer").select("c_custkey", R.rooted(path, "/base").alias("rooted"), R.relative(R.rooted(path, "/base"), "/base").alias("relative"), X.slug(F.col("c_name"), "-").alias("slug"))


def m01_rounding(spark, d):
    v = (F.col("o_orderkey") - 300).cast("double") / 8
    return table(spark, d, "orders").select("o_orderkey", F.bround(v, 1).alias("even"), F.ceil(v).cast("long").alias("up"), F.floor(v).cast("long").alias("down"), F.abs(v).alias("size"), F.greatest(F.lit(-5.0), F.least(F.lit(50.0), v)).alias("cut"), F.pmod(F.col("o_orderkey") - 300, F.lit(7)).cast("long").alias("modulo"))


def m03_formats(spark, d):
    v = F.col("o_orderkey").cast("double") / 8
    return table(spark, d, "orders").select("o_orderkey", X.fixed(v, 3).alias("three"), F.format_string("%06X", F.col("o_orderkey")).alias("hex"), F.format_string("%03d", F.col("o_orderkey") % 1000).alias("padded"), F.concat(X.fixed(v, 1), F.lit("%")).alias("percent"))


def m05_arrays(spark, d):
    w = F.split("p_name", " ")
    pairs = F.zip_with(w, F.sequence(F.lit(1), F.size(w)), lambda a, i: F.concat(i.cast("string"), a))
    return table(spark, d, "part").select("p_partkey", F.array_join(pairs, ",").alias("numbered"), F.get(F.reverse(w), F.lit(0)).alias("last"), F.array_join(F.slice(w, 1, 1), "").alias("first"), F.array_contains(w, F.lit("widget")).alias("has"))


def m06_nested_default(spark, d):
    e = table(spark, d, "events").select("event_id", F.from_json(F.when(F.col("event_id") % 4 > 0, F.concat(F.lit('{"a":'), F.when(F.col("event_id") % 4 > 1, F.col("props")).otherwise("null"), F.lit("}"))), "a struct<k:string,z:string>").alias("m"))
    return e.select("event_id", F.coalesce("m.a.k", F.lit("")).alias("k"), F.coalesce("m.a.z", F.lit("none")).alias("z"))


def m07_json(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k int").alias("p"))
    return e.select("event_id", F.to_json(F.struct(F.col("event_type").alias("t"), (F.col("p.k") + 1).alias("k"), F.array("event_id").alias("l"))).alias("json"))


def m08_map_merge(spark, d):
    n = F.col("c_custkey")
    base = F.create_map(F.lit("a"), n.cast("string"), F.lit("b"), F.lit("old"))
    over = F.when(n % 2 == 0, F.create_map(F.lit("b"), F.lit("new"), F.lit("c"), n.cast("string"))).otherwise(F.create_map(F.lit("c"), F.lit("only")))
    get = lambda m: F.concat_ws(",", *[F.coalesce(m[k], F.lit("-")) for k in "abc"])
    return table(spark, d, "customer").select("c_custkey", get(R.merged(base, over)).alias("merged"), get(R.defaulted(base, over)).alias("defaulted"))


def s04_environments(spark, d):
    unit = lambda i: F.concat(F.lit("\\begin{question}\n "), "p_name", F.lit(" "), i.cast("string"), F.lit("\n\\end{question} text \\begin{answer}"), "p_type", F.lit("\n\n"), "p_brand", F.lit("\\end{answer}\n"))
    value = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("p_partkey") % 3), unit), "")
    rows = table(spark, d, "part").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("file"), value.alias("value"))
    return readers.environments(rows).select("file", F.col("unit").cast("long").alias("unit"), "question", "answer")


def s05_quote_slots(spark, d):
    n = F.col("o_orderkey")
    line = F.when(n % 5 == 0, F.concat(F.lit("% quote-id: q"), n.cast("string"))).when(n % 5 < 3, F.concat(F.lit(r"  \TstMaybeNotableQuoteAt{"), (n % 90).cast("string"), F.lit(".5}{"), (n % 700).cast("string"), F.lit("}{200.25}{"), "o_orderpriority", F.lit("}"))).otherwise("other")
    rows = table(spark, d, "orders").select(F.concat(F.lit("f"), (F.col("o_custkey") % 9).cast("string")).alias("file"), n.alias("line_no"), line.alias("line"))
    return readers.quotes(rows)


def s11_json_lines(spark, d):
    rows = table(spark, d, "events").select("event_id", F.from_json("props", "k int").alias("hit"))
    return rows.where("hit.k is not null").select("event_id", F.col("hit.k").cast("long").alias("k"))


def s12_catalog(spark, d):
    """Pieces of a catalog document, interviews only."""
    piece = F.struct(F.when(F.col("n_nationkey") % 3 == 0, "interview").otherwise("essay").alias("piece_type"), F.concat(F.lit("Issue0"), F.col("n_regionkey").cast("string")).alias("issue"), F.lower("n_name").alias("slug"))
    doc = table(spark, d, "nation").agg(F.to_json(F.struct(F.collect_list(piece).alias("pieces"))).alias("value"))
    return readers.catalog(doc, "interview").select("issue", "slug")


def s16_transcript_sections(spark, d):
    text = F.concat(F.lit("Unit: 1\n\nQUESTION SPOKEN TEXT:\n"), "p_name", F.lit("\n\nANSWER SPOKEN TEXT:\n"), "p_type", F.lit(" ."))
    whole = F.when(F.col("p_partkey") % 6 == 0, F.col("p_name")).otherwise(text)
    return table(spark, d, "part").select("p_partkey", X.section(whole, "QUESTION SPOKEN TEXT:", "ANSWER SPOKEN TEXT:", strict=False).alias("question"), X.section(whole, "ANSWER SPOKEN TEXT:", "\x00", strict=False).alias("answer"))


def s22_comment_block(spark, d):
    n = F.col("o_orderkey")
    line = F.when(n % 40 == 3, "% ABSTRACT").when(n % 40 == 11, "% END").when((n % 10 == 9) & (n % 30 == 9), "no comment").otherwise(F.concat(F.lit("% "), "o_orderpriority"))
    rows = table(spark, d, "orders").select(F.concat(F.lit("f"), (F.col("o_custkey") % 9).cast("string")).alias("file"), n.alias("line_no"), line.alias("line"))
    return readers.commented_block(rows, "ABSTRACT", "END")


def t11_pronounced(spark, d):
    text = F.concat(F.lit("[Music] The AI of "), "c_name", F.lit(" (laughs) met MAI and AI, "), "c_mktsegment", F.lit(" (2001)"))
    return table(spark, d, "customer").select("c_custkey", R.pronounced(text, {"AI": "A I", "BUILDING": "Building", "A I of": "the A I of"}).alias("spoken"))


def t16_crop(spark, d):
    text = F.concat(F.lit("Front matter\n "), "p_brand", F.lit(" \n"), F.when(F.col("p_partkey") % 3 == 0, F.replace("p_name", F.lit(" "), F.lit(" \n "))).otherwise(F.col("p_name")), F.lit("?  And the rest"))
    found = R.crop(text, F.when(F.col("p_partkey") % 5 == 0, F.lit("never there")).otherwise(F.col("p_name")))
    return table(spark, d, "part").select("p_partkey", found.alias("c")).select("p_partkey", "c.text", "c.cropped")


def g20_array_statistics(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", F.round(A.mean(e), 4).alias("mean"), F.round(A.share_over(e, 0.05), 6).alias("over"), F.array_min(e).cast("double").alias("least"), F.array_max(e).cast("double").alias("most"))


def f19_solid(spark, d):
    e = F.when(F.col("vec_id") % 3 == 0, F.transform("embedding", lambda x: F.lit(1).cast("float"))).otherwise(F.col("embedding"))
    return table(spark, d, "embeddings").where(A.solid(e, 0.01)).select("vec_id")


def j20_paired_samples(spark, d):
    t = table(spark, d, "embeddings")
    moved = t.where("vec_id % 5 > 0").select((F.col("vec_id") - 1).alias("vec_id"), "embedding")
    return A.paired(t, moved, ["vec_id"], "embedding").select("vec_id", F.round("mean_difference", 4).alias("mean"), F.round(F.col("most_difference").cast("double"), 4).alias("most"))


def c08_fidelity(spark, d):
    clean = F.regexp_replace("text", "[*&$%#]{3}", "")  # what is left of a text is a part of it, so all of it matches
    ratio = 2.0 * F.length(clean) / (F.length("text") + F.length(clean))
    ok = S.fidelity(X.found_patterns(F.col("text"), ["***", "&&&", "$$$"]), ratio, [F.col("doc_id") % 7 > 0, F.length("text") > 0])
    return table(spark, d, "documents").select("doc_id", ok.alias("ok"))


QUERIES = {f.__name__: f for f in (j03_name_fallback, j04_voice_status, j05_changed_profiles, j24_apply_latest, j25_verified, f13_in_list, f14_work_queue, f15_status_prefix, f18_under_root, o02_queue_limit, o05_largest_file, g22_total_size, c14_scaffold, p01_composite_key, p02_unit_of_path, p06_public_manifest, p07_coalesce_chain, p09_paths, m01_rounding, m03_formats, m05_arrays, m06_nested_default, m07_json, m08_map_merge, s04_environments, s05_quote_slots, s11_json_lines, s12_catalog, s16_transcript_sections, s22_comment_block, t11_pronounced, t16_crop, g20_array_statistics, f19_solid, j20_paired_samples, c08_fidelity)}

_PROFILES = "(SELECT 'v' || n_nationkey AS slug, CASE WHEN n_nationkey % 2 = 0 THEN 'working' ELSE 'candidate' END AS profile_status, concat_ws(',', CASE WHEN n_nationkey % 5 = 3 THEN 'no_audio' END, CASE WHEN n_nationkey % 3 = 0 THEN 'too_long' END) AS flags, CASE WHEN n_nationkey <> 4 THEN 'a' || n_nationkey END AS audio, CAST(n_nationkey * 3 AS VARCHAR) AS sha FROM nation WHERE n_nationkey < 9)"
_STATUS = f"""WITH v AS (SELECT DISTINCT ON (plan, slug) plan, ord, slug FROM (SELECT s_suppkey AS plan, 0 AS ord, 'v' || (s_suppkey % 7) AS slug FROM supplier UNION ALL SELECT s_suppkey, 1, 'v' || (s_suppkey % 11) FROM supplier) ORDER BY plan, slug, ord),
j AS (SELECT v.*, p.profile_status, p.flags FROM v LEFT JOIN {_PROFILES} p USING (slug)),
a AS (SELECT plan, coalesce(string_agg(slug, ';' ORDER BY ord) FILTER (WHERE flags IS NULL OR flags <> ''), '') AS missing,
coalesce(string_agg(slug || ':' || coalesce(flags, 'missing_profile'), ';' ORDER BY ord) FILTER (WHERE flags IS NULL OR flags <> ''), '') AS failures,
coalesce(string_agg(slug, ';' ORDER BY ord) FILTER (WHERE flags = '' AND profile_status <> 'working'), '') AS candidate_only FROM j GROUP BY plan),
r AS (SELECT a.*, plan % 5 AS units, CASE WHEN plan % 4 = 0 THEN 'yes' WHEN plan % 4 = 1 THEN 'no' END AS rendered, CASE WHEN missing = '' AND plan % 5 > 0 THEN 'yes' ELSE 'no' END AS renderable FROM a)"""

SQL = {
    "j03_name_fallback": "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 1 THEN 'own ' || o_orderkey END, c_name, '') AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 > 0) ON c_custkey = o_custkey",
    "j04_voice_status": _STATUS + " SELECT plan, missing, failures, candidate_only, renderable FROM r",
    "j05_changed_profiles": f"WITH t AS (SELECT o_orderkey AS unit, 'v' || (o_orderkey % 11) AS slug, CASE WHEN o_orderkey % 11 <> 4 THEN 'a' || (o_orderkey % 11 + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) END AS audio, CAST(o_orderkey % 11 * 3 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS sha FROM orders), c AS (SELECT unit, slug, CASE WHEN p.slug IS NULL THEN 'missing' WHEN t.audio IS DISTINCT FROM p.audio THEN 'audio' WHEN t.sha IS DISTINCT FROM p.sha THEN 'sha' END AS change, t.slug AS s FROM t LEFT JOIN {_PROFILES} p USING (slug)) SELECT unit, s AS slug, change FROM c WHERE change IS NOT NULL".replace("SELECT unit, slug, CASE WHEN p.slug", "SELECT unit, CASE WHEN p.sha"),
    "j24_apply_latest": f"WITH l AS (SELECT 'v' || (o_orderkey % 13) AS slug, max(o_orderkey) AS k FROM orders GROUP BY 1) SELECT p.slug, profile_status, 'new' || k AS audio, CAST(k AS VARCHAR) AS sha FROM {_PROFILES} p JOIN l USING (slug) WHERE profile_status <> 'working'",
    "j25_verified": "SELECT o_orderkey % 40 AS unit, count(*) AS files, CAST(sum(CAST(trunc(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS bytes FROM orders WHERE o_orderkey % 40 IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1",
    "f13_in_list": "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY') AND c_nationkey NOT IN (3, 7)",
    "f14_work_queue": _STATUS + " SELECT plan, units FROM r WHERE renderable = 'yes' AND coalesce(rendered, '') <> 'yes' AND units <= 3 ORDER BY units, plan LIMIT 20",
    "f15_status_prefix": "SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '4-%' OR o_orderpriority IN ('1-URGENT', '5-LOW')",
    "f18_under_root": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '/work/' WHEN 1 THEN '/' WHEN 2 THEN '/work/a/b/' ELSE '/work/ab/' END || o_orderkey AS path, o_orderkey % 4 = 2 AS inside FROM orders",
    "o02_queue_limit": _STATUS + " SELECT plan, units FROM r WHERE renderable = 'yes'",
    "o05_largest_file": "WITH f AS (SELECT o_custkey, 'f' || o_orderkey AS name, CAST(floor(o_totalprice / 50000) AS BIGINT) AS bytes FROM orders) SELECT o_custkey, name, bytes FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY bytes DESC, name) AS r FROM f) WHERE r = 1",
    "g22_total_size": "SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY 1",
    "c14_scaffold": f"SELECT 'v' || n_nationkey AS slug, n_name, coalesce(p.profile_status, 'new') AS profile_status, coalesce(p.audio, 'refs/' || n_name) AS audio, coalesce(p.sha, '') AS sha FROM nation LEFT JOIN {_PROFILES} p ON p.slug = 'v' || n_nationkey",
    "p01_composite_key": "SELECT o_orderkey, 'Issue' || lpad(CAST(o_orderkey % 23 AS VARCHAR), 2, '0') || '/' || o_orderstatus AS key, lpad(CAST(o_orderkey % 23 AS VARCHAR), 2, '0') AS issue FROM orders",
    "p02_unit_of_path": "SELECT r_regionkey, r_name || '/x_' || r_regionkey AS unit FROM region",
    "p06_public_manifest": """SELECT o_orderkey, 'mp3' AS codec, o_totalprice AS seconds, '[' || array_to_string(list_transform(range(0, o_orderkey % 3 + 1), lambda i: '{"slug":"v' || i || '","gate":"' || CASE WHEN i % 2 = 0 THEN 'pass' ELSE 'warn' END || '"}'), ',') || ']' AS voices FROM orders""",
    "p07_coalesce_chain": "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 1 THEN 'w' || c_custkey END, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) END, CASE WHEN c_custkey % 5 = 0 THEN 'last' END, '') AS url FROM customer",
    "p09_paths": "SELECT c_custkey, '/base/p/' || c_custkey AS rooted, 'p/' || c_custkey AS relative, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM customer",
    "m01_rounding": "WITH v AS (SELECT o_orderkey, CAST(o_orderkey - 300 AS DOUBLE) / 8 AS v FROM orders) SELECT o_orderkey, round_even(v, 1) AS even, CAST(ceil(v) AS BIGINT) AS up, CAST(floor(v) AS BIGINT) AS down, abs(v) AS size, greatest(-5.0::DOUBLE, least(50.0::DOUBLE, v)) AS cut, ((o_orderkey - 300) % 7 + 7) % 7 AS modulo FROM v",
    "m03_formats": "SELECT o_orderkey, printf('%.3f', o_orderkey / 8.0::DOUBLE) AS three, lpad(upper(to_hex(o_orderkey)), 6, '0') AS hex, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS padded, printf('%.1f', o_orderkey / 8.0::DOUBLE) || '%' AS percent FROM orders",
    "m05_arrays": "WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part) SELECT p_partkey, array_to_string(list_transform(w, lambda a, i: i || a), ',') AS numbered, w[-1] AS last, w[1] AS first, list_contains(w, 'widget') AS has FROM w",
    "m06_nested_default": "SELECT event_id, CASE WHEN event_id % 4 > 1 THEN coalesce(json_extract_string(props, '$.k'), '') ELSE '' END AS k, 'none' AS z FROM events",
    "m07_json": """SELECT event_id, '{"t":"' || event_type || '","k":' || (CAST(json_extract_string(props, '$.k') AS INT) + 1) || ',"l":[' || event_id || ']}' AS json FROM events""",
    "m08_map_merge": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ',new,' || c_custkey ELSE c_custkey || ',old,only' END AS merged, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ',old,' || c_custkey ELSE c_custkey || ',old,only' END AS defaulted FROM customer",
    "s04_environments": "SELECT 'f' || p_partkey AS file, unit, p_name || ' ' || unit AS question, p_type || chr(10) || chr(10) || p_brand AS answer FROM (SELECT *, unnest(range(0, p_partkey % 3 + 1)) AS unit FROM part)",
    "s05_quote_slots": "WITH l AS (SELECT 'f' || (o_custkey % 9) AS file, o_orderkey AS line_no, o_orderkey % 5 IN (1, 2) AS q, CASE WHEN o_orderkey % 5 = 0 THEN 'q' || o_orderkey END AS id, o_orderpriority FROM orders), g AS (SELECT *, coalesce(sum(CASE WHEN q THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM l), i AS (SELECT *, last_value(id IGNORE NULLS) OVER (PARTITION BY file, g ORDER BY line_no) AS quote_id FROM g) SELECT file, line_no, line_no % 90 + 0.5::DOUBLE AS x, CAST(line_no % 700 AS DOUBLE) AS y, 200.25::DOUBLE AS width, o_orderpriority AS quote, quote_id FROM i WHERE q",
    "s11_json_lines": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL",
    "s12_catalog": "SELECT 'Issue0' || n_regionkey AS issue, lower(n_name) AS slug FROM nation WHERE n_nationkey % 3 = 0",
    "s16_transcript_sections": "SELECT p_partkey, p_name AS question, CASE WHEN p_partkey % 6 = 0 THEN p_name ELSE p_type || ' .' END AS answer FROM part",
    "s22_comment_block": "WITH l AS (SELECT 'f' || (o_custkey % 9) AS file, o_orderkey AS line_no, CASE WHEN o_orderkey % 40 = 3 THEN 'start' WHEN o_orderkey % 40 = 11 OR o_orderkey % 30 = 9 THEN 'stop' ELSE 'in' END AS kind, o_orderpriority FROM orders), s AS (SELECT file, min(line_no) AS s FROM l WHERE kind = 'start' GROUP BY 1), e AS (SELECT l.file, s, min(line_no) AS e FROM l JOIN s ON l.file = s.file AND line_no > s AND kind = 'stop' GROUP BY 1, 2) SELECT l.file, line_no, o_orderpriority AS text FROM l JOIN s ON l.file = s.file LEFT JOIN e ON l.file = e.file WHERE line_no > s.s AND (e IS NULL OR line_no < e) AND kind = 'in'",
    "t11_pronounced": "SELECT c_custkey, 'The the A I of ' || c_name || ' met MAI and A I, ' || replace(c_mktsegment, 'BUILDING', 'Building') || ' (2001)' AS spoken FROM customer",
    "t16_crop": "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'Front matter ' || p_brand || ' ' || p_name || '? And the rest' ELSE p_name || '? And the rest' END AS text, p_partkey % 5 <> 0 AS cropped FROM part",
    "g20_array_statistics": "SELECT vec_id, round(list_avg(CAST(embedding AS DOUBLE[])), 4) + 0.0 AS mean, round(len(list_filter(embedding, lambda x: x > 0.05)) / CAST(len(embedding) AS DOUBLE), 6) AS over, CAST(list_min(embedding) AS DOUBLE) AS least, CAST(list_max(embedding) AS DOUBLE) AS most FROM embeddings",
    "f19_solid": "SELECT vec_id FROM embeddings WHERE vec_id % 3 = 0 OR list_max(embedding) - list_min(embedding) <= 0.01",
    "j20_paired_samples": "WITH b AS (SELECT vec_id - 1 AS vec_id, embedding AS e FROM embeddings WHERE vec_id % 5 > 0), z AS (SELECT vec_id, list_transform(list_zip(embedding, e), lambda p: abs(p[1] - p[2])) AS d FROM embeddings JOIN b USING (vec_id)) SELECT vec_id, round(list_avg(CAST(d AS DOUBLE[])), 4) + 0.0 AS mean, round(CAST(list_max(d) AS DOUBLE), 4) AS most FROM z",
    "c08_fidelity": "SELECT doc_id, NOT contains(text, '***') AND NOT contains(text, '&&&') AND NOT contains(text, '$$$') AND 2.0::DOUBLE * length(regexp_replace(text, '[*&$%#]{3}', '', 'g')) / (length(text) + length(regexp_replace(text, '[*&$%#]{3}', '', 'g'))) >= 0.985 AND doc_id % 7 > 0 AND length(text) > 0 AS ok FROM documents",
}
