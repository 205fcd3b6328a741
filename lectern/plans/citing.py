"""Queries of citation linking and of records checked against a registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import python as P
from ..operators import citations as C
from ..sources import readers
from .common import table
from .derived import spans, with_spans


def _entries(spark, d):
    return C.anchors(C.entries(spans(spark, d)))


def _found(spark, d):
    s = spans(spark, d)
    return C.candidates(s, C.pattern_map(C.anchors(C.entries(s))))


def f05_reference_spans(spark, d):
    return C.reference_spans(spans(spark, d)).select("file", "line_no")


def f06_entry_starts(spark, d):
    rows = C.reference_spans(spans(spark, d))
    return rows.where(C.starts_entry(F.col("plain"))).select("file", "line_no")


def f07_linkable(spark, d):
    return C.with_heading(spans(spark, d)).where(C.linkable()).select("file", "line_no")


def g16_reference_patterns(spark, d):
    return C.pattern_map(_entries(spark, d)).select("file", "pattern", F.array_join("anchors", ";").alias("anchors"))


def t21_entry_authors(spark, d):
    return _entries(spark, d).select("file", "first_line", "year", F.array_join("surnames", "|").alias("surnames"), "anchor")


def j08_citation_candidates(spark, d):
    return _found(spark, d).select("file", "line_no", F.explode("held").alias("h")).select("file", "line_no", "h.pattern", "h.anchor")


def j08_citation_links(spark, d):
    return C.linked(_found(spark, d)).select("file", "line_no", "n_links", "new_text")


def g17_pattern_occurrences(spark, d):
    return C.occurrences(_found(spark, d))


def t32_unwrapped_links(spark, d):
    linked = F.concat(F.lit(r"\RefAnchor{a"), "line_no", F.lit(r"}see \CitationLink{b}{"), F.lit(r"\CitationLink{c}{"), "text", F.lit("}} there"))
    return spans(spark, d).where(~F.col("text").rlike("[{}\\\\]")).select("line_no", C.plain(linked).alias("plain"), C.unwrap_links(linked).alias("unwrapped"))


def t37_anchored_lines(spark, d):
    s = spans(spark, d).select("file", "line_no", "text")
    rows = s.join(_entries(spark, d).select("file", F.col("first_line").alias("line_no"), "anchor"), ["file", "line_no"])
    once = C.anchored_text(F.col("text"), F.col("anchor"))
    return rows.select("file", "line_no", C.anchored_text(once, F.lit("again")).alias("text"))


def e02_link_targets(spark, d):
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "page", "nn"))), lambda x: F.concat(F.lit(r"\RefAnchor{"), x["nn"], x["page"], F.lit(r"}\CitationLink{"), x["nn"], (x["page"] + x["line_no"] % 2).cast("string"), F.lit("}{t}")))
    whole = spans(spark, d).where("line_no % 9 = 0").withColumn("nn", F.concat(F.lit("k"), (F.col("line_no") % 7).cast("string"))).groupBy("file").agg(F.array_join(parts, "").alias("value"))
    return C.validated(whole)


# --- records


def _records(spark, d):
    """A record of each customer, and its text as a file."""
    n = F.col("c_custkey")
    doi = F.when(n % 7 == 0, F.concat(F.lit("10.1234/cut-"), (n % 3).cast("string"), F.lit("-"))).when(n % 11 > 0, F.concat(F.lit("<10.1234/abc."), n.cast("string"), F.lit(">;")))
    rows = table(spark, d, "customer").select(n.alias("key"), doi.alias("doi"), F.concat(F.lit("On the "), F.lower("c_mktsegment"), F.lit(" of "), n.cast("string")).alias("title"), F.concat(F.lit("Olsen, Ana and Ben Meyer"), F.when(n % 5 == 0, " and Haas, C.").otherwise("")).alias("authors"))
    field = lambda name, v: F.when(v.isNotNull(), F.concat(F.lit(f"\n  {name} = {{"), v, F.lit("},"))).otherwise("")
    text = F.concat(F.lit("@article{c"), F.col("key").cast("string"), F.lit(","), field("title", F.lit("an old title")), field("Title", F.replace("title", F.lit(" "), F.lit("\n  "))), field("author", F.col("authors")), field("DOI", F.col("doi")), F.lit("\n}\n"))
    return rows.withColumn("value", text).withColumn("file", F.concat(F.lit("c"), F.col("key").cast("string")))


def _registry(spark, d):
    n = F.col("c_custkey")
    authors = F.array(F.struct(F.lit("Ölsen").alias("family"), F.lit(None).cast("string").alias("literal")), F.struct(F.lit("").alias("family"), F.when(n % 4 > 0, "Meyer").alias("literal")), F.struct(F.lit("Olsen").alias("family"), F.lit("").alias("literal")))
    return table(spark, d, "customer").where("c_custkey % 6 > 0").select(F.concat(F.lit("10.1234/abc."), n.cast("string")).alias("doi"), F.lit("OK").alias("status"), F.concat(F.when(n % 8 > 0, "ON THE "), F.upper("c_mktsegment"), F.lit(": of, "), n.cast("string"), F.lit(" and more")).alias("csl_title"), authors.alias("csl_authors"))


def s06_bib_records(spark, d):
    f = readers.bib(_records(spark, d).select("file", "value"))
    return f.select("file", "key", F.col("fields.title").alias("title"), F.col("fields.author").alias("author"), F.col("fields.doi").alias("doi"))


def s07_required_field(spark, d):
    f = readers.bib(_records(spark, d).where("doi is not null").select("file", "value"))
    return readers.required_field(f, "doi")


def j06_records_and_registry(spark, d):
    r = _records(spark, d)
    results = C.lookups(r.select(C.clean_doi(F.coalesce("doi", F.lit(""))).alias("doi")).where("doi <> ''"), _registry(spark, d))
    return C.checked_records(r, results)


def j07_doi_universe(spark, d):
    r = _records(spark, d).select(C.clean_doi(F.col("doi")).alias("doi")).where("doi <> ''")
    text = spans(spark, d).select(F.explode(C.text_dois(F.col("text"))).alias("doi"))
    return C.lookups(r.unionAll(text), _registry(spark, d)).select("doi", "status")


def c07_title_status(spark, d):
    """With the ratio of titles that don't contain each other."""
    r = _records(spark, d)
    results = C.lookups(r.select(C.clean_doi(F.coalesce("doi", F.lit(""))).alias("doi")).where("doi <> ''"), _registry(spark, d))
    return C.checked_records(r, results, ratio=P.similarity()(F.col("bib"), F.col("csl"))).select("key", "title_status")


def t17_dois_and_urls(spark, d):
    text = F.concat("text", F.lit(" and doi: 10.99999/ab- "), F.col("page").cast("string"), F.lit(", http://dx.doi.org/10.4321/ x.y)."))
    return spans(spark, d).select("line_no", F.array_join(C.text_dois(text), "|").alias("dois"), F.array_join(C.text_urls(text), "|").alias("urls"), F.exists(C.text_dois(text), C.incomplete_doi).alias("cut"))


def t19_families(spark, d):
    return _records(spark, d).select("key", F.array_join(C.record_families(F.col("authors")), "|").alias("families"))


def p08_reshaped(spark, d):
    """A provider's messages in the common shape."""
    a = F.transform("csl_authors", lambda x: F.struct(F.coalesce(x["family"], F.lit("")).alias("family"), F.coalesce(x["literal"], F.lit("")).alias("given")))
    m = _registry(spark, d).select("doi", F.array("csl_title").alias("title"), F.array().cast("array<string>").alias("container"), a.alias("author"))
    return m.select("doi", F.coalesce(F.get("title", F.lit(0)), F.lit("")).alias("title"), F.coalesce(F.get("container", F.lit(0)), F.lit("")).alias("container"), F.to_json("author").alias("author"))


QUERIES = {f.__name__: f for f in (f05_reference_spans, f06_entry_starts, f07_linkable, g16_reference_patterns, t21_entry_authors, j08_citation_candidates, j08_citation_links, g17_pattern_occurrences, t32_unwrapped_links, t37_anchored_lines, e02_link_targets, s06_bib_records, s07_required_field, j06_records_and_registry, j07_doi_universe, c07_title_status, t17_dois_and_urls, t19_families, p08_reshaped)}

_HEAD = ", h AS (SELECT file, min(line_no) AS h FROM s WHERE lower(trim(text)) = 'references' GROUP BY file), hh AS (SELECT s.file, line_no AS h_line, page AS h_page, y AS h_y FROM s JOIN h ON s.file = h.file AND line_no = h)"
_REFS = _HEAD + ", r AS (SELECT s.*, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS plain FROM s JOIN hh USING (file) WHERE line_no > h_line AND NOT (page = h_page AND y <= h_y + 5) AND y BETWEEN 45 AND 755 AND color <> 'C767171' AND size >= 10 AND (contains(font, 'Cormorant') OR contains(font, 'Times')) AND trim(text) <> '')"
_ENTRY = "length(split_part(plain, ',', 1)) BETWEEN 2 AND 90 AND NOT regexp_matches(split_part(plain, ',', 1), '[^\\p{L}''’. -]') AND plain[length(split_part(plain, ',', 1)) + 1:length(split_part(plain, ',', 1)) + 2] = ', '"
# the years and names of these spans, by their two shapes and what follows them in a group
_ENTRIES = _REFS + f""", m AS (SELECT *, x <= min(x) OVER (PARTITION BY file) + 8.5 AND {_ENTRY} AS starts FROM r),
n AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no) AS g FROM m),
t AS (SELECT file, min(line_no) AS first_line, string_agg(plain, ' ' ORDER BY line_no) AS t FROM n WHERE g > 0 GROUP BY file, g),
u AS (SELECT file, first_line, t, coalesce(nullif(regexp_extract(t, '\\((\\d{{4}}[a-z]?)', 1), ''), nullif(regexp_extract(t, '\\b((?:18|19|20)\\d{{2}}[a-z]?)\\b', 1), '')) AS year FROM t),
v AS (SELECT *, CASE WHEN contains(t, '(' || year) THEN t[1:strpos(t, '(' || year) - 1] ELSE t[1:strpos(t, year) - 1] END AS a FROM u WHERE year IS NOT NULL),
w0 AS (SELECT *, list_filter(list_transform(string_split_regex(a, '\\s*,\\s*(?:&|and\\s)?\\s*|\\s*&\\s*|\\s+and\\s+'), lambda z: trim(z)), lambda z: z <> '') AS z FROM v),
w AS (SELECT *, list_filter(z, lambda p, j: NOT regexp_matches(p, '^\\p{{Lu}}\\.') AND coalesce(regexp_matches(z[j + 1], '^\\p{{Lu}}\\.'), false)) AS i,
  list_filter(list_transform(z, lambda p: regexp_extract(p, '^(?:\\p{{Lu}}\\.\\s*)+(\\p{{Lu}}[\\p{{L}}''’-]+)', 1)), lambda p: p <> '') AS k FROM w0),
e0 AS (SELECT file, first_line, year, a, list_concat(i, k) AS l FROM w),
e1 AS (SELECT file, first_line, year, CASE WHEN len(l) > 0 THEN list_filter(l, lambda z, j: list_position(l, z) = j) WHEN contains(a, ',') THEN [trim(split_part(a, ',', 1))] ELSE [] END AS names FROM e0),
e2 AS (SELECT *, 'ref-' || file || '-' || array_to_string(list_transform(names[1:2], lambda z: trim(regexp_replace(lower(z), '[^a-z0-9]+', '-', 'g'), '-')), '-') || '-' || year AS base FROM e1 WHERE len(names) > 0),
e AS (SELECT *, CASE WHEN row_number() OVER o = 1 THEN base ELSE base || '-' || row_number() OVER o END AS anchor FROM e2 WINDOW o AS (PARTITION BY file, base ORDER BY first_line)),
q AS (SELECT file, anchor, unnest(CASE WHEN len(names) = 1 THEN [names[1] || ', ' || year, names[1] || ' (' || year || ')']
  WHEN len(names) = 2 THEN [names[1] || j || names[2] || y for y in [', ' || year, ' (' || year || ')'] for j in [' & ', ' and ', ' \\& ']]
  ELSE [names[1] || ' et al., ' || year, names[1] || ' et al. (' || year || ')', names[1] || ' et al. ' || year] END || [names[1] || ', ' || year]) AS pattern FROM e),
pm AS (SELECT file, pattern, string_agg(DISTINCT anchor, ';' ORDER BY anchor) AS anchors, count(DISTINCT anchor) AS n FROM q GROUP BY 1, 2)"""
_ENTRIES = _ENTRIES.replace("[names[1] || j || names[2] || y for y in [', ' || year, ' (' || year || ')'] for j in [' & ', ' and ', ' \\& ']]", "[names[1] || j || names[2] || ', ' || year for j in [' & ', ' and ', ' \\& ']] || [names[1] || j || names[2] || ' (' || year || ')' for j in [' & ', ' and ', ' \\& ']]")
_LINKABLE = "(h_line IS NULL OR line_no < h_line) AND NOT contains(text, 'http') AND NOT contains(text, 'doi.org') AND NOT contains(text, 'Citation:') AND NOT regexp_matches(text, '(?i)Cite\\s+as:') AND y <= 760 AND size >= 8"
_HELD = _ENTRIES + f", f AS (SELECT s.file, line_no, text, pattern, anchors AS anchor FROM s LEFT JOIN hh USING (file) JOIN pm ON pm.file = s.file AND n = 1 AND contains(text, pattern) WHERE {_LINKABLE})"
_REC = """WITH c AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 7 = 0 THEN '10.1234/cut-' || (c_custkey % 3) || '-' WHEN c_custkey % 11 > 0 THEN '10.1234/abc.' || c_custkey END AS doi,
'on the ' || lower(c_mktsegment) || ' of ' || c_custkey AS title, c_mktsegment, c_custkey % 5 = 0 AS third FROM customer)"""
_KNOWN = "CASE WHEN key % 7 = 0 THEN 'MALFORMED' WHEN doi IS NULL OR key % 6 = 0 THEN 'MISSING' ELSE 'OK' END"

SQL = {
    "f05_reference_spans": with_spans(_REFS + " SELECT file, line_no FROM r"),
    "f06_entry_starts": with_spans(_REFS + f" SELECT file, line_no FROM r WHERE {_ENTRY}"),
    "f07_linkable": with_spans(_HEAD + f" SELECT s.file, line_no FROM s LEFT JOIN hh USING (file) WHERE {_LINKABLE}"),
    "g16_reference_patterns": with_spans(_ENTRIES + " SELECT file, pattern, anchors FROM pm"),
    "t21_entry_authors": with_spans(_ENTRIES + " SELECT file, first_line, year, array_to_string(names, '|') AS surnames, anchor FROM e"),
    "j08_citation_candidates": with_spans(_HELD + " SELECT file, line_no, pattern, anchor FROM f"),
    "g17_pattern_occurrences": with_spans(_HELD + " SELECT file, pattern, CAST(sum((length(text) - length(replace(text, pattern, ''))) // length(pattern)) AS BIGINT) AS n FROM f GROUP BY 1, 2"),
    "t32_unwrapped_links": with_spans(" SELECT line_no, trim(regexp_replace('see ' || text || ' there', '\\s+', ' ', 'g')) AS plain, '\\RefAnchor{a' || line_no || '}see ' || text || ' there' AS unwrapped FROM s WHERE NOT regexp_matches(text, '[{}\\\\]')"),
    "t37_anchored_lines": with_spans(_ENTRIES + " SELECT s.file, line_no, '\\RefAnchor{' || anchor || '}' || text AS text FROM s JOIN e ON e.file = s.file AND first_line = line_no"),
    "e02_link_targets": with_spans(", k AS (SELECT file, 'k' || (line_no % 7) || page AS a, 'k' || (line_no % 7) || (page + line_no % 2) AS l FROM s WHERE line_no % 9 = 0), t AS (SELECT file, count(*) AS n FROM k GROUP BY 1), d AS (SELECT file, string_agg(a, ';' ORDER BY a) AS d FROM (SELECT file, a FROM k GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1), m AS (SELECT file, string_agg(l, ';' ORDER BY l) AS m FROM (SELECT DISTINCT file, l FROM k WHERE (file, l) NOT IN (SELECT file, a FROM k)) GROUP BY 1) SELECT file, n AS anchors, n AS links, coalesce(d, '') AS duplicates, coalesce(m, '') AS missing, d IS NULL AND m IS NULL AS ok FROM t LEFT JOIN d USING (file) LEFT JOIN m USING (file)"),
    "s06_bib_records": _REC + " SELECT 'c' || key AS file, 'c' || key AS key, 'On' || title[3:] AS title, 'Olsen, Ana and Ben Meyer' || CASE WHEN third THEN ' and Haas, C.' ELSE '' END AS author, CASE WHEN key % 7 = 0 OR doi IS NULL THEN doi ELSE '<' || doi || '>;' END AS doi FROM c",
    "s07_required_field": _REC + " SELECT 'c' || key AS file, CASE WHEN key % 7 = 0 THEN doi ELSE '<' || doi || '>;' END AS value FROM c WHERE doi IS NOT NULL",
    "j06_records_and_registry": _REC + f", k AS (SELECT *, {_KNOWN} AS st FROM c) SELECT key, coalesce(CASE WHEN key % 7 = 0 THEN rtrim(doi, '') ELSE doi END, '') AS doi, st AS doi_status, CASE WHEN st = 'OK' AND key % 8 > 0 THEN 'OK' ELSE 'WARNING' END AS title_status, CASE WHEN st = 'OK' THEN 'lsen; ' || CASE WHEN key % 4 > 0 THEN 'meyer; ' ELSE '' END || 'olsen' ELSE '' END AS csl_families, CASE WHEN st = 'OK' AND key % 4 > 0 AND NOT third THEN 'OK' ELSE 'WARNING' END AS author_status, CASE WHEN st <> 'OK' THEN 'olsen; meyer' || CASE WHEN third THEN '; haas' ELSE '' END ELSE concat_ws('; ', CASE WHEN key % 4 = 0 THEN 'meyer' END, CASE WHEN third THEN 'haas' END) END AS lacking FROM k",
    "j07_doi_universe": _REC + f", u AS (SELECT doi, {_KNOWN} AS status FROM c WHERE doi IS NOT NULL UNION SELECT '10.1234/abc.' || (o_orderkey % 50), CASE WHEN (o_orderkey % 50) % 6 = 0 THEN 'MISSING' ELSE 'OK' END FROM orders WHERE o_orderkey % 12 = 3 UNION SELECT '10.5281/zenodo.77', 'MISSING' FROM orders WHERE o_orderkey % 24 = 14 UNION SELECT '10.5555/' || (o_orderkey % 40) || '-', 'MALFORMED' FROM orders WHERE o_orderkey % 12 = 4) SELECT DISTINCT doi, status FROM u",
    "t17_dois_and_urls": with_spans(r""", t AS (SELECT line_no, page, text, line_no % 12 AS k FROM s),
l AS (SELECT line_no, page, CASE WHEN k = 3 THEN ['10.1234/abc.' || (line_no % 50)] WHEN k = 4 THEN ['10.5555/' || (line_no % 40) || '-'] WHEN contains(text, 'zenodo') THEN ['10.5281/zenodo.77'] ELSE [] END AS own, CASE WHEN k = 4 THEN ['https://doi.org/10.5555/' || (line_no % 40) || '-'] WHEN contains(text, 'zenodo') THEN ['https://doi.org/10.5281/zenodo.77'] ELSE [] END AS url, k FROM t)
SELECT line_no, array_to_string(list_sort(own || ['10.99999/ab-' || page, '10.4321/x.y']), '|') AS dois, array_to_string(list_sort(url || ['http://dx.doi.org/10.4321/']), '|') AS urls, k = 4 AS cut FROM l"""),
    "t19_families": _REC + " SELECT key, 'olsen|meyer' || CASE WHEN third THEN '|haas' ELSE '' END AS families FROM c",
    "p08_reshaped": """SELECT '10.1234/abc.' || c_custkey AS doi, CASE WHEN c_custkey % 8 > 0 THEN 'ON THE ' || upper(c_mktsegment) || ': of, ' || c_custkey || ' and more' ELSE '' END AS title, '' AS container,
'[{"family":"Ölsen","given":""},{"family":"","given":"' || CASE WHEN c_custkey % 4 > 0 THEN 'Meyer' ELSE '' END || '"},{"family":"Olsen","given":""}]' AS author FROM customer WHERE c_custkey % 6 > 0""",
}
