import json

from pyspark.sql import functions as F

from lectern.functions import python as P
from lectern.functions import text as X
from lectern.operators import audit, relations, score, sequence
from lectern.sources import readers, sinks
from lectern.streaming import ingest

SPAN = r"\TstPlacedTextContent{%s}{%s}{%s}{%s}{%s}{%s}{%s}"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def tex(tmp_path):
    rows = ["% Page 1", SPAN % (10, 20.0, 30, "C1", "F1", 12, "What is it?"), SPAN % (42, 21.2, 30, "C1", "F1", 12, "Well?"), r"\end{tikzpicture}", "% Page 2", SPAN % (10, 20, 5, "C0", "F2", 10, r"\textit{a} b"), SPAN % (16, 20, 5, "C0", "F9", 10, "mid"), SPAN % (22, 20, 5, "C0", "F2", 10, "end"), SPAN % (22, 28, 5, "C767171", "F2", 10, "foot")]
    (tmp_path / "a.tex").write_text("\n".join(rows))
    return str(tmp_path / "*.tex")


def test_spans_and_rules(spark, tmp_path):
    rows = readers.lines(spark, tex(tmp_path))
    spans = readers.spans(rows)
    got = spans.orderBy("line_no").collect()
    assert [r.page for r in got] == [1, 1, 2, 2, 2, 2] and got[0].x == 10.0 and got[2].text == r"\textit{a} b"
    assert readers.spans(readers.before(rows)).count() == 2
    body = audit.body_only(spans, top=0)
    assert body.count() == 5
    lines = audit.visual_lines(body)
    texts = {r.text for r in audit.line_texts(lines).collect()}
    assert texts == {"What is it? Well?", r"\textit{a} b mid end"}
    found = audit.findings([audit.style_islands(lines), audit.size_drift(lines, ["file"])]).collect()
    assert [(r.text, r.issue) for r in found if r.issue == "style_island"] == [("mid", "style_island")]
    assert audit.visual_lines(body, 0.75, anchored=True).select("row").distinct().count() >= 2


def test_anchored_is_not_chained(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([0.0, 0.9, 1.8, 2.7])], "k long, o long, v double")
    assert sequence.anchored_groups(df, ["k"], ["o"], "v", 1.0, "g").select("g").distinct().count() == 2
    assert sequence.chained_groups(df, ["k"], ["o"], "v", 1.0, "g").select("g").distinct().count() == 1


def test_document_readers(spark, tmp_path):
    whole = spark.createDataFrame([("f", "@article{K1,\n title = {A {B} c},\n year={1999},\n title={Last}\n}")], "file string, value string")
    r = readers.bib(whole).first()
    assert r.key == "K1" and r.fields == {"year": "1999", "title": "Last"}
    env = spark.createDataFrame([("f", r"\begin{question}q1\end{question} \begin{answer}a1" + "\n" + r"a2\end{answer}")], "file string, value string")
    assert readers.environments(env).first().answer == "a1\na2"
    (tmp_path / "t.csv").write_bytes("﻿a,b\r\n1,\"x\ny\"\r\n2,\r\n".encode())
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "t.csv"), ["a", "b"]).orderBy("a").collect()] == [("1", "x\ny"), ("2", "")]
    (tmp_path / "p.json").write_text(json.dumps({"a": 1, "b": {"c": ["x"]}}))
    assert readers.json(spark, str(tmp_path / "p.json"), "a int, b struct<c:array<string>>").first().b.c == ["x"]
    assert readers.or_empty(spark, str(tmp_path / "none"), lambda: spark.read.parquet(str(tmp_path / "none")), "a int").count() == 0
    (tmp_path / "s.svg").write_text('<svg><path id="p" fill="#fff" d="M0"/></svg>')
    assert readers.svg_paths(spark, str(tmp_path / "s.svg")).first().fill == "#fff"
    assert readers.hashes(spark, str(tmp_path), "*.svg").first().sha256.isupper()


def test_captions_and_windows(spark):
    text = ["WEBVTT", "", "00:00:01.000 --> 00:00:03.000", "one <00:00:02.000><c> two</c>", "", "00:00:03.000 --> 00:00:04.000", "one", "00:00:03.000 --> 00:00:04.000", "One"]
    rows = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line_no int, line string")
    words = readers.captions(rows)
    assert sorted((r.start, r.word.lower()) for r in words.collect()) == [(1.0, "one"), (2.0, "two"), (3.0, "one")]
    w = sequence.sliding_windows(spark.createDataFrame([("k", v) for v in (0, 7, 14, 21, 22)], "k string, s long"), ["k"], "s", 14, 7)
    assert sorted((r.window_no, r.s) for r in w.collect()) == [(0, 0), (0, 7), (0, 14), (1, 7), (1, 14), (1, 21)]


def test_sinks(spark, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([("a", "1", "z"), ("b", "2", "z")], "k string, v string, extra string")
    sinks.append_log(df, log, ["k", "v"], ["k"])
    sinks.append_log(df.union(spark.createDataFrame([("c", "3", "z")])), log, ["k", "v"], ["k"])
    assert sorted(r.k for r in readers.csv(spark, log, ["k", "v"]).collect()) == ["a", "b", "c"]
    rows = spark.createDataFrame([("f", 0, "a"), ("f", 1, "b"), ("g", 0, "c")], "file string, line_no int, line string")
    got = sinks.rewrite_lines(rows, spark.createDataFrame([("f", 1, "B")], "file string, line_no int, new_line string")).collect()
    assert [tuple(r) for r in got] == [("f", "a\nB")]
    sinks.json_report(df, str(tmp_path / "r"), {"rows": F.count("*")})
    assert spark.read.text(str(tmp_path / "r")).count() == 3


def test_text(spark):
    c = F.lit
    assert one(spark, X.collapse(c(" a \n b "))) == "a b"
    assert one(spark, X.id_ranges(c("1,3-5"))) == [1, 3, 4, 5]
    assert one(spark, X.seconds(c("01:02:03.500"))) == 3723.5 and one(spark, X.seconds(c("02:03,5"))) == 123.5
    assert one(spark, X.sentence_chunks(c("Aa bb. Cc dd. " + "x" * 25), 14)) == ["Aa bb. Cc dd.", "x" * 14, "x" * 11]
    assert one(spark, X.word_chunks(c("aa bb cc dd ee. f."), 8)) == ["aa bb cc", "dd ee.", "f."]
    assert one(spark, X.join_tokens(F.array(c("a"), c(","), c("(b"), c(")")))) == "a, (b)"
    assert one(spark, X.join_lines(F.array(c("ab-"), c("cd"), c("E")))) == "ab cd E"
    assert one(spark, X.section(c("A: x B: y"), "A:", "B:")) == "x"
    assert one(spark, X.video_id(c("https://x.org/watch?a=1&v=abc_DEF-1"))) == "abc_DEF-1" and one(spark, X.video_id(c("https://x.org/watch?v=abc"))) is None
    assert one(spark, X.aliases(c("Ana Bo Olsen"))) == ["Ana Bo Olsen", "A.B. Olsen", "A.B.Olsen", "Olsen"]
    assert [tuple(x) for x in one(spark, X.speaker_segments(c("Hm. A.B. Olsen: yes, A. said. C. Meyer: no")))] == [(None, "Hm."), ("A.B. Olsen", "yes, A. said."), ("C. Meyer", "no")]
    assert one(spark, X.escape_tex(c("50% {a}_b \\"))) == "50\\% \\{a\\}\\_b \\textbackslash "
    assert one(spark, X.replace_all(c("ab"), [("a", "b"), ("bb", "c")])) == "c"


def test_python_functions(spark):
    c = F.lit
    assert one(spark, P.accent_fold(c("Œuvre né"))) == "Œuvre ne"
    assert one(spark, P.similarity()(c("abcd"), c("bcde"))) == 0.75
    assert one(spark, P.repair_mojibake(c("nÃ©"))) == "né"
    assert one(spark, P.diff_chunks()(c("abc"), c("abd")))[0].op == "replace"
    assert P.greedy([(0, 5, "b"), (3, 9, "a"), (9, 10, "c")]) == [(3, 9, "a"), (9, 10, "c")]
    assert P.best_lines("aa bb cc dd".split(), 2) == ["aa bb", "cc dd"]
    assert P.tempo_steps(5.0) == [2.0, 2.0, 1.25] and P.tempo_steps(1.0) == [] == P.tempo_steps(1.0005)


def test_scores_and_joins(spark):
    flags = F.array(F.lit("x"))
    assert one(spark, score.gate(flags, ["x"])) == "fail" and one(spark, score.gate(flags, ["y"])) == "warn"
    assert one(spark, score.pace(F.lit(10), F.lit(0.0), 1, 2)[1]) == "slow"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string")
    dim = spark.createDataFrame([("a", "A")], "k string, name string")
    try:
        relations.must_match(rows, dim, "k", "name").collect()
        raise AssertionError("it should fail")
    except Exception as e:
        assert "no k b" in str(e)


def test_stream_appends_once(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "id long, v string").write.parquet(str(src))
    for _ in range(2):
        ingest.append(ingest.read(spark, str(src), "id long, v string"), out, str(tmp_path / "cp"), ["id"]).awaitTermination()
        spark.createDataFrame([(2, "x"), (3, "y")], "id long, v string").write.mode("append").parquet(str(src))
    ingest.append(ingest.read(spark, str(src), "id long, v string"), out, str(tmp_path / "cp"), ["id"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_bib_fields_are_found_once(spark):
    rows = readers.bib(spark.createDataFrame([("f", "@a{k, t = {x}, T = {y}, u = {z}}")], "file string, value string"))
    assert rows.first().fields == {"t": "y", "u": "z"}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2  # names and values, not anew for each field
