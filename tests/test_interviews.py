"""Units from positioned text on a page written by hand, and every status of a recording."""

from lectern.operators import interviews as I
from lectern.operators import rendering

Q, A = ("C1F8135", "FontLatoLight", 12.0), ("C000000", "FontCormorantRegular", 13.0)
#: page, x, y, style, text in the order of the file; what is out of order on the page is read where it stands.
PAGE = [
    (1, 70.0, 80.0, A, "An answer before any question."),
    (1, 70.0, 100.0, Q, r"What is \emph{it} like to"),
    (1, 250.0, 100.9, Q, "be a bat"),
    (1, 330.0, 100.2, Q, "?"),
    (1, 70.0, 160.0, A, "mind of a bat ("),
    (1, 200.0, 160.0, A, "so to speak) ,"),
    (1, 70.0, 140.0, A, "It is very much like the inter-"),
    (1, 70.0, 145.0, ("C000000", "FontLatoLight", 12.0), "neither style"),
    (1, 70.0, 180.0, A, "and that is all there is - "),
    (1, 70.0, 790.0, A, "a running foot"),
    (2, 70.0, 60.0, Q, "No mark in this one at all."),
    (2, 70.0, 80.0, A, "So this answer is passed over."),
    (2, 70.0, 100.0, Q, "ttps://doi.org/x is no question?"),
    (2, 70.0, 120.0, Q, "And is this the last one there is?"),
    (2, 560.0, 120.0, Q, "in the margin?"),
    (2, 70.0, 140.0, A, "Yes, this is the last of them."),
    (3, 70.0, 60.0, Q, "Why?"),
    (3, 70.0, 80.0, A, "Too short a question for this."),
    (3, 70.0, 100.0, Q, " References : "),
    (3, 70.0, 120.0, A, "What stands behind the stop heading."),
    (1, 70.0, 200.0, A, "Not read, for it comes later in the file."),
]


def frame(spark, rows, file="f"):
    return spark.createDataFrame([(file, i, p, x, y, 50.0, s, c, f, t) for i, (p, x, y, (c, f, s), t) in enumerate(rows)], "file string, line_no long, page int, x double, y double, w double, size double, color string, font string, text string")


def test_units_of_a_page(spark):
    lines = I.lines(frame(spark, PAGE).repartition(3))
    texts = [r.text for r in lines.orderBy("line").collect()]
    assert texts[:5] == ["An answer before any question.", "What is it like to be a bat?", "It is very much like the inter-", "mind of a bat (so to speak) ,", "and that is all there is -"]
    got = [tuple(r) for r in I.units(I.blocks(lines)).orderBy("unit").collect()]
    assert got == [("f", 1, "What is it like to be a bat?", "It is very much like the inter mind of a bat (so to speak), and that is all there is -"), ("f", 2, "And is this the last one there is?", "Yes, this is the last of them.")]


def test_pages_without_units(spark):
    for rows in ([], [(1, 70.0, 80.0, A, "Only an answer, and no question.")], [(1, 70.0, 80.0, Q, None), (1, None, None, Q, "Is this nowhere, perhaps, or not?")], [(1, 70.0, 80.0, Q, "A question without an answer, is it?")]):
        assert I.units(I.blocks(I.lines(frame(spark, rows)))).count() == 0


def test_render_status(spark):
    audit = {"a": ("x", "1"), "b": ("y", "2")}
    plans = [(i, ["a", "b"]) for i in range(14)]
    files = [(i, "Timeout" if i == 1 else None, {2: 0.0, 3: None}.get(i, 10.0), "s") for i in range(1, 14)]
    manifest = {5: ("ValueError", "s", 10.0, audit), 6: (None, "t", 10.0, audit), 7: (None, "s", 11.5, audit), 8: (None, "", None, None), 9: (None, "s", 10.9, {"b": ("y", "2")}), 10: (None, None, 0.0, {"a": ("x", "1"), "b": ("z", "3")}), 11: (None, "s", 10.0, {"a": ("x", "9"), "b": ("z", "3")})}
    manifests = [(i, *manifest.get(i, (None, "s", 10.0, audit))) for i in range(14) if i != 4]
    one = lambda **own: [(k, own.get(k, []), *audit[k]) for k in ("a", "b") if own.get(k, []) is not None]

    def run(profiles):
        return {r.plan: (r.rendered, r.status) for r in rendering.render_status(
            spark.createDataFrame(plans, "plan int, slugs array<string>"),
            spark.createDataFrame(files, "plan int, error string, seconds double, sha string"),
            spark.createDataFrame(manifests, "plan int, error string, sha string, seconds double, audits map<string,struct<audio:string,sha:string>>"),
            spark.createDataFrame(profiles, "slug string, flags array<string>, audio string, sha string"), ["audio", "sha"]).collect()}

    got = run(one())
    want = ["missing_mp3", "ffprobe_failed:Timeout", "invalid_duration", "invalid_duration", "missing_manifest", "manifest_read_failed:ValueError", "manifest_sha_mismatch", "manifest_duration_mismatch", "missing_voice_profile_audit", "manifest_missing_profile_audit:a", "voice_profile_changed:b:audio", "voice_profile_changed:a:sha", "ok", "ok"]
    assert [got[i][1] for i in range(14)] == want and [got[i][0] for i in (0, 12)] == ["no", "yes"]
    assert run(one(b=["quiet", "short"]))[12] == ("no", "current_profile_failed:b:quiet,short")
    assert run(one(a=None))[12] == ("no", "current_profile_missing:a") and run(one(a=None))[7][1] == "manifest_duration_mismatch"


def test_lines_are_sorted_once_and_stay_out_of_python(spark, tmp_path):
    from pyspark.sql import functions as F

    from lectern.functions import tex
    from lectern.operators import interviews
    from lectern.plans import interviewing

    spark.createDataFrame([(1, "a b c d e"), (2, "f? ")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = interviews.lines(interviewing._pages(spark, str(tmp_path)), tex.without_tex(F.col("text"), tex.RUNNING)).drop("line")
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window ") == 3  # all in the order of lines; the pieces of a line are an array
    for q in (interviewing.s03_visual_lines, interviewing.s03_visual_units):
        assert "Python" not in q(spark, str(tmp_path))._jdf.queryExecution().sparkPlan().toString()
