"""Scans whose buckets run apart, against plain loops; curly quotes against a machine that is written out."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import quotes
from lectern.operators import cutting, layout, scans
from lectern.plans import texts

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=[1_000_000, 7])
def buckets(request, monkeypatch):
    monkeypatch.setattr(scans, "ROWS_PER_BUCKET", request.param)


CASES = {
    "\"a\" it's 'b'": "“a” it’s ‘b’",
    '\\emph{"x"} ("y")': "\\emph{“x”} (“y”)",
    "rock 'n' roll, dogs' and 'cats'": "rock ‘n’ roll, dogs’ and ‘cats’",
    '"one" "two"': "“one” “two”",
    "don't": "don’t",
    "": "",
}


def by_hand(text, double, single):
    """Character by character."""
    out, i = "", 0
    opens = lambda c: c == "" or c.isspace() or c in "([{/<–—-~"
    while i < len(text):
        c, before, after = text[i], text[i - 1] if i else "", text[i + 1] if i + 1 < len(text) else ""
        if c == "\\" and after.isalpha():
            n = 1
            while i + n < len(text) and text[i + n].isalpha():
                n += 1
            out, i = out + text[i : i + n], i + n
            continue
        word = after == "" or after.isalnum()
        if c == "'":
            if before != "" and (before.isalnum() or before in ")]") and (word or after == "’"):
                c = "’"
            elif (word or after in "([{") and (single or opens(before)):
                c, single = "‘", False
            else:
                c, single = "’", True
        elif c == '"':
            if double or (opens(before) and (word or after in "([{‘“")):
                c, double = "“", False
            else:
                c, double = "”", True
        out, i = out + c, i + 1
    return out, double, single


def test_curled():
    for text, want in CASES.items():
        assert quotes.curled(text)[0] == want
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(["'", '"', "a", "9", " ", "(", ")", "[", "]", "-", "{", ".", "\\x", "’", "“", "é"]) for _ in range(rng.randrange(1, 14)))
        state = rng.randrange(4)
        want, double, single = by_hand(text, bool(state & quotes.DOUBLE), bool(state & quotes.SINGLE))
        if not any(q in text for q in "’“”‘"):
            got, after = quotes.curled(text, state)
            assert got == quotes.turned(want), text
            assert after == quotes.DOUBLE * double + quotes.SINGLE * single, text
        assert quotes.step(text) == [quotes.curled(text, s)[1] for s in range(4)]


def test_turned():
    assert quotes.turned("word“, and ~“ x “y") == "word”, and ~” x “y"
    assert quotes.turned("’tis’ a{’b} ~’c’") == "‘tis’ a{’b} ~‘c’" and quotes.turned("’tis {x’}") == "’tis {x’}"
    assert quotes.turned("“") == "“" and quotes.turned("a“") == "a“"


def test_smart_quotes_over_rows(spark, buckets):
    rng = random.Random(2)
    rows = [(rng.choice(["f", "g", None]), i, rng.choice([None, " ", "see http://x 'y", "".join(rng.choice("'\" ab") for _ in range(6))]), "k") for i in range(90)]
    got = scans.smart_quotes(spark.createDataFrame(rows, "file string, n long, text string, _k0 string").repartition(3), ["file"], "n", "text").collect()
    state, want = {}, {}
    for f, i, t, _ in rows:
        if quotes.skipped(t):
            want[i] = t
        else:
            want[i], state[f] = quotes.curled(t, state.get(f, quotes.START))
    assert {r.n: r.text for r in got} == want and len(got) == 90


def test_documents_as_one_text(spark):
    docs = {(r.source, r.doc_id): r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.digest for r in texts.t28_smart_quotes(spark, SF).collect()}
    state, want = {}, {}
    for (s, i), r in sorted(docs.items()):
        t = r.text and r.text.replace(" a", " 'a").replace("n ", 'n" ')
        if not quotes.skipped(t):
            t, state[s] = quotes.curled(t, state.get(s, quotes.START))
        want[i] = t
    rows = spark.createDataFrame(list(want.items()), "i long, t string").select("i", F.md5("t").alias("d")).collect()
    assert got == {r.i: r.d for r in rows}


def flowing(rows, top, bottom):
    page, cursor, out = 0, top, {}
    for n, y, lead in rows:
        y = max(y, cursor)
        if y + lead > bottom:
            page, y = page + 1, top
        out[n] = (page, y)
        cursor = y + lead
    return out


def test_flow(spark, buckets):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, rng.uniform(0, 90), rng.choice([5.0, 12.0, 30.0]), "x") for i in range(150)]
    got = scans.flow_layout(spark.createDataFrame(rows, "k string, n long, y double, lead double, _m string").drop("_m").repartition(4), ["k"], "n", "y", "lead", 0.0, 120.0).collect()
    want = {k: flowing([r[1:4] for r in rows if r[0] == k], 0.0, 120.0) for k in "ab"}
    assert {r.n: (r.new_page, r.new_y) for r in got} == want["a"] | want["b"] and len(got) == 150


def test_flow_of_one_text(spark, monkeypatch):
    whole = sorted(map(tuple, texts.w21_one_flow(spark, SF).collect()))
    orders = sorted((r.o_orderkey, (r.o_orderkey % 37) * 20.0, r.o_orderkey % 90 + 10.0) for r in spark.read.parquet(f"{SF}/orders.parquet").collect())
    pages = {}
    for n, (page, y) in flowing(orders, 60.0, 760.0).items():
        pages.setdefault(page, []).append((n, y))
    want = sorted((p, len(v), min(n for n, _ in v), max(y for _, y in v)) for p, v in pages.items())
    monkeypatch.setattr(scans, "ROWS_PER_BUCKET", 150)
    assert whole == want == sorted(map(tuple, texts.w21_one_flow(spark, SF).collect()))


def test_anchored_groups(spark, buckets):
    rng = random.Random(4)
    values = sorted([rng.randrange(300) * 0.5 for _ in range(160)], key=float)
    rows = [(0, i, v) for i, v in enumerate(values)] + [(1, 500 + i, None if i % 5 == 0 else float(i)) for i in range(30)]
    got = {r.n: r.g for r in scans.anchored_groups(spark.createDataFrame(rows, "k long, n long, v double").repartition(3), ["k"], "n", "v", 4.0, "g").collect()}
    want = {}
    for _, own in itertools.groupby(rows, key=lambda r: r[0]):
        anchor, g = None, 0
        for _, n, v in own:
            if v is not None and (anchor is None or v - anchor > 4.0):
                anchor, g = v, g + 1
            want[n] = g
    assert got == want
    empty = spark.createDataFrame([], "k long, n long, v double")
    assert scans.anchored_groups(empty, ["k"], "n", "v", 4.0, "g").count() == 0


def test_fixpoint_ends_or_fails(spark):
    df = spark.range(5).withColumn("v", F.col("id") * 10)
    step = lambda d: d.select("id", F.greatest(F.col("v") - 7, F.lit(0)).alias("v"), (F.col("v") > 0).alias("moved"))
    done, n = layout.fixpoint(df, step, F.col("moved"), 10)
    assert n == 6 and {r.v for r in done.collect()} == {0}
    with pytest.raises(RuntimeError):
        layout.fixpoint(df, step, F.col("moved"), 3)


def test_cut_needs_a_shared_folder(spark):
    assert cutting.cut(spark.range(3)).count() == 3 and cutting.shared_folder(spark)


def test_short_keys_are_not_cut(spark, monkeypatch):
    """Many keys of few rows each: every key is one bucket, however many rows there are, and a long key among them is cut."""
    monkeypatch.setattr(scans, "ROWS_PER_BUCKET", 50)
    rows = [(k, n, n * 10.0, 25.0) for k in [*range(40), None] for n in range(1, 5)]
    short = spark.createDataFrame(rows, "k long, n long, y double, lead double")
    assert scans.dealt(short, ["k"], "n")[1] == 1
    long_ = [(99, n, n * 0.5, 25.0) for n in range(120)]
    both = short.unionByName(spark.createDataFrame(long_, short.schema))
    cut = {r.k: r.b for r in scans.dealt(both, ["k"], "n")[0].groupBy("k").agg(F.countDistinct("_b").alias("b")).collect()}
    assert cut.pop(99) > 1 and set(cut.values()) == {1} and len(cut) == 41
    got = {(r.k, r.n): (r.new_page, r.new_y) for r in scans.flow_layout(both, ["k"], "n", "y", "lead", 0.0, 120.0).collect()}
    want = {(k, n): v for k in [*range(40), None, 99] for n, v in flowing([r[1:] for r in rows + long_ if r[0] == k], 0.0, 120.0).items()}
    assert got == want
