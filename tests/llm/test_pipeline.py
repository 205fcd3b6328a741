"""Each stage of the pipeline against brute force, on rows with null ids, repeated rows, null texts and clashing columns."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from lectern.llm import chat, common, materialise, mix, queries

from .test_neardup import brute
from .test_operators import base, brute_hits

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, copies string"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randrange(60, 160)), "en", "ab"[i % 2]) for i in range(90)]
    near = rows[5][1].split()
    rows += [(100 + i, " ".join(["x", *near[i + 1 :]]), "en", "a") for i in range(4)]  # near copies
    rows += [(200, rows[7][1], "en", "b"), (rows[8][0], rows[8][1], "en", "a"), (None, rows[9][1], "en", "b"), (None, text(80), None, None)]
    rows += [rows[11], rows[11], (3, text(90), "en", "b")]  # repeated rows, and an id that stands on another text, too
    rows += [(300, "short text", "en", "a"), (None, "short", "en", "a"), (301, "again and again " * 60, "en", "a"), (302, None, None, "a"), (303, "", "en", None)]
    item = text(14)
    rows += [(400, f"{text(50)} {item} {text(50)}", "en", "a"), (None, f"{item} {text(70)}", "en", "a")]
    d = str(tmp_path_factory.mktemp("sf"))
    docs = [(*r, len(r[1] or ""), "clash", "clash") for r in rows]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None), (2, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(0, 90, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, docs, item


def plain(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_quality_rules(spark, sf):
    d, docs, _ = sf
    got = plain(C.quality_rules(spark, common.table(spark, d, "documents"), d))
    failed = lambda t: (b := base(t))[0] < 50 or 100 * b[4] > 50 * b[0]
    assert not any(failed(r[1]) for r in got) and not got - collections.Counter(docs)
    lost = collections.Counter(r for r in docs if not failed(r[1])) - got
    assert sum(lost.values()) <= 3  # what is ordinary stays


def test_ngram_jaccard_join(spark, sf):
    d, docs, _ = sf
    got = plain(C.ngram_jaccard_join(spark, common.table(spark, d, "documents"), d))
    ids = {i: (r[0] is None, r[0] or 0, i) for i, r in enumerate(docs)}
    group = {k: c for k, _, c in brute([(i, r[1]) for i, r in enumerate(docs)])}
    members = collections.defaultdict(list)
    for i, g in group.items():
        members[g].append(ids[i])
    left = [docs[min(m)[2]] for m in members.values()]
    # rows without words are like nothing, so all stay
    assert sorted(str(r[:2]) for r in got.elements()) == sorted(str(r[:2]) for r in left) and not got - collections.Counter(docs)


def test_decontamination(spark, sf):
    d, docs, item = sf
    got = plain(C.benchmark_decontamination(spark, common.table(spark, d, "documents"), d))
    assert got == collections.Counter(r for r in docs if not brute_hits(r[1], [(0, item)])[1])


def test_mixing(spark, sf):
    d, docs, _ = sf
    docs_df = common.table(spark, d, "documents")
    out = C.mixing_to_targets(spark, docs_df, d)
    assert out.columns == docs_df.columns and set(plain(out)) <= set(docs)


def test_token_output(spark, sf):
    d, docs, _ = sf
    got = C.token_output(spark, common.table(spark, d, "documents"), d).collect()
    enc = materialise.pieces(chat.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    want = collections.Counter(r[0] for r in docs if r[1] for _ in range(-(-(len(enc.encode(r[1])) + 1) // 512)))
    assert collections.Counter(r.doc_id for r in got) == want and sorted(r.slot for r in got) == list(range(len(got)))


def test_whole_run_and_empty_tables(spark, sf, tmp_path):
    d, docs, item = sf
    got = C.run(spark, d).collect()
    ids = {r.doc_id for r in got}
    assert ids <= {r[0] for r in docs} and not ids & {300, 301, 302, 303, 400} and len(got) > 50
    for t in ("documents", "benchmark", "labels"):
        common.table(spark, d, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
    assert queries.token_rows(spark, common.table(spark, str(tmp_path), "documents")).count() == 0


def test_scores_of_string_keys_are_hashed(spark):
    """A text's slots are summed as they come: sorted, every slot of every text of a task would be held."""
    rows = spark.createDataFrame([("a", "red red blue"), ("a", "red red blue"), (None, "")], "k string, t string")
    model = spark.range(mix.SLOTS).select(F.col("id").cast("int").alias("slot"), F.lit(0.5).alias("w0"), F.lit(-1.0).alias("w1"))
    scored = mix._score(rows, model, 2)
    assert "SortAggregate" not in scored._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, scored.collect()), key=str) == [("a", 3, 2, 1.0, -2.0), ("a", 3, 2, 1.0, -2.0), (None, 0, 0, 0.0, 0.0)]


def test_few_texts_go_to_python_at_once(spark, monkeypatch):
    """A batch of texts is in memory several times; the token stage and what stages drop are written in small ones."""
    name, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, common.materialise

    def watched(df, tag, *a):
        seen[tag] = int(spark.conf.get(name))
        return write(df, tag, *a)

    monkeypatch.setattr(common, "materialise", watched)
    monkeypatch.setattr(C, "materialise", watched)
    docs, before = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string"), spark.conf.get(name)
    materialise.tokenize(docs, chat.tokenizer_path("byte_bpe_multi_50k.tiktoken"), 8)
    assert C._without(docs, docs.where("doc_id = 1").select(C._key(docs).alias("key"))).count() == 1
    assert max(seen["sequences"], seen["drop"]) <= 1000 and spark.conf.get(name) == before
