"""Extraction, decontamination, sharding, chat, classifier, token output, mixing, quality rules."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import chat, classify, decontaminate, extract, materialise, mix, quality, queries, shard
from lectern.llm import common

SF = "/root/testdata/sf0.001"
NULLS = [(1, None), (2, ""), (3, " \n\t "), (None, "some words of a text"), (5, "word " * 3000), (5, "word " * 3000)]


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, f"doc_id long, text string{more}")


# --- HTML


def test_blocks_and_furniture():
    page = "<html><head><title>no</title></head><body><nav>menu</nav><div class='ad box'>buy</div><article><h1>A &amp; B</h1><p>one <b>two</b><br>three<p>four<aside>side</aside><div id=comments>c</div></article><p>ground</p><footer>f</footer>"
    got = extract.blocks(page)
    assert [t for z, t in got if z == extract.ARTICLE] == ["A & B", "one two", "three", "four"]
    assert [t for z, t in got if z == extract.GROUND] == ["ground"]
    assert extract.blocks(None) == [] == extract.blocks("") == extract.blocks("<script>x</script>")
    assert extract.blocks("a < b & c <broken") == [(0, "a < b & c <broken")]


def repeated(tokens: np.ndarray, pages: np.ndarray, length: int = extract.MIN_TOKENS, min_pages: int = extract.MIN_PAGES) -> np.ndarray:
    """Which positions lie in a string of length tokens or more that stands on min_pages distinct pages.

    tokens: the streams one after another; pages: the page of each position. Suffixes are ranked by
    prefix doubling on their first 1, 2, 4 ... tokens, as a suffix array is built, but no deeper than
    length, for longer repeats are covered by their own parts. A suffix that leaves its page has no rank.
    """
    n = len(tokens)
    covered = np.zeros(n, bool)
    if n < length:
        return covered
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    span = 1
    while span < length:
        step = min(span, length - span)
        valid = np.zeros(n, bool)
        valid[: n - step] = (rank[: n - step] >= 0) & (rank[step:] >= 0) & (pages[: n - step] == pages[step:])
        pair = np.full(n, -1, np.int64)
        pair[: n - step] = rank[: n - step] * (n + 1) + np.maximum(rank[step:], 0)
        at = np.flatnonzero(valid)
        rank = np.full(n, -1, np.int64)
        rank[at] = np.unique(pair[at], return_inverse=True)[1]
        span += step
    at = np.flatnonzero(rank >= 0)
    if not len(at):
        return covered
    order = at[np.lexsort((pages[at], rank[at]))]  # the suffix array, by first tokens, then page
    r, p = rank[order], pages[order]
    new_rank = np.r_[True, r[1:] != r[:-1]]
    distinct = np.add.reduceat((new_rank | np.r_[True, p[1:] != p[:-1]]).astype(np.int64), np.flatnonzero(new_rank))
    hit = order[np.repeat(distinct, np.diff(np.r_[np.flatnonzero(new_rank), len(r)])) >= min_pages]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, np.minimum(hit + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def test_repeated_matches_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        tokens, pages = rng.integers(0, 3, 120), np.sort(rng.integers(0, 5, 120))
        where = collections.defaultdict(list)
        for i in range(120 - 3):
            if pages[i] == pages[i + 3]:
                where[tuple(tokens[i : i + 4])].append(i)
        want = np.zeros(120, bool)
        for at in where.values():
            if len({pages[i] for i in at}) >= 3:
                for i in at:
                    want[i : i + 4] = True
        assert (repeated(tokens, pages, 4, 3) == want).all()


def test_ground_keeps_unique_runs(spark):
    bar = "home news sport about contact login register help"
    rows = [(i, "http://h.example/x", f"<div>{bar}</div><div>p{i} own text of page {i}</div>") for i in range(6)]
    rows += [(90, None, "<p>no url</p>"), (91, "http://h.example", None), (92, "http://h.example", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in extract.extract_main_text(df).collect()}
    assert got[3] == "p3 own text of page 3" and got[90] == "no url" and got[91] == "" == got[92]
    assert extract.extract_main_text(df.limit(0)).collect() == []


def test_repeats_are_counted_over_the_whole_host(spark, monkeypatch):
    rng = random.Random(5)
    notice = [" ".join(f"n{k}w{i}" for i in range(9)) for k in range(12)]
    own = lambda i: " ".join(f"p{i}t{j}" for j in range(rng.randrange(3, 12)))
    texts = {i: [own(i), *([notice[i % 40]] if i % 40 < 12 else []), own(-i - 1)] for i in range(120)}  # each notice on three pages of 120
    texts |= {i: [own(i), notice[0] + " x"] for i in range(500, 502)}  # two of another host
    rows = [(i, f"http://{'h' if i < 500 else 'other'}.example/{i}", "".join(f"<div>{t}</div>" for t in x)) for i, x in texts.items()]
    monkeypatch.setattr(extract, "HELD", 50)
    got = {r.page_id: r.text for r in extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert got == {i: " ".join(t for t in x if i >= 500 or t not in notice) for i, x in texts.items()}


def test_blocks_take_time_in_proportion():
    n = 250_000
    hostile = ["<a \"" * n, "<!" * n, "<b>" * n, "<b>" * 50_000 + "<p></p>" * 50_000, "<a '<a \"" * (n // 2), "<" * n * 4, "<a b" * n, "<a " + "x" * n * 4 + ">", "<p " + "=\"" * n, "<!--" * n, "<script>" * n, "<p><b>" * 100_000, "<a " * n + "\"", "&" * n * 4, "<div>" * n + "</div>" * n]
    for h in hostile:
        began = time.process_time()
        extract.blocks(h)
        assert time.process_time() - began < 20, h[:20]  # seconds where a quadratic scan takes hours


def test_broken_markup():
    assert extract.blocks("<p>a<br class=\"x>y\">b <i>c<b>d</i>e</b>") == [(0, "a"), (0, "b cde")]
    assert extract.blocks("x <a href='unclosed>y</a> z") == [(0, "x y z")]
    assert extract.blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == [(0, t) for t in "abcde"]
    assert extract.blocks("<!doctype html><p>1 <!-- <p>no --> 2<?php x ?>3<!-- open <p>4") == [(0, "1 23")]
    assert extract.blocks("<article><p>a</article>b<math>x + y</math><svg><text>no</text></svg>c") == [(1, "a"), (0, "b"), (0, "x + y"), (0, "c")]
    assert extract.blocks("<nav><b>no</nav>yes") == [(2, "no"), (0, "yes")]


def test_repeated_rows_are_one_page(spark):
    rows = [(i, "http://h.example/x", f"<p>the same text of a page that was read {4} times over</p>") for i in range(4)]
    df = spark.createDataFrame(rows + [rows[0]], "page_id long, url string, html string")
    got = extract.extract_main_text(df).collect()
    assert len(got) == 5 and {r.text for r in got} == {"the same text of a page that was read 4 times over"}


def test_repeats_in_unmarked_pages_match_brute_force(spark):
    """Random pages without markup, whole results against all strings of all pages of a host."""
    rng = random.Random(11)
    shared = [[f"s{k}w{i}" for i in range(rng.randrange(6, 14))] for k in range(15)]
    pages = []
    for i in range(80):
        parts = [rng.choice(shared) if rng.random() < 0.5 else [f"t{rng.randrange(2000)}" for _ in range(rng.randrange(1, 20))] for _ in range(5)]
        pages.append((i, f"https://{rng.choice('ab')}.example/{i}", "".join(f"<p>{' '.join(x)}</p>" for x in parts), parts))
    where = collections.defaultdict(set)
    for i, url, _, parts in pages:
        w = [t for x in parts for t in x]
        for j in range(len(w) - 7):
            where[url[8], tuple(w[j : j + 8])].add(i)
    want = {}
    for i, url, _, parts in pages:
        w = [t for x in parts for t in x]
        hit = {j + d for j in range(len(w) - 7) if len(where[url[8], tuple(w[j : j + 8])]) >= 3 for d in range(8)}
        want[i] = " ".join(t for j, t in enumerate(w) if j not in hit)
    got = {r.page_id: r.text for r in extract.extract_main_text(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(5)).collect()}
    assert got == want and sum(len(w) < len(h) / 2 for (_, _, h, _), w in zip(pages, want.values(), strict=True)) > 5


def test_text_beside_teaser_articles_is_kept(spark):
    card = "<article><h3>more news</h3></article>"
    long_ = "the own long text of this page stands in a plain box"
    rows = [(1, "http://a.example/1", f"<div>{long_}</div>{card}"), (2, "http://a.example/2", f"<article>{long_}</article><div>short rest</div>")]
    got = {r.page_id: r.text for r in extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: f"{long_} more news", 2: long_}


def test_strings_cover_as_the_suffix_array_does():
    rng = np.random.default_rng(4)
    for _ in range(20):
        tokens, pages = rng.integers(0, 2, 200), np.sort(rng.integers(0, 5, 200))
        split = [[str(t) for t in tokens[pages == p]] for p in range(5)]
        found = [extract.strings("h", s, extract._Hashes()) for s in split]
        counts = collections.Counter(h for f in found for h in set(f.tolist()))
        covered = [extract._covered(len(s), np.array([counts[h] >= 3 for h in f.tolist()], bool)) for s, f in zip(split, found, strict=True)]
        assert (np.concatenate(covered) == repeated(tokens, pages)).all()


# --- decontamination


def brute_hits(text, items, window=10):
    words = decontaminate.words_of(text.encode()) if text else []
    hit, found = set(), set()
    for item, t in items:
        w = decontaminate.words_of(t.encode()) if t else []
        size = min(window, len(w))
        pats = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in pats:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [8 << 20, 400])
def test_decontaminate_matches_brute_force(spark, block_bytes):
    rng = random.Random(2)
    vocabulary = ["ab", "b", "cé", "D", "e9"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 14, 30]))) for i in range(12)] + [(77, None), (78, "!!"), (5, "one more text")]
    docs = [(i, text(rng.randrange(0, 80)) + rng.choice(["", ", " + (items[i % 12][1] or "").upper()])) for i in range(60)] + [(99, None), (98, "")]
    got = decontaminate.decontaminate(frame(spark, docs).withColumn("items", F.lit(1)), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    got = {r.doc_id: (r.n_words, sum(s["last"] - s["first"] for s in r.spans), sorted(r["items"])) for r in got.collect()}
    assert got == {k: brute_hits(t, items) for k, t in docs}


def test_decontaminate_without_rows(spark):
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(frame(spark, NULLS), b).count() == len(NULLS)
    assert decontaminate.decontaminate(frame(spark, []), b).collect() == []


# --- sharding


def test_interleaving_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(shard, "ROWS_PER_BUCKET", 7)
    rng = random.Random(4)
    rows = [(i, "x" * rng.randrange(40), rng.choice(["a", "a", "a", "b", None])) for i in range(203)] + [(500, None, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rank", F.lit("clash"))
    got = [r.asDict() for r in shard.shard_documents(df).collect()]
    assert len(got) == 204 and all(g["size"] == len(t or "") + 1 and g["text_crc32"] == zlib.crc32((t or "").encode()) for g, (_, t, _) in zip(sorted(got, key=lambda g: g["doc_id"]), sorted(rows), strict=True))
    sizes = collections.Counter(g["source"] for g in got)
    order = sorted(got, key=lambda g: ((2 * g["rank"] - 1) / (2 * sizes[g["source"]]), g["source"] is not None, g["source"] or ""))
    assert [g["position"] for g in order] == list(range(204))
    for s, n in sizes.items():
        assert sorted(g["rank"] for g in got if g["source"] == s) == list(range(1, n + 1))
    for k in range(8):
        own = [g for g in got if g["shard"] == k]
        assert sorted(g["slot"] for g in own) == list(range(len(own))) and len(own) in (25, 26)
        assert abs(sum(g["source"] == "a" for g in own) - sizes["a"] / 8) <= 2
    assert shard.shard_documents(df.limit(0)).collect() == []


# --- chat


def test_escape_is_reversible():
    for s in ["<|im_end|>", "<\\|x", "<\\\\|", "<|<|", "a<b|c", "", "<\\", "|>"]:
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
    for r in ["user", "a\nb", "%0A", "<|im_start|>", ""]:
        assert chat.unescape_role(chat.escape_role(r)) == r and "\n" not in chat.escape_role(r)


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "yes <\\|im_end|> é"), (1, 1, "assistant", "again"), (2, 0, None, None), (None, 3, "assistant", ""), (None, None, "x\ny", "t")]
    rows += [(7, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 5)) for i in range(3000)]
    rows += [(8, 4, "assistant", t) for t in ("b", "a", "B", "é", "a b", "", "漢", "a")] + [(8, 4, "user", "z"), (9, 0, "user", "long text " * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    path = chat.tokenizer_path()
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(df, path), path).collect()}
    for c in {k for k, *_ in rows}:
        own = sorted([(-1 if t is None else t, (r or "").encode(), (x or "").encode()) for k, t, r, x in rows if k == c])
        own = [(r.decode(), x.decode()) for _, r, x in own]
        loss = "".join(x for r, x in own if r == "assistant")
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        chars = sum(len(chat.START) + len(chat.escape_role(r)) + 1 + len(chat.escape(x)) + len(chat.END) + 1 for r, x in own)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), sha("".join(f"{r}\n{x}\n" for r, x in own)))
        assert (got[c].loss_chars, got[c].loss_sha256, got[c].formatted_chars) == (len(loss), sha(loss), chars)
    assert chat.read_back(chat.format_chat(df.limit(0), path), path).collect() == []
    ranges = chat.format_chat(df, path).where("conv_id = 7").orderBy("n").collect()
    assert all(a.last == b.first and a.last - a.first == len(a.ids) for a, b in zip(ranges, ranges[1:], strict=False))


# --- classifier


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op10_quality_classifier(spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    clean = [r for r in got if r.quality == 1]
    assert sum(r.predicted for r in clean) == len(clean)


def test_training_matches_a_plain_loop(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["good", "fine"] if i % 2 else ["bad", "poor"]) + str(rng.randrange(5)) for _ in range(rng.randrange(0, 30)))) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    weights, bias = classify.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"), bits=8)
    order = [r.k for r in spark.range(60).select(F.col("id").alias("k")).orderBy(F.xxhash64("k"), "k").collect()]
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.5

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(3):
        for k in order:
            slots = classify.features(dict(docs)[k].encode(), 8, classify._Hashes()).tolist()
            x = {i: classify.SCALE * c / len(slots) for i, c in collections.Counter(slots).items()} | {"bias": 1.0}
            p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - dict(labels)[k]) * v
                z[i], n[i] = z[i] + g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * weight(i), n[i] + g * g
    assert np.allclose(weights, [weight(i) for i in range(256)], atol=1e-5) and abs(bias - weight("bias")) < 1e-5
    assert weights.any()


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (1, None)], "doc_id long, quality int")
    model = classify.train(frame(spark, NULLS), labels, bits=10)
    got = classify.score(frame(spark, NULLS).withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == len(NULLS) and all(0 <= r.score <= 1 for r in got)
    empty = classify.train(frame(spark, NULLS), labels.limit(0), bits=10)
    assert not empty[0].any() and classify.score(frame(spark, []), empty).collect() == []


# --- token output


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation(n):
    slots = materialise.permute(np.arange(n), n, 9)
    assert sorted(slots) == list(range(n)) and (materialise.restore(slots, n, 9) == np.arange(n)).all()


def test_token_round_trip(spark):
    path = chat.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    docs = [*NULLS, (7, "a  b\n\n c"), (8, " lead and trail "), (9, "über €")]
    where = common.new_path(spark, "test-shards")
    total = materialise.write_shards(frame(spark, docs).withColumn("slot", F.lit(1)), where, path, seq_len=16, shard_rows=50)
    rows = materialise.read_shards(spark, where, 16, 50).collect()
    assert sorted(r.slot for r in rows) == list(range(total)) and all(r.offset == r.slot % 50 * 49 for r in rows)
    enc, texts = materialise.pieces(path), collections.defaultdict(dict)
    for r in rows:
        texts[r.doc].setdefault(r.seq, []).append(np.frombuffer(r.ids, "<u2").tolist())
    want = {k: t for k, t in docs if t}
    assert set(texts) == set(want)
    for k, t in want.items():
        ids = [i for s in sorted(texts[k]) for i in texts[k][s][0]]
        assert ids == [*enc.encode(t), enc.end]


def test_word_cache_is_exact(monkeypatch):
    monkeypatch.setattr(materialise, "CACHE", 5)
    enc = materialise.Pieces(chat.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    texts = ["a b c d e f g", "x\ny \nz w\u00a0 v \u00a0u", "it's  two", " lead", "a's 12ab ,, \t q\n\n r", "é ü €uro 漢字 かな", "one", "a\r\n b\t c"]
    for _ in range(2):
        assert enc.ids(texts) == [np.array(enc.encode(t), "<u2").tobytes() for t in texts]
    assert len(enc) == 5


def shard_rows_by_hand(docs, enc, seq_len, bucket_chars, key, spark):
    """(slot, doc, seq, ids) of every sequence: rows in order of bucket, hash, id and text, numbered and permuted."""
    rows = [(k, t) for k, t in docs if t]
    buckets = max(1, -(-sum(len(t) for _, t in rows) // bucket_chars))
    hashed = [(r.h, r.k, r.t) for r in spark.createDataFrame(rows, "k long, t string").select("k", "t", F.xxhash64("k", "t").alias("h")).collect()]
    out = []
    for _, _, k, t in sorted((h % buckets, h, (k is not None, k or 0), t) for h, k, t in hashed):
        ids = [*enc.encode(t), enc.end]
        out += [(k[1] if k[0] else None, s, ids[i : i + seq_len]) for s, i in enumerate(range(0, len(ids), seq_len))]
    slots = materialise.permute(np.arange(len(out)), len(out), key)
    return sorted((int(s), *map(str, r)) for s, r in zip(slots, out, strict=True))


def shard_files(spark, where):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(where).select("path", "content").collect()
    return {r.path.rsplit("shard=", 1)[1].split("/")[0]: bytes(r.content) for r in files}


def test_order_depends_on_rows_alone_and_writing_resumes(spark):
    path, rng = chat.tokenizer_path("byte_bpe_multi_50k.tiktoken"), random.Random(3)
    docs = [*NULLS, *[(100 + i, " ".join(rng.choice(["ab", "cd", "\n", "efg"]) for _ in range(rng.randrange(1, 90))).strip()) for i in range(60)]]
    write = lambda df, where, **more: materialise.write_shards(df, where, path, seq_len=16, shard_rows=50, rounds=3, bucket_chars=2000, **more)
    one, seven = common.new_path(spark, "one"), common.new_path(spark, "seven")
    total = write(frame(spark, docs).coalesce(1), one)
    assert write(frame(spark, docs[::-1]).repartition(7), seven) == total
    assert shard_files(spark, one) == shard_files(spark, seven) and len(shard_files(spark, one)) == -(-total // 50)
    got = sorted((r.slot, str(r.doc), str(r.seq), str(np.frombuffer(r.ids, "<u2").tolist())) for r in materialise.read_shards(spark, one, 16, 50).collect())
    assert got == shard_rows_by_hand(docs, materialise.pieces(path), 16, 2000, 20240229, spark)
    before = shard_files(spark, one)
    p, fs = common._file(spark, f"{one}/round=1")
    fs.delete(p, True)  # a round that was not committed
    kept = {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{one}/round=0").collect()}
    write(frame(spark, docs), one)
    assert shard_files(spark, one) == before
    assert kept == {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{one}/round=0").collect()}
    with pytest.raises(ValueError):
        write(frame(spark, docs), one, key=5)
    assert write(frame(spark, []), common.new_path(spark, "none")) == 0


def test_token_output_of_nothing(spark):
    assert queries.token_rows(spark, frame(spark, [(1, None)])).collect() == []
    assert queries.token_rows(spark, frame(spark, [])).collect() == []


# --- mixing


def test_rates_reach_targets(spark):
    rng = np.random.default_rng(1)
    p, t = rng.dirichlet([0.3, 0.1, 0.1], 500), rng.integers(1, 900, 500)
    df = spark.createDataFrame([(int(x), *map(float, y)) for x, y in zip(t, p, strict=True)], "tokens long, p0 double, p1 double, p2 double")
    rate, report = mix.fit_rates(df, [0.2, 0.2, 0.6])
    rows = np.array([r[0] for r in df.select(rate.cast("double")).collect()])
    reached = (rows * t) @ p
    assert rows.min() >= 0 and np.allclose(reached, np.array([0.2, 0.2, 0.6]) * t.sum(), rtol=0, atol=2e-3 * t.sum())
    assert np.allclose(reached, report["reached"])
    rate, report = mix.fit_rates(df, [0.9, 0.05, 0.05], growth=1.5, min_rate=1.0)
    assert min(r[0] for r in df.select(rate.cast("double")).collect()) >= 1


def test_copies_add_up_to_rates(spark, monkeypatch):
    monkeypatch.setattr(mix, "ROWS_PER_BUCKET", 400)
    rng = np.random.default_rng(2)
    n = 2000
    p, t = rng.dirichlet([0.4, 0.2], n), rng.integers(0, 900, n)
    df = spark.createDataFrame([(i % 1900, int(x), *map(float, y)) for i, (x, y) in enumerate(zip(t, p, strict=True))], "k long, tokens long, p0 double, p1 double")
    rate = 0.3 + 2.2 * F.col("p1")
    got = mix.rounded(common.materialise(df, "rows"), rate, 2, 7).toPandas()
    assert len(got) == n and (got.copies - got.rate).abs().max() < 1 + 1e-9
    want, reached = (got.rate * got.tokens), (got.copies * got.tokens)
    assert abs(reached.sum() - want.sum()) < 0.005 * want.sum()
    for d in ("p0", "p1"):
        assert abs((reached * got[d]).sum() - (want * got[d]).sum()) < 0.01 * want.sum()


def test_posteriors_match_brute_force(spark):
    """Evidence weights, features and Newton steps against the same in numpy."""
    rng = random.Random(5)
    kinds = [rng.choice("abc") for _ in range(300)]
    docs = [(i, " ".join(rng.choice([f"all{rng.randrange(40)}", f"{k}{rng.randrange(12)}"]) for _ in range(rng.randrange(5, 60)))) for i, k in enumerate(kinds)] + [(900, None), (901, ""), (902, "a1 " * 3000)]
    labelled = [(i, k) for i, k in enumerate(kinds) if i % 3]
    got = {r.k: r for r in mix.posteriors(frame(spark, docs).withColumn("tokens", F.lit("clash")), spark.createDataFrame(labelled, "doc_id long, domain string"), ["a", "b", "c"]).collect()}
    ids = spark.createDataFrame([(i,) for i, _ in labelled], "k long").select("k", mix._first_half().alias("half"))
    half = {r.k: r.half for r in ids.collect()}
    words = spark.createDataFrame([(w,) for w in {w for _, t in docs for w in (t or "").split()}], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(mix.SLOTS)).cast("int").alias("s"))
    slot = {r.w: r.s for r in words.collect()}
    slots = {k: {slot[w] for w in (t or "").split()} for k, t in docs}
    tokens = {k: len((t or "").split()) for k, t in docs}
    count = collections.defaultdict(lambda: np.zeros(3))
    for k, d in labelled:
        if half[k]:
            for s in slots[k]:
                count[s]["abc".index(d)] += 1
    mass = sum(count.values())
    total = mass.sum()
    weight = {}
    for s, c in count.items():
        expect = mass * c.sum() / total
        z = np.abs(c - expect) / np.sqrt(np.maximum(expect * (1 - mass / total), 0.25))
        if z.max() >= mix.MIN_Z:
            w = np.log((c + 0.5) / (mass + 1))
            weight[s] = w - w.mean()

    def features(k):
        e = sum((weight[s] for s in slots[k] if s in weight), np.zeros(3))
        n, root = len(slots[k]), np.sqrt(max(len(slots[k]), 1))
        against = e[1:] - e[0]
        return np.r_[1, np.clip(against, -20, 20) / 4, np.clip(against / root, -10, 10), np.log1p(tokens[k]) / 4, n / tokens[k] if tokens[k] else 1.0]

    logistic = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    x = np.array([features(k) for k, _ in labelled if not half[k]])
    y = np.array([d for k, d in labelled if not half[k]])
    w = np.zeros((3, x.shape[1]))
    for _ in range(8):
        for c in range(3):
            q = logistic(x @ w[c])
            h = (x * (q * (1 - q))[:, None]).T @ x + np.eye(x.shape[1])
            step = np.linalg.solve(h, x.T @ ((y == "abc"[c]) - q) - w[c])
            w[c] += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
    for k, _ in docs:
        q = logistic(w @ features(k))
        assert np.allclose([got[k].p0, got[k].p1, got[k].p2], q / q.sum(), atol=1e-6), k
    assert sum("abc"[int(np.argmax([got[i].p0, got[i].p1, got[i].p2]))] == k for i, k in enumerate(kinds)) > 270


def test_mix_edges(spark):
    labelled = spark.createDataFrame([(4, "a"), (5, "b"), (None, "a"), (6, "zzz"), (7, None)], "doc_id long, domain string")
    rows, _ = mix.mix(frame(spark, NULLS).withColumn("tokens", F.lit("clash")), labelled, {"a": 0.5, "b": 0.5})
    assert rows.count() == len(NULLS) and rows.where("rate < 0 or copies < 0").count() == 0
    rows, _ = mix.mix(frame(spark, []), labelled, {"a": 0.5, "b": 0.5})
    assert rows.count() == 0


def test_pipeline_takes_down_a_large_toxic_source(spark, tmp_path, capsys):
    import corpus_pipeline

    rng = random.Random(7)
    own = {"high": 0.5, "toxic": 0.35, "low": 0.15}
    kinds = rng.choices(list(own), list(own.values()), k=900)
    docs = [(i, " ".join(rng.choice([f"all{rng.randrange(300)}", f"{k}{rng.randrange(60)}"]) for _ in range(rng.randrange(60, 140)))) for i, k in enumerate(kinds)]
    labels = [(i, 1 if k == "high" else 0, int(k == "toxic")) for i, k in enumerate(kinds) if i % 2]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = frame(spark, [d for d, k in zip(docs, kinds, strict=True) if k != "low" or d[0] % 8 == 0])  # an unlabelled rest of the low ones
    tokens = collections.Counter()
    for r in corpus_pipeline.mixing_to_targets(spark, left, str(tmp_path)).collect():
        tokens[kinds[r.doc_id]] += len(r.text.split())
    share = {k: n / sum(tokens.values()) for k, n in tokens.items()}
    assert abs(share["toxic"] - 0.07) < 0.03 and share.get("low", 0) < 0.01
    assert "toxic 0.0" in capsys.readouterr().err


# --- quality rules


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count, hit = collections.Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i in range(len(w) - 2):
        if count[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_base_statistics_match_brute_force(spark):
    docs = [tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]
    docs += [(10**6 + i, t) for i, t in enumerate(["", None, "a b c a b c", "a a a a", "a\n\na\n a\na", "  x y #|", "a b", "a b c", "<>\r\n<>\r\n"])]
    got = {r.doc_id: tuple(r)[1:6] for r in quality.base_rules(frame(spark, docs).withColumn("n_words", F.lit("clash"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {k: base(t) for k, t in docs}


def mcd_by_hand(z, steps=4):
    """center, inverse factor and scale of one group, by the same method in numpy."""
    floors = np.array(list(quality.STATISTICS.values()))
    chol = lambda c: np.linalg.inv(np.linalg.cholesky(c))
    d2_of = lambda c, inv: ((inv @ (z - c).T) ** 2).sum(0)
    bucket = lambda d2: np.floor(np.log2(np.maximum(d2, 2.0**-20)) * 16)

    def estimate(x):
        return x.mean(0), chol(np.cov(x.T, bias=True) + np.diag(floors**2))

    def least_bucket(b, share):  # the first at which the share of rows is reached
        return np.sort(b)[int(np.ceil(share * len(b))) - 1]

    grid = np.floor(z * 256) / 256
    at = lambda share: np.array([least_bucket(grid[:, i], share) for i in range(5)])
    mid, spread = at(0.5), np.maximum((at(0.75) - at(0.25)) / 1.349, floors)
    u = (z - mid) / spread
    unit = u / np.sqrt(np.maximum((u * u).sum(1), 1e-12))[:, None]
    best = None
    for m in (np.eye(5), np.tanh(u).T @ np.tanh(u), unit.T @ unit):
        s = np.sqrt(np.outer(np.diag(m), np.diag(m)))
        r = np.where(np.eye(5) > 0, 1.0, 0.9 * np.divide(m, s, out=np.zeros((5, 5)), where=s > 0))
        c, inv = mid, chol(r * np.outer(spread, spread))
        for _ in range(steps):
            b = bucket(d2_of(c, inv))
            c, inv = estimate(z[b <= least_bucket(b, quality.ALPHA)])
        det = -2 * np.log(np.diag(inv)).sum()
        if best is None or det < best[0] - 1e-12:
            best = det, c, inv
    scale = lambda b: max(2.0 ** ((least_bucket(b, 0.5) + 1) / 16) / quality.CHI2_MEDIAN, 1.0)
    b = bucket(d2_of(*best[1:]))
    c, inv = estimate(z[2.0 ** (b / 16) <= quality.CHI2_REWEIGHT * scale(b)])
    return c, inv, scale(bucket(d2_of(c, inv)))


def test_robust_fit_matches_numpy(spark, monkeypatch):
    rng = np.random.default_rng(8)
    good = rng.multivariate_normal(np.zeros(5), np.diag([1, 0.04, 0.01, 0.02, 0.03]) + 0.005, 400)
    bad = rng.normal(6, 0.2, (80, 5))
    z = {"g": np.vstack([good, bad]), "h": rng.gamma(2, 0.3, (333, 5)), "same": np.ones((70, 5))}
    df = common.materialise(spark.createDataFrame([(g, v.tolist()) for g, x in z.items() for v in x], "g string, z array<double>"), "z")
    for groups in (quality.BROADCAST_GROUPS, 1):
        monkeypatch.setattr(quality, "BROADCAST_GROUPS", groups)
        for m in quality.fit(df).collect():
            inv = np.zeros((5, 5))
            for (i, j), v in zip(quality.PAIRS, m.inv, strict=True):
                inv[i, j] = v
            c, want, scale = mcd_by_hand(z[m.g])
            assert np.allclose(m.center, c) and np.allclose(inv, want) and np.isclose(m.scale, scale), m.g
            if m.g == "g":
                d2 = ((inv @ (z["g"] - np.array(m.center)).T) ** 2).sum(0) / m.scale
                assert (d2[:400] <= quality.CHI2_LIMIT).mean() > 0.99 and (d2[400:] > quality.CHI2_LIMIT).all()


def test_verdicts_match_brute_force(spark):
    """kept and distance2 of whole rows, with groups of 59, 60 and 61 rows."""
    rng = random.Random(9)
    rows = []
    for source, n in (("a", 59), ("b", 60), ("c", 61), (None, 150)):
        for i in range(n):
            w = [f"w{rng.randrange(3000)}" + "#" * (rng.random() < 0.02) for _ in range(rng.randrange(30, 300))]
            if i % 17 == 3:
                w = [x + "||" for x in w]
            if i % 19 == 4:
                w += w[: len(w) // 3]
            rows.append((len(rows), "\n".join(" ".join(w[j : j + 9]) for j in range(0, len(w), 9)), "en", source))
    rows += [(5000, rows[7][1], "en", "a"), (5000, rows[7][1], "en", "a")]  # repeated rows: a has 61
    rows += [(6000 + i, rows[i][1], "de", "z") for i in range(5)]  # a small language: the fit of all rows
    got = {r.doc_id: r for r in quality.robust_outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("clash"))).collect()}
    z, ok = {}, {}
    for k, t, _, _ in rows:
        n, chars, symbols, dup, rep = base(t)
        ok[k] = not (n < 50 or 100 * rep > 50 * n)
        lines = sum(bool(x.strip()) for x in t.split("\n"))
        z[k] = [np.log(n), np.log(chars / n), np.sqrt(symbols / n), np.sqrt(dup / max(lines, 1)), np.sqrt(rep / n)]
    passed = lambda pick: [r[0] for r in rows if ok[r[0]] and pick(r)]
    for lang, source in {(r[2], r[3]) for r in rows}:
        own = passed(lambda r, a=lang, b=source: r[2:] == (a, b))
        near = passed(lambda r, a=lang: r[2] == a)
        members = own if len(own) >= 60 else near if len(near) >= 60 else passed(lambda r: True)
        c, inv, scale = mcd_by_hand(np.array([z[k] for k in members]))
        for k in own:
            d2 = float(((inv @ (np.array(z[k]) - c)) ** 2).sum() / scale)
            assert np.isclose(got[k].distance2, d2) and got[k].kept == (d2 <= quality.CHI2_LIMIT), (lang, source, k)
    assert all(r.base_failed != ok[k] and (ok[k] or r.distance2 is None and not r.kept) for k, r in got.items())
    assert 5 < sum(ok[k] and not r.kept for k, r in got.items()) < 60
    few = spark.createDataFrame(rows[:59], "doc_id long, text string, lang string, source string")
    assert all(r.kept != r.base_failed for r in quality.robust_outliers(few, min_group=60).collect())


def test_quality_edges(spark):
    more = [(k, t, None if i % 2 else "en", None) for i, (k, t) in enumerate(NULLS)]
    got = quality.robust_outliers(spark.createDataFrame(more, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == len(NULLS) and not any(r.kept for r in got)
    assert quality.robust_outliers(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []


def test_each_share_rejects_alone_in_a_clean_group(spark):
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(10**4):04d}" for _ in range(n)]
    lines = lambda w, n: "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))
    rows = [(i, lines(fresh(rng.randrange(300, 500)), 8)) for i in range(120)]
    few = [f"q{i:04d}" for i in range(20)]
    rows.append((900, lines([rng.choice(few) for _ in range(400)], 1)))  # one word a line, 95% of the lines seen before
    again = fresh(90)
    rows.append((901, lines([*again, *fresh(220), *again], 7)))  # 45% of the words in repeated windows
    rows.append((902, lines([w + "#" * (i % 8 == 0) for i, w in enumerate(fresh(400))], 8)))  # a symbol in 8 words
    rows += [(903, lines([*fresh(400), "a", "#"], 8)), (904, lines([*fresh(392), *(w := fresh(8)), *w], 8))]  # a lone symbol, a lone repeated line
    got = {r.doc_id: r for r in quality.robust_outliers(frame(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit("s")})).collect()}
    assert not any(r.base_failed for r in got.values())
    assert got[900].n_dup_lines >= 380 and {k for k, r in got.items() if not r.kept} == {900, 901, 902}
