"""Vector codes and spelling variants against brute force, and their odd inputs."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import codes, queries, spelling

SF = "/root/testdata/sf0.001"

# --- vector codes


def test_trees_find_the_nearest_with_ties():
    rng = np.random.default_rng(1)
    for width, n, spread in ((1, 16, 3), (3, 16, 2), (8, 40, 400), (8, 256, 4000), (2, 1, 5)):
        entries = rng.integers(-spread, spread + 1, (n, width))
        parts = rng.integers(-spread, spread + 1, (500, width))
        d2 = ((parts[:, None, :] - entries[None]) ** 2).sum(2)
        index, best = codes.nearest(parts, codes.Tree(entries))
        assert (index == d2.argmin(1)).all() and (best == d2.min(1)).all()
        index, best = codes.nearest(parts.astype(object), codes.Tree(entries.astype(object)))
        assert (index == d2.argmin(1)).all() and (best == d2.min(1)).all()


def test_trees_leave_entries_out():
    rng = np.random.default_rng(2)
    entries = rng.integers(-4000, 4000, (200, 3))
    parts = entries[rng.integers(0, 200, 300)] + rng.integers(-20, 20, (300, 3))
    best, index = np.full(300, np.iinfo(np.int64).max), np.full(300, 10**6)
    assert codes.Tree(entries).search(parts, np.arange(300), best, index) < 300 * 100
    assert (best == ((parts[:, None] - entries[None]) ** 2).sum(2).min(1)).all()


def by_hand(rows, n_parts=8, n_entries=16, rounds=6):
    """Plain Python over (id, vector, label) rows."""
    good = sorted((r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max((len(r[1]) for r in good), default=0) // n_parts)
    ints = [[int(np.floor(c * 4096.0)) for c in r[1]] + [0] * (size * n_parts - len(r[1])) for r in good]
    cut = [[v[p * size : (p + 1) * size] for p in range(n_parts)] for v in ints]
    books = [[v[p] for v in cut[:n_entries]] for p in range(n_parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            of = collections.defaultdict(list)
            for v in cut:
                of[near(v[p], book)[1]].append(v[p])
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else book[e] for e in range(len(book))]
    out, sums = [], collections.Counter()
    for r, v in zip(good, cut):
        found = [near(x, book) for x, book in zip(v, books)]
        error = sum(d for d, _ in found)
        sums[r[2]] += error
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error, r[2]))
    return sorted((i, c, e, sums[lab]) for i, c, e, lab in out) if all(r[0] is not None for r in out) else [(i, c, e, sums[lab]) for i, c, e, lab in out], books


def encoded(df, **more):
    rows, books = codes.encode(df, **more)
    return sorted(((r.id, r.code, r.error, r.label_error) for r in rows.collect()), key=repr), books


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_codes_by_hand(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice((1, 0.01)) for _ in range(16)], rng.choice((None, 1, 2))) for i in range(120)]
    rows += [(7, rows[7][1], 1), (7, [0.0] * 16, 2)]  # repeats of an id
    rows += [(200, None, 1), (201, [1.0] * 15 + [None], 1), (202, [float("nan")] * 16, 1), (203, [float("-inf")] * 16, None)]
    got, books = encoded(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want, want_books = by_hand(rows)
    assert got == sorted(want, key=repr) and books == want_books


def test_codes_of_odd_vectors(spark):
    rows = [(1, [0.5, -0.5, 3.0], 1), (2, [], None), (None, [1e30] * 9, None), (3, [1e6, -1e6], 1), (4, [-0.0001] * 10, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", id string, code int")
    got, books = encoded(df)
    want, want_books = by_hand(rows)
    assert books == want_books
    fits = lambda e: e if e < 1 << 63 else None
    assert [g[:3] for g in got] == sorted(((i, c, fits(e)) for i, c, e, _ in want), key=repr)
    few = [r for r in rows if r[0] in (1, 2)]
    got, books = encoded(df.where("vec_id = 1 or vec_id = 2"))
    assert (got, books) == (sorted(by_hand(few)[0], key=repr), by_hand(few)[1]) and all(len(b) == 2 for b in books)
    none, books = encoded(df.where("vec_id > 99"))
    assert none == [] and books == [[]] * 8
    assert encoded(df.where("embedding is null or vec_id = 99"))[0] == []
    with pytest.raises(ValueError):
        codes.encode(df, n_entries=257)


def test_salted_label_sums(spark, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", 0)
    rows = [(i, [float(i % 7), 1.0], (None, 1)[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert encoded(df, n_parts=2)[0] == sorted(by_hand(rows, 2)[0], key=repr)


def test_digits():
    for v in (0, 1, -1, 5 << 90, -(5 << 90) - 3, (1 << 40) - 1, -(1 << 40)):
        assert sum(d << codes.DIGIT * p for p, d in codes._digits(v)) == v


# --- spelling variants


def variants_by_hand(docs, every=31, min_length=7, lead=10):
    n = collections.Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % every else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: k for w, k in n.items() if k >= 2 and len(w) >= min_length}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    all_near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)] for w in n}
    form = {}
    for w, ns in all_near.items():
        if ns and n[best := min(ns, key=lambda x: (-n[x], x))] >= lead * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(all_near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


def variants(df, every=31):
    rows = spelling.group_variants(spelling.count_words(df, typo_every=every)).collect()
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows), key=repr)


def test_variants_by_hand(spark):
    rng = random.Random(5)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(40)]

    def edit(w):
        at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
        return w[:at] + ("" if kind == 0 else rng.choice(letters + "ÉÿÀ")) + w[at + (kind != 1) :]

    words = base + [edit(w) for w in base for _ in range(4)] + [edit(edit(w)) for w in base for _ in range(3)]
    words += ["abababab", "babababa", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "ééééééé", "Ééééééé"]
    weights = [rng.choice((1, 1, 3, 40, 500)) for _ in words]
    docs = [(i, " ".join(rng.choice((w, w, w.upper() if w.isascii() else w)) for w in rng.choices(words, weights, k=120))) for i in range(200)]
    docs += [(1, None), (2, ""), (None, "abababab " * 30), (None, "abababab " * 30), (5, docs[5][1]), (9, "aaaaaaa" * 3000 + "9" + "zzzzzzz " * 5000)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(4)
    want = variants_by_hand(docs)
    assert len(want) > 150 and any(w[1] for w in want) and any(w[2] != w[1] for w in want if w[1])
    assert variants(df) == want


def test_long_texts_are_read_run_by_run(spark, monkeypatch):
    docs = [(1, "Wanderer wanderer wandere; wanderern " * 50), (2, "wanderer " * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = variants(df)
    monkeypatch.setattr(spelling, "LONG", 5)
    monkeypatch.setattr(spelling, "HELD", 1)
    assert variants(df) == want == variants_by_hand(docs)


def test_no_words(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "short words only, once perhaps")], "doc_id long, text string")
    assert variants(df) == [] == variants(df.where("doc_id > 9"))
    with pytest.raises(ValueError):
        spelling.group_variants(spelling.count_words(df), lead=1)


def test_bands_and_chains(spark):
    words = spark.createDataFrame([("wandered", 5), ("zzzzzzz", 1)], "word string, n long")
    bits = spelling.deal_letters(words)
    assert len(bits) == 90 == len(set(bits.values()))
    for a, b in (("wandered", "wanderer"), ("wandered", "wandere"), ("wandered", "wéandered")):
        equal = [x == y for x, y in zip(spelling.bands(a, bits), spelling.bands(b, bits))]
        assert any(equal) and (len(a) == len(b) or sum(equal) == 2)
        assert {k for k in spelling.keys(a, spelling.bands(a, bits))} and len(list(spelling.keys(a, spelling.bands(a, bits)))) == 10
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(11)], "word string, form string")
    assert {r.root for r in spelling.roots(chain).collect()} == {"11"}


def test_queries_on_the_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op13_spelling_variants(spark, SF).collect()
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got), key=repr) == variants_by_hand(docs)
    rows = queries.op11_vector_codes(spark, SF)
    kept = spark.read.parquet(f"{SF}/embeddings.parquet").where("embedding is not null").count()
    assert rows.count() == kept and rows.agg(F.countDistinct("codebooks_sha256")).first()[0] == 1
