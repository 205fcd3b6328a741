"""Weak supervision: the label model against plain loops and enumeration, held-out rows, and odd inputs."""

import random
from collections import Counter
from itertools import product

import numpy as np

from lectern.llm import queries, weak

SF = "/root/testdata/sf0.01"


def test_votes():
    memory = weak.lexicon_memory(["idiot", "idio-", "trash"])
    first = len(weak.PATTERNS)
    names = lambda t: [list(weak.PATTERNS)[v] if v < first else v - first for v in weak.vote(t, memory, first)]
    assert names(None) == names("") == ["no cue", "few words"]
    assert names("What IDIOTS! trash and " + " ".join(map(chr, range(0x3B1, 0x3C9)))) == [1, 2]
    assert names("LOOK AT THIS!! NOW!!") == ["no cue", "shouting", "marks", "few words"]
    assert names("an id**ot") == ["no cue", "mask", "few words"] and names("*a b* c1 1d ****") == ["no cue", "few words"]
    assert names("an id*ot c0der no no no") == ["no cue", "mask", "digit in word", "thrice", "few words"]
    assert weak.cues("wandering") == ["wandering", "wand-", "wande-", "wander-", "wanderi-", "wanderin-"] and weak.cues("at") == ["at"]


def test_posteriors_are_those_of_the_joint_distribution():
    rng = np.random.default_rng(0)
    parent = np.array([-1, 0, 1, -1])
    rows = rng.uniform(5, 50, (2, 2, 4))
    m = weak.LabelModel(parent, rows * rng.uniform(0.1, 0.9, rows.shape), rows, np.array([30.0, 10.0]))
    rate, prior = np.exp(m.fires), np.exp(m.prior)
    votes = np.array(list(product((False, True), repeat=4)))
    joint = np.zeros((2, 16))
    for k, f in enumerate(votes):
        for y in (0, 1):
            p = prior[y]
            for j in range(4):
                r = rate[y, int(parent[j] >= 0 and f[parent[j]]), j]
                p *= r if f[j] else 1 - r
            joint[y, k] = p
    assert abs(joint.sum() - 1) < 1e-9
    assert np.allclose(m.posterior(votes, np.full(16, -1)), joint[1] / joint.sum(0))
    assert np.allclose(m.posterior(votes, np.zeros(16, int)), 0.01 * joint[1] / (0.01 * joint[1] + 0.99 * joint[0]))


def drawn(n, seed=1):
    """Votes of six voters; the fifth repeats the first four times in five."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.3
    f = rng.random((n, 6)) < np.where(y[:, None], [0.7, 0.6, 0.5, 0.8, 0.3, 0.1], [0.05, 0.1, 0.1, 0.2, 0.3, 0.6])
    f[:, 4] = np.where(rng.random(n) < 0.8, f[:, 0], f[:, 4])
    return y.astype(int), f


def test_label_model_finds_rates_and_dependencies(spark):
    y, f = drawn(6000)
    label = np.where(np.arange(6000) < 300, y, -1)
    held = Counter((tuple(np.flatnonzero(v).tolist()), int(t)) for v, t in zip(f, label))
    patterns = spark.createDataFrame([(list(v), t, n) for (v, t), n in held.items()], "votes array<int>, label int, n long")
    m = weak.fit_label_model(patterns, 6)
    assert {(4, 0), (0, 4)} & {(j, int(p)) for j, p in enumerate(m.parent)}
    p = m.posterior(f, np.full(6000, -1))
    assert ((p > 0.5) == y).mean() > 0.93
    for j in (1, 2, 3, 5):
        if m.parent[j] < 0:
            assert abs(np.exp(m.fires[1, 0, j]) - [0, 0.6, 0.5, 0.8, 0, 0.1][j]) < 0.06
    again = weak.fit_label_model(patterns.repartition(7), 6)
    assert (again.fires == m.fires).all() and (again.parent == m.parent).all()
    # one step by plain loops
    parent = m.parent
    got = weak._expected(patterns, 6, m.posterior, parent, True)
    firing, rows, pairs = np.zeros((2, 2, 6)), np.zeros((2, 2, 6)), np.zeros((2, 6, 6))
    for (v, t), n in held.items():
        fired = np.array([j in v for j in range(6)])
        p1 = round(float(m.posterior(fired[None], np.array([t]))[0]) * weak.UNIT) / weak.UNIT
        for c, w in ((0, n * (1 - p1)), (1, n * p1)):
            for j in range(6):
                s = int(parent[j] >= 0 and fired[parent[j]])
                rows[c, s, j] += w
                firing[c, s, j] += w * fired[j]
                pairs[c, j] += w * (fired[j] & fired)
    assert np.allclose(got["firing"], firing) and np.allclose(got["rows"], rows) and np.allclose(got["pairs"], pairs)
    assert got["labels"].tolist() == [(label == 0).sum(), (label == 1).sum()]


def test_independent_voters_have_no_parents():
    rng = np.random.default_rng(4)
    f = rng.random((4000, 5)) < 0.3
    y = rng.random(4000) < 0.5
    pairs = np.stack([(f * w[:, None]).T.astype(float) @ f for w in (~y, y)])
    firing = np.stack([f[~y].sum(0), f[y].sum(0)]).astype(float)
    rows = np.stack([np.full(5, (~y).sum()), np.full(5, y.sum())]).astype(float)
    assert (weak.dependencies(pairs, firing, rows) == -1).all()


def texts(n, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    rude = ["blockhead", "nitwit", "dimwit", "numbskull", "buffoon"]
    out = []
    for i in range(n):
        words, toxic = rng.choices(plain, k=rng.randint(20, 80)), int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(rude)
        out.append((i, " ".join(words), toxic))
    return out


def test_lexicon_and_scores(spark):
    rows = texts(900)
    docs = spark.createDataFrame([(i, t, "x", 0.0) for i, t, _ in rows] + [(5000, None, "x", 0.0), (5001, "", "x", 0.0), (None, "nitwit " * 40, "x", 0.0), (7, rows[7][1], "x", 0.0)], "doc_id long, text string, k string, score double").repartition(3)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows[:400]] + [(3, None, "x"), (None, 1, "x"), (9, rows[9][2], "x")], "doc_id long, toxic int, t string")
    m = weak.train(docs, labels)
    assert {"blockhead", "nitwit"} <= set(m.lexicon) and all(c[:4] in {"bloc", "nitw", "dimw", "numb", "buff"} for c in m.lexicon)
    got = [(r.doc_id, r.score) for r in weak.score(docs, m).collect()]
    by = dict(got)
    assert len(got) == 904 and all(0 <= s <= 1 for _, s in got)
    assert by[5000] == by[5001] and by[5000] < 0.5 and by[None] > 0.5
    assert sum((by[i] >= 0.5) == y for i, _, y in rows[400:]) > 0.97 * 500
    w = weak.train(docs.repartition(6), labels.repartition(2))
    assert w.lexicon == m.lexicon and np.array_equal(w.weights, m.weights) and w.bias == m.bias


def test_without_rows_labels_or_classes(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, toxic int")
    for d, lab in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        m = weak.train(d, lab)
        assert m.lexicon == [] and weak.score(d, m).count() == d.count()


def test_held_out_rows(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op12_weak_supervision(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.93 and all(r.predicted == (r.score >= 0.5) for r in rows)
