"""Toxicity by weak supervision: many voters, a generative model of their votes, and a linear classifier on its posteriors.

Cues of a text are its distinct words (runs of letters, in lower case) and the beginnings of its words. The voters are a lexicon of cues,
found where labelled rows of class 1 hold them far more often than others, and patterns of form (shouting, masks, repeats and
the like), one of which is the absence of every lexicon cue. Each voter fires on a text or abstains.

The label model gives each voter a rate of firing in either class, and a second pair of rates where its firing depends on another voter: a
spanning tree of those pairs that, given the class, tell most of each other. Classes are hidden; where a row is labelled, the label
is one more voter, right in LABEL_ACCURACY of its cases. Expectation maximisation runs over the counts of all texts' vote patterns
until the expected counts stay, and never moves more than sums to the driver; posteriors are added in fixed point, so results don't
depend on how rows lie. The classifier is a logistic regression over hashed cues, trained by follow-the-regularised-leader
on the posteriors of a bounded sample of texts; its score of a text is a sparse dot product.

Null and empty texts hold no cue and get the score of the bias. Null labels and ids are passed over, of several labels of
one id the majority counts (a tie counts as 1). Without a labelled row of either class there is no lexicon, and scores follow the patterns alone.
Repeated rows count as often as they stand, but the classifier learns from each once. Other columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classify import Ftrl, sigmoid
from .common import discard, materialise

_WORD = re.compile(r"[^\W\d_]+").findall
#: Beginnings of words that are cues of their own, in letters; the word goes on behind them.
STEMS = range(4, 9)
#: Words whose cues a worker remembers, and cues counted in a task before they are handed on.
CACHE, HELD = 500_000, 300_000
#: Posteriors are added as multiples of 1 / UNIT.
UNIT = 1 << 20
#: How often a given label is taken to be right.
LABEL_ACCURACY = 0.99
_MASK = re.compile(r"[*@#$%](?<=[^\W\d_].)[*@#$%]{0,2}[^\W\d_]").search
_DIGITS = re.compile(r"\d(?<=[^\W\d_]\d)[^\W\d_]").search
#: Patterns of form, by name; each fires on a text and its words.
PATTERNS = {
    "no cue": None,
    "shouting": lambda text, words: 2 * sum(map(str.isupper, text.split())) > len(words),
    "mask": lambda text, words: _MASK(text) is not None,
    "digit in word": lambda text, words: _DIGITS(text) is not None,
    "thrice": lambda text, words: any(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False)),
    "marks": lambda text, words: 10 * (text.count("!!") + text.count("??")) > len(words),
    "few words": lambda text, words: len(words) < 20,
    "small vocabulary": lambda text, words: 3 * len(set(words)) < len(words),
}


def cues(word: str) -> list[str]:
    """The word, and its beginnings with a hyphen."""
    return [word] + [word[:n] + "-" for n in STEMS if n < len(word)]


class _Memory(dict):
    """What of a word's cues counts: word to a tuple of numbers, by a function of one cue. heads: if given, no cue of a word counts that begins otherwise."""

    def __init__(self, number, heads: set[str] | None = None):
        self.number, self.heads = number, heads

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = tuple(n for c in cues(word) if (n := self.number(c)) is not None)
        return found

    def of(self, words) -> list[int]:
        """The numbers of all cues of the words, each once, rising."""
        if self.heads is not None:
            words = [w for w in words if w[: STEMS[0]] in self.heads]
        return sorted({n for w in words for n in self[w]})


def lexicon_memory(lexicon: list[str]) -> _Memory:
    """By place in the lexicon; words that begin as none of its cues aren't looked up."""
    return _Memory({c: i for i, c in enumerate(lexicon)}.get, {c.rstrip("-")[: STEMS[0]] for c in lexicon})


def vote(text: str | None, lexicon: _Memory, first: int) -> list[int]:
    """The voters that fire: pattern i as i, cues from first on."""
    text = text or ""
    words = _WORD(text.lower())
    held = lexicon.of(set(words))
    forms = [i for i, (name, fires) in enumerate(PATTERNS.items()) if (fires(text, words) if fires else not held)]
    return forms + [first + n for n in held]


# --- labelled rows and the lexicon


def majority(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """k, y of at most so many labelled ids, those of the smallest hash."""
    rows = labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y")).where("k is not null and y is not null")
    return rows.groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y")).orderBy(F.xxhash64("k"), "k").limit(most)


def find_lexicon(taught: DataFrame, most: int, min_rows: int = 3, min_share: float = 0.02, min_ratio: float = 30.0) -> list[str]:
    """At most so many cues, by falling evidence for class 1: the rows of class 1 with the cue, times the logarithm of how
    much oftener they have it than rows of class 0, if that is min_ratio and they are min_rows and min_share of their class. taught: y, t. Of cues that begin alike and stand in as many rows the longest is kept."""

    def count(batches):
        held: Counter = Counter()
        for b in batches:
            for y, t in zip(b.column(0), b.column(1), strict=True):
                held.update((c, y.as_py()) for c in {c for w in set(_WORD((t.as_py() or "").lower())) for c in cues(w)})
                held["", y.as_py()] += 1
                if len(held) >= HELD:
                    yield _counts(held)
                    held = Counter()
        if held:
            yield _counts(held)

    counted = taught.select("y", "t").mapInArrow(count, "c string, y int, n long")
    sums = materialise(counted.groupBy("c").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b")).where(f"a >= {min_rows} or c = ''"), "cues")
    rows = {r.c: (r.a, r.b) for r in sums.where("c = ''").collect()}
    of, others = rows.get("", (0, 0))
    if not of or not others:
        discard(sums)
        return []
    ratio = (F.col("a") + 0.5) / (of + 1) / ((F.col("b") + 0.5) / (others + 1))
    best = sums.where("c <> ''").select("c", "a", "b", (F.col("a") * F.log(ratio)).alias("s")).where((F.col("a") >= min_share * of) & (ratio >= min_ratio)).orderBy(F.desc("s"), F.desc(F.length("c")), F.desc("c")).limit(8 * most).collect()
    discard(sums)
    kept: dict[tuple, str] = {}
    for r in best:
        if len(kept) < most:
            kept.setdefault((r.c[: STEMS[0]], r.a, r.b), r.c)
    return list(kept.values())


def _counts(held: Counter) -> pa.RecordBatch:
    c, y = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(y, pa.int32()), pa.array(held.values(), pa.int64())], ["c", "y", "n"])


# --- the label model


class LabelModel:
    """Rates of firing by class, voter and state of the voter it depends on (parent -1: on none), from counts of
    firing[class, state, voter] and rows[class, state, voter]; the classes' shares are those of labels[label]. In a state
    that few rows are in, a rate leans on that of both states together, as if 5 rows had it."""

    def __init__(self, parent: np.ndarray, firing: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        self.parent = parent
        both = (firing.sum(1, keepdims=True) + 0.05) / (rows.sum(1, keepdims=True) + 1.0)
        rates = (firing + 5 * both) / (rows + 5)
        self.fires, self.rests = np.log(rates), np.log1p(-np.minimum(rates, 1 - 1e-6))
        self.prior = np.log((labels + 1.0) / (labels.sum() + 2.0))
        self.said = np.log(np.where(np.eye(2) > 0, LABEL_ACCURACY, 1 - LABEL_ACCURACY))

    def posterior(self, fired: np.ndarray, label: np.ndarray) -> np.ndarray:
        """P(class 1) of rows of votes; label -1: not labelled."""
        state = _states(fired, self.parent)
        log = np.stack([self.prior[y] + np.where(fired, np.where(state, self.fires[y, 1], self.fires[y, 0]), np.where(state, self.rests[y, 1], self.rests[y, 0])).sum(1) for y in (0, 1)])
        known = label >= 0
        log[:, known] += self.said[:, label[known]]
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def _states(fired: np.ndarray, parent: np.ndarray) -> np.ndarray:
    return fired[:, np.maximum(parent, 0)] & (parent >= 0)


def _dense(patterns, n_voters: int) -> np.ndarray:
    fired = np.zeros((len(patterns), n_voters), bool)
    for row, p in zip(fired, patterns, strict=True):
        row[p] = True
    return fired


def _expected(patterns: DataFrame, n_voters: int, posterior, parent: np.ndarray, pairs: bool) -> dict[str, np.ndarray]:
    """Sums over all patterns, weighted by posteriors: of firing and rows for each voter and state, and of pairs that fire together."""
    shapes = {"firing": (2, 2, n_voters), "rows": (2, 2, n_voters), "labels": (2,), "pairs": (2, n_voters, n_voters) if pairs else (0,)}
    names = list(shapes)

    def run(batches):
        sums = {k: np.zeros(s, np.int64) for k, s in shapes.items()}
        for b in batches:
            label, n = b.column(1).to_numpy(), b.column(2).to_numpy()
            fired = _dense(b.column(0).to_pylist(), n_voters)
            p1 = np.rint(posterior(fired, label) * UNIT).astype(np.int64)
            state = _states(fired, parent)
            for y, w in enumerate((n * (UNIT - p1), n * p1)):
                for s in (0, 1):
                    at = state if s else ~state
                    sums["rows"][y, s] += w @ at
                    sums["firing"][y, s] += w @ (at & fired)
                sums["labels"][y] += UNIT * n[label == y].sum()
                if pairs:
                    sums["pairs"][y] += (fired * w[:, None]).T @ fired
        for i, k in enumerate(names):
            flat = sums[k].ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(flat[at])], ["k", "at", "n"])

    got = patterns.select("votes", "label", "n").mapInArrow(run, "k int, at int, n long").groupBy("k", "at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    out = {k: np.zeros(s) for k, s in shapes.items()}
    for r in got:
        out[names[r.k]].reshape(-1)[r.at] = int(r.n) / UNIT
    return out


def dependencies(pairs: np.ndarray, firing: np.ndarray, rows: np.ndarray, least: float = 30.0) -> np.ndarray:
    """The parent of each voter: the spanning forest of the greatest conditional mutual information of two voters given the
    class, of edges whose likelihood ratio statistic is at least so much. firing and rows: by class and voter."""
    m = firing.shape[1]
    g = np.zeros((m, m))
    for y in (0, 1):
        total = max(rows[y, 0], 1e-9)
        f = firing[y]
        both = pairs[y]
        for seen, one, other in ((both, f[:, None], f[None]), (f[:, None] - both, f[:, None], total - f[None]), (f[None] - both, total - f[:, None], f[None]), (total - f[:, None] - f[None] + both, total - f[:, None], total - f[None])):
            want = np.maximum(one * other / total, 1e-12)
            g += 2 * np.where(seen > 1e-9, seen * np.log(np.maximum(seen, 1e-12) / want), 0)
    np.fill_diagonal(g, 0)
    parent, free = np.full(m, -1), np.ones(m, bool)
    while free.any():  # from the voter that fires most of those left, the strongest edge on
        root = int(np.flatnonzero(free)[np.argmax(firing.sum(0)[free])])
        free[root] = False
        tree = [root]
        while free.any():
            block = g[np.ix_(tree, np.flatnonzero(free))]
            a, b = np.unravel_index(np.argmax(block), block.shape)
            if block[a, b] < least:
                break
            child = int(np.flatnonzero(free)[b])
            parent[child], free[child] = tree[a], False
            tree.append(child)
    return parent


def fit_label_model(patterns: DataFrame, n_voters: int, tolerance: float = 1e-3) -> LabelModel:
    """patterns: votes (voters that fire), label (-1: none), n. Begins with the labelled rows, finds the dependencies once, and goes on until
    no expected count moves by more than tolerance of the rows of its class."""
    none = np.full(n_voters, -1)
    known = lambda fired, label: np.where(label >= 0, label, 0.0)
    begun = _expected(patterns.where("label >= 0"), n_voters, known, none, True)
    labels = begun["labels"]
    parent = dependencies(begun["pairs"], begun["firing"][:, 0], begun["rows"][:, 0])
    begun = _expected(patterns.where("label >= 0"), n_voters, known, parent, False)
    model, last = LabelModel(parent, begun["firing"], begun["rows"], labels), None
    while True:
        now = _expected(patterns, n_voters, model.posterior, parent, False)
        model = LabelModel(parent, now["firing"], now["rows"], labels)
        if last is not None:
            of = np.maximum(now["rows"][:, :, 0].sum(1), 1.0)
            if max((np.abs(now[k] - last[k]).max((1, 2)) / of).max() for k in ("firing", "rows")) <= tolerance:
                return model
        last = now


# --- the operator


class Toxicity:
    """A fitted model: slots with weights (2**bits of them), bias, lexicon and label model."""

    def __init__(self, weights: np.ndarray, bias: float, lexicon: list[str], labels: LabelModel):
        self.weights, self.bias, self.lexicon, self.labels = weights, bias, lexicon, labels


def _slot(bits: int):
    return lambda cue: xxhash.xxh64_intdigest(cue) >> (64 - bits)


def train(docs: DataFrame, labels: DataFrame, sample: DataFrame | None = None, bits: int = 20, max_labelled: int = 20_000, max_rows: int = 20_000, max_cues: int = 200, epochs: int = 4, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Toxicity:
    """Lexicon from at most max_labelled labelled ids, label model from the votes of all docs, classifier from at most max_rows
    rows of sample (docs, if not given)."""
    known = materialise(majority(labels, id_col, label_col, max_labelled), "known")
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    lexicon = find_lexicon(rows.join(F.broadcast(known), "k"), max_cues)
    first = len(PATTERNS)
    n_voters = first + len(lexicon)

    def votes(batches):
        memory, held = lexicon_memory(lexicon), Counter()
        for b in batches:
            for t, y in zip(b.column(0), b.column(1), strict=True):
                held[tuple(vote(t.as_py(), memory, first)), y.as_py()] += 1
            if len(held) >= HELD:
                yield _voted(held)
                held = Counter()
        if held:
            yield _voted(held)

    labelled = rows.join(F.broadcast(known), "k", "left").select("t", F.coalesce("y", F.lit(-1)).alias("label"))
    patterns = materialise(labelled.mapInArrow(votes, "votes array<int>, label int, n long").groupBy("votes", "label").agg(F.sum("n").alias("n")), "votes")
    model = fit_label_model(patterns, n_voters)
    discard(patterns)

    own = rows if sample is None else sample.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    # a fixed share of the hashes, so that only rows of the sample are shuffled
    share = min(1.0, 1.1 * max_rows / max(own.count(), 1))
    drawn = own.withColumn("h", F.xxhash64("k", "t")).where(F.col("h") <= F.lit(min(int((share - 0.5) * 2**64), 2**63 - 1))).dropDuplicates(["h"]).orderBy("h").limit(max_rows)
    drawn = drawn.join(F.broadcast(known), "k", "left").select("h", "t", F.coalesce("y", F.lit(-1)).alias("label"))

    def teach(batches):
        memory, slots = lexicon_memory(lexicon), _Memory(_slot(bits))
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            fired = _dense([vote(t, memory, first) for t in texts], n_voters)
            p = model.posterior(fired, b.column(2).to_numpy())
            x = [np.array(slots.of(set(_WORD((t or "").lower()))), np.int32).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array(x, pa.binary())], ["h", "p", "x"])

    taught = materialise(drawn.mapInArrow(teach, "h long, p double, x binary"), "taught")

    def learn(batches):
        ftrl = _Presence(bits)
        for b in batches:
            for lo in range(0, b.num_rows, 2_000):
                part = b.slice(lo, 2_000)
                seen = [(np.frombuffer(x.as_py(), np.int32), y) for x, y in zip(part.column(2), part.column(1).to_pylist(), strict=True)]
                for _ in range(epochs):
                    for x, y in seen:
                        ftrl.learn(x, y)
        w = ftrl.weights(np.arange(len(ftrl.z)))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at].astype(np.float64))], ["at", "w"])

    got = taught.repartition(1).sortWithinPartitions("h").mapInArrow(learn, "at int, w double").collect()
    discard(taught, known)
    w = np.zeros((1 << bits) + 1)
    for r in got:
        w[r.at] = r.w
    return Toxicity(w[:-1], float(w[-1]), lexicon, model)


def _voted(held: Counter) -> pa.RecordBatch:
    votes, label = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(votes, pa.list_(pa.int32())), pa.array(label, pa.int32()), pa.array(held.values(), pa.int64())], ["votes", "label", "n"])


class _Presence(Ftrl):
    """Learns from slots that are there or not, and from labels between 0 and 1."""

    def __init__(self, bits: int, alpha: float = 0.2, l1: float = 3.0, l2: float = 0.1):
        super().__init__(bits, alpha=alpha, l1=l1, l2=l2)

    def learn(self, slots: np.ndarray, y: float) -> None:
        at = np.append(slots, len(self.z) - 1)
        w = self.weights(at)
        g = sigmoid(float(w.sum())) - y
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) of every row's whole text."""
    bits = len(model.weights).bit_length() - 1
    held = {int(s): float(model.weights[s]) for s in np.flatnonzero(model.weights)}
    slot, bias = _slot(bits), model.bias
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))

    def run(batches):
        memory = _Memory(lambda cue: s if (s := slot(cue)) in held else None)
        for b in batches:
            s = [sigmoid(bias + sum(held[n] for n in memory.of(set(_WORD((t.as_py() or "").lower()))))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["k", "score"])

    return rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, score double").withColumnRenamed("k", id_col)
