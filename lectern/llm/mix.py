"""Mixing sources to target weights by soft membership, DataFrame operations only.

A classifier learns domains from a labelled table: one half of the labelled rows gives hashed words their
weights as evidence, the other half fits logistic regressions on the sums of evidence. Each document gets a
posterior over domains. Document rates r >= min_rate are then fitted so that the expected token totals of the domains,
sum over documents of r * tokens * posterior, match the targets: least squares by projected gradient steps
in the metric of the K x K matrix of domain overlaps of the documents that are free to move. A step is one
aggregation over the documents; only K + K * K sums come to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOKEN = r"[a-z0-9\x80-\x{10FFFF}]+|[^\sa-z0-9\x80-\x{10FFFF}]+"
#: Slots of the hashed vocabulary; the model has one row of K weights for each.
SLOTS = 1 << 16
#: A slot is in the model if its share in one domain is so many standard errors from its share overall.
MIN_Z = 5.0
MAX_LABELLED = 20_000
#: Rows whose rates are rounded together, about.
ROWS_PER_BUCKET = 20_000


def _first_half() -> Column:
    """Labelled rows that teach the vocabulary; the others teach what its evidence is worth."""
    return F.pmod(F.xxhash64("k", F.lit("half")), F.lit(2)) == 0


def _slots(text: Column) -> Column:
    """The distinct slots of the tokens of a whole text."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(SLOTS)).cast("int")))


def _vocabulary(labelled: DataFrame, k: int) -> DataFrame:
    """slot and w0.., for slots whose share differs between domains beyond chance: log of the slot's
    smoothed share of all slots of each domain's documents, less their mean. At most SLOTS rows. Shares
    of slots, not of documents: else the long documents of a domain would make every slot typical of it."""
    counts = labelled.select("y", F.explode("slots").alias("slot")).groupBy("slot").agg(*[F.sum(F.when(F.col("y") == i, 1.0).otherwise(0.0)).alias(f"c{i}") for i in range(k)])
    counts = common.materialise(counts, "slots")
    mass = counts.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0.0)) for i in range(k)]).first()
    share = sum((F.col(f"c{i}") for i in range(k)), F.lit(0.0)) / max(sum(mass), 1.0)
    z = [F.abs(F.col(f"c{i}") - m * share) / F.sqrt(F.greatest(m * share * (1.0 - m / max(sum(mass), 1.0)), F.lit(0.25))) for i, m in enumerate(mass)]
    counts = counts.where(F.greatest(F.lit(0.0), *z) >= MIN_Z)
    logs = counts.select("slot", *[F.log((F.col(f"c{i}") + 0.5) / (m + 1.0)).alias(f"w{i}") for i, m in enumerate(mass)])
    mean = sum((F.col(f"w{i}") for i in range(k)), F.lit(0.0)) / k
    return logs.select("slot", *[(F.col(f"w{i}") - mean).alias(f"w{i}") for i in range(k)])


def _features(k: int) -> list[Column]:
    """Evidence of each domain against the first, plain and by the root of the number of slots; length; variety."""
    root = F.sqrt(F.greatest(F.col("n"), F.lit(1)).cast("double"))
    against = [F.col(f"s{i}") - F.col("s0") for i in range(1, k)]
    cut = lambda v, m: F.least(F.greatest(v, F.lit(-m)), F.lit(m))
    length = F.log1p(F.col("tokens").cast("double"))
    return [F.lit(1.0), *[cut(v, 20.0) / 4 for v in against], *[cut(v / root, 10.0) for v in against], length / 4, F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("tokens")), F.lit(1.0))]


def _dot(w: np.ndarray, x: list[Column]) -> Column:
    return sum((float(v) * c for v, c in zip(w, x, strict=True)), F.lit(0.0))


def _logistic(v: Column) -> Column:
    return 1.0 / (1.0 + F.exp(F.least(F.greatest(-v, F.lit(-30.0)), F.lit(30.0))))


def _calibrate(known: DataFrame, k: int, rounds: int = 8, ridge: float = 1.0) -> np.ndarray:
    """One logistic regression for each domain against the rest, by Newton steps; a step is one aggregation
    that sums the small gradients and Hessians. known has y and what _features() reads."""
    x = _features(k)
    d = len(x)
    known = common.materialise(known.select("y", *[v.alias(f"x{i}") for i, v in enumerate(x)]).coalesce(1), "known")  # bounded, as the labelled rows are
    x, pairs = [F.col(f"x{i}") for i in range(d)], [(i, j) for i in range(d) for j in range(i + 1)]
    w = np.zeros((k, d))
    for _ in range(rounds):
        at = known.select("y", *x, *[_logistic(_dot(w[c], x)).alias(f"p{c}") for c in range(k)])
        at = at.select(*x, *[((F.col("y") == c).cast("double") - F.col(f"p{c}")).alias(f"r{c}") for c in range(k)], *[(F.col(f"p{c}") * (1.0 - F.col(f"p{c}"))).alias(f"v{c}") for c in range(k)])
        aggs = [F.sum(F.col(f"r{c}") * x[i]) if j is None else F.sum(F.col(f"v{c}") * x[i] * x[j]) for c in range(k) for i, j in [*((i, None) for i in range(d)), *pairs]]
        got = np.array([v or 0.0 for v in at.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()]).reshape(k, -1)
        for c in range(k):
            h = np.zeros((d, d))
            h[np.tril_indices(d)] = got[c, d:]
            h = h + np.tril(h, -1).T + ridge * np.eye(d)
            step = np.linalg.solve(h, got[c, :d] - ridge * w[c])
            w[c] += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
    common.discard(known)
    return w


def _score(rows: DataFrame, model: DataFrame, k: int) -> DataFrame:
    """k, tokens, n and the sums of evidence s0.. of every row (k, t)."""
    words = rows.select(F.monotonically_increasing_id().alias("r"), "k", F.regexp_count("t", F.lit(common.WORD)).cast("long").alias("tokens"), _slots(F.col("t")).alias("slots"))
    words = words.select("r", "k", "tokens", F.size("slots").alias("n"), F.explode_outer("slots").alias("slot")).join(F.broadcast(model), "slot", "left")
    # all that a row has is a key, for sums alone are hashed: the first of a string would be sorted, with every slot of every text
    return words.groupBy("r", "k", "tokens", "n").agg(*[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(k)]).drop("r")


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", teach: DataFrame | None = None, label_id_col: str | None = None) -> DataFrame:
    """k (the id), tokens, p0.. (posterior of each domain in domains) for every row.

    labelled has an id and a domain; at most MAX_LABELLED of its rows, those with the smallest hash, are
    used, and only their ids and the model, SLOTS rows at most, are broadcast. Null ids and domains outside
    the list are passed over, an id with several domains takes the first in the list's order. Without
    labelled rows the posteriors are uniform. teach has the texts of the labelled rows, if docs no longer
    has all of them: a domain whose rows an earlier stage took out is learned all the same; its ids are in
    label_id_col, as those of labelled are. Texts without tokens have no evidence, only length and variety. Repeated rows get one
    posterior each; other columns are not read, whatever they are called.
    """
    index = F.create_map(*[x for i, d in enumerate(domains) for x in (F.lit(d), F.lit(i))])
    label_id_col = label_id_col or id_col
    sample = labelled.select(F.col(label_id_col).alias("k"), index[F.col(domain_col)].alias("y")).where("k is not null and y is not null")
    sample = common.materialise(sample.groupBy("k").agg(F.min("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(MAX_LABELLED), "labelled")
    texts = lambda df, c=id_col: df.select(F.col(c).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    rows, k = texts(docs), len(domains)
    known = rows if teach is None else texts(teach, label_id_col)
    model = common.materialise(_vocabulary(known.join(F.broadcast(sample.where(_first_half())), "k").select("y", _slots(F.col("t")).alias("slots")), k).coalesce(1), "vocabulary")

    scored = common.materialise(_score(rows, model, k), "scores")
    half = sample.where(~_first_half())
    known = scored if teach is None else _score(known.join(F.broadcast(half.select("k")), "k", "left_semi"), model, k)
    w = _calibrate(known.join(F.broadcast(half), "k"), k)
    x = _features(len(domains))
    raw = scored.select("k", "tokens", *[_logistic(_dot(w[i], x)).alias(f"q{i}") for i in range(len(domains))])
    all_ = sum((F.col(f"q{i}") for i in range(len(domains))), F.lit(0.0))
    out = common.materialise(raw.select("k", "tokens", *[(F.col(f"q{i}") / all_).alias(f"p{i}") for i in range(len(domains))]), "posteriors")
    common.discard(scored, model, sample)
    return out


def fit_rates(rows: DataFrame, shares: list[float], budget: float | str | None = None, min_rate: float = 0.0, max_rate: float = 16.0, growth: float = 1.0, steps: int = 20, tolerance: float = 1e-3) -> tuple[Column, dict]:
    """The rate as a column of rows (tokens, p0..), and a report.

    budget: expected tokens in all; None: growth times as many as there are; "grow": the least at which no
    domain has to lose tokens. From rates of one, a step moves each rate by its posteriors times the solution of the
    overlap matrix for what the domains lack, cut to [min_rate, max_rate]; a step that doesn't lower the squared
    error is halved. Stops when all domains are within tolerance of their targets, or after steps.
    """
    k = len(shares)
    p, t = [F.col(f"p{i}") for i in range(k)], F.col("tokens").cast("double")
    w = np.array(shares, float) / sum(shares)

    def totals(rate: Column) -> np.ndarray:
        got = rows.withColumn("_rate", rate).agg(*[F.sum(t * F.col("_rate") * x).alias(f"a{i}") for i, x in enumerate(p)]).first()
        return np.array([x or 0.0 for x in got])

    def overlaps(rate: Column, lack: np.ndarray) -> np.ndarray:
        """Sums of tokens * posterior * posterior over the documents that the gradient doesn't hold at a bound."""
        pull = sum((float(v) * x for v, x in zip(lack / np.maximum(natural, 1.0), p, strict=True)), F.lit(0.0))
        free = ((F.col("_rate") > min_rate) | (F.col("_pull") > 0)) & ((F.col("_rate") < max_rate) | (F.col("_pull") < 0))
        r = rows.withColumns({"_rate": rate, "_pull": pull})
        got = r.agg(*[F.sum(F.when(free, t * p[i] * p[j])).alias(f"h{i}{j}") for i in range(k) for j in range(k)]).first()
        return np.array([x or 0.0 for x in got]).reshape(k, k)

    rate: Column = F.lit(1.0)
    if min_rate > 1 or max_rate < 1:
        rate = F.lit(float(min(max(1.0, min_rate), max_rate)))
    total = natural = totals(rate)
    if budget == "grow":
        with np.errstate(divide="ignore", invalid="ignore"):
            goal = w * max([x for x in np.where(w > 0, natural / w, 0.0)], default=0.0)
    else:
        goal = w * (growth * float(natural.sum()) if budget is None else float(budget))
    scale = max(float(goal.sum()), 1.0)
    error = lambda a: float((((a - goal) / scale) ** 2).sum())
    size, taken = 1.0, 0
    for taken in range(1, steps + 1):
        if np.all(np.abs(total - goal) <= tolerance * scale):
            break
        lack = goal - total
        h = overlaps(rate, lack)
        v = np.linalg.solve(h + np.eye(k) * (1e-6 * np.trace(h) + 1e-9), lack)
        while size >= 1e-3:
            move = sum((float(x) * size * c for x, c in zip(v, p, strict=True)), F.lit(0.0))
            trial = F.least(F.greatest(rate + move, F.lit(float(min_rate))), F.lit(float(max_rate)))
            new = totals(trial)
            if error(new) < error(total):
                rate, total, size = trial, new, min(1.0, size * 2)
                break
            size /= 2
        else:
            break
    return rate, {"goal": goal.tolist(), "reached": total.tolist(), "natural": natural.tolist(), "steps": taken}


def shares(report: dict, domains: list[str]) -> dict[str, tuple[float, float]]:
    """Of a report of fit_rates(): per domain the share of tokens that was sought, and the expected one."""
    goal, reached = (np.array(report[c], float) / max(sum(report[c]), 1.0) for c in ("goal", "reached"))
    return {d: (float(g), float(r)) for d, g, r in zip(domains, goal, reached, strict=True)}


def rounded(rows: DataFrame, rate: Column, k: int, seed: int) -> DataFrame:
    """rows (k, tokens, p0..) with rate and copies: rates rounded so that sums agree. Rows of about the same length and the
    same likeliest domain stand in a seeded order, and each gets the whole numbers that the running sum of rates passes in its
    row: a run of rows is at most one copy off, where coin flips would be off by the root of their number."""
    total = rows.count()
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    h = F.xxhash64(F.lit(seed), "k", "tokens")
    likeliest = F.greatest(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(-i).alias("i")) for i in range(k)])["i"] if k > 1 else F.lit(0)
    place = {"rate": rate, "_h": h, "_b": F.pmod(h, F.lit(buckets)), "_s": F.floor(F.log2(F.greatest(F.col("tokens"), F.lit(1)).cast("double")) * 2), "_d": likeliest}
    own = Window.partitionBy("_b", "_s", "_d")
    upto = F.sum("rate").over(own.orderBy("_h", "k").rowsBetween(Window.unboundedPreceding, 0))
    start = F.pmod(F.xxhash64(F.lit(seed), "_b", "_s", "_d"), F.lit(1 << 30)) / float(1 << 30)
    out = rows.withColumns(place).withColumn("_u", upto + start)
    before = F.coalesce(F.floor(F.lag("_u").over(own.orderBy("_h", "k"))), F.floor(start))
    return out.withColumn("copies", (F.floor("_u") - before).cast("long")).drop("_h", "_b", "_s", "_d", "_u")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | str | None = None, min_rate: float = 0.0, max_rate: float = 16.0, growth: float = 1.0, seed: int = 29, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", teach: DataFrame | None = None, label_id_col: str | None = None) -> tuple[DataFrame, dict]:
    """Per row: id, tokens, posteriors (array in the order of targets), rate, copies; and a report of totals.

    copies is the rate rounded up or down, see rounded(). at_bound is true where the rate is min_rate or max_rate. Rows without
    tokens have the prior and a rate of their own, and weigh nothing. teach, label_id_col: see posteriors(). Repeated
    rows are rows of their own. An empty table gives an empty result.
    """
    domains = list(targets)
    rows = posteriors(docs, labelled, domains, id_col, text_col, domain_col, teach, label_id_col)
    rate, report = fit_rates(rows, [targets[d] for d in domains], budget, min_rate, max_rate, growth)
    out = rounded(rows, rate, len(domains), seed)
    bound = (F.col("rate") <= min_rate) | (F.col("rate") >= max_rate)
    return out.select(F.col("k").alias(id_col), "tokens", F.array(*[f"p{i}" for i in range(len(domains))]).alias("posteriors"), "rate", "copies", bound.alias("at_bound")), report
