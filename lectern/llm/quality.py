"""Quality rules: robust multivariate outliers by minimum covariance determinant, DataFrame operations only.

Statistics of a text are transformed and, per language and source, fitted with a robust mean and
covariance: from three deterministic starts, concentration steps keep the share ALPHA of rows with the
smallest Mahalanobis distance, the start with the smallest determinant wins, and a reweighting step follows.
A row is rejected when its squared distance exceeds a limit. A pass over the rows is one aggregate with partial
sums by group and bucket of distance; a bucket's sums are kept or left as a whole. Models are broadcast up to a
number of groups, and beyond it joined by group and salt: the rows of a group never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import SPACE, WORD, let

SYMBOLS = "#*$%&|<>"
ALPHA = 0.75
#: Chi-square with five degrees of freedom: the median, the 0.975 quantile for reweighting, the 0.999 quantile.
CHI2_MEDIAN, CHI2_REWEIGHT, CHI2_LIMIT = 4.3515, 12.8325, 20.515
#: Statistics by name with a spread, in units of the transformed value, whose square is added to each
#: fitted variance: a lone symbol in a spotless group is no outlier, and no covariance is singular. The
#: spreads of the three shares are a symbol in 250 words, a line in 44 and a word in 100, small
#: against their ranges of 1, 1 and, after the base rule, sqrt(0.5): in a spotless group each can reject alone.
STATISTICS = {"z_words": 0.5, "z_word_length": 0.12, "z_symbols": 0.063, "z_dup_lines": 0.15, "z_repeats": 0.1}
#: Buckets of squared distance per octave, for the order statistic that a concentration step needs.
STEPS_PER_OCTAVE = 16
#: A group of fewer rows is fitted with its language, and that, if small, with all rows.
MIN_GROUP = 60
#: Models of so many groups, about a kilobyte each, are broadcast; beyond, rows of a group are dealt by SALTS.
BROADCAST_GROUPS, SALTS = 10_000, 64
#: Tasks that write a table of groups.
MODEL_TASKS = 8
P = len(STATISTICS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def statistics(text: Column) -> dict[str, Column]:
    """Base statistics of a whole text; null has no words. Everything is computed inside the row."""
    text = F.coalesce(text, F.lit(""))
    words = F.expr("regexp_extract_all(_t, '" + WORD.replace("\\", "\\\\") + "', 0)")
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD))
    return {
        "_w": words,
        "_l": lines,
        "word_chars": F.length("_t").cast("long") - F.regexp_count("_t", F.lit(SPACE)).cast("long"),
        "n_symbols": F.length("_t").cast("long") - F.length(F.translate("_t", SYMBOLS, "")).cast("long"),
    }


def repeat_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more. Windows are sorted, so that equal
    ones are neighbours; then the ranges of the repeated ones are added up in order of position."""
    n = F.size(words)
    windows = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    twice = lambda s: F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
    covered = lambda p: F.aggregate(p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])
    starts = lambda r: F.sort_array(F.transform(r, lambda x: x["i"]))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows(words)), lambda s: let(twice(s), lambda r: covered(starts(r)))))


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, and the columns in carry."""
    rows = docs.select(F.col(id_col), *[F.col(c) for c in carry if c != id_col], F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    rows = rows.withColumns(statistics(F.col("_t"))).drop("_t")
    rows = rows.withColumns({
        "n_words": F.size("_w").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_repeat_words": repeat_words(F.col("_w")),
    }).drop("_w", "_l")
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def transformed() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(n),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)).cast("double") / n),
        F.sqrt(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


def _group_key(*cols: str) -> Column:
    return F.to_json(F.array(*[F.col(c).cast("string") for c in cols]))


def _products() -> list[Column]:
    """Count, sums and sums of products of z."""
    x = [F.get("z", i) for i in range(P)]
    out = [F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(P)]]
    return out + [F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i, j in PAIRS]


def _fit(sums: DataFrame, keys: list[str]) -> DataFrame:
    """From sums: center (array), inv (rows of the inverse Cholesky factor) and log_det, in layers that each
    refer to columns of the one before."""
    n = F.greatest(F.col("n"), F.lit(1.0))
    floors = list(STATISTICS.values())
    df = sums.select(*keys, *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)], *[(F.col(f"q{i}{j}") / n).alias(f"q{i}{j}") for i, j in PAIRS])
    df = df.select(*keys, *[f"m{i}" for i in range(P)], *[(F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (floors[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS])
    return _factor(df, keys)


def _factor(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cholesky factor of c, column by column, and its inverse, row by row."""
    for j in range(P):
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)), F.lit(1e-8))))
        df = df.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}") for i in range(j + 1, P)}) if j + 1 < P else df
    df = df.withColumns({f"v{i}{i}": 1.0 / F.col(f"l{i}{i}") for i in range(P)})
    for d in range(1, P):
        df = df.withColumns({f"v{i}{i - d}": -sum((F.col(f"l{i}{k}") * F.col(f"v{k}{i - d}") for k in range(i - d, i)), F.lit(0.0)) / F.col(f"l{i}{i}") for i in range(d, P)})
    return df.select(*keys, F.array(*[F.col(f"m{i}") for i in range(P)]).alias("center"), F.array(*[F.col(f"v{i}{j}") for i, j in PAIRS]).alias("inv"), (2 * sum((F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0))).alias("log_det"))


def _distance(z: Column, model: Column) -> Column:
    at = {p: k for k, p in enumerate(PAIRS)}
    d = [F.get(z, F.lit(j)) - F.get(model["center"], F.lit(j)) for j in range(P)]
    y = [sum((F.get(model["inv"], F.lit(at[i, j])) * d[j] for j in range(i + 1)), F.lit(0.0)) for i in range(P)]
    return sum((v * v for v in y), F.lit(0.0))


def _bucket(d2: Column) -> Column:
    return F.floor(F.log2(F.greatest(d2, F.lit(2.0**-20))) * STEPS_PER_OCTAVE).cast("int")


def _with_model(rows: DataFrame, model: DataFrame, groups: int, how: str = "inner") -> DataFrame:
    """rows with the columns of model, one row for each of so many groups g."""
    if groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(model), "g", how)
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = model.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["g", "_salt"], how).drop("_salt")


def _small(df: DataFrame) -> DataFrame:
    return common.materialise(df.coalesce(MODEL_TASKS), "mcd")


def _before(keys: list[str]) -> tuple[Column, Column]:
    """Of buckets b with n rows: the rows in the buckets before, and in all."""
    w = Window.partitionBy(*keys)
    return F.coalesce(F.sum("n").over(w.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), F.sum("n").over(w)


def _added(bins: DataFrame, keys: list[str]) -> DataFrame:
    names = ["n", *[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in PAIRS]]
    return bins.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])


def _starts(rows: DataFrame, groups: int) -> DataFrame:
    """Three starts per group around medians: quartile spreads alone, the correlation of tanh scores, and
    the spatial-sign covariance. Medians and spreads are exact to 1/256, from histograms."""
    long = rows.select("g", F.posexplode("z").alias("i", "x")).groupBy("g", "i", F.floor(F.col("x") * 256).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    before, all_ = _before(["g", "i"])
    long = long.withColumn("upto", before + F.col("n")).withColumn("all", all_)
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("b") / 256.0))
    per = long.groupBy("g", "i").agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("spread"))
    floors = F.get(F.array(*[F.lit(v) for v in STATISTICS.values()]), F.col("i"))
    per = per.withColumn("spread", F.greatest(F.col("spread"), floors))
    pick = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c)))
    med = _small(per.groupBy("g").agg(F.array(*[pick("mid", i) for i in range(P)]).alias("mid"), F.array(*[pick("spread", i) for i in range(P)]).alias("spread")))
    u = _with_model(rows, med, groups)
    u = u.select("g", *[((F.get("z", i) - F.get("mid", i)) / F.get("spread", i)).alias(f"u{i}") for i in range(P)])
    x = [F.col(f"u{i}") for i in range(P)]
    u = u.withColumn("norm2", F.greatest(sum((v * v for v in x), F.lit(0.0)), F.lit(1e-12)))
    sums = u.groupBy("g").agg(*[F.sum(F.tanh(x[i]) * F.tanh(x[j])).alias(f"t{i}{j}") for i, j in PAIRS], *[F.sum(x[i] * x[j] / F.col("norm2")).alias(f"p{i}{j}") for i, j in PAIRS])
    sums = sums.join(med, "g")
    sd = [F.get("spread", i) for i in range(P)]
    center = [F.get("mid", i).alias(f"m{i}") for i in range(P)]
    corr = lambda c, i, j: F.lit(1.0) if i == j else 0.9 * F.coalesce(F.try_divide(F.col(f"{c}{i}{j}"), F.sqrt(F.col(f"{c}{i}{i}") * F.col(f"{c}{j}{j}"))), F.lit(0.0))
    forms = [lambda i, j: F.lit(1.0 if i == j else 0.0), lambda i, j: corr("t", i, j), lambda i, j: corr("p", i, j)]
    form = lambda k, f: F.struct(F.lit(k).alias("k"), *[(f(i, j) * sd[i] * sd[j]).alias(f"c{i}{j}") for i, j in PAIRS])
    three = sums.select("g", *center, F.explode(F.array(*[form(k, f) for k, f in enumerate(forms)])).alias("_f"))
    out = _small(_factor(three.select("g", *[f"m{i}" for i in range(P)], "_f.*"), ["g", "k"]))
    common.discard(med)
    return out


def fit(rows: DataFrame, steps: int = 4) -> DataFrame:
    """Per group g of rows (g, z): center, inv, log_det, and scale, by which squared distances are divided.

    rows must be a table that is cheap to read again. A concentration step is one pass over it: sums by bucket of
    distance, of which those up to the one that reaches the share ALPHA are added up. In the same way the
    reweighting step takes the buckets that begin within its limit.
    """
    groups = rows.select("g").distinct().count()
    model = _starts(rows, groups)
    one = F.struct("center", "inv", "log_det")
    for _ in range(steps):
        three = model.groupBy("g").agg(F.array(*[F.max(F.when(F.col("k") == k, one)) for k in range(3)]).alias("models"))
        scored = _with_model(rows, three, groups)
        scored = scored.select("g", "z", F.posexplode(F.array(*[_distance(F.col("z"), F.get("models", F.lit(k))) for k in range(3)])).alias("k", "d2"))
        bins = scored.groupBy("g", "k", _bucket(F.col("d2")).alias("b")).agg(*_products())
        before, all_ = _before(["g", "k"])
        inner = bins.withColumn("before", before).withColumn("all", all_).where(F.col("before") < ALPHA * F.col("all"))
        old, model = model, _small(_fit(_added(inner, ["g", "k"]), ["g", "k"]))
        common.discard(old)
    best = _small(model.groupBy("g").agg(F.min_by(one, F.struct("log_det", "k")).alias("m")))
    common.discard(model)

    def scaled(bins: DataFrame) -> DataFrame:
        """bins with the scale that puts the median distance where that of the chi-square distribution is."""
        before, all_ = _before(["g"])
        bins = bins.withColumn("before", before).withColumn("all", all_)
        edge = F.pow(F.lit(2.0), (F.col("b") + 1) / STEPS_PER_OCTAVE)
        mid = F.min(F.when(F.col("before") + F.col("n") >= 0.5 * F.col("all"), edge)).over(Window.partitionBy("g"))
        return bins.withColumn("scale", F.greatest(mid / CHI2_MEDIAN, F.lit(1.0)))

    scored = _with_model(rows, best, groups).select("g", "z", _distance(F.col("z"), F.col("m")).alias("d2"))
    bins = scaled(scored.groupBy("g", _bucket(F.col("d2")).alias("b")).agg(*_products()))
    within = bins.where(F.pow(F.lit(2.0), F.col("b") / STEPS_PER_OCTAVE) <= CHI2_REWEIGHT * F.col("scale"))
    final = _small(_fit(_added(within, ["g"]), ["g"]).select("g", one.alias("m")))
    scored = _with_model(rows, final, groups).select("g", _distance(F.col("z"), F.col("m")).alias("d2"))
    scale = scaled(scored.groupBy("g", _bucket(F.col("d2")).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))).groupBy("g").agg(F.max("scale").alias("scale"))
    out = _small(final.join(scale, "g").select("g", "m.*", "scale"))
    common.discard(best, final)
    return out


def robust_outliers(docs: DataFrame, limit: float = CHI2_LIMIT, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source"), steps: int = 4, min_group: int = MIN_GROUP) -> DataFrame:
    """Per row: id, base statistics, base_failed, kept and distance2 (null if base_failed).

    The fit is over rows that pass the base rules, per pair of group_cols (null is a value); a group of fewer
    than min_group rows takes the fit of its first column, or of all rows; if those are fewer still, every
    such row is kept: a covariance of five statistics needs rows. A row at the limit is kept. Repeated rows count
    each and get one verdict. An empty table gives an empty result. limit is for the squared distance after scaling;
    null text has no words and fails the base rules. Other columns are not read, whatever they are called.
    """
    first, second = group_cols
    rows = base_rules(docs, id_col, text_col, carry=tuple(dict.fromkeys(group_cols)))
    rows = rows.withColumns({"g2": _group_key(first, second), "g1": _group_key(first), "z": F.array(*transformed())}).drop(*[c for c in group_cols if c != id_col])
    rows = common.materialise(rows, "statistics")
    ok = rows.where(~F.col("base_failed"))
    sizes = _small(ok.groupBy("g2", "g1").agg(F.count(F.lit(1)).alias("n2")))
    pairs, total = sizes.agg(F.count(F.lit(1)), F.sum("n2")).first()
    sizes = sizes.withColumn("n1", F.sum("n2").over(Window.partitionBy("g1")))
    group = F.when(F.col("n2") >= min_group, F.col("g2")).when(F.col("n1") >= min_group, F.col("g1")).when(F.lit((total or 0) >= min_group), F.lit("[]"))
    chosen = _small(sizes.select("g2", "g1", group.alias("g")))
    # every row counts in the fit of its pair, its first column or the whole, as far as some pair is judged by that
    levels = [F.col("g2"), F.col("g1"), F.lit("[]")]
    used = [chosen.select(x.alias("own"), "g").where("own = g").select(F.col("own").alias("g")).distinct() for x in levels[:2]]
    whole = chosen.where("g = '[]'").limit(1).count() > 0
    members = None
    for x, own in zip(levels, [*used, None], strict=True):
        part = ok.select(x.alias("g"), "z")
        if own is not None:
            part = _with_model(part, own, pairs)
        elif not whole:
            continue
        members = part if members is None else members.unionByName(part)
    model = fit(members, steps)
    judged = chosen.join(model, "g").select(F.col("g2").alias("g"), F.struct("center", "inv", "log_det").alias("m"), "scale")
    out = _with_model(rows.withColumnRenamed("g2", "g"), judged, pairs, "left")
    d2 = F.when(~F.col("base_failed"), _distance(F.col("z"), F.col("m")) / F.col("scale"))
    out = out.withColumn("distance2", d2)
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= limit)
    return out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance2")
