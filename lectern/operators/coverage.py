"""From plans and profiles to a work queue: which units can be rendered, which have been, what is next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def voices(plans: DataFrame, key: str, slugs: str) -> DataFrame:
    """key, ord, slug: the distinct voices of each plan in the order in which it names them."""
    return plans.select(key, F.posexplode(F.array_distinct(F.filter(slugs, lambda s: F.coalesce(s, F.lit("")) != ""))).alias("ord", "slug"))


def voice_status(plans: DataFrame, profiles: DataFrame, key: str, slugs: str) -> DataFrame:
    """Per plan, from profiles (slug, profile_status, blocking: array of flags): missing (no profile, or a blocked
    one), failures (slug:flags), candidate_only (usable, not yet working), each a list joined by ";" in order of the plan."""
    rows = voices(plans, key, slugs).join(profiles, "slug", "left")
    gone = F.col("blocking").isNull()
    failed = gone | (F.size("blocking") > 0)
    why = F.when(gone, F.concat("slug", F.lit(":missing_profile"))).when(F.size("blocking") > 0, F.concat_ws(":", "slug", F.array_join("blocking", ",")))
    listed = lambda cond, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("ord", value.alias("v"))))), lambda x: x["v"]), ";")
    found = rows.groupBy(key).agg(listed(failed, F.col("slug")).alias("missing"), listed(failed, why).alias("failures"), listed(~failed & (F.col("profile_status") != "working"), F.col("slug")).alias("candidate_only"))
    names = ("missing", "failures", "candidate_only")
    return plans.select(key).join(found, key, "left").select(key, *[F.coalesce(c, F.lit("")).alias(c) for c in names])


def renderable(missing: Column, units: Column) -> Column:
    return F.when((missing == "") & (units > 0), "yes").otherwise("no")


def changed_profiles(then: DataFrame, now: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per row of then (key, slug, fields): the first field whose value now differs, null-safe; "missing" if there is no
    row now; rows without a change are left out."""
    rows = then.join(now.select("slug", *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_here")), "slug", "left")
    first = F.coalesce(F.when(F.col("_here").isNull(), "missing"), *[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), f) for f in fields])
    return rows.select(key, "slug", first.alias("change")).where("change is not null")


def queue(rows: DataFrame, key: str, units: str, most_units: int | None = None, limit: int | None = None, again: bool = False) -> DataFrame:
    """Renderable units that aren't rendered yet (or again), small ones first; no limit is no limit, as is 0 or None."""
    out = rows.where(F.col("renderable") == "yes")
    if not again:
        out = out.where(F.coalesce("rendered", F.lit("")) != "yes")
    if most_units is not None:
        out = out.where(F.coalesce(F.col(units), F.lit(0)) <= most_units)
    out = out.orderBy(units, key)
    return out.limit(limit) if limit else out


def apply_latest(profiles: DataFrame, candidates: DataFrame, order: str, fields: list[str], skip: str | None = "working") -> DataFrame:
    """Profiles that a candidate changes, with its fields: the last candidate of a slug in that order; slugs without a
    profile are passed over, and so are profiles whose status is skip."""
    last = candidates.groupBy("slug").agg(F.max_by(F.struct(*fields), order).alias("_new"))
    rows = profiles.join(last, "slug")
    if skip is not None:
        rows = rows.where(F.coalesce("profile_status", F.lit("")) != skip)
    return rows.select(*[c for c in profiles.columns if c not in fields], *[F.col(f"_new.{f}").alias(f) for f in fields])


def verified(files: DataFrame, manifests: DataFrame, key: str) -> DataFrame:
    """Files whose unit's check passed: they may go, for the result is known to be good."""
    return files.join(manifests.where("asr = 'passed'").select(key), key, "left_semi")


def scaffold(wanted: DataFrame, existing: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """Every wanted row, with what exists of it kept and defaults for the rest."""
    rows = wanted.join(existing.select(key, *[F.col(c).alias(f"_{c}") for c in defaults]), key, "left")
    return rows.select(*wanted.columns, *[F.coalesce(f"_{c}", v).alias(c) for c, v in defaults.items()])


def first_by(rows: DataFrame, field: str, order: str, given: DataFrame | None = None) -> DataFrame:
    """Per value of field the first card in order; a given (field, card) wins."""
    out = rows.groupBy(field).agg(F.min_by("card", order).alias("card"))
    if given is None:
        return out
    return out.join(given.select(field, F.col("card").alias("_given")), field, "full").select(field, F.coalesce("_given", "card").alias("card"))


def page_ranges(pieces: DataFrame, issue: str, order: str, pages: str, first: int = 2) -> DataFrame:
    """Each piece with the range of pages that it has in its issue, pieces one after another from page first on."""
    w = Window.partitionBy(issue).orderBy(order)
    before = F.coalesce(F.sum(pages).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pieces.withColumn("first_page", (before + first).cast("long")).withColumn("last_page", (F.col("first_page") + F.col(pages) - 1).cast("long"))


def largest(rows: DataFrame, key: str, size: str, name: str) -> DataFrame:
    """The largest file of each key; of equal ones the first by name."""
    return rows.groupBy(key).agg(F.min_by(F.struct(name, size), F.struct((-F.col(size)).alias("s"), name)).alias("_m")).select(key, F.col(f"_m.{name}").alias(name), F.col(f"_m.{size}").alias(size))
