"""Whether a plan's recording is whole and still that of its speakers: the first check that fails names the status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .score import first_failure


def _named(name: str, *more: Column) -> Column:
    return F.concat_ws(":", F.lit(name), *more)


def speaker_problems(plans: DataFrame, manifests: DataFrame, profiles: DataFrame, fields: list[str]) -> DataFrame:
    """plan, problem: of the first speaker of each plan with one. plans: plan, slugs in order; manifests: plan, audits (a map of slug to a struct of
    fields); profiles: slug, flags that block, fields."""
    rows = plans.select("plan", F.posexplode("slugs").alias("_at", "slug")).join(profiles.withColumn("_p", F.lit(True)), "slug", "left")
    rows = rows.join(manifests.select("plan", "audits"), "plan", "left").withColumn("_then", F.try_element_at("audits", F.col("slug")))
    checks = [
        (F.col("_p").isNull(), _named("current_profile_missing", F.col("slug"))),
        (F.size("flags") > 0, _named("current_profile_failed", F.col("slug"), F.array_join("flags", ","))),
        (F.col("_then").isNull(), _named("manifest_missing_profile_audit", F.col("slug"))),
        *[(~F.col(f"_then.{f}").eqNullSafe(F.col(f)), _named("voice_profile_changed", F.col("slug"), F.lit(f))) for f in fields],
    ]
    rows = rows.withColumn("problem", F.coalesce(*[F.when(c, n) for c, n in checks])).where("problem is not null")
    first = F.row_number().over(Window.partitionBy("plan").orderBy("_at"))
    return rows.withColumn("_n", first).where("_n = 1").select("plan", "problem")


def render_status(plans: DataFrame, files: DataFrame, manifests: DataFrame, profiles: DataFrame, fields: list[str], slack: float = 1.0) -> DataFrame:
    """plan, rendered (yes or no), status. files: plan, error, seconds, sha; manifests: plan, error, sha, seconds, audits (see above).

    A sum or length that the manifest doesn't give isn't compared."""
    rows = plans.select("plan").join(files.select("plan", F.lit(True).alias("_f"), F.col("error").alias("_fe"), "seconds", "sha"), "plan", "left")
    rows = rows.join(manifests.select("plan", F.lit(True).alias("_m"), F.col("error").alias("_me"), F.col("sha").alias("_sha"), F.col("seconds").alias("_s"), "audits"), "plan", "left")
    rows = rows.join(speaker_problems(plans, manifests, profiles, fields), "plan", "left")
    given = F.coalesce(F.col("_s"), F.lit(0.0))
    named = lambda name, error: F.when(error.isNotNull(), _named(name, error))
    checks = [
        (F.col("_f").isNull(), "missing_mp3"),
        (F.col("_fe").isNotNull(), "probe"),
        (~F.coalesce(F.col("seconds") > 0, F.lit(False)), "invalid_duration"),
        (F.col("_m").isNull(), "missing_manifest"),
        (F.col("_me").isNotNull(), "manifest"),
        ((F.coalesce(F.col("_sha"), F.lit("")) != "") & ~F.col("_sha").eqNullSafe(F.col("sha")), "manifest_sha_mismatch"),
        ((given != 0) & (F.abs(given - F.col("seconds")) > slack), "manifest_duration_mismatch"),
        (F.coalesce(F.size("audits"), F.lit(0)) <= 0, "missing_voice_profile_audit"),
        (F.col("problem").isNotNull(), "speaker"),
    ]
    first = first_failure(checks)
    status = F.when(first == "probe", named("ffprobe_failed", F.col("_fe"))).when(first == "manifest", named("manifest_read_failed", F.col("_me"))).when(first == "speaker", F.col("problem")).otherwise(first)
    return rows.select("plan", F.when(status == "ok", "yes").otherwise("no").alias("rendered"), status.alias("status"))
