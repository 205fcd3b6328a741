"""A corpus pipeline of five stages; each stage's result is written and read again as the next one's documents.

Stages know rows by a key: a digest of id, text, language and source. Rows that agree in all of these share a verdict, whether or
not their id is null or stands on other rows as well; of such repeated rows the n-gram Jaccard join keeps one. Null
and empty texts fail the quality rules, so that later stages see none in run(), and each stage alone takes them: they
are near-duplicates of nothing, hold no benchmark passage, have a rate of their own and no sequence. Stages return the columns of
their input, other columns than those of documents included; columns of documents that are missing count as null.
An empty table passes through every stage.
"""

from __future__ import annotations

import sys
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import decontaminate, mix, neardup, quality, queries
from lectern.llm.common import TEXTS, batches_of, discard, materialise, table

#: Shares of tokens that the domains of the labelled table should have, and the tokens in all, as a multiple of
#: what there is. Rates go from zero up: a domain that is over its share loses documents. What of the low
#: domain the quality rules have left should go.
TARGETS = {"high": 0.93, "low": 0.0, "toxic": 0.07}
GROWTH = 1.2
#: A domain whose reached share is further from its target is reported as missed.
TOLERANCE = 0.01
#: So many keys are looked up by a broadcast; beyond, by a shuffle.
BROADCAST_KEYS = 200_000


def _key(docs: DataFrame) -> Column:
    of = lambda c: F.col(f"`{c}`") if c in docs.columns else F.lit(None)
    return F.md5(F.to_json(F.struct(of("doc_id").alias("i"), F.md5(of("text").cast("binary")).alias("t"), of("lang").alias("l"), of("source").alias("s"))).cast("binary"))


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """What operators read of docs, under a key of that name."""
    of = lambda c: (F.col(f"`{c}`") if c in docs.columns else F.lit(None).cast("string")).alias(c)
    return docs.select(_key(docs).alias(key), *[of(c) for c in ("doc_id", "text", "lang", "source") if c in docs.columns or c != "doc_id"])


def _beside(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """docs joined with found, a written table of keys and perhaps other columns; found goes out by broadcast if it is small."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key(docs).alias("key"))
    return rows.join(F.broadcast(found) if found.count() <= BROADCAST_KEYS else found, "key", how)


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs but for the rows with these keys."""
    with batches_of(docs.sparkSession, TEXTS):
        drop = materialise(keys.select("key").distinct(), "drop")
    return _beside(docs, drop, "left_anti").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules, and outliers of their language and source."""
    return _without(docs, quality.robust_outliers(_keyed(docs, "key"), id_col="key").where("not kept"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component of near-duplicates the document of the least id (a null one last), and of rows with
    one key one."""
    own = _keyed(docs, "key")
    id_ = F.col("doc_id") if "doc_id" in docs.columns else F.lit(None).cast("long")
    named = own.select(F.struct(id_.isNull().alias("none"), id_.alias("id"), "key").alias("id"), "text")
    found = materialise(neardup.near_duplicates(named, id_col="id").select("id.key", (F.col("id") != F.col("component_id")).alias("goes")), "groups")
    left = _without(docs, found.where("goes"))
    again = materialise(found.where("not goes").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key"), "again")
    if again.isEmpty():
        return left
    once = _beside(left, again, "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return _without(left, again).unionByName(once.select("row.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return _without(docs, decontaminate.decontaminate(_keyed(docs, "key"), table(spark, sf_dir, "benchmark"), id_col="key").where("size(spans) > 0"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document in as many rows as its rate says, or in none. Domains are learned from the texts of the
    whole table, for no labelled document of a domain that the quality rules reject is left in docs."""
    rows, report = mix.mix(_keyed(docs, "key"), queries.domain_labels(spark, sf_dir), TARGETS, growth=GROWTH, teach=table(spark, sf_dir, "documents"), id_col="key", label_id_col="doc_id")
    reached = mix.shares(report, list(TARGETS))
    print("mixing, shares of tokens:", ", ".join(f"{d} {r:.4f} (target {g:.4f})" for d, (g, r) in reached.items()), file=sys.stderr)
    missed = [d for d, (g, r) in reached.items() if abs(r - g) > TOLERANCE]
    if missed:
        warnings.warn(f"mixing missed the target shares of {', '.join(missed)}", stacklevel=2)
    one = F.lit(1).cast("long")
    other = materialise(rows.where("copies <> 1").groupBy("key").agg(F.max("copies").alias("copies")), "copies")
    out = _beside(docs, other, "left").where("copies is null or copies > 0")
    return out.select("row", F.explode(F.sequence(one, F.coalesce("copies", one))).alias("copy")).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the documents as token shards in training order, and returns every record read back."""
    return queries.token_rows(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_targets),
    ("token-ID / binary output", token_output),
]

#: SQL expresses neither the covariance fits and the rates nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        last, docs = docs, stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, "stage")
        discard(last)  # the last stage has written what its result reads
    return docs
