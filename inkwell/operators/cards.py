"""Document cards, buckets of cards, and statistics over buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty, strip

FAMILIES = ("languages", "frameworks", "tools", "domains", "patterns")
SCORES = ("reusability_total", "frequency_score", "consistency_score", "complexity_score", "codifiability_score", "toolability_score")
UNKNOWN = "unknown"


def card_tags(items: Column) -> Column:
    """Empty and unknown ones dropped; lower case, stripped, spaces to hyphens, first of equals."""
    named = F.filter(nonempty(items), lambda t: t.isNotNull() & (t != ""))
    return F.array_distinct(F.filter(F.transform(named, lambda t: F.replace(strip(F.lower(t)), F.lit(" "), F.lit("-"))), lambda t: t != UNKNOWN))


def bucket_key(domains: Column, patterns: Column) -> Column:
    """First domain and first pattern, each ``unknown`` by default."""
    return F.concat(F.coalesce(F.get(domains, F.lit(0)), F.lit(UNKNOWN)), F.lit("__"), F.coalesce(F.get(patterns, F.lit(0)), F.lit(UNKNOWN)))


def cards(extractions: DataFrame) -> DataFrame:
    """The narrow projection of extractions that all later stages read: about a tenth of their size."""
    none = F.lit(None)
    assessed = F.struct(
        F.col("skill_assessment.reusability_score").alias("reusability_total"),
        *[F.col(f"skill_assessment.{s}").alias(s) for s in SCORES[1:]],
        F.col("skill_assessment.extraction_priority").alias("extraction_priority"),
    )
    kept = F.struct(*[card_tags(F.col(f"tags.{f}")).alias(f) for f in FAMILIES])
    c = extractions.select(
        "doc_id",
        "format_detected",
        assessed.alias("scores"),
        kept.alias("tags"),
        F.struct(F.col("trigger.what_triggered").alias("what_triggered"), F.slice("trigger.keywords_phrases", 1, 10).alias("keywords"), F.col("trigger.draft_skill_trigger").alias("draft_trigger")).alias("trigger"),
        F.slice("workflow.high_level_steps", 1, 5).alias("workflow_steps"),
        F.transform(F.slice("outputs_produced.artifacts", 1, 5), lambda a: F.coalesce(a["name"], F.lit(""))).alias("artifacts"),
        F.transform(F.slice("issues_and_fixes.items", 1, 5), lambda i: F.substring(F.coalesce(i["issue"], F.lit("")), 1, 80)).alias("issues"),
        none.cast("string").alias("_unused"),
    ).drop("_unused")
    return c.withColumn("bucket_key", bucket_key(F.col("tags.domains"), F.col("tags.patterns")))


def buckets(cards: DataFrame) -> DataFrame:
    """One row per bucket, its documents in order; domain and pattern are the key's first two parts."""
    parts = F.split("bucket_key", "__")
    b = cards.groupBy("bucket_key").agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"), F.count(F.lit(1)).alias("doc_count"))
    return b.select("bucket_key", "doc_ids", F.get(parts, F.lit(0)).alias("primary_domain"), F.coalesce(F.get(parts, F.lit(1)), F.lit(UNKNOWN)).alias("primary_pattern"), "doc_count")


def bucket_members(cards: DataFrame) -> DataFrame:
    """The documents of buckets as rows: what all stages read; ``buckets`` is their form as files."""
    return cards.select("bucket_key", "doc_id")


def bucket_sizes(cards: DataFrame) -> DataFrame:
    """Sizes without the lists: what statistics need."""
    return cards.groupBy("bucket_key").agg(F.count(F.lit(1)).alias("doc_count"))


def bucket_stats(sizes: DataFrame) -> DataFrame:
    """One row over all buckets, 0 where there are none."""
    n = F.col("doc_count")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return sizes.agg(
        F.count(F.lit(1)).alias("total_buckets"),
        zero(F.sum(n)).alias("total_docs"),
        F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_bucket_size"),
        zero(F.max(n)).alias("max_bucket_size"),
        zero(F.min(n)).alias("min_bucket_size"),
        F.count_if(n == 1).alias("singleton_buckets"),
        zero(F.max(F.when(F.col("bucket_key") == f"{UNKNOWN}__{UNKNOWN}", n))).alias("unknown_bucket_size"),
    )


def top_buckets(sizes: DataFrame, n: int = 10) -> DataFrame:
    return sizes.orderBy(F.desc("doc_count"), "bucket_key").limit(n)
