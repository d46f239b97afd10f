"""Tag enrichment: which cards need it, prompts, the rule decider, vocabulary checks, merging back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty
from .cards import bucket_key
from .responses import ENRICHMENT, inside_fence, parse

# The vocabularies.
DOMAINS = (
    "data-analysis", "data-processing", "data-validation", "data-profiling",
    "pdf-processing", "pdf-extraction", "document-processing", "text-extraction",
    "api-development", "backend", "frontend", "ui", "dashboard",
    "deployment", "infrastructure", "devops", "ci-cd",
    "ai-integration", "llm", "prompt-engineering", "machine-learning",
    "database", "sql", "nosql", "data-modeling",
    "testing", "qa", "automation", "scripting",
    "logging", "monitoring", "observability", "error-handling",
    "authentication", "security", "authorization",
    "file-processing", "image-processing", "audio-processing", "video-processing",
    "web-scraping", "etl", "data-pipeline", "workflow-automation",
    "cli-tools", "utilities", "configuration", "settings",
)
PATTERNS = (
    "feature-implementation", "bug-fix", "refactor", "optimization",
    "integration", "migration", "upgrade", "configuration",
    "extraction", "transformation", "loading", "etl",
    "api-wrapper", "client-library", "sdk-integration",
    "ui-component", "form-handling", "data-visualization",
    "error-handling", "retry-logic", "fallback",
    "caching", "performance", "scaling",
    "validation", "sanitization", "normalization",
    "report-generation", "export", "import",
    "scheduled-task", "batch-processing", "async-processing",
    "template-creation", "code-generation", "scaffolding",
)


def needs_enrichment(domains: Column, patterns: Column) -> Column:
    """No valid domain, or no valid pattern."""
    valid = lambda tags: F.exists(nonempty(tags), lambda t: t.isNotNull() & (t != "") & (t != "unknown"))
    return ~valid(domains) | ~valid(patterns)


def candidates(cards: DataFrame, limit: int | None = None) -> DataFrame:
    found = cards.filter(needs_enrichment(F.col("tags.domains"), F.col("tags.patterns")))
    return found.orderBy("doc_id").limit(limit) if limit else found


def prompt(vocabulary: tuple[tuple[str, ...], tuple[str, ...]] = (DOMAINS, PATTERNS)) -> Column:
    card = F.to_json(F.struct("doc_id", "trigger", "workflow_steps", "artifacts", "issues", "tags"), {"ignoreNullFields": "false"})
    ask = "Choose one to three domains and one to three patterns for this card, from the lists only. Answer with JSON: domains, patterns, confidence, reasoning."
    return F.concat(F.lit(ask + "\nDomains: " + ", ".join(vocabulary[0]) + "\nPatterns: " + ", ".join(vocabulary[1]) + "\nCard: "), card)


def rule_decider(vocabulary: tuple[tuple[str, ...], tuple[str, ...]] = (DOMAINS, PATTERNS)) -> Column:
    """An offline answer: terms of the vocabulary that occur as tokens in the card, in its order, three at most."""
    said = F.lower(F.concat_ws(" ", F.col("trigger.what_triggered"), F.array_join("workflow_steps", " "), F.array_join("artifacts", " "), *[F.array_join(f"tags.{f}", " ") for f in ("languages", "frameworks", "tools", "domains", "patterns")]))
    padded = F.concat(F.lit("-"), F.regexp_replace(said, r"[^a-z0-9]+", "-"), F.lit("-"))
    pick = lambda terms: F.slice(F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(padded, F.concat(F.lit("-"), t, F.lit("-")))), 1, 3)
    return F.to_json(F.struct(pick(vocabulary[0]).alias("domains"), pick(vocabulary[1]).alias("patterns"), F.lit(0.5).alias("confidence"), F.lit("terms that occur").alias("reasoning")))


def in_vocabulary(found: Column, terms: tuple[str, ...], old: Column) -> Column:
    """Known terms in their order, repeats kept; the old tags if none is known."""
    kept = F.filter(nonempty(found), lambda t: F.array_contains(F.array(*map(F.lit, terms)), t))
    return F.when(F.size(kept) > 0, kept).otherwise(old)


def enrich(cards: DataFrame, answer: Column, vocabulary: tuple[tuple[str, ...], tuple[str, ...]] = (DOMAINS, PATTERNS), only: Column | None = None) -> DataFrame:
    """All cards, those in need with tags from the answer (a Column of text); one pass, no join.

    ``_enrichment`` is null where a card wasn't touched; a malformed answer leaves it as it was, with an error.
    ``only``: which of the cards in need are asked about at all.
    """
    needed = needs_enrichment(F.col("tags.domains"), F.col("tags.patterns"))
    if only is not None:
        needed = needed & only
    c = cards.withColumn("_answer", F.when(needed, parse(inside_fence(answer), ENRICHMENT))).withColumn("_needed", needed)
    ok = F.col("_answer").isNotNull()
    old = F.col("bucket_key")
    tags = F.col("tags").withField("domains", in_vocabulary(F.col("_answer.domains"), vocabulary[0], F.col("tags.domains"))).withField("patterns", in_vocabulary(F.col("_answer.patterns"), vocabulary[1], F.col("tags.patterns")))
    note = F.when(
        F.col("_needed"),
        F.struct(
            ok.alias("enriched"),
            F.when(ok, F.coalesce(F.col("_answer.confidence"), F.lit(0.0))).alias("confidence"),
            F.when(ok, F.coalesce(F.col("_answer.reasoning"), F.lit(""))).alias("reasoning"),
            F.when(ok, old).alias("original_bucket_key"),
            F.when(~ok, F.lit("malformed answer")).alias("error"),
        ),
    )
    c = c.withColumn("_enrichment", note).withColumn("tags", F.when(ok, tags).otherwise(F.col("tags")))
    return c.withColumn("bucket_key", F.when(ok, bucket_key(F.col("tags.domains"), F.col("tags.patterns"))).otherwise(old)).drop("_answer", "_needed")


def merge_back(cards: DataFrame, enriched: DataFrame) -> DataFrame:
    """Cards with those replaced that were enriched elsewhere (a table of the same columns, unique by doc_id)."""
    new = enriched.select("doc_id", F.struct(*[c for c in enriched.columns if c != "doc_id"]).alias("_new"))
    joined = cards.join(new, "doc_id", "left")
    shared = set(enriched.columns)
    return joined.select("doc_id", *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c) for c in cards.columns if c != "doc_id"])


def summary(enriched: DataFrame) -> DataFrame:
    """One row: cards, those in need of tags, those enriched, those that failed, and those that changed their bucket."""
    done = F.coalesce(F.col("_enrichment.enriched"), F.lit(False))
    needed = F.col("_enrichment").isNotNull()
    moved = done & (F.col("_enrichment.original_bucket_key") != F.col("bucket_key"))
    return enriched.agg(F.count(F.lit(1)).alias("cards"), F.count_if(needed).alias("needed"), F.count_if(done).alias("enriched"), F.count_if(needed & ~done).alias("failed"), F.count_if(moved).alias("moved"))


def bucket_changes(enriched: DataFrame) -> DataFrame:
    moved = enriched.filter(F.col("_enrichment.enriched") & (F.col("_enrichment.original_bucket_key") != F.col("bucket_key")))
    return moved.select("doc_id", F.col("_enrichment.original_bucket_key").alias("old_bucket"), F.col("bucket_key").alias("new_bucket"))
