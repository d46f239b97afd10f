"""Purity audit: candidates, a stratified sample of cards, prompts, and what becomes of the answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import nonempty
from .responses import AUDIT, parse, without_fences

MIN_SIZE = 10
FIRST = {"a_priority": 3, "b_issues": 2, "c_artifacts": 2}
#: No sample is larger.
MOST = 12


def candidates(clusters: DataFrame, name: str | None = None, min_size: int = MIN_SIZE) -> DataFrame:
    return clusters.filter(F.col("cluster_name") == name) if name else clusters.filter(F.col("member_count") >= min_size)


def sample_size(count: Column) -> Column:
    return F.least(F.lit(MOST), F.greatest(F.lit(8), F.floor(count / 4))).cast("int")


def sample(members: DataFrame, seed: str = "audit") -> DataFrame:
    """Rows of members (cluster_name, member_count, position, doc_id, priority, n_issues, n_artifacts) that the audit reads.

    Small clusters are taken whole. Otherwise the first of three strata come first, and the rest is drawn by md5 order.
    """
    by = Window.partitionBy("cluster_name")
    stratum = F.when(F.col("priority") == "high", "a_priority").when(F.col("n_issues") > 0, "b_issues").when(F.col("n_artifacts") > 0, "c_artifacts").otherwise("d_other")
    m = members.withColumn("n", sample_size(F.col("member_count"))).withColumn("stratum", stratum).withColumn("_draw", F.md5(F.concat("doc_id", F.lit(seed))))
    cards = m.groupBy("cluster_name").agg(F.count(F.lit(1)).alias("_cards"))
    # what can be chosen at all: the first of each stratum, and of the order of drawing as many as remain then; few rows of a
    # cluster leave a task, so that no task sorts a large cluster
    first = m.withColumn("_at", F.row_number().over(Window.partitionBy("cluster_name", "stratum").orderBy("position"))).filter(F.col("_at") <= max(FIRST.values()))
    drawn = m.withColumn("_at", F.row_number().over(by.orderBy("_draw", "position"))).filter(F.col("_at") <= MOST + sum(FIRST.values())).withColumn("_at", F.lit(None).cast("int"))
    m = first.union(drawn).groupBy("cluster_name", "position").agg(F.min("_at").alias("_at"), *[F.first(c).alias(c) for c in m.columns if c not in ("cluster_name", "position")]).join(cards, "cluster_name")
    taken = F.coalesce(*[F.when(F.col("stratum") == s, F.col("_at") <= k) for s, k in FIRST.items()], F.lit(False))
    m = m.withColumn("_first", F.coalesce(taken, F.lit(False)).cast("int"))
    ranked = m.withColumn("sample_rank", F.row_number().over(by.orderBy(F.desc("_first"), F.when(F.col("_first") == 1, F.col("stratum")), F.when(F.col("_first") == 1, F.col("position")), "_draw", "position")))
    chosen = ranked.filter((F.col("_cards") <= F.col("n")) | (F.col("sample_rank") <= F.col("n")))
    return chosen.select(*members.columns, "n", "stratum", "sample_rank")


def card_text() -> Column:
    cut = lambda name, n: F.array_join(F.slice(nonempty(F.col(name)), 1, n), ", ")
    return F.concat_ws("\n", F.concat(F.lit("Document: "), F.col("doc_id")), F.concat(F.lit("Trigger: "), F.substring(F.coalesce("trigger.what_triggered", F.lit("")), 1, 300)), F.concat(F.lit("Keywords: "), cut("trigger.keywords", 5)), F.concat(F.lit("Domains: "), cut("tags.domains", 5)), F.concat(F.lit("Patterns: "), cut("tags.patterns", 5)), F.concat(F.lit("Steps: "), cut("workflow_steps", 3)), F.concat(F.lit("Artifacts: "), cut("artifacts", 3)), F.concat(F.lit("Issues: "), cut("issues", 3)))


def prompts(sampled: DataFrame) -> DataFrame:
    """cluster_name, prompt; sampled has a column text per card and sample_rank."""
    cards = F.transform(F.array_sort(F.collect_list(F.struct("sample_rank", "text"))), lambda c: c["text"])
    return sampled.groupBy("cluster_name").agg(F.concat(F.lit("Are these documents about one skill? Answer with JSON.\n\n"), F.array_join(cards, "\n---\n")).alias("prompt"))


def results(answers: DataFrame) -> DataFrame:
    """answers (cluster_name, member_count, answer): a malformed answer keeps the cluster, with confidence 0."""
    a = answers.withColumn("_a", parse(without_fences(F.col("answer")), AUDIT))
    ok = F.col("_a").isNotNull()
    return a.select(
        "cluster_name", "member_count", F.when(ok, F.coalesce("_a.is_pure", F.lit(True))).otherwise(True).alias("is_pure"),
        F.when(ok, F.coalesce("_a.recommendation", F.lit("keep_as_is"))).otherwise("keep_as_is").alias("recommendation"), F.when(ok, F.coalesce("_a.confidence", F.lit(0.0))).otherwise(0.0).alias("confidence"), F.col("_a.split_into").alias("split_into"), F.when(ok, F.coalesce("_a.reasoning", F.lit(""))).otherwise("").alias("reasoning"),
    )


def splits(audited: DataFrame) -> DataFrame:
    return audited.filter(F.col("recommendation") == "split")


def kept(audited: DataFrame) -> DataFrame:
    return audited.filter(F.col("recommendation") != "split").select("cluster_name")


def rule_answers(prompted: DataFrame) -> DataFrame:
    """cluster_name, answer: an offline auditor that keeps every cluster."""
    answer = F.to_json(F.struct(F.lit(True).alias("is_pure"), F.lit("keep_as_is").alias("recommendation"), F.lit(0.5).alias("confidence"), F.lit("kept by rule").alias("reasoning")))
    return prompted.select("cluster_name", answer.alias("answer"))


def summary(audited: DataFrame) -> DataFrame:
    """One row: clusters audited, splits recommended, clusters kept."""
    split = F.col("recommendation") == "split"
    return audited.agg(F.count(F.lit(1)).alias("audited"), F.count_if(split).alias("splits"), F.count_if(~split).alias("kept"))
