"""Merging clusters across buckets: domain rollups, groups, decisions, final clusters, the map of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import nonempty
from .responses import MERGE, inside_fence, parse

# Fixed values, in the order in which they are tried.
ROLLUPS = {
    "pdf-processing": ("pdf-processing", "pdf-extraction", "document-processing", "text-extraction"),
    "data-analysis": ("data-analysis", "data-processing", "data-validation", "data-profiling", "excel"),
    "frontend": ("frontend", "ui", "dashboard", "html-generation", "forms"),
    "api-development": ("api-development", "backend", "api", "fastapi"),
    "deployment": ("deployment", "infrastructure", "devops", "ci-cd"),
    "ai-integration": ("ai-integration", "llm", "prompt-engineering", "machine-learning"),
    "monitoring": ("monitoring", "logging", "observability", "error-handling"),
}
OTHER = "misc"


def domain_rollup(domains: Column, rollups: dict[str, tuple[str, ...]] = ROLLUPS) -> Column:
    """The first rollup of which any member is contained in any domain, as a substring."""
    low = F.transform(nonempty(domains), F.lower)

    def hit(members: tuple[str, ...]) -> Column:
        return F.exists(low, lambda d: F.exists(F.array(*map(F.lit, members)), lambda m: F.contains(d, m)))

    return F.coalesce(*[F.when(hit(members), name) for name, members in rollups.items()], F.lit(OTHER))


def signatures(clusters: DataFrame, by_name: bool = False, rollups: dict[str, tuple[str, ...]] = ROLLUPS) -> DataFrame:
    """Clusters as merging sees them. ``by_name`` keeps, of clusters of one name, the last only (in order of bucket)."""
    s = clusters.select(
        "bucket_key", "cluster_ord", "cluster_name", F.substring(F.coalesce("cluster_description", F.lit("")), 1, 200).alias("description"),
        nonempty(F.col("top_tags.domains")).alias("domains"), nonempty(F.col("top_tags.patterns")).alias("patterns"), nonempty(F.col("top_tags.frameworks")).alias("frameworks"),
        F.slice(nonempty(F.col("trigger_phrases")), 1, 10).alias("trigger_phrases"), F.slice(nonempty(F.col("typical_outputs")), 1, 10).alias("typical_outputs"),
        "member_doc_ids", F.size("member_doc_ids").cast("long").alias("member_count"),
    ).withColumn("domain_rollup", domain_rollup(F.col("domains"), rollups))
    if by_name:
        w = Window.partitionBy("cluster_name").orderBy(F.desc("bucket_key"), F.desc("cluster_ord"))
        s = s.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return s


def lost_by_name(clusters: DataFrame) -> DataFrame:
    """Names that several buckets use: what keying by name would lose."""
    return clusters.groupBy("cluster_name").agg(F.count(F.lit(1)).alias("n"), F.sum("member_count").alias("n_docs")).filter("n > 1")


def _united(rows: DataFrame, keys: list[str], columns: dict[str, int | None]) -> DataFrame:
    """keys, and of each array column the distinct items in order, the first so many only.

    Items are distinct rows before any are gathered, and of those beyond the first few leave a task; one pass for all columns.
    """
    def told(c: str) -> Column:
        return F.transform(nonempty(F.col(c)), lambda x: F.struct(F.lit(c).alias("kind"), x.alias("item")))

    items = rows.select(*keys, F.explode(F.concat(*map(told, columns))).alias("t")).select(*keys, "t.kind", "t.item").distinct()
    limits = {c: n for c, n in columns.items() if n is not None}
    if limits:
        place = F.row_number().over(Window.partitionBy(*keys, "kind").orderBy("item"))
        ranked = items.filter(F.col("kind").isin(*limits)).withColumn("_n", place).filter(F.col("_n") <= max(limits.values()))
        wanted = F.coalesce(*[F.when(F.col("kind") == c, F.col("_n") <= n) for c, n in limits.items()])
        items = items.filter(~F.col("kind").isin(*limits)).union(ranked.filter(wanted).drop("_n"))
    return items.groupBy(*keys).agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == c, F.col("item")))).alias(c) for c in columns])


def rollup_groups(sigs: DataFrame) -> DataFrame:
    """One row per rollup, most documents first. Tags are united as distinct rows before they are gathered."""
    keys = ["domain_rollup"]
    base = sigs.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bucket_key", "cluster_ord", "cluster_name"))), lambda c: c["cluster_name"]).alias("cluster_names"),
        F.count(F.lit(1)).alias("member_count"), F.sum("member_count").alias("total_docs"),
    )
    columns = {"domains": None, "patterns": None, "trigger_phrases": 20, "typical_outputs": 20}
    base = base.join(_united(sigs, keys, columns), keys, "left").withColumns({c: nonempty(F.col(c)) for c in columns})
    return base.withColumnRenamed("domain_rollup", "rollup").orderBy(F.desc("total_docs"), F.desc("member_count"), "rollup")


def rollup_prompt(group: DataFrame) -> DataFrame:
    cut = lambda name, n: F.array_join(F.slice(name, 1, n), ", ")
    text = F.concat_ws("\n", F.concat(F.lit("Rollup: "), F.col("rollup")), F.concat(F.lit("Clusters: "), cut("cluster_names", 15)), F.concat(F.lit("Domains: "), cut("domains", 10)), F.concat(F.lit("Patterns: "), cut("patterns", 10)), F.concat(F.lit("Triggers: "), cut("trigger_phrases", 10)), F.concat(F.lit("Outputs: "), cut("typical_outputs", 10)))
    return group.select("rollup", text.alias("prompt"))


def rule_answers(groups: DataFrame) -> DataFrame:
    """rollup, answer: everything of a rollup becomes one skill."""
    skill = F.struct(F.concat("rollup", F.lit("-skill")).alias("skill_name"), F.concat(F.lit("Documents about "), F.col("rollup")).alias("skill_description"), F.slice("trigger_phrases", 1, 5).alias("activation_triggers"), F.col("cluster_names").alias("cluster_names"), F.col("total_docs").cast("int").alias("estimated_doc_count"))
    return groups.select("rollup", F.to_json(F.struct(F.lit("merge_all").alias("recommendation"), F.array(skill).alias("skills"), F.lit("one rollup, one skill").alias("rationale"))).alias("answer"))


def skills(groups: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per skill asked for. A malformed answer gives one skill of the whole group, and counts as no decision."""
    g = groups.join(answers, "rollup", "left").withColumn("_a", parse(inside_fence(F.col("answer")), MERGE))
    fallback = F.array(F.struct(F.concat("rollup", F.lit("-skill")).alias("skill_name"), F.lit("").alias("skill_description"), F.slice("trigger_phrases", 1, 5).alias("activation_triggers"), F.col("cluster_names").alias("cluster_names"), F.lit(None).cast("int").alias("estimated_doc_count")))
    asked = F.when(F.col("_a").isNull(), fallback).otherwise(F.col("_a.skills"))
    s = g.select("rollup", F.col("cluster_names").alias("_all"), F.col("_a.recommendation").alias("recommendation"), F.posexplode(asked).alias("skill_ord", "skill"), F.size(asked).alias("_n"))
    given = F.col("skill.cluster_names")
    whole = ((F.col("recommendation") == "merge_all") & (F.col("_n") == 1)) | (F.size(nonempty(given)) == 0)
    return s.select(
        "rollup", "skill_ord", F.coalesce("skill.skill_name", F.concat("rollup", F.lit("-skill"))).alias("skill_name"), F.coalesce("skill.skill_description", F.lit("")).alias("skill_description"),
        nonempty(F.col("skill.activation_triggers")).alias("activation_triggers"), F.when(F.coalesce(whole, F.lit(False)), F.col("_all")).otherwise(given).alias("cluster_names"), F.col("recommendation").isNotNull().alias("decided"),
    )


def skill_parts(wanted: DataFrame, sigs: DataFrame) -> DataFrame:
    """rollup, skill_ord with a row for each cluster that a skill names: of its own rollup, or else of any other."""
    keys = ["rollup", "skill_ord"]
    named = wanted.select(*keys, F.explode(F.array_distinct("cluster_names")).alias("cluster_name"))
    where = named.join(sigs.select("cluster_name", "domain_rollup").distinct(), "cluster_name")
    own = F.col("domain_rollup") == F.col("rollup")
    where = where.withColumn("_own", F.max(own.cast("int")).over(Window.partitionBy(*keys, "cluster_name"))).filter(own | (F.col("_own") == 0)).drop("_own")
    return where.join(sigs, ["cluster_name", "domain_rollup"]).drop("domain_rollup")


def skill_members(wanted: DataFrame, sigs: DataFrame) -> DataFrame:
    """rollup, skill_ord, doc_id: the distinct members of each skill as rows."""
    return skill_parts(wanted, sigs).select("rollup", "skill_ord", F.explode("member_doc_ids").alias("doc_id")).distinct()


def final_clusters(wanted: DataFrame, sigs: DataFrame) -> DataFrame:
    """One row per skill: distinct sorted members, united tags, sorted triggers beyond those given.

    ``cluster_id`` names it by rollup and place, as two skills of different rollups may share a name.
    """
    keys = ["rollup", "skill_ord"]
    parts = skill_parts(wanted, sigs)
    columns = {"domains": None, "patterns": None, "frameworks": None, "trigger_phrases": 10, "typical_outputs": 15, "source_buckets": None}
    f = wanted.join(_united(parts.withColumn("source_buckets", F.array("bucket_key")), keys, columns), keys, "left")
    f = f.join(skill_members(wanted, sigs).groupBy(*keys).agg(F.array_sort(F.collect_list("doc_id")).alias("member_doc_ids")), keys, "left")
    f = f.withColumn("member_doc_ids", nonempty(F.col("member_doc_ids")))
    tags = F.struct(*[nonempty(F.col(c)).alias(c) for c in ("domains", "patterns", "frameworks")])
    return f.select(
        F.concat_ws("/", "rollup", F.col("skill_ord").cast("string")).alias("cluster_id"),
        F.col("skill_name").alias("cluster_name"), F.col("skill_description").alias("cluster_description"), "member_doc_ids", F.size("member_doc_ids").cast("long").alias("member_count"), tags.alias("top_tags"),
        F.concat("activation_triggers", nonempty(F.col("trigger_phrases"))).alias("trigger_phrases"), nonempty(F.col("typical_outputs")).alias("typical_outputs"), F.col("cluster_names").alias("source_clusters"), F.col("source_buckets"), F.col("rollup").alias("domain_rollup"), F.lit(True).alias("is_merged"), "skill_ord",
    )


def doc_to_cluster(final: DataFrame) -> DataFrame:
    """One cluster per document: of several the last, in order of rollup and skill."""
    rows = final.select(F.explode("member_doc_ids").alias("doc_id"), "cluster_name", F.struct("domain_rollup", "skill_ord").alias("o"))
    return rows.groupBy("doc_id").agg(F.max_by("cluster_name", "o").alias("cluster_name"))


def merge_summary(n_before: DataFrame, n_after: DataFrame) -> DataFrame:
    """input_clusters, output_clusters, reduction_percent."""
    counted = n_before.select(F.lit(1).alias("a"), F.lit(0).alias("b")).union(n_after.select(F.lit(0), F.lit(1))).agg(F.coalesce(F.sum("a"), F.lit(0)).alias("input_clusters"), F.coalesce(F.sum("b"), F.lit(0)).alias("output_clusters"))
    return counted.withColumn("reduction_percent", (1 - F.col("output_clusters") / F.greatest("input_clusters", F.lit(1))) * 100)
