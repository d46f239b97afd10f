"""Synthesis of packages: inputs in order, payloads with a cap, a template renderer, routing of states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty
from .responses import PACKAGE, parse, without_fence_lines

PAYLOAD_CAP = 50_000


def inputs(final: DataFrame, reps: DataFrame, extractions: DataFrame) -> DataFrame:
    """Final clusters (by cluster_id) with their extractions in order of rank; ``state``: ready, skipped (no extraction) or failed (no representatives)."""
    placed = reps.select("cluster_id", F.posexplode("representative_doc_ids").alias("place", "doc_id"))
    found = placed.join(extractions, "doc_id")
    gathered = found.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id", "payload"))).alias("parts"))
    joined = final.join(reps.select("cluster_id", F.lit(True).alias("_reps")), "cluster_id", "left").join(gathered, "cluster_id", "left")
    state = F.when(F.col("_reps").isNull(), "failed").when(F.col("parts").isNull(), "skipped").otherwise("ready")
    return joined.withColumn("state", state).drop("_reps")


def wanted(final: DataFrame, names: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """The clusters to make packages of: those named, or all; the first so many in order of name."""
    chosen = final.filter(F.col("cluster_name").isin(*names)) if names else final
    return chosen.orderBy("cluster_name").limit(limit) if limit else chosen


def payload() -> Column:
    """An extraction's nine fields for the prompt, as JSON."""
    raw = lambda k: F.coalesce(F.try_element_at("raw_sections", F.lit(k)), F.lit(""))
    return F.to_json(F.struct("doc_id", "trigger", "workflow", "code_written", "issues_and_fixes", "skill_assessment", "tags", raw("context").alias("raw_context"), raw("workflow").alias("raw_workflow")), {"ignoreNullFields": "false"})


def prompt() -> Column:
    cut = lambda name, n: F.array_join(F.slice(nonempty(F.col(name)), 1, n), ", ")
    documents = F.substring(F.concat(F.lit("["), F.array_join(F.transform("parts", lambda p: p["payload"]), ", "), F.lit("]")), 1, PAYLOAD_CAP)
    return F.concat_ws("\n", F.concat(F.lit("Write a skill package for the cluster "), F.col("cluster_name")), F.concat(F.lit("Domains: "), cut("top_tags.domains", 10)), F.concat(F.lit("Patterns: "), cut("top_tags.patterns", 10)), F.concat(F.lit("Frameworks: "), cut("top_tags.frameworks", 10)), F.concat(F.lit("Triggers: "), cut("trigger_phrases", 15)), F.concat(F.lit("Outputs: "), cut("typical_outputs", 10)), F.concat(F.lit("Documents: "), documents))


def template_answer() -> Column:
    """An offline answer: a page made from the cluster itself."""
    ids = F.transform("parts", lambda p: p["doc_id"])
    page = F.concat(F.lit("# "), F.col("cluster_name"), F.lit("\n\n"), F.coalesce("cluster_description", F.lit("")), F.lit("\n\n## When\n"), F.array_join(F.transform(F.slice("trigger_phrases", 1, 15), lambda t: F.concat(F.lit("- "), t)), "\n"), F.lit("\n\n## Sources\n"), F.array_join(F.transform(ids, lambda i: F.concat(F.lit("- "), i)), "\n"))
    files = F.array(F.struct(F.lit("references/sources.md").alias("path"), F.array_join(ids, "\n").alias("contents")))
    none = F.array().cast("array<struct<path:string,contents:string>>")
    trace = F.struct(ids.alias("source_doc_ids"), F.create_map(F.lit("Sources"), ids).alias("section_sources"))
    return F.to_json(F.struct(F.col("cluster_name").alias("skill_name"), F.substring(F.coalesce("cluster_description", F.lit("")), 1, 100).alias("description"), page.alias("skill_md"), files.alias("references_files"), none.alias("scripts_files"), none.alias("assets_files"), trace.alias("traceability")))


def packages(ready: DataFrame, answer: Column) -> DataFrame:
    """cluster_name, state (processed, skipped, failed), and files (path, contents) of each package."""
    a = ready.withColumn("_a", F.when(F.col("state") == "ready", parse(without_fence_lines(answer), PACKAGE)))
    file = lambda path, text: F.struct(path.alias("path"), text.alias("contents"))
    kind = "array<struct<path:string,contents:string>>"

    def listed(n: str) -> Column:
        found = F.transform(F.col(f"_a.{n}_files"), lambda f: file(F.coalesce(f["path"], F.lit(f"{n}/unknown.md")), F.coalesce(f["contents"], F.lit(""))))
        return F.coalesce(found, F.array().cast(kind))

    main = F.array(file(F.lit("SKILL.md"), F.coalesce("_a.skill_md", F.lit(""))), file(F.lit("traceability.json"), F.coalesce(F.to_json("_a.traceability"), F.lit("{}"))))
    state = F.when(F.col("state") != "ready", F.col("state")).when(F.col("_a").isNull(), "failed").otherwise("processed")
    keys = [c for c in ("cluster_id", "cluster_name") if c in ready.columns]
    return a.select(*keys, state.alias("state"), F.coalesce("_a.skill_name", F.when(F.col("_a").isNotNull(), F.lit("unknown-skill"))).alias("skill_name"), F.when(F.col("_a").isNotNull(), F.concat(main.cast(kind), *[listed(n).cast(kind) for n in ("references", "scripts", "assets")])).otherwise(F.array().cast(kind)).alias("files"))


def summary(done: DataFrame) -> DataFrame:
    return done.agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("processed", "failed", "skipped")])
