"""The test tables in the engine's shapes: cards and clusters from documents, notes in Markdown from orders, answers from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards from documents and labels: domain by language, pattern by source; every seventh has no domain."""
    d, labels = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), table(spark, sf_dir, "labels")
    j = d.join(labels, "doc_id", "left")
    domain = F.when(F.col("lang") == "en", "api-development").when(F.col("lang") == "fr", "data-analysis").when(F.col("lang") == "de", "ui-guidelines").otherwise("notes")
    none = F.array().cast("array<string>")
    listed = lambda c: F.array(c).cast("array<string>")
    tags = F.struct(none.alias("languages"), F.when(F.col("n_chars") % 2 == 0, listed(F.lit("spark"))).otherwise(none).alias("frameworks"), none.alias("tools"), F.when(F.col("doc_id") % 7 == 0, none).otherwise(listed(domain)).alias("domains"), listed(F.col("source")).alias("patterns"))
    c = j.select(
        F.format_string("doc%08d", "doc_id").alias("doc_id"),
        F.struct((F.col("n_chars") % 26).cast("int").alias("reusability_total"), F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("extraction_priority")).alias("scores"),
        tags.alias("tags"),
        F.struct(F.concat(F.lit("export "), F.col("source")).alias("what_triggered"), listed(F.col("lang")).alias("keywords"), F.lit(None).cast("string").alias("draft_trigger")).alias("trigger"),
        none.alias("workflow_steps"),
        F.when(F.col("n_chars") % 4 == 0, listed(F.concat("source", F.lit(".csv")))).otherwise(none).alias("artifacts"),
        F.when(F.col("toxic") == 1, listed(F.lit("offending text"))).otherwise(none).alias("issues"),
        (F.col("n_chars") % 3 == 0).alias("has_code"),
    )
    return c.withColumn("bucket_key", F.concat(F.coalesce(F.get("tags.domains", F.lit(0)), F.lit("unknown")), F.lit("__"), F.get("tags.patterns", F.lit(0))))


def card_extractions(cards: DataFrame) -> DataFrame:
    block = F.struct(F.lit("sql").alias("language"), F.lit("select 1").alias("code"), F.lit(None).cast("string").alias("heading"), F.lit(True).alias("reuse_flag"))
    return cards.filter("has_code").select("doc_id", F.struct(F.array(block).alias("blocks")).alias("code_written"))


def bucket_clusters(cards: DataFrame) -> DataFrame:
    """One cluster per bucket, in the shape of incremental clusters."""
    c = cards.groupBy("bucket_key").agg(
        F.array_sort(F.collect_list("doc_id")).alias("member_doc_ids"), F.count(F.lit(1)).alias("member_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("trigger.keywords")))).alias("trigger_phrases"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("artifacts")))).alias("typical_outputs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags.domains")))).alias("domains"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags.patterns")))).alias("patterns"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags.frameworks")))).alias("frameworks"),
    )
    return c.select("bucket_key", F.lit(0).cast("long").alias("cluster_ord"), F.concat("bucket_key", F.lit("-1")).alias("cluster_name"), F.concat(F.lit("About "), "bucket_key").alias("cluster_description"), "member_doc_ids", "member_count", F.struct("domains", "patterns", "frameworks").alias("top_tags"), "trigger_phrases", "typical_outputs")


def _full() -> Column:
    return F.concat_ws(
        "\n", F.lit("# Section A: Header"), F.concat(F.lit("- **Date**: "), "day"), F.concat(F.lit("- **Type**: "), "o_orderpriority"), F.concat(F.lit("- **Domain/Module**: "), "n_name"), F.concat(F.lit("- **Complexity**: "), "complexity"),
        F.concat(F.lit("- **Time Spent**: "), "n_lines", F.lit(" hours")), F.concat(F.lit("- **Repo/Branch**: orders/"), "o_custkey"), F.lit(""), F.concat(F.lit("**What triggered this task?**: Order "), "o_orderkey", F.lit(" of customer "), "o_custkey"), F.lit(""),
        F.lit("**Keywords/Phrases**:"), F.concat(F.lit('- "'), "c_mktsegment", F.lit('"')), F.concat(F.lit('- "'), "n_name", F.lit('"')), F.lit(""),
        F.lit("## Section B: Context"), F.concat(F.lit("**Objective**: Ship order "), "o_orderkey"), F.concat(F.lit("**Environment**: "), "o_orderstatus", F.lit(" yard")), F.concat(F.lit("**Requirements/Problem**: Customer "), "o_custkey"), F.lit(""),
        F.lit("## Section C: Workflow"), F.lit("**Workflow Type**: batch"), F.lit(""), F.col("steps"), F.lit(""), F.lit("| Decision | Options | Choice | Rationale |"), F.lit("| --- | --- | --- | --- |"), F.col("decisions"), F.lit(""),
        F.lit("## Section D: Knowledge"), F.lit("**Database**: orders and lines"), F.lit("**API**: carrier api"), F.lit(""), F.concat(F.lit("- **Runbook**: page "), "o_custkey"), F.lit(""),
        F.lit("## Section E: Code"), F.concat(F.lit("### Load order "), "o_orderkey"), F.lit("```sql"), F.concat(F.lit("select * from lineitem where l_orderkey = "), "o_orderkey"), F.lit("```"), F.lit("This block is reusable."), F.lit(""),
        F.lit("## Section F: Outputs"), F.lit("| Filename | Format | Purpose | Template Potential |"), F.lit("| --- | --- | --- | --- |"), F.concat(F.lit("| order_"), "o_orderkey", F.lit(".csv | csv | shipping list | [x] Yes |")), F.lit(""),
        F.lit("## Section G: Issues"), F.lit("| Issue | Root Cause | Fix |"), F.lit("| --- | --- | --- |"), F.concat(F.lit("| Delay of order "), "o_orderkey", F.lit(" | flag "), "flag", F.lit(" | call customer "), "o_custkey", F.lit(" |")), F.lit(""),
        F.lit("## Section H: Verification"), F.concat(F.lit("- Row check: "), "n_lines", F.lit(" rows")), F.lit("- [x] Totals agree"), F.lit("- [ ] Label printed"), F.lit(""),
        F.lit("## Section I: Skill Assessment"), F.lit("| Dimension | Score |"), F.concat(F.lit("| Frequency | "), "n_lines", F.lit(" |")), F.lit("| Consistency | 3 |"), F.lit("| Complexity | 2 |"), F.lit("| Codifiability | 4 |"), F.lit("| Tool-ability | 5 |"),
        F.concat(F.lit("| TOTAL | "), (F.col("n_lines") + 14).cast("string"), F.lit(" |")), F.lit("- [x] **High Priority**"), F.lit(""),
        F.lit("## Section J: Tags"), F.lit("- **Languages**: SQL, Python"), F.lit("- **Frameworks**: Spark"), F.concat(F.lit("- **Domains**: "), "c_mktsegment", F.lit(", "), "n_name"), F.lit("- **Patterns**: Batch Processing; Export"), F.lit("- **Tools**: none"), F.lit("- **Services**: none"),
    )


def _quick() -> Column:
    return F.concat_ws(
        "\n", F.concat(F.lit("**Date**: "), "day", F.lit(" | **Type**: "), "o_orderpriority", F.lit(" | **Domain**: "), "n_name"), F.lit(""), F.lit("## Trigger"), F.concat(F.lit("> Ship order "), "o_orderkey"), F.lit(""), F.lit("## Workflow"), F.col("steps"), F.lit(""),
        F.lit("## Key Decisions"), F.concat(F.lit("- **Carrier "), "o_custkey", F.lit("** -> rail -> cheaper")), F.lit(""), F.lit("## Issues"), F.concat(F.lit("- Delay "), "o_orderkey", F.lit(" -> call customer "), "o_custkey"), F.lit(""),
        F.lit("## Skill Potential: Medium"), F.lit(""), F.lit("## Tags"), F.concat(F.lit("Languages: SQL | Domains: "), "c_mktsegment", F.lit(" | Patterns: Export")),
    )


def _legacy() -> Column:
    return F.concat_ws("\n", F.concat(F.lit("Task Documentation "), "o_orderkey"), F.lit(""), F.lit("## A. Overview"), F.concat(F.lit("- **Date**: "), "day"), F.concat(F.lit("- **Type**: "), "o_orderpriority"), F.lit(""), F.lit("## B. Steps"), F.col("steps"))


def order_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One note per order (path, content, o_orderkey), in the format that the key modulo 3 names: full, quick, legacy."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    said = lines.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))).alias("lines"), F.count(F.lit(1)).alias("n"), F.max("l_returnflag").alias("flag")
    )
    text = lambda c: c.cast("string")
    step = F.transform("lines", lambda x: F.concat(text(x["l_linenumber"]), F.lit(". Pick part "), text(x["l_partkey"]), F.lit(" from supplier "), text(x["l_suppkey"])))
    decision = F.transform("lines", lambda x: F.concat(F.lit("| Ship line "), text(x["l_linenumber"]), F.lit(" | rail, air | "), x["l_returnflag"], F.lit(" | status "), x["l_linestatus"], F.lit(" |")))
    o = table(spark, sf_dir, "orders").join(said, F.col("o_orderkey") == F.col("l_orderkey"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    o = o.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).withColumn("complexity", F.when(F.col("o_orderstatus") == "F", "High").when(F.col("o_orderstatus") == "O", "Medium").otherwise("Low"))
    o = o.withColumn("steps", F.array_join(step, "\n")).withColumn("decisions", F.array_join(decision, "\n")).withColumn("n_lines", F.col("n"))
    kind = F.col("o_orderkey") % 3
    notes = o.select("o_orderkey", F.format_string("notes/SR-PTD_%d.md", "o_orderkey").alias("path"), F.when(kind == 0, _full()).when(kind == 1, _quick()).otherwise(_legacy()).alias("content"))
    # extraction costs far more per byte than the sizes tell by which partitions would be coalesced
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return notes.repartition(n, "o_orderkey")


def event_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to enrichment from events: plain, fenced, malformed, and out of the vocabulary, by event_id modulo 4."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    body = F.concat(F.lit('{"domains": ["etl", "'), "event_type", F.lit('"], "patterns": ["export"], "confidence": 0.5, "reasoning": "k'), F.coalesce("k", F.lit("")), F.lit('"}'))
    kind = F.col("event_id") % 4
    other = F.concat(F.lit('{"domains": ["'), "event_type", F.lit('"], "patterns": ["nothing"], "confidence": 0.25}'))
    fence = F.lit("```")
    answer = F.when(kind == 0, body).when(kind == 1, F.concat(fence, F.lit("json\n"), body, F.lit("\n"), fence, F.lit("\nDone."))).when(kind == 2, F.substring(body, 1, 20)).otherwise(other)
    return e.select("event_id", "event_type", "k", answer.alias("answer"))
