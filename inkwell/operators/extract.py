"""Typed nested records from Markdown notes: one row a document, narrow projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinct_ignoring_case, doc_id, every, first, let, nonempty, normalize_tag, py, rows, strip, text_list
from .codeblocks import BLOCK, code_blocks, code_blocks_nearest
from .sections import detect_format, section_map, with_segments

# Fixed values of the format: patterns, word lists, messages.
QUOTE = r">\s*(.+?)(?=\n(?!>)|$)"
DECISION_ROW = r"\|\s*([^|]+)\s*\|\s*([^|]+)\s*\|\s*([^|]+)\s*\|\s*([^|]+)\s*\|"
ARROW_DECISION = r"-\s*\*?\*?([^*\n]+)\*?\*?\s*->\s*([^\->]+)\s*(?:->\s*(.+))?"
STEP = r"^\s*(\d+)\.\s+(.+?)(?=\n\s*\d+\.|$)"
STEP_LINE = r"^(\d+)\.\s*(.+)$"
ARTIFACT_ROW = r"\|\s*`?([^|`]+)`?\s*\|\s*([^|]+)\s*\|\s*([^|]+)\s*\|(?:\s*([^|]+)\s*\|)?"
MODIFIED_FILE = r"-\s*`?([^`\n:]+(?:\.(?:py|js|ts|html|css|json|md|yaml|yml|xml))?)`?(?:\s*[-:]?\s*(.+))?"
ISSUE_ROW = r"\|\s*([^|]+)\s*\|\s*([^|]+)\s*\|\s*([^|]+)\s*\|"
ISSUE_PART = r"##\s*Issues?[^#]*?(?=##|$)"
ISSUE_BULLET = r"-\s*([^\->:\n]+)\s*(?:->|:)\s*([^\->\n]+)(?:\s*->\s*(.+))?"
NOT_ISSUES = (
    "tests", "validation", "success criteria", "pr/diff", "scripts", "snippets", "configs", "docs updated", "template", "utility",
    "storage", "saved as", "location", "artifacts", "modified files", "environment", "starting state",
)
KNOWN_KNOWLEDGE = ("db", "database", "api", "code", "codebase", "code patterns")
PARAGRAPH = r":\s*([^\n]+(?:\n(?!\*\*)[^\n]+)*)"
BULLETS_OR_LINE = r"\*\*:\s*\n?((?:\s*-[^\n]+\n?)+|[^\n*]+)"
TAG_FIELDS = {
    "languages": r"(?:\*\*)?Languages?(?:\*\*)?:\s*([^|\n]+)",
    "frameworks": r"(?:\*\*)?Frameworks?(?:/Libs?)?(?:\*\*)?:\s*([^|\n]+)",
    "tools": r"(?:\*\*)?(?:Tools?|Operational)(?:\*\*)?:\s*([^|\n]+)",
    "domains": r"(?:\*\*)?Domains?(?:\*\*)?:\s*([^|\n]+)",
    "patterns": r"(?:\*\*)?Patterns?(?:\*\*)?:\s*([^|\n]+)",
    "services": r"(?:\*\*)?(?:External\s*)?Services?(?:\*\*)?:\s*([^|\n]+)",
}


def metadata(text: Column) -> Column:
    return F.struct(
        first(text, r"\*\*Date\*\*:\s*(\d{4}-\d{2}-\d{2})").alias("date"),
        F.lit(None).cast("string").alias("task_id"),
        first(text, r"\*\*Type\*\*:\s*([^|*\n]+)").alias("task_type"),
        first(text, r"\*\*Domain(?:/Module)?\*\*:\s*([^|*\n]+)").alias("domain"),
        first(text, r"\*\*Complexity\*\*:\s*(\w+)").alias("complexity"),
        first(text, r"\*\*Time Spent\*\*:\s*([^\n]+)").alias("time_spent"),
        first(text, r"\*\*Repo/Branch(?:/PR/Commits)?\*\*:\s*([^\n]+)").alias("repo_branch"),
    )


def _unquoted(text: Column) -> Column:
    return F.regexp_replace(text, "^[> ]+", "")


def trigger(text: Column) -> Column:
    quotes = every(text, QUOTE, "s")
    quoted = F.when(F.size(quotes) > 0, F.array_join(F.transform(quotes, strip), " "))
    asked = _unquoted(first(text, r"\*\*What triggered[^*]*\*\*[:\s]*\n?>?\s*(.+?)(?=\n\n|\n\*\*|$)", "is"))
    block = r"[:\s]*\n?((?:>?\s*-[^\n]+\n?)+|[^\n*]+)"
    words = F.regexp_extract(text, py(r"\*\*Keywords?[^*]*\*\*" + block, "i"), 1)
    marks = F.regexp_extract(text, py(r"\*\*Context Markers?\*\*" + block, "i"), 1)
    keywords = F.transform(F.filter(every(words, r'[-*>]\s*"?([^"\n]+)"?'), lambda k: strip(k) != ""), lambda k: F.regexp_replace(k, r"^[ \"']+|[ \"']+$", ""))
    markers = F.filter(F.transform(every(marks, r"[-*>]\s*([^\n]+)"), strip), lambda m: m != "")
    return F.struct(
        F.coalesce(asked, quoted).alias("what_triggered"),
        nonempty(keywords).alias("keywords_phrases"),
        nonempty(markers).alias("context_markers"),
        _unquoted(first(text, r"\*\*Draft Skill Trigger\*\*[:\s]*\n?>?\s*(.+?)(?=\n\n|\n\*\*|$)", "is")).alias("draft_skill_trigger"),
    )


def context(text: Column) -> Column:
    return F.struct(
        first(text, r"(?:Problem Statement|Requirements/Problem)[:\s]*\n?\*?\*?([^\n*]+(?:\n(?!\*\*)[^\n*]+)*)", "i").alias("problem_statement"),
        first(text, r"\*\*Starting state" + BULLETS_OR_LINE, "i").alias("starting_state"),
        first(text, r"\*\*Environment(?:/Versions?)?" + BULLETS_OR_LINE, "i").alias("environment"),
        first(text, r"\*\*Constraints?(?:/Dependencies)?" + BULLETS_OR_LINE, "i").alias("constraints"),
        first(text, r"\*\*Objective\*\*:\s*([^\n]+)").alias("objective"),
        first(text, r"\*\*Requirements?(?:/Problem)?\*\*:\s*([^\n]+)").alias("requirements"),
        text_list().alias("success_criteria"),
    )


def steps(text: Column) -> Column:
    """array<struct<step_number, action>> by number, equal steps once, ties by first place."""
    def listed(pattern: str, flags: str, clean) -> Column:
        found = rows(text, pattern, ["n", "t"], flags)
        return F.transform(found, lambda r, i: F.struct(r["n"].cast("int").alias("n"), i.alias("at"), clean(r["t"]).alias("t")))

    main = F.filter(listed(STEP, "ms", lambda t: strip(F.get(F.split(t, "\n"), F.lit(0)))), lambda r: (r["t"] != "") & ~r["t"].startswith("-"))
    rest = F.filter(listed(STEP_LINE, "m", strip), lambda r: r["t"] != "")
    found = let(main, lambda m: F.array_sort(F.when(F.size(m) > 0, m).otherwise(rest)))
    return F.array_distinct(F.transform(found, lambda r: F.struct(r["n"].alias("step_number"), r["t"].alias("action"))))


def decisions(text: Column) -> Column:
    kind = "array<struct<decision:string,options:string,choice:string,rationale:string>>"
    table = F.filter(rows(text, DECISION_ROW, ["a", "b", "c", "d"]), lambda r: ~F.contains(F.lower(r["a"]), F.lit("decision")) & ~F.contains(r["a"], F.lit("---")))
    table = F.transform(table, lambda r: F.struct(*[strip(r[x]).alias(n) for x, n in zip("abcd", ("decision", "options", "choice", "rationale"), strict=True)]))
    arrows = F.transform(rows(text, ARROW_DECISION, ["a", "c", "d"]), lambda r: F.struct(strip(r["a"]).alias("decision"), F.lit(None).cast("string").alias("options"), strip(r["c"]).alias("choice"), strip(r["d"]).alias("rationale")))
    return F.coalesce(F.concat(table.cast(kind), arrows.cast(kind)), F.array().cast(kind))


def knowledge(text: Column) -> Column:
    kind = "array<struct<type:string,detail:string>>"
    db = first(text, r"\*\*(?:DB|Database)[^*]*\*\*" + PARAGRAPH, "i")
    api = first(text, r"\*\*API[^*]*\*\*" + PARAGRAPH, "i")
    code = first(text, r"\*\*(?:Code(?:base)?|Code patterns?)[^*]*\*\*" + PARAGRAPH, "i")
    main = F.filter(F.array(*[F.struct(F.lit(n).alias("type"), x.alias("detail")) for n, x in (("database", db), ("api", api), ("codebase", code))]), lambda s: s["detail"].isNotNull())
    bullets = F.filter(rows(text, r"-\s*\*\*([^*]+)\*\*:\s*([^\n]+)", ["t", "d"]), lambda r: ~F.lower(r["t"]).isin(*KNOWN_KNOWLEDGE))
    named = F.transform(bullets, lambda r: F.struct(F.lower(strip(r["t"])).alias("type"), strip(r["d"]).alias("detail")))
    return F.struct(
        F.coalesce(F.concat(main.cast(kind), named.cast(kind)), F.array().cast(kind)).alias("sources"),
        db.alias("db_knowledge"), api.alias("api_knowledge"), code.alias("codebase_knowledge"), F.lit(None).cast("string").alias("notes"),
    )


def artifacts(text: Column) -> Column:
    kind = "array<struct<name:string,type:string,path_hint:string,template_potential:boolean,notes:string>>"
    low = lambda x: F.lower(x)
    table = F.filter(
        rows(text, ARTIFACT_ROW, ["a", "b", "c", "d"]),
        lambda r: ~(F.contains(low(r["a"]), F.lit("filename")) | (F.contains(low(r["a"]), F.lit("file")) & F.contains(low(r["b"]), F.lit("change")))) & ~F.contains(r["a"], F.lit("---")),
    )
    table = F.transform(table, lambda r: F.struct(strip(r["a"]), strip(r["b"]), F.lit(None).cast("string"), F.contains(low(r["d"]), F.lit("[x]")) | F.contains(low(r["d"]), F.lit("yes")), strip(r["c"])))
    files = F.filter(rows(text, MODIFIED_FILE, ["a", "b"]), lambda r: F.contains(strip(r["a"]), F.lit(".")))
    files = F.transform(files, lambda r: F.struct(strip(r["a"]), F.lit("modified_file"), strip(r["a"]), F.lit(False), F.when(r["b"] != "", strip(r["b"]))))
    return F.coalesce(F.concat(table.cast(kind), files.cast(kind)), F.array().cast(kind))


def _is_issue(text: Column) -> Column:
    low = strip(F.lower(text))
    skipped = F.exists(F.array(*map(F.lit, NOT_ISSUES)), lambda w: F.contains(low, w))
    return ~low.startswith("**") & ~skipped & (F.length(text) > 5)


def issues(text: Column) -> Column:
    kind = "array<struct<issue:string,cause:string,fix:string,prevention:string,references:array<string>>>"
    none = F.lit(None).cast("string")
    table = F.filter(
        F.transform(rows(text, ISSUE_ROW, ["a", "b", "c"]), lambda r: F.struct(strip(r["a"]).alias("a"), strip(r["b"]).alias("b"), strip(r["c"]).alias("c"))),
        lambda r: ~F.contains(F.lower(r["a"]), F.lit("issue")) & ~F.contains(r["a"], F.lit("---")) & ~F.contains(F.lower(r["a"]), F.lit("symptom")) & _is_issue(r["a"]),
    )
    table = F.transform(table, lambda r: F.struct(r["a"], r["b"], r["c"], none, text_list()))
    part = F.regexp_extract(text, py(ISSUE_PART, "is"), 0)
    bullets = F.filter(rows(part, ISSUE_BULLET, ["a", "b", "c"]), lambda r: _is_issue(strip(r["a"])))
    bullets = F.transform(bullets, lambda r: F.struct(strip(r["a"]), none, strip(r["b"]), F.when(r["c"] != "", strip(r["c"])), text_list()))
    return F.coalesce(F.concat(table.cast(kind), bullets.cast(kind)), F.array().cast(kind))


def verification(text: Column) -> Column:
    checks = F.transform(rows(text, r"-\s*([^:\n]+):\s*([^\n]+)", ["t", "r"]), lambda r: F.struct(strip(r["t"]).alias("test"), strip(r["r"]).alias("result")))
    criteria = F.transform(rows(text, r"-\s*\[([x ])\]\s*(.+)", ["m", "c"], "i"), lambda r: F.struct(strip(r["c"]).alias("criterion"), (F.lower(r["m"]) == "x").alias("met")))
    expected = F.regexp_extract(text, py(r"\*\*(?:After fix|Expected)\*\*:\s*\n?((?:-[^\n]+\n?)+)", "i"), 1)
    return F.struct(
        F.coalesce(checks, F.array().cast("array<struct<test:string,result:string>>")).alias("checks"),
        nonempty(F.transform(every(expected, r"-\s*(.+)"), strip)).alias("expected_results"),
        F.coalesce(criteria, F.array().cast("array<struct<criterion:string,met:boolean>>")).alias("success_criteria_met"),
    )


def assessment(text: Column) -> Column:
    score = lambda name: first(text, name + r"[^|]*\|\s*(\d)", "i").try_cast("int")
    potential = F.lower(first(text, r"Skill Potential:\s*(\w+)", "i"))
    ticked = F.lower(first(text, r"\[x\]\s*\*?\*?(\w+)\s*Priority", "i"))
    return F.struct(
        first(text, r"(?:TOTAL|Total)[^|]*\|\s*(\d+)").try_cast("int").alias("reusability_score"),
        *[score(p).alias(f"{n}_score") for n, p in (("frequency", "Frequency"), ("consistency", "Consistency"), ("complexity", "Complexity"), ("codifiability", "Codifiability"), ("toolability", "Tool-?ability"))],
        F.when(potential.isin("high", "medium"), potential).when(potential.isNotNull(), "low").otherwise(ticked).alias("extraction_priority"),
        first(text, r"\*\*Notes?\*\*:\s*([^\n]+(?:\n(?!\*\*)[^\n]+)*)", "i").alias("notes"),
    )


def tags(text: Column) -> Column:
    def family(name: str, pattern: str) -> Column:
        raw = F.split(F.regexp_extract(text, py(pattern, "i"), 1), "[,;]")
        kept = F.filter(raw, lambda t: (strip(t) != "") & ((F.lower(strip(t)) != "none") if name == "services" else F.lit(True)))
        return distinct_ignoring_case(F.transform(kept, normalize_tag)).alias(name)

    return F.struct(*[family(n, p) for n, p in TAG_FIELDS.items()], F.lit(None).cast("string").alias("safety_risk"))


def warnings() -> Column:
    def missing(when: Column, message: str) -> Column:
        return F.when(when, message)

    return F.array_compact(
        F.array(
            missing(F.coalesce(F.col("metadata.date"), F.lit("")) == "", "Missing: metadata.date"),
            missing(F.coalesce(F.col("trigger.what_triggered"), F.lit("")) == "", "Missing: trigger.what_triggered"),
            missing(F.size("workflow.high_level_steps") == 0, "Missing: workflow.high_level_steps"),
            missing(F.size("code_written.blocks") == 0, "Empty: code_written.blocks"),
            missing(F.size("tags.languages") == 0, "Missing: tags.languages"),
            missing(F.size("tags.domains") == 0, "Missing: tags.domains"),
        )
    )


def split_documents(docs: DataFrame) -> DataFrame:
    """docs (path, content) with doc_id, format_detected, section_order and raw_sections added."""
    content = F.col("content")
    d = docs.withColumn("doc_id", doc_id(F.col("path"), content)).withColumn("format_detected", detect_format(content))
    d = with_segments(d, "content", "format_detected", "_parts").withColumn("_names", F.transform("_parts", lambda s: s["name"]))
    return d.withColumn("section_order", F.array_distinct("_names")).withColumn("raw_sections", section_map(F.col("_parts"), F.col("_names"))).drop("_parts", "_names")


def extract(docs: DataFrame, heading_mode: str = "reference") -> DataFrame:
    """One extraction row per document (path, content). ``heading_mode``: ``reference`` or ``nearest`` (see codeblocks)."""
    content = F.col("content")
    empty = F.lit("")

    def section(*names: str) -> Column:
        return F.coalesce(*[F.try_element_at(F.col("raw_sections"), F.lit(n)) for n in names], empty)

    d = split_documents(docs)
    d = d.withColumn("metadata", metadata(F.concat(section("header"), F.lit("\n"), F.substring(content, 1, 1000))))
    d = d.withColumn("context_inputs", context(section("context", "header"))).withColumn("trigger", trigger(section("trigger", "header")))
    # '' counts as missing in the chain of fallbacks
    told = lambda c: F.when(c != "", c)
    why = F.coalesce(told(F.col("trigger.what_triggered")), told(first(F.substring(content, 1, 2000), QUOTE, "s")), told(F.col("context_inputs.objective")), F.col("context_inputs.requirements"))
    d = d.withColumn("trigger", F.col("trigger").withField("what_triggered", why))
    header = section("header")
    flow = F.when(section("workflow") != "", section("workflow")).when((F.col("format_detected") == "legacy") & F.contains(header, F.lit("1. ")), header).otherwise(empty)
    d = d.withColumn("_flow", flow).withColumn("_steps", steps(F.col("_flow")))
    none = F.lit(None).cast("string")
    d = d.withColumn(
        "workflow",
        F.struct(
            first(F.col("_flow"), r"\*\*Workflow Type\*\*:\s*(\w+)", "i").alias("workflow_type"),
            F.transform("_steps", lambda s: s["action"]).alias("high_level_steps"),
            F.transform("_steps", lambda s: F.struct(s["step_number"].alias("step_number"), s["action"].alias("action"), none.alias("tool_command"), none.alias("input"), none.alias("output"))).alias("detailed_step_log"),
            F.concat(decisions(F.col("_flow")), decisions(section("decisions"))).alias("decision_points"),
        ),
    )
    udf = code_blocks_nearest if heading_mode == "nearest" else code_blocks
    fenced = F.contains(content, F.lit("```"))
    d = d.withColumn("knowledge_accessed", knowledge(section("knowledge")))
    d = d.withColumn("code_written", F.struct(F.when(fenced, udf(section("code"), content)).otherwise(F.array().cast(f"array<{BLOCK}>")).alias("blocks")))
    d = d.withColumn("outputs_produced", F.struct(artifacts(section("outputs")).alias("artifacts")))
    d = d.withColumn("issues_and_fixes", F.struct(issues(section("issues")).alias("items"))).withColumn("verification", verification(section("verification")))
    more = F.filter("section_order", lambda k: F.contains(k, F.lit("skill")) | F.contains(k, F.lit("reusab")) | F.contains(k, F.lit("tags")))
    judged = F.concat(section("skill_assessment", "skill_potential"), F.array_join(F.transform(more, lambda k: F.concat(F.lit("\n"), F.try_element_at(F.col("raw_sections"), k))), ""))
    judged = F.concat(judged, F.when(F.contains(content, F.lit("Dimension")) & F.contains(content, F.lit("Score")), F.concat(F.lit("\n"), content)).otherwise(empty))
    d = d.withColumn("_judged", judged).withColumn("skill_assessment", assessment(F.col("_judged")))
    d = d.withColumn("_tagged", F.concat(section("tags"), F.lit("\n"), F.right(content, F.lit(1000)))).withColumn("tags", tags(F.col("_tagged")))
    d = d.withColumn("parse_warnings", warnings())
    return d.withColumn("source_path", F.col("path")).drop("_flow", "_steps", "_judged", "_tagged", "section_order")


def summary(extractions: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: processed, failed, total, with_warnings."""
    done = extractions.select(F.lit(1).alias("processed"), F.lit(0).alias("failed"), (F.size("parse_warnings") > 0).cast("int").alias("with_warnings"))
    both = done.union(rejects.select(F.lit(0), F.lit(1), F.lit(0)))
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("processed", "failed", "with_warnings")]
    return both.agg(*totals, F.count(F.lit(1)).alias("total"))
