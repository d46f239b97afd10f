"""Document format, and the split into named sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py, strip

# Fixed values of the document format: headings of sections, in the order in which they are tried.
FULL_SECTIONS = {
    "header": r"^#\s*(?:Section\s*A[:.]?|SR-PTD|Task Doc).*?(?:Header|Skill Trigger)",
    "context": r"^(?:##\s*(?:Section\s*B[:.]?|Context|Inputs)|##\s*Problem Statement)",
    "workflow": r"^##\s*(?:Section\s*C[:.]?|Workflow|Work Performed)",
    "knowledge": r"^##\s*(?:Section\s*D[:.]?|Knowledge|Knowledge Used|Knowledge Accessed)",
    "code": r"^##\s*(?:Section\s*E[:.]?|Code|Code Written)",
    "outputs": r"^##\s*(?:Section\s*F[:.]?|Output|Artifacts|Files)",
    "issues": r"^##\s*(?:Section\s*G[:.]?|Issue|Issues|Problems)",
    "verification": r"^##\s*(?:Section\s*H[:.]?|Verification|Validation|Test)",
    "skill_assessment": r"^##\s*(?:Section\s*I[:.]?|Skill.*Assessment|Reusability)",
    "tags": r"^##\s*(?:Section\s*J[:.]?|Tags)",
}
QUICK_SECTIONS = {
    "trigger": r"^##\s*Trigger",
    "workflow": r"^##\s*Workflow",
    "decisions": r"^##\s*Key Decisions",
    "knowledge": r"^##\s*Knowledge",
    "code": r"^##\s*Code",
    "outputs": r"^##\s*Output",
    "issues": r"^##\s*Issues",
    "skill_potential": r"^##\s*Skill Potential",
    "tags": r"^##\s*Tags",
}


def detect_format(content: Column) -> Column:
    """full, quick or legacy; the tests of dates look at the text as written, not in lower case."""
    low = F.lower(content)
    inline = F.contains(low, F.lit("| **type**:")) | F.contains(F.substring(content, 1, 500), F.lit("**date**:"))
    return (
        F.when(F.contains(low, F.lit("section a")) | F.contains(low, F.lit("skill trigger profile")), "full")
        .when(inline & F.contains(low, F.lit("## trigger")) & F.contains(low, F.lit("## workflow")), "quick")
        .when(F.contains(low, F.lit("task doc")) | F.contains(F.substring(content, 1, 200), F.lit("- **date**:")), "legacy")
        .otherwise("quick")
    )


def section_of(line: Column, fmt: Column) -> Column:
    """The section that the line opens, or null. Only lines with ``#`` first are held against the patterns."""
    def named(patterns: dict[str, str]) -> Column:
        return F.coalesce(*[F.when(F.regexp_like(line, F.lit(py(p, "i"))), name) for name, p in patterns.items()])

    return F.when(~line.startswith("#"), F.lit(None)).when(fmt == "full", named(FULL_SECTIONS)).otherwise(named(QUICK_SECTIONS))


def with_segments(df: DataFrame, content: str, fmt: str, out: str) -> DataFrame:
    """``out``: array<struct<name, body>>, the runs of lines from each heading on; lines before the first are ``header``.

    Lines and headings are columns of their own, so that each is computed once per row and not once per heading.
    """
    df = df.withColumn("_lines", F.split(F.col(content), "\n"))
    opened = F.transform("_lines", lambda x, i: F.struct(i.alias("at"), section_of(x, F.col(fmt)).alias("name")))
    df = df.withColumn("_opened", F.filter(opened, lambda h: h["name"].isNotNull()))
    start = F.array(F.struct(F.lit(0).alias("at"), F.lit("header").alias("name")))
    first = F.get("_opened", F.lit(0))["at"]
    df = df.withColumn("_heads", F.when(first.eqNullSafe(F.lit(0)), F.col("_opened")).otherwise(F.concat(start, "_opened")))

    def body(h: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_heads", i + 1)["at"], F.size("_lines"))
        return F.struct(h["name"].alias("name"), strip(F.array_join(F.slice("_lines", h["at"] + 1, end - h["at"]), "\n")).alias("body"))

    return df.withColumn(out, F.transform("_heads", body)).drop("_lines", "_opened", "_heads")


def section_map(parts: Column, names: Column) -> Column:
    """name -> body; of a section that occurs again the last wins. ``names``: the segments' names, in order."""
    last = F.filter(parts, lambda s, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), s["name"]))
    return F.map_from_entries(last)
