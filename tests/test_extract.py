"""Extraction of notes: one case per rule that a plain rewrite would get wrong."""

from __future__ import annotations

import pytest

from inkwell.functions.text import doc_id, normalize_tag
from inkwell.operators import cards as C
from inkwell.operators import codeblocks, extract
from inkwell.sources import markdown
from pyspark.sql import functions as F

FULL = """# Section A: Task Header
- **Date**: 2024-02-03
- **Type**: Feature | **Complexity**: High
- **Domain/Module**: billing, reports

**What triggered this?**: The invoice -> run failed
**Context Markers:** - never read

## Section C: Workflow
2. second step
1. first step
   - detail
2. second step
```text
3. in a fence
```
| Decision | Options | Choice | Why |
| --- | --- | --- | --- |
| Store | disk, cloud | disk | cheap |

## Section G: Issues
| Issue | Cause | Fix | Prevention |
|---|---|---|---|
| Slow start of the job | cold cache | warm it | always |

## Section H: Verification
- Totals: equal
- [X] Signed off
**Expected**:
- all green

## Workflow again
1. only this stays

## Section J: Tags
- **Languages**:
- **Frameworks**: Spark; FastAPI, spark
- **Patterns**: Data Export
- **Services**: none, S3
"""


@pytest.fixture(scope="module")
def ex(spark):
    notes = [
        ("n/SR-PTD_full.md", FULL),
        ("n/SR-PTD_prose.md", "A section about nothing.\n> quoted line"),
        ("n/task_doc_x.md", "Task Documentation\n- x\n1. do this\n2. - skipped\n"),
        ("n/SR-PTD_empty.md", ""),
        ("n/SR-PTD_dup.md", "**Date**: 2024-01-01 | **Type**: Fix\n## Trigger\n> one\n## Workflow\n1. a\n## Trigger\n> two\nrest\n## Skill Potential: huge\n## Tags\nDomains: guidelines, שלום, Café X\n"),
    ]
    df = spark.createDataFrame(notes, "path string, content string")
    return {r.path.rpartition("/")[2]: r for r in extract.extract(df).collect()}


def test_formats(ex):
    assert {k: r.format_detected for k, r in ex.items()} == {"SR-PTD_full.md": "full", "SR-PTD_prose.md": "full", "task_doc_x.md": "legacy", "SR-PTD_empty.md": "quick", "SR-PTD_dup.md": "quick"}


def test_sections_last_wins(ex):
    s = ex["SR-PTD_dup.md"].raw_sections
    assert s["trigger"] == "## Trigger\n> two\nrest" and s["header"].startswith("**Date**")
    assert ex["SR-PTD_full.md"].raw_sections["workflow"] == "## Workflow again\n1. only this stays"
    assert ex["SR-PTD_empty.md"].raw_sections == {"header": ""}


def test_full_fields(ex):
    r = ex["SR-PTD_full.md"]
    assert (r.metadata.date, r.metadata.task_type, r.metadata.complexity, r.metadata.domain) == ("2024-02-03", "Feature", "High", "billing, reports")
    assert r.trigger.what_triggered == "The invoice -> run failed" and r.trigger.context_markers == []
    assert r.workflow.high_level_steps == ["only this stays"]
    assert r.verification.checks[0].asDict() == {"test": "Totals", "result": "equal"}
    assert [(c.criterion, c.met) for c in r.verification.success_criteria_met] == [("Signed off", True)] and r.verification.expected_results == ["all green"]
    # three-cell rows over a table of four cells: the header's last cell opens the next match
    assert "Slow start of the job" not in [i.issue for i in r.issues_and_fixes.items]
    # an empty field takes the next line
    assert r.tags.languages == ["--frameworks-spark", "fastapi", "spark"] and r.tags.frameworks == ["spark", "fastapi"]
    assert r.tags.services == ["s3"] and r.tags.patterns == ["data-export"]


def test_fallbacks_and_warnings(ex):
    assert ex["SR-PTD_prose.md"].trigger.what_triggered == "quoted line"
    assert ex["task_doc_x.md"].workflow.high_level_steps == ["do this"]
    assert ex["SR-PTD_dup.md"].skill_assessment.extraction_priority == "low"
    assert ex["SR-PTD_dup.md"].tags.domains == ["guidelines", "שלום", "café-x"]
    assert list(ex["SR-PTD_empty.md"].parse_warnings) == ["Missing: metadata.date", "Missing: trigger.what_triggered", "Missing: workflow.high_level_steps", "Empty: code_written.blocks", "Missing: tags.languages", "Missing: tags.domains"]


def test_steps_by_number_then_place(spark):
    df = spark.createDataFrame([("2. b\n1. z\n1. a\n2. b\n10. k",)], "t string")
    assert [s.action for s in df.select(extract.steps(F.col("t")).alias("s")).first().s] == ["z", "a", "b", "k"]


def test_tag_and_id(spark):
    r = spark.createDataFrame([("  Data   Pröcess/ing_1 ", "a/b.c/x.y.md", "té")], "t string, p string, c string").select(normalize_tag(F.col("t")).alias("t"), doc_id(F.col("p"), F.col("c")).alias("i")).first()
    import hashlib

    assert r.t == "data-pröcessing_1" and r.i == "x.y_" + hashlib.md5("té".encode()).hexdigest()[:8]


def test_code_pairing():
    text = "### One\n```py\nx = 1\n```\n### Two\n```py\ny = 2\n```\nreusable"
    got = codeblocks.find_blocks(text)
    # the closing fence of the first block takes the second, under the first heading
    assert [(b["code"], b["heading"]) for b in got] == [("x = 1", "One"), ("y = 2", "One")] and got[0]["reuse_flag"]
    assert [b["heading"] for b in codeblocks.find_blocks(text, nearest=True)] == ["One", "Two"]
    assert codeblocks.find_blocks("```py\nunclosed") == []
    merged = codeblocks.merged_blocks("```py\nx = 1\n```", text)
    assert [b["code"] for b in merged] == ["x = 1", "y = 2"] and merged[0]["heading"] is None


def test_sources(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "SR-PTD_a.md").write_bytes(b"one\r\ntwo\rthree")
    (tmp_path / "sub/task_doc_b.md").write_bytes(b"\xff\xfe")
    (tmp_path / "notes.md").write_text("not scanned")
    files = markdown.scan_directory(spark, str(tmp_path))
    docs, rejects = markdown.decode(files)
    assert [r.content for r in docs.collect()] == ["one\ntwo\nthree"] and rejects.count() == 1
    assert markdown.scan_file(spark, str(tmp_path / "notes.md")).count() == 1
    before = markdown.manifest(files)
    assert markdown.changed(before, before).count() == 0
    assert markdown.changed(before, before.limit(0)).count() == 2


def test_cards(spark, ex):
    df = spark.createDataFrame([("n/SR-PTD_full.md", FULL)], "path string, content string")
    c = C.cards(extract.extract(df)).first()
    assert c.bucket_key == "billing__data-export" or c.bucket_key.endswith("__data-export")
    tags = spark.createDataFrame([(["A b", "a-b", "", "unknown", None, " C "],)], "t array<string>").select(C.card_tags(F.col("t")).alias("t")).first().t
    assert tags == ["a-b", "c"]
    none = C.bucket_stats(C.bucket_sizes(spark.createDataFrame([], "doc_id string, bucket_key string"))).first()
    assert none.total_buckets == 0 and none.max_bucket_size == 0 and none.avg_bucket_size == 0


def test_strip_as_python(spark):
    from inkwell.functions.text import SPACE, strip

    texts = ["", " ", SPACE, f"{SPACE}a b{SPACE}c{SPACE}", "\u3000x\xa0", "x\u200b ", "no ends"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    found = {r.i: r.s for r in rows.select("i", strip(rows.t).alias("s")).collect()}
    assert found == {i: t.strip() for i, t in enumerate(texts)} | {len(texts): None}
    assert all(c.isspace() for c in SPACE)


def test_first_spellings(spark):
    from pyspark.sql import functions as F

    from inkwell.functions.text import distinct_ignoring_case

    rows = spark.createDataFrame([(0, ["B", "a", " b ", "A", "c"]), (1, []), (2, None)], "i int, t array<string>")
    found = {r.i: r.s for r in rows.select("i", distinct_ignoring_case(F.col("t")).alias("s")).collect()}
    assert found == {0: ["B", "a", "c"], 1: [], 2: None}
