"""DuckDB SQL for the registered queries, written from the tables and not from the operators.

Notes are made from orders by construction, so what extraction must find is told by the tables themselves.
"""

from __future__ import annotations

from ..operators.enrich import DOMAINS, PATTERNS
from ..operators.merge import ROLLUPS

_O = """
l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
per AS (
  SELECT l_orderkey, count(*) AS n, max(l_returnflag) AS flag,
    string_agg(l_linenumber || '. Pick part ' || l_partkey || ' from supplier ' || l_suppkey, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS steps,
    string_agg('| Ship line ' || l_linenumber || ' | rail, air | ' || l_returnflag || ' | status ' || l_linestatus || ' |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS decisions,
    max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS has_first
  FROM lineitem GROUP BY l_orderkey),
uniq AS (
  SELECT l_orderkey, count(*) AS n_steps, string_agg('Pick part ' || l_partkey || ' from supplier ' || l_suppkey, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS listed,
    string_agg(CASE WHEN r <= 5 THEN 'Pick part ' || l_partkey || ' from supplier ' || l_suppkey END, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS five
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM l) GROUP BY l_orderkey),
o AS (
  SELECT o_orderkey, o_custkey, o_orderpriority AS prio, o_orderstatus AS st, strftime(o_orderdate, '%Y-%m-%d') AS day, c_mktsegment AS seg, n_name AS nat, per.n, per.flag, per.steps, per.decisions, per.has_first,
    uniq.n_steps, uniq.listed, uniq.five, o_orderkey % 3 AS k, CASE o_orderstatus WHEN 'F' THEN 'High' WHEN 'O' THEN 'Medium' ELSE 'Low' END AS complexity
  FROM orders JOIN per ON o_orderkey = per.l_orderkey JOIN uniq ON o_orderkey = uniq.l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_PARTS = """
body AS (
  SELECT o_orderkey, k,
    '# Section A: Header' || chr(10) || '- **Date**: ' || day || chr(10) || '- **Type**: ' || prio || chr(10) || '- **Domain/Module**: ' || nat || chr(10) || '- **Complexity**: ' || complexity || chr(10) || '- **Time Spent**: ' || n || ' hours' || chr(10)
      || '- **Repo/Branch**: orders/' || o_custkey || chr(10) || chr(10) || '**What triggered this task?**: Order ' || o_orderkey || ' of customer ' || o_custkey || chr(10) || chr(10) || '**Keywords/Phrases**:' || chr(10) || '- "' || seg || '"' || chr(10) || '- "' || nat || '"' AS f_header,
    '## Section B: Context' || chr(10) || '**Objective**: Ship order ' || o_orderkey || chr(10) || '**Environment**: ' || st || ' yard' || chr(10) || '**Requirements/Problem**: Customer ' || o_custkey AS f_context,
    '## Section C: Workflow' || chr(10) || '**Workflow Type**: batch' || chr(10) || chr(10) || steps || chr(10) || chr(10) || '| Decision | Options | Choice | Rationale |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) || decisions AS f_workflow,
    '## Section D: Knowledge' || chr(10) || '**Database**: orders and lines' || chr(10) || '**API**: carrier api' || chr(10) || chr(10) || '- **Runbook**: page ' || o_custkey AS f_knowledge,
    '## Section E: Code' || chr(10) || '### Load order ' || o_orderkey || chr(10) || '```sql' || chr(10) || 'select * from lineitem where l_orderkey = ' || o_orderkey || chr(10) || '```' || chr(10) || 'This block is reusable.' AS f_code,
    '## Section F: Outputs' || chr(10) || '| Filename | Format | Purpose | Template Potential |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) || '| order_' || o_orderkey || '.csv | csv | shipping list | [x] Yes |' AS f_outputs,
    '## Section G: Issues' || chr(10) || '| Issue | Root Cause | Fix |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| Delay of order ' || o_orderkey || ' | flag ' || flag || ' | call customer ' || o_custkey || ' |' AS f_issues,
    '## Section H: Verification' || chr(10) || '- Row check: ' || n || ' rows' || chr(10) || '- [x] Totals agree' || chr(10) || '- [ ] Label printed' AS f_verification,
    '## Section I: Skill Assessment' || chr(10) || '| Dimension | Score |' || chr(10) || '| Frequency | ' || n || ' |' || chr(10) || '| Consistency | 3 |' || chr(10) || '| Complexity | 2 |' || chr(10) || '| Codifiability | 4 |' || chr(10) || '| Tool-ability | 5 |' || chr(10)
      || '| TOTAL | ' || (n + 14) || ' |' || chr(10) || '- [x] **High Priority**' AS f_skill_assessment,
    '## Section J: Tags' || chr(10) || '- **Languages**: SQL, Python' || chr(10) || '- **Frameworks**: Spark' || chr(10) || '- **Domains**: ' || seg || ', ' || nat || chr(10) || '- **Patterns**: Batch Processing; Export' || chr(10) || '- **Tools**: none' || chr(10) || '- **Services**: none' AS f_tags,
    '**Date**: ' || day || ' | **Type**: ' || prio || ' | **Domain**: ' || nat AS q_header, '## Trigger' || chr(10) || '> Ship order ' || o_orderkey AS q_trigger, '## Workflow' || chr(10) || steps AS q_workflow,
    '## Key Decisions' || chr(10) || '- **Carrier ' || o_custkey || '** -> rail -> cheaper' AS q_decisions, '## Issues' || chr(10) || '- Delay ' || o_orderkey || ' -> call customer ' || o_custkey AS q_issues, '## Skill Potential: Medium' AS q_skill_potential,
    '## Tags' || chr(10) || 'Languages: SQL | Domains: ' || seg || ' | Patterns: Export' AS q_tags,
    'Task Documentation ' || o_orderkey || chr(10) || chr(10) || '## A. Overview' || chr(10) || '- **Date**: ' || day || chr(10) || '- **Type**: ' || prio || chr(10) || chr(10) || '## B. Steps' || chr(10) || steps AS y_header
  FROM o)"""
_FULL = ("header", "context", "workflow", "knowledge", "code", "outputs", "issues", "verification", "skill_assessment", "tags")
_QUICK = ("header", "trigger", "workflow", "decisions", "issues", "skill_potential", "tags")
_GLUE = " || chr(10) || chr(10) || "
_NOTES = f"""{_O},{_PARTS},
notes AS (SELECT o_orderkey, CASE k WHEN 0 THEN {_GLUE.join("f_" + x for x in _FULL)} WHEN 1 THEN {_GLUE.join("q_" + x for x in _QUICK)} ELSE y_header END AS content FROM body)"""
_SECTIONS = " UNION ALL ".join([f"SELECT o_orderkey, '{x}' AS section, f_{x} AS body FROM body WHERE k = 0" for x in _FULL] + [f"SELECT o_orderkey, '{x}', q_{x} FROM body WHERE k = 1" for x in _QUICK] + ["SELECT o_orderkey, 'header', y_header FROM body WHERE k = 2"])
_SLUG = "regexp_replace(lower({0}), '[ ]+', '-', 'g')"

_CARDS = """
cards AS (
  SELECT d.doc_id AS num, printf('doc%08d', d.doc_id) AS doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.lang = 'en' THEN 'api-development' WHEN d.lang = 'fr' THEN 'data-analysis' WHEN d.lang = 'de' THEN 'ui-guidelines' ELSE 'notes' END AS domain,
    coalesce(l.toxic = 1, false) AS issue, d.n_chars % 3 = 0 AS code, d.n_chars % 4 = 0 AS artifact
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
b AS (SELECT *, coalesce(domain, 'unknown') || '__' || source AS bucket_key FROM cards),
sizes AS (SELECT bucket_key, count(*) AS doc_count, min(domain) AS domain, min(source) AS source FROM b GROUP BY bucket_key)"""
_ROLLUP = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(coalesce(domain, ''), '{m}')" for m in members) + f" THEN '{name}'" for name, members in ROLLUPS.items()) + " ELSE 'misc' END"
_RCOUNT = "CASE WHEN {0} <= 5 THEN least(3, {0}) WHEN {0} <= 15 THEN 5 ELSE 8 END"
_SCORED = (
    _CARDS
    + """,
f AS (
  SELECT *, num % 11 <> 0 AS has_card FROM b),
scored AS (
  SELECT bucket_key AS cluster_id, doc_id, has_card AND issue AS hi, has_card AND code AS hc, has_card AND artifact AS ha,
    CASE WHEN has_card THEN CASE quality WHEN 1 THEN 30 WHEN 0 THEN 10 ELSE 0 END + least(25, n_chars % 26) + CASE WHEN issue THEN 15 ELSE 0 END + CASE WHEN code THEN 15 ELSE 0 END + CASE WHEN artifact THEN 10 ELSE 0 END ELSE 0 END AS total FROM f)"""
)


def _chosen(scored: str) -> str:
    """Greedy choice told as two passes: a document is taken in the first pass if fewer than half are, or it fills a gap."""
    return f"""
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY total DESC, doc_id) AS rn, count(*) OVER (PARTITION BY cluster_id) AS size FROM {scored}),
g AS (
  SELECT *, {_RCOUNT.format("size")} AS want,
    hi AND count(*) FILTER (WHERE hi) OVER before = 0 AS fi, hc AND count(*) FILTER (WHERE hc) OVER before = 0 AS fc, ha AND count(*) FILTER (WHERE ha) OVER before = 0 AS fa
  FROM r WINDOW before AS (PARTITION BY cluster_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p1 AS (SELECT *, (rn <= want // 2 OR fi OR fc OR fa) AS early FROM g),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY early DESC, rn) AS sel_rank FROM p1),
chosen AS (SELECT *, coalesce(nullif(concat_ws(', ', CASE WHEN fi THEN 'issues coverage' END, CASE WHEN fc THEN 'code coverage' END, CASE WHEN fa THEN 'artifacts coverage' END), ''), 'high score (' || total || ')') AS why FROM ranked WHERE sel_rank <= want)"""


_REPS = f"""{_SCORED},{_chosen("scored")},
reps AS (
  SELECT cluster_id, doc_id, size FROM chosen WHERE size > 2
  UNION ALL SELECT DISTINCT cluster_id, 'doc99999999', size FROM chosen WHERE size > 2 AND right(cluster_id, 1)::INT % 3 = 0),
cover AS (SELECT cluster_id, bool_or(fi) AS i, bool_or(fc) AS c, bool_or(fa) AS a FROM chosen WHERE size > 2 GROUP BY 1)"""
_EVENTS = """
e AS (SELECT event_id, event_type, event_id % 4 AS kind, regexp_extract(props, '"k": *([0-9]+)', 1) AS k FROM events)"""
_IN = lambda terms: "(" + ", ".join(f"'{t}'" for t in terms) + ")"
_ENRICHED = f"""{_CARDS},{_EVENTS},
j AS (
  SELECT b.*, e.kind, e.k, domain IS NULL AS needed, domain IS NULL AND e.kind IS NOT NULL AND e.kind <> 2 AS ok FROM b LEFT JOIN e ON b.num = e.event_id),
n AS (
  SELECT *, CASE WHEN ok AND kind <> 3 THEN 'etl' WHEN domain IS NULL THEN NULL ELSE domain END AS d2, CASE WHEN ok AND kind <> 3 THEN 'export' ELSE source END AS p2 FROM j),
m AS (SELECT *, CASE WHEN ok THEN coalesce(d2, 'unknown') || '__' || p2 ELSE bucket_key END AS key2 FROM n)"""
_SIG = f"""{_CARDS},
c AS (
  SELECT bucket_key, count(*) AS n_docs, min(domain) AS domain, min(source) AS source, string_agg(DISTINCT lang, ', ' ORDER BY lang) AS langs,
    max(CASE WHEN artifact THEN source || '.csv' END) AS output, max(CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 0 END) AS spark FROM b GROUP BY bucket_key),
s AS (SELECT *, {_ROLLUP} AS rollup FROM c)"""
_SKILL = f"""{_SIG},
doc AS (SELECT b.*, s.rollup FROM b JOIN s ON b.bucket_key = s.bucket_key),
members AS (
  SELECT rollup || '-skill' AS cluster_id, doc_id, issue AS hi, code AS hc, artifact AS ha,
    CASE quality WHEN 1 THEN 30 WHEN 0 THEN 10 ELSE 0 END + least(25, n_chars % 26) + CASE WHEN issue THEN 15 ELSE 0 END + CASE WHEN code THEN 15 ELSE 0 END + CASE WHEN artifact THEN 10 ELSE 0 END AS total FROM doc),
{_chosen("members")},
ready AS (
  SELECT cl.cluster_id AS cluster_name, CASE WHEN cl.cluster_id = 'misc-skill' THEN 'failed' WHEN count(ch.doc_id) FILTER (WHERE ch.hc) = 0 THEN 'skipped' ELSE 'ready' END AS state,
    CASE WHEN cl.cluster_id = 'misc-skill' THEN '' ELSE coalesce(string_agg(ch.doc_id, '|' ORDER BY sel_rank) FILTER (WHERE ch.hc), '') END AS documents
  FROM (SELECT DISTINCT cluster_id FROM members) cl LEFT JOIN chosen ch ON cl.cluster_id = ch.cluster_id GROUP BY cl.cluster_id)"""
_CONV = """
t AS (
  SELECT conv_id, turn, role, length(text) AS n, min(turn) OVER (PARTITION BY conv_id, role) AS opened, count(*) OVER (PARTITION BY conv_id) AS size FROM conversations),
cl AS (
  SELECT conv_id, role, count(*) AS member_count, min(opened) AS opened, string_agg('t' || turn, '|' ORDER BY turn) AS members, max(size) AS size FROM t GROUP BY conv_id, role),
ph AS (SELECT conv_id, role, 2 * count(DISTINCT n % 3) AS n_phrases FROM t WHERE turn > opened GROUP BY conv_id, role),
clusters AS (
  SELECT 'conv' || cl.conv_id AS bucket_key, row_number() OVER (PARTITION BY cl.conv_id ORDER BY cl.opened) - 1 AS cluster_ord, cl.role AS cluster_name, cl.member_count, cl.members, coalesce(ph.n_phrases, 0) AS n_phrases, cl.size = 1 AS singleton
  FROM cl LEFT JOIN ph ON cl.conv_id = ph.conv_id AND cl.role = ph.role)"""


_SIGNATURE = "'Name: ' || b.bucket_key || '-1' || chr(10) || 'About: About ' || b.bucket_key || chr(10) || 'Domains: ' || coalesce(c.domain, '') || chr(10) || 'Patterns: ' || c.source || chr(10) || 'Triggers: ' || langs || chr(10) || 'Outputs: ' || coalesce(output, '') || chr(10) || 'Documents: ' || n_docs"
_SUMMARY = "'Document: ' || doc_id || chr(10) || 'Trigger: export ' || b.source || chr(10) || 'Keywords: ' || lang || chr(10) || 'Domains: ' || coalesce(b.domain, '') || chr(10) || 'Patterns: ' || b.source || chr(10) || 'Steps: ' || chr(10) || 'Artifacts: ' || CASE WHEN artifact THEN b.source || '.csv' ELSE '' END"
_SAMPLE = """
x AS (SELECT b.*, z.doc_count, least(12, greatest(8, z.doc_count // 4)) AS want, CASE WHEN quality = 1 THEN 'a_priority' WHEN issue THEN 'b_issues' WHEN artifact THEN 'c_artifacts' ELSE 'd_other' END AS stratum FROM b JOIN sizes z ON b.bucket_key = z.bucket_key WHERE z.doc_count >= 10),
y AS (SELECT *, row_number() OVER (PARTITION BY bucket_key, stratum ORDER BY doc_id) AS pos FROM x),
f AS (SELECT *, (stratum = 'a_priority' AND pos <= 3) OR (stratum = 'b_issues' AND pos <= 2) OR (stratum = 'c_artifacts' AND pos <= 2) AS taken FROM y),
q AS (SELECT *, count(*) FILTER (WHERE taken) OVER (PARTITION BY bucket_key) AS n_taken, row_number() OVER (PARTITION BY bucket_key, taken ORDER BY md5(doc_id || 'audit'), doc_id) AS drawn FROM f)"""
_FILES = """
said AS (
  SELECT r.cluster_name, replace(r.documents, '|', chr(10)) AS listed, r.documents, t.langs, length('Documents about ' || t.rollup) AS n_about, t.rollup
  FROM ready r JOIN (SELECT s.rollup, s.rollup || '-skill' AS cluster_name, string_agg(DISTINCT b.lang, '|' ORDER BY b.lang) AS langs FROM s JOIN b ON s.bucket_key = b.bucket_key GROUP BY s.rollup) t ON r.cluster_name = t.cluster_name WHERE state = 'ready'),
files AS (
  SELECT cluster_name, 'SKILL.md' AS path, length('# ' || cluster_name || chr(10) || chr(10) || 'Documents about ' || rollup || chr(10) || chr(10) || '## When' || chr(10) || '- ' || replace(langs || '|' || langs, '|', chr(10) || '- ') || chr(10) || chr(10) || '## Sources' || chr(10) || '- ' || replace(documents, '|', chr(10) || '- ')) AS n_chars FROM said
  UNION ALL SELECT cluster_name, 'references/sources.md', length(listed) FROM said
  UNION ALL SELECT cluster_name, 'traceability.json', length('{"source_doc_ids":["' || replace(documents, '|', '","') || '"],"section_sources":{"Sources":["' || replace(documents, '|', '","') || '"]}}') FROM said)"""


def _with(cte: str, body: str, more: str = "") -> str:
    return f"WITH {cte.strip()}{',' + more if more else ''}\n{body}"


ORACLE_SQL: dict[str, str] = {
    "tag_normalize": "SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(p_type || chr(9) || '/ ' || p_brand || ' (É' || p_size || ')')), '[ \\t]+', '-', 'g'), '[^\\p{L}\\p{N}_\\-]', '', 'g') AS tag FROM part",
    "tag_distinct": "SELECT c_custkey, lower(c_mktsegment) || '|' || c_name AS kept FROM customer",
    "doc_id_hash": _with(_NOTES, "SELECT o_orderkey, 'SR-PTD_' || o_orderkey || '_' || substr(md5(content), 1, 8) AS doc_id FROM notes"),
    "format_detect": _with(_O, "SELECT o_orderkey, CASE k WHEN 0 THEN 'full' WHEN 1 THEN 'quick' ELSE 'legacy' END AS format_detected FROM o"),
    "section_split": _with(f"{_O},{_PARTS}", f"SELECT o_orderkey, section, md5(body) AS body_md5, length(body) AS n_chars FROM ({_SECTIONS}) x"),
    "header_metadata": _with(_O, "SELECT o_orderkey, day AS date, prio AS task_type, CASE WHEN k < 2 THEN nat END AS domain, CASE WHEN k = 0 THEN complexity END AS complexity, CASE WHEN k = 0 THEN n || ' hours' END AS time_spent, CASE WHEN k = 0 THEN 'orders/' || o_custkey END AS repo_branch FROM o"),
    "trigger_fields": _with(_O, "SELECT o_orderkey, CASE k WHEN 0 THEN 'Order ' || o_orderkey || ' of customer ' || o_custkey WHEN 1 THEN 'Ship order ' || o_orderkey END AS what_triggered, CASE WHEN k = 0 THEN seg || '|' || nat ELSE '' END AS keywords, 0 AS n_markers FROM o"),
    "context_fields": _with(_O, "SELECT o_orderkey, CASE WHEN k = 0 THEN 'Ship order ' || o_orderkey END AS objective, CASE WHEN k = 0 THEN st || ' yard' END AS environment, CASE WHEN k = 0 THEN 'Customer ' || o_custkey END AS requirements, CASE WHEN k = 0 THEN ': Customer ' || o_custkey END AS problem_statement, NULL::VARCHAR AS starting_state FROM o"),
    "workflow_steps": _with(_O, "SELECT o_orderkey, CASE WHEN k = 0 THEN 'batch' END AS workflow_type, CASE WHEN k = 2 AND has_first = 0 THEN '' ELSE listed END AS steps, CASE WHEN k = 2 AND has_first = 0 THEN 0 ELSE n_steps END AS n_steps FROM o"),
    "decision_rows": _with(_O, "SELECT o_orderkey, 'Ship line ' || l_linenumber AS decision, 'rail, air' AS options, l_returnflag AS choice, 'status ' || l_linestatus AS rationale FROM o JOIN lineitem x ON o_orderkey = x.l_orderkey WHERE k = 0 UNION ALL SELECT o_orderkey, 'Carrier ' || o_custkey, NULL, 'rail', 'cheaper' FROM o WHERE k = 1"),
    "knowledge_sources": _with(_O, "SELECT o_orderkey, 'database' AS type, 'orders and lines' AS detail FROM o WHERE k = 0 UNION ALL SELECT o_orderkey, 'api', 'carrier api' FROM o WHERE k = 0 UNION ALL SELECT o_orderkey, 'runbook', 'page ' || o_custkey FROM o WHERE k = 0"),
    "code_blocks": _with(_O, "SELECT o_orderkey, 'sql' AS language, 'select * from lineitem where l_orderkey = ' || o_orderkey AS code, 'Load order ' || o_orderkey AS heading, true AS reuse_flag FROM o WHERE k = 0"),
    "artifact_rows": _with(_O, "SELECT o_orderkey, 'order_' || o_orderkey || '.csv' AS name, 'csv' AS type, true AS template_potential, 'shipping list' AS notes FROM o WHERE k = 0"),
    "issue_rows": _with(_O, "SELECT o_orderkey, CASE k WHEN 0 THEN 'Delay of order ' || o_orderkey ELSE 'Delay ' || o_orderkey END AS issue, CASE WHEN k = 0 THEN 'flag ' || flag END AS cause, 'call customer ' || o_custkey AS fix, NULL::VARCHAR AS prevention FROM o WHERE k < 2"),
    "verification_rows": _with(_O, "SELECT o_orderkey, CASE WHEN k = 0 THEN 'Row check=' || n || ' rows' ELSE '' END AS checks, CASE WHEN k = 0 THEN 'Totals agree=true|Label printed=false' ELSE '' END AS criteria FROM o"),
    "assessment_scores": _with(_O, "SELECT o_orderkey, CASE WHEN k = 0 THEN n + 14 END AS reusability_score, CASE WHEN k = 0 THEN left(n::VARCHAR, 1)::BIGINT END AS frequency_score, CASE WHEN k = 0 THEN 3 END AS consistency_score, CASE WHEN k = 0 THEN 2 END AS complexity_score, CASE WHEN k = 0 THEN 4 END AS codifiability_score, CASE WHEN k = 0 THEN 5 END AS toolability_score, CASE k WHEN 0 THEN 'high' WHEN 1 THEN 'medium' END AS extraction_priority FROM o"),
    "tag_families": _with(_O, f"SELECT o_orderkey, CASE k WHEN 0 THEN 'sql|python' WHEN 1 THEN 'sql' ELSE '' END AS languages, CASE WHEN k = 0 THEN 'spark' ELSE '' END AS frameworks, CASE WHEN k = 0 THEN 'none' ELSE '' END AS tools, CASE k WHEN 0 THEN {_SLUG.format('seg')} || '|' || {_SLUG.format('nat')} WHEN 1 THEN {_SLUG.format('seg')} ELSE '' END AS domains, CASE k WHEN 0 THEN 'batch-processing|export' WHEN 1 THEN 'export' ELSE '' END AS patterns, '' AS services FROM o"),
    "parse_warnings": _with(_O, "SELECT o_orderkey, CASE k WHEN 0 THEN '' WHEN 1 THEN 'Empty: code_written.blocks' ELSE 'Missing: trigger.what_triggered' || CASE WHEN has_first = 0 THEN '|Missing: workflow.high_level_steps' ELSE '' END || '|Empty: code_written.blocks|Missing: tags.languages|Missing: tags.domains' END AS warnings FROM o"),
    "note_cards": _with(_NOTES, f"SELECT 'SR-PTD_' || o.o_orderkey || '_' || substr(md5(content), 1, 8) AS doc_id, CASE WHEN k = 0 THEN n + 14 END AS total, CASE WHEN k = 0 THEN seg || '|' || nat ELSE '' END AS keywords, CASE WHEN k = 2 AND has_first = 0 THEN '' ELSE five END AS steps, CASE WHEN k = 0 THEN 'order_' || o.o_orderkey || '.csv' ELSE '' END AS artifacts, CASE k WHEN 0 THEN 'Delay of order ' || o.o_orderkey WHEN 1 THEN 'Delay ' || o.o_orderkey ELSE '' END AS issues, CASE k WHEN 0 THEN {_SLUG.format('seg')} || '__batch-processing' WHEN 1 THEN {_SLUG.format('seg')} || '__export' ELSE 'unknown__unknown' END AS bucket_key FROM o JOIN notes ON o.o_orderkey = notes.o_orderkey"),
    "extraction_summary": _with(_O, "SELECT count(*) AS processed, 0 AS failed, count(*) FILTER (WHERE k > 0) AS with_warnings, count(*) AS total FROM o"),
    "bucket_rows": _with(_CARDS, "SELECT bucket_key, md5(string_agg(doc_id, '|' ORDER BY doc_id)) AS ids_md5, split_part(bucket_key, '__', 1) AS primary_domain, split_part(bucket_key, '__', 2) AS primary_pattern, count(*) AS doc_count FROM b GROUP BY bucket_key"),
    "bucket_stats": _with(_CARDS, "SELECT count(*) AS total_buckets, sum(doc_count)::BIGINT AS total_docs, avg(doc_count)::DOUBLE AS avg_bucket_size, max(doc_count) AS max_bucket_size, min(doc_count) AS min_bucket_size, count(*) FILTER (WHERE doc_count = 1) AS singleton_buckets, coalesce(max(CASE WHEN bucket_key = 'unknown__unknown' THEN doc_count END), 0) AS unknown_bucket_size FROM sizes"),
    "bucket_topn": _with(_CARDS, "SELECT bucket_key, doc_count FROM sizes ORDER BY doc_count DESC, bucket_key LIMIT 10"),
    "bucket_file_names": "WITH k AS (SELECT DISTINCT left(c_mktsegment, 1) || CASE WHEN c_nationkey % 2 = 0 THEN '/' ELSE '-' END || (c_nationkey % 3) AS key FROM customer) SELECT replace(key, '/', '-') AS name, count(*) AS n, string_agg(key, '|' ORDER BY key) AS keys FROM k GROUP BY 1 HAVING count(*) > 1",
    "needs_enrichment": _with(_CARDS, "SELECT doc_id, bucket_key FROM b WHERE domain IS NULL"),
    "enrichment_limit": _with(_CARDS, "SELECT doc_id FROM b WHERE domain IS NULL ORDER BY doc_id LIMIT 25"),
    "response_parse": _with(_EVENTS, "SELECT event_id, kind <> 2 AS parsed, CASE WHEN kind < 2 THEN 'etl|' || event_type WHEN kind = 3 THEN event_type ELSE '' END AS domains, CASE WHEN kind < 2 THEN 0.5::DOUBLE WHEN kind = 3 THEN 0.25::DOUBLE END AS confidence, CASE WHEN kind < 2 THEN 'k' || k END AS reasoning FROM e"),
    "vocab_filter": _with(_EVENTS, f"SELECT event_id, CASE WHEN kind < 2 THEN 'etl' || CASE WHEN event_type IN {_IN(DOMAINS)} THEN '|' || event_type ELSE '' END ELSE event_type END AS domains, CASE WHEN kind < 2 AND 'export' IN {_IN(PATTERNS)} THEN 'export' ELSE event_type END AS patterns FROM e"),
    "enrich_merge": _with(_ENRICHED, "SELECT doc_id, key2 AS bucket_key, coalesce(d2, '') AS domains, p2 AS patterns, CASE WHEN needed THEN ok END AS enriched, CASE WHEN ok THEN bucket_key END AS original_bucket FROM m"),
    "enrich_rules": _with(_CARDS, "SELECT doc_id, CASE WHEN domain IS NULL THEN 'unknown__export' ELSE bucket_key END AS bucket_key, CASE WHEN domain IS NULL THEN 0.5::DOUBLE END AS confidence FROM b"),
    "enrich_replaced": _with(_ENRICHED, "SELECT doc_id, key2 AS bucket_key, CASE WHEN artifact THEN 1 ELSE 0 END AS n_artifacts FROM m"),
    "bucket_changes": _with(_ENRICHED, "SELECT doc_id, bucket_key AS old_bucket, key2 AS new_bucket FROM m WHERE ok AND bucket_key <> key2"),
    "bucket_regrouped": _with(_ENRICHED, "SELECT key2 AS bucket_key, count(*) AS doc_count FROM m GROUP BY 1"),
    "bucket_join_cards": _with(_CARDS, "SELECT bucket_key, size AS bucket_size, position, doc_id FROM (SELECT *, count(*) OVER (PARTITION BY bucket_key) AS size, row_number() OVER (PARTITION BY bucket_key ORDER BY doc_id) - 1 AS position FROM b) x WHERE size >= 3 AND code"),
    "incremental_fold": _with(_CONV, "SELECT bucket_key, cluster_ord, cluster_name, member_count, members, n_phrases, singleton FROM clusters"),
    "assignment_log": _with(_CONV, "SELECT 'conv' || conv_id AS bucket_key, 't' || turn AS doc_id, CASE WHEN turn = opened THEN 'new_cluster' ELSE 'assign' END AS decision, role AS cluster_name, 0.5::DOUBLE AS confidence FROM t"),
    "fold_by_rules": _with(_CONV, "SELECT bucket_key, bucket_key || '-' || (cluster_ord + 1) AS cluster_name, member_count FROM clusters"),
    "fold_totals": _with(_CONV, "SELECT bucket_key, count(*) AS n_clusters, sum(member_count)::BIGINT AS n_docs, count(*) FILTER (WHERE singleton) AS n_singletons FROM clusters GROUP BY 1 ORDER BY n_clusters DESC, n_docs DESC, bucket_key LIMIT 10"),
    "cluster_signature": _with(_SIG, "SELECT bucket_key || '-1' AS cluster_name, md5('Name: ' || bucket_key || '-1' || chr(10) || 'About: About ' || bucket_key || chr(10) || 'Domains: ' || coalesce(domain, '') || chr(10) || 'Patterns: ' || source || chr(10) || 'Triggers: ' || langs || chr(10) || 'Outputs: ' || coalesce(output, '') || chr(10) || 'Documents: ' || n_docs) AS signature_md5 FROM c"),
    "card_summary": _with(_CARDS, "SELECT doc_id, md5('Document: ' || doc_id || chr(10) || 'Trigger: export ' || source || chr(10) || 'Keywords: ' || lang || chr(10) || 'Domains: ' || coalesce(domain, '') || chr(10) || 'Patterns: ' || source || chr(10) || 'Steps: ' || chr(10) || 'Artifacts: ' || CASE WHEN artifact THEN source || '.csv' ELSE '' END) AS summary_md5 FROM b"),
    "domain_rollup": _with(_SIG, "SELECT bucket_key || '-1' AS cluster_name, rollup AS domain_rollup, n_docs AS member_count FROM s"),
    "rollup_groups": _with(_SIG, "SELECT s.rollup, count(*) AS n_clusters, sum(n_docs)::BIGINT AS total_docs, coalesce(string_agg(DISTINCT domain, '|' ORDER BY domain), '') AS domains, string_agg(DISTINCT source, '|' ORDER BY source) AS patterns, max(g.langs) AS triggers, coalesce(max(a.outputs), '') AS outputs FROM s LEFT JOIN (SELECT rollup, string_agg(DISTINCT lang, '|' ORDER BY lang) AS langs FROM b JOIN s s2 ON b.bucket_key = s2.bucket_key GROUP BY 1) g ON s.rollup = g.rollup LEFT JOIN (SELECT rollup, string_agg(output, '|' ORDER BY output) AS outputs FROM (SELECT rollup, output, row_number() OVER (PARTITION BY rollup ORDER BY output) AS rn FROM (SELECT DISTINCT rollup, output FROM s WHERE output IS NOT NULL) y) z WHERE rn <= 20 GROUP BY 1) a ON s.rollup = a.rollup GROUP BY s.rollup"),
    "lost_by_name": _with(_SIG, "SELECT source AS cluster_name, count(*) AS n, sum(n_docs)::BIGINT AS n_docs FROM c GROUP BY 1 HAVING count(*) > 1"),
    "signatures_by_name": _with(_SIG, "SELECT source AS cluster_name, max(bucket_key) AS bucket_key FROM c GROUP BY 1"),
    "skill_clusters": _with(_SIG, "SELECT s.rollup || '-skill' AS cluster_name, s.rollup AS domain_rollup, count(*) AS member_count, md5(string_agg(b.doc_id, '|' ORDER BY b.doc_id)) AS members_md5, string_agg(DISTINCT b.lang, '|' ORDER BY b.lang) || '|' || string_agg(DISTINCT b.lang, '|' ORDER BY b.lang) AS triggers, count(DISTINCT s.bucket_key) AS n_buckets FROM s JOIN b ON s.bucket_key = b.bucket_key GROUP BY s.rollup"),
    "merge_fallback": _with(_SIG, "SELECT DISTINCT rollup, CASE WHEN rollup = 'misc' THEN 'misc-skill' ELSE v.name END AS skill_name, rollup <> 'misc' AS decided, CASE WHEN rollup <> 'misc' AND v.name = 'b' THEN 'x' ELSE 'all' END AS names FROM s, (VALUES ('a'), ('b')) AS v(name) WHERE rollup <> 'misc' OR v.name = 'a'"),
    "doc_to_cluster": _with(_SIG, "SELECT b.doc_id, s.rollup || '-skill' AS cluster_name FROM b JOIN s ON b.bucket_key = s.bucket_key"),
    "merge_reduction": _with(_SIG, "SELECT count(*) AS input_clusters, count(DISTINCT rollup) AS output_clusters, round((1 - count(DISTINCT rollup)::DOUBLE / greatest(count(*), 1)) * 100, 6) AS reduction_percent FROM s"),
    "audit_candidates": _with(_SIG, "SELECT bucket_key || '-1' AS cluster_name, n_docs AS member_count, least(12, greatest(8, n_docs // 4)) AS sample_size FROM c WHERE n_docs >= 10"),
    "stratified_sample": _with(
        _CARDS,
        "SELECT bucket_key || '-1' AS cluster_name, doc_id, stratum FROM q WHERE doc_count <= want OR taken OR drawn <= want - n_taken",
        _SAMPLE,
    ),
    "audit_results": _with(_SIG, "SELECT bucket_key || '-1' AS cluster_name, n_docs % 3 <> 1 AS is_pure, CASE WHEN n_docs % 3 = 1 THEN 'split' ELSE 'keep_as_is' END AS recommendation, CASE n_docs % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.75 ELSE 0.5 END::DOUBLE AS confidence FROM c"),
    "rep_count": _with(_SIG, f"SELECT bucket_key || '-1' AS cluster_name, n_docs AS member_count, {_RCOUNT.format('n_docs')} AS target FROM c"),
    "rep_score": _with(_SCORED, "SELECT cluster_id, doc_id, total::BIGINT AS total_score, hi AS has_issues, hc AS has_code, ha AS has_artifacts FROM scored"),
    "rep_select": _with(f"{_SCORED},{_chosen('scored')}", "SELECT cluster_id, doc_id, sel_rank, why AS why_selected, total::BIGINT AS total_score FROM chosen"),
    "coverage_status": _with(f"{_SCORED},{_chosen('scored')}", "SELECT cluster_id, string_agg(doc_id, '|' ORDER BY sel_rank) AS reps, bool_or(fi) AS has_issues_doc, bool_or(fc) AS has_code_doc, bool_or(fa) AS has_artifacts_doc, CASE WHEN bool_or(fi) AND bool_or(fc) AND bool_or(fa) THEN 'OK' ELSE 'PARTIAL' END AS status, count(*) AS actual_count FROM chosen GROUP BY cluster_id"),
    "known_ids": _with(_CARDS, "SELECT doc_id FROM b"),
    "sanity_missing_rep": _with(_REPS, "SELECT DISTINCT bucket_key AS cluster_id FROM b WHERE bucket_key NOT IN (SELECT cluster_id FROM reps)"),
    "sanity_unresolved": _with(_REPS, "SELECT cluster_id, count(*) AS n FROM reps WHERE doc_id NOT IN (SELECT doc_id FROM b WHERE num % 5 <> 0) GROUP BY 1"),
    "sanity_orphans": _with(_REPS, "SELECT cluster_id, count(*) AS n FROM reps WHERE doc_id = 'doc99999999' GROUP BY 1"),
    "sanity_class": _with(_REPS, "SELECT cluster_id, CASE WHEN NOT (i OR c OR a) THEN 'THIN' WHEN NOT (i AND c) THEN 'PARTIAL' ELSE 'OK' END AS coverage FROM cover"),
    "sanity_verdict": _with(
        _REPS,
        "SELECT issues, warnings, CASE WHEN issues > 0 THEN 1 ELSE 0 END AS exit_code FROM q",
        """
q AS (
  SELECT (SELECT count(DISTINCT bucket_key) FROM b WHERE bucket_key NOT IN (SELECT cluster_id FROM reps)) + (SELECT count(DISTINCT cluster_id) FROM reps WHERE doc_id NOT IN (SELECT doc_id FROM b WHERE num % 5 <> 0))
    + (SELECT count(DISTINCT cluster_id) FROM reps WHERE doc_id = 'doc99999999') AS issues, (SELECT count(*) FROM cover WHERE NOT (i OR c OR a)) AS warnings)""",
    ),
    "synthesis_input": _with(_SKILL, "SELECT cluster_name, state, documents FROM ready"),
    "enrichment_prompt": _with(_CARDS, "SELECT doc_id, md5('Choose one to three domains and one to three patterns for this card, from the lists only. Answer with JSON: domains, patterns, confidence, reasoning.' || chr(10) || 'Domains: x, y' || chr(10) || 'Patterns: z') AS lists_md5, doc_id AS card_id FROM b WHERE domain IS NULL"),
    "enrichment_summary": _with(_ENRICHED, "SELECT count(*) AS cards, count(*) FILTER (WHERE needed) AS needed, count(*) FILTER (WHERE ok) AS enriched, count(*) FILTER (WHERE needed AND NOT ok) AS failed, count(*) FILTER (WHERE ok AND bucket_key <> key2) AS moved FROM m"),
    "bucket_first": _with(_CARDS, "SELECT b.bucket_key, doc_count AS bucket_size, row_number() OVER (PARTITION BY b.bucket_key ORDER BY doc_id) - 1 AS position, doc_id FROM b JOIN (SELECT * FROM sizes WHERE doc_count >= 2 ORDER BY bucket_key LIMIT 3) z ON b.bucket_key = z.bucket_key"),
    "fold_odd_answers": _with(_CONV, "SELECT bucket_key, cluster_name, member_count, member_count AS n_members FROM clusters"),
    "log_odd_answers": _with(_CONV, "SELECT 'conv' || conv_id AS bucket_key, 't' || turn AS doc_id, CASE WHEN turn = opened THEN 'new_cluster' ELSE 'assign' END AS decision, role AS cluster_name, CASE turn % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.25::DOUBLE ELSE NULL END AS confidence FROM t"),
    "fold_summary": _with(_CONV, "SELECT (SELECT count(DISTINCT conv_id) FROM t) AS buckets, (SELECT count(*) FROM t) AS documents, (SELECT count(*) FROM clusters) AS clusters, (SELECT count(*) FROM clusters WHERE singleton) AS singletons, (SELECT count(*) FROM t WHERE turn > opened) AS assigned, (SELECT count(*) FROM t WHERE turn = opened) AS opened, 0 AS fallbacks"),
    "assignment_prompt": _with(_SIG, f"SELECT doc_id, md5(CASE WHEN code THEN 'Assign the document to a cluster or open a new one. Answer with JSON.' || chr(10) || chr(10) || 'Clusters:' || chr(10) || {_SIGNATURE} || chr(10) || chr(10) || {_SUMMARY} ELSE 'This is the first document: open a cluster for it.' || chr(10) || chr(10) || {_SUMMARY} END) AS prompt_md5 FROM b JOIN c ON b.bucket_key = c.bucket_key"),
    "rollup_prompt": _with(_SIG, "SELECT rollup, 'Domains: ' || coalesce(string_agg(DISTINCT domain, ', ' ORDER BY domain), '') AS domains, 'Rollup: ' || rollup AS head, 6 AS n_lines FROM s GROUP BY rollup"),
    "skills_across_rollups": _with(_SIG, "SELECT g.rollup || '/0' AS cluster_id, 'same' AS cluster_name, (SELECT count(*) FROM b) AS member_count, (SELECT md5(string_agg(doc_id, '|' ORDER BY doc_id)) FROM b) AS members_md5 FROM (SELECT DISTINCT rollup FROM s) g"),
    "audit_splits": _with(_SIG, "SELECT bucket_key || '-1' AS cluster_name, 2 AS n_parts, 0.75::DOUBLE AS confidence FROM c WHERE n_docs >= 10 AND n_docs % 2 = 0"),
    "audit_kept": _with(_SIG, "SELECT bucket_key || '-1' AS cluster_name FROM c WHERE n_docs >= 10 AND n_docs % 2 = 1"),
    "audit_summary": _with(_SIG, "SELECT count(*) AS audited, count(*) FILTER (WHERE n_docs % 2 = 0) AS splits, count(*) FILTER (WHERE n_docs % 2 = 1) AS kept FROM c WHERE n_docs >= 10"),
    "audit_card_text": _with(_CARDS, "SELECT doc_id, md5('Document: ' || doc_id || chr(10) || 'Trigger: export ' || source || chr(10) || 'Keywords: ' || lang || chr(10) || 'Domains: ' || coalesce(domain, '') || chr(10) || 'Patterns: ' || source || chr(10) || 'Steps: ' || chr(10) || 'Artifacts: ' || CASE WHEN artifact THEN source || '.csv' ELSE '' END || chr(10) || 'Issues: ' || CASE WHEN issue THEN 'offending text' ELSE '' END) AS text_md5 FROM b"),
    "audit_prompt": _with(_CARDS, "SELECT cluster_name, count(*) AS n_cards, min_by(doc_id, place) AS first_doc FROM chosen GROUP BY 1", _SAMPLE + """,
chosen AS (
  SELECT bucket_key || '-1' AS cluster_name, doc_id, row_number() OVER (PARTITION BY bucket_key ORDER BY taken DESC, CASE WHEN taken THEN stratum END, CASE WHEN taken THEN doc_id END, md5(doc_id || 'audit'), doc_id) AS place
  FROM q WHERE doc_count <= want OR taken OR drawn <= want - n_taken)"""),
    "rep_summary": _with(f"{_SCORED},{_chosen('scored')}", "SELECT count(DISTINCT cluster_id) AS clusters, count(*) AS representatives, (SELECT count(*) FROM (SELECT 1 FROM chosen GROUP BY cluster_id HAVING bool_or(fi) AND bool_or(fc) AND bool_or(fa)) x) AS ok, (SELECT count(*) FROM (SELECT 1 FROM chosen GROUP BY cluster_id HAVING NOT (bool_or(fi) AND bool_or(fc) AND bool_or(fa))) x) AS partial FROM chosen"),
    "synthesis_prompt": _with(_SKILL, "SELECT r.cluster_name, 'Domains: ' || coalesce(d.domains, '') AS domains, '[{\"doc_id\":\"' || replace(r.documents, '|', '\"}, {\"doc_id\":\"') || '\"}]' AS documents FROM ready r JOIN (SELECT rollup || '-skill' AS cluster_name, string_agg(DISTINCT domain, ', ' ORDER BY domain) AS domains FROM s GROUP BY 1) d ON r.cluster_name = d.cluster_name WHERE state = 'ready'"),
    "skill_files": _with(_SKILL, "SELECT cluster_name, 'processed' AS state, path, n_chars::BIGINT AS n_chars FROM files", _FILES),
    "synthesis_summary": _with(_SKILL, "SELECT count(*) FILTER (WHERE state = 'ready') AS processed, count(*) FILTER (WHERE state = 'failed') AS failed, count(*) FILTER (WHERE state = 'skipped') AS skipped FROM ready"),
    "manifest_changes": _with(_O, "SELECT o_orderkey FROM o WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0"),
}
