"""Enrichment, the fold, merging, representatives, checks, synthesis and the whole run."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators import audit, enrich, merge, representatives, responses, synthesis
from inkwell.operators import clusters as I
from inkwell.plans import pipeline
from inkwell.plans.config import Config, read_env
from inkwell.sources import tables
from inkwell.streaming import incremental

FENCE = "```"


def _one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "want"),
    [('{"a": 1}', '{"a": 1}'), (f'{FENCE}json\n{{"a": 1}}\n{FENCE}\ntrailing', '{"a": 1}'), (f"{FENCE}\nopen\nend", "open\nend"), ("", "")],
)
def test_fences(spark, text, want):
    assert _one(spark, responses.inside_fence(F.col("t")), t=text) == want
    assert I._unfenced(text) == want


def test_parse_tells_malformed(spark):
    p = responses.parse(F.col("t"), responses.ENRICHMENT)
    assert _one(spark, p, t='{"domains": ["x"') is None and _one(spark, p, t="[1]") is None and _one(spark, p, t="") is None
    assert _one(spark, p, t="{}").domains is None
    assert _one(spark, responses.without_fences(F.col("t")), t=f"{FENCE}json\n{{}}\n{FENCE}") == "{}"
    assert _one(spark, responses.without_fence_lines(F.col("t")), t=f"{FENCE}json\n{{}}\n{FENCE}") == "{}"


def _card(spark, domains, patterns):
    kind = "doc_id string, tags struct<languages:array<string>,frameworks:array<string>,tools:array<string>,domains:array<string>,patterns:array<string>>, trigger struct<what_triggered:string,keywords:array<string>>, workflow_steps array<string>, artifacts array<string>, issues array<string>, bucket_key string"
    return spark.createDataFrame([("d", ([], [], [], domains, patterns), ("please export the etl", []), [], [], [], "a__b")], kind)


def test_enrichment(spark):
    whole = enrich.enrich(_card(spark, ["a"], ["b"]), F.lit('{"domains": ["etl"]}')).first()
    assert whole._enrichment is None and whole.bucket_key == "a__b"
    # either family missing is enough, and both are replaced
    half = enrich.enrich(_card(spark, ["a"], ["unknown"]), F.lit('{"domains": ["etl", "nope", "etl"], "patterns": ["export"], "confidence": 1}')).first()
    assert half.tags.domains == ["etl", "etl"] and half.bucket_key == "etl__export" and half._enrichment.original_bucket_key == "a__b"
    bad = enrich.enrich(_card(spark, [], []), F.lit("oops")).first()
    assert bad._enrichment.enriched is False and bad.bucket_key == "a__b"
    rule = enrich.enrich(_card(spark, [], []), enrich.rule_decider()).first()
    assert (rule.tags.domains, rule.tags.patterns) == (["etl"], ["etl", "export"])


CARD = {"doc_id": "document-with-a-long-name", "bucket_key": "b", "tags": {"domains": ["x"]}, "keywords": ["k"], "artifacts": ["f"]}


def test_fold_steps():
    clusters = []
    assert I.step(CARD, clusters, '{"decision": "new_cluster", "cluster_name": "n"}', 1) == (0, "new_cluster", 0.0) and clusters[0]["singleton"]
    assert I.step(CARD, clusters, '{"decision": "whatever", "cluster_name": "n", "confidence": 0.5, "updated_signature": {"trigger_phrases": ["p", "p", "k", ""]}}', 1) == (0, "assign", 0.5)
    assert clusters[0]["trigger_phrases"] == ["k", "p", "p"] and not clusters[0]["singleton"]
    assert I.step(CARD, clusters, '{"decision": "assign", "cluster_name": "gone"}', 1) == (1, None, None) and not clusters[1]["singleton"]
    assert I.step(CARD, clusters, "broken", 9)[1] is None and clusters[2]["cluster_name"] == "singleton-document-with-a-long" and clusters[2]["singleton"]
    many = [{"cluster_name": str(i), "tags": {"domains": ["y"]}} for i in range(10)] + [{"cluster_name": "late", "tags": {"domains": ["x"]}}]
    assert json.loads(I.rule_decider(CARD, many))["decision"] == "new_cluster"


def test_fold_reads_an_answer_whole_before_it_acts():
    """Confidences of any kind are kept out of the count, null signatures are empty, and a bad answer touches no cluster."""
    clusters = []
    assert I.step(CARD, clusters, '{"decision": "new_cluster", "cluster_name": "a", "confidence": "high"}', 5) == (0, "new_cluster", None)
    assert I.step(CARD, clusters, '{"decision": "assign", "cluster_name": "a", "confidence": null, "updated_signature": null}', 5) == (0, "assign", None)
    assert I.step(CARD, clusters, '{"decision": "assign", "cluster_name": "a", "confidence": "0.5", "updated_signature": {"trigger_phrases": null}}', 5) == (0, "assign", 0.5)
    assert clusters[0]["member_count"] == 3 and len(clusters) == 1
    for bad in ('["a"]', '{"decision": "assign", "cluster_name": "a", "updated_signature": ["x"]}', '{"decision": "assign", "cluster_name": "a", "updated_signature": {"trigger_phrases": 5}}'):
        at, decision, _ = I.step(CARD, clusters, bad, 5)
        assert decision is None and at == len(clusters) - 1 and clusters[at]["singleton"]
    assert clusters[0]["member_count"] == 3 and clusters[0]["trigger_phrases"] == ["k"]
    assert I.step(CARD, clusters, '{"decision": "new_cluster", "cluster_name": 7, "cluster_description": null}', 5)[1] == "new_cluster" and clusters[-1]["cluster_name"] == "7" and clusters[-1]["cluster_description"] == ""


def _members(spark, n=60):
    rng = random.Random(3)
    rows = [(f"b{i % 3}", 20, i // 3, f"d{i}", ([], [], [], [rng.choice("xyz"), rng.choice("uvw")], []), ([],), []) for i in range(n)]
    return spark.createDataFrame(rows, "bucket_key string, bucket_size long, position long, doc_id string, tags struct<languages:array<string>,frameworks:array<string>,tools:array<string>,domains:array<string>,patterns:array<string>>, trigger struct<keywords:array<string>>, artifacts array<string>")


def test_fold_equals_loop_and_ignores_input_order(spark):
    m = _members(spark)
    want = {}
    for b in ("b0", "b1", "b2"):
        state = []
        for r in m.filter(F.col("bucket_key") == b).orderBy("position").collect():
            card = {"doc_id": r.doc_id, "bucket_key": b, "tags": r.tags.asDict(), "keywords": [], "artifacts": []}
            at, _, _ = I.step(card, state, I.rule_decider(card, state), 20)
            want.setdefault((b, state[at]["cluster_name"]), []).append(r.doc_id)
    for df in (m, m.repartition(7)):
        got = {(r.bucket_key, r.cluster_name): r.member_doc_ids for r in I.clusters(I.fold(df)).collect()}
        assert got == want


def test_streamed_fold_equals_batch(spark, tmp_path):
    m = _members(spark).select("bucket_key", "position", "doc_id", F.to_json("tags").alias("tags"), F.when(F.col("position") % 2 == 0, F.col("trigger.keywords")).alias("keywords"), F.lit(None).cast("array<string>").alias("artifacts"))
    for i in range(3):
        m.filter(f"position div 7 = {i}").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        s = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in/*"))
        q = incremental.stream_clusters(s).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(240)
        if q.isActive:
            q.stop()
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"no state store here: {str(e)[:80]}")
    log = spark.read.parquet(str(tmp_path / "out"))
    got = {(r.bucket_key, r.doc_id): r.cluster_name for r in log.filter("event = 'member'").collect()}
    folded = {(r.bucket_key, r.cluster_name): (r.member_count, sorted(r.member_doc_ids)) for r in I.clusters(I.fold(_members(spark))).collect()}
    assert {(r.bucket_key, r.cluster_name): (r.member_count, sorted(r.member_doc_ids)) for r in I.clusters(incremental.latest(log)).collect()} == folded
    want = {(r.bucket_key, r.doc_id): r.cluster_name for r in I.fold(_members(spark)).filter("event = 'member'").collect()}
    assert got == want


@pytest.mark.parametrize(("domains", "want"), [(["guidelines"], "frontend"), (["rapid"], "api-development"), (["excellent"], "data-analysis"), ([], "misc"), (None, "misc"), (["LLM"], "ai-integration")])
def test_rollup_by_substring(spark, domains, want):
    df = spark.createDataFrame([(domains,)], "d array<string>")
    assert df.select(merge.domain_rollup(F.col("d")).alias("x")).first().x == want


def _greedy(docs, k):
    """The two passes as a loop."""
    order = sorted(docs, key=lambda d: (-d[2], d[1]))
    chosen, covered, why = [], set(), {}
    for d in order:
        if len(chosen) >= k:
            break
        gaps = [f for f, x in zip(representatives.FLAGS, d[3:], strict=True) if x and f not in covered]
        if gaps or len(chosen) < k // 2:
            chosen.append(d)
            covered |= set(gaps)
            why[d[0]] = ", ".join(f"{g} coverage" for g in gaps) or f"high score ({d[2]})"
    for d in order:
        if len(chosen) < k and d not in chosen:
            chosen.append(d)
            why[d[0]] = f"high score ({d[2]})"
    return [(d[0], why[d[0]]) for d in chosen]


def test_selection_equals_the_greedy_loop(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for c in range(60):
        n = rng.choice([1, 2, 3, 5, 6, 15, 16, 30])
        docs = [(f"c{c}d{i}", i, rng.choice([0, 10, 20, 30]), *(rng.random() < 0.3 for _ in range(3))) for i in range(n)]
        rows += [(f"c{c}", d[1], d[0], d[2], *d[3:]) for d in docs]
        want[f"c{c}"] = _greedy(docs, min(3, n) if n <= 5 else 5 if n <= 15 else 8)
    scored = spark.createDataFrame(rows, "cluster_id string, position int, doc_id string, total_score int, has_issues boolean, has_code boolean, has_artifacts boolean")
    got = {}
    for r in representatives.select(scored).orderBy("cluster_id", "sel_rank").collect():
        got.setdefault(r.cluster_id, []).append((r.doc_id, r.why_selected))
    assert got == want


def test_split_rule_and_sample_size(spark):
    df = spark.createDataFrame([(5, 20, False), (5, 25, False), (4, 4, False), (1, 9, True)], "a int, b int, l boolean")
    assert [r.x for r in df.select(representatives.split_applies(F.col("a"), F.col("b"), F.col("l")).alias("x")).collect()] == [True, False, False, True]
    sizes = spark.createDataFrame([(n,) for n in (7, 8, 40, 60)], "n long")
    assert [r.x for r in sizes.select(audit.sample_size(F.col("n")).alias("x")).collect()] == [8, 8, 10, 12]


def test_packages_stay_in_their_folder(spark, tmp_path):
    assert tables.safe_path("../x", "d") is None and tables.safe_path("/etc/x", "d") is None and tables.safe_path("a\\..\\..\\x", "d") is None
    assert tables.safe_path(None, "references/unknown.md") == "references/unknown.md"
    p = spark.createDataFrame([("s/k", [("SKILL.md", "# x"), ("../evil", "y"), (None, "z")])], "skill_name string, files array<struct<path:string,contents:string>>")
    got = tables.write_packages(p, f"file://{tmp_path}").collect()
    assert [r.written for r in got] == [True, False, True] and (tmp_path / "s-k/SKILL.md").read_text() == "# x" and (tmp_path / "s-k/references/unknown.md").exists()


def test_json_tables(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x",\n "n": 1}')
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "_summary.json").write_text('{"id": "no"}')
    rows, bad = tables.read_json_table(spark, str(tmp_path), "id string, n int")
    assert [tuple(r) for r in rows.collect()] == [("x", 1)] and bad.count() == 1
    tables.write_json_records(rows, f"file://{tmp_path}/out", "id").collect()
    assert json.loads((tmp_path / "out/x.json").read_text()) == {"id": "x", "n": 1}
    tables.write_table(rows, str(tmp_path / "t"))
    assert tables.first_table(spark, [str(tmp_path / "none"), str(tmp_path / "t")]).count() == 1


def test_config(tmp_path):
    assert read_env("# c\nA=1\n B = 'x=y' \n\nbad") == {"A": "1", "B": "x=y"}
    (tmp_path / "c.json").write_text('{"domains": ["only"], "other": 1}')
    assert Config.load(str(tmp_path / "c.json")).vocabulary[0] == ("only",) and Config.load(str(tmp_path / "no")).min_bucket_size == 1
    Config().save(str(tmp_path / "d.json"))
    assert Config.load(str(tmp_path / "d.json")) == Config()


def test_whole_run_and_resume(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for i in range(8):
        (src / f"SR-PTD_{i}.md").write_text(f"**Date**: 2024-01-0{i + 1} | **Type**: Fix\n## Trigger\n> export run {i}\n## Workflow\n1. do {i}\n## Issues\n- Late job {i} -> restart\n## Tags\nLanguages: SQL | Domains: etl{i % 2} | Patterns: Export\n")
    (src / "SR-PTD_bad.md").write_bytes(b"\xff")
    out = pipeline.run_pipeline(spark, str(src), str(tmp_path / "run"))
    assert out["extractions"].count() == 8 and out["rejects"].count() == 1 and out["clusters"].count() == 2
    assert out["findings"].filter("severity = 'issue'").count() == 0
    assert {r.state for r in out["packages"].collect()} == {"processed"}
    first = sorted(map(str, out["representatives"].collect()))
    again = pipeline.run_pipeline(spark, str(src), str(tmp_path / "run"))
    assert {r.status for r in again["status"].collect()} == {"resumed"} and sorted(map(str, again["representatives"].collect())) == first
    dry = pipeline.run_pipeline(spark, str(src), str(tmp_path / "dry"), Config(dry_run=True))
    assert dry["rollup_prompts"].count() == 1 and "final" not in dry and "packages" not in dry
    (src / "SR-PTD_9.md").write_text("## Trigger\n> new\n")
    more = pipeline.run_pipeline(spark, str(src), str(tmp_path / "run"))
    assert {r.status for r in more["status"].collect()} == {"done"} and more["extractions"].count() == 9


def _notes(folder, n=12):
    folder.mkdir()
    for i in range(n):
        tags = "" if i % 4 == 3 else f"Domains: {'frontend' if i % 2 else 'backend'} | Patterns: Export"
        (folder / f"SR-PTD_{i:02d}.md").write_text(f"**Date**: 2024-01-0{i % 9 + 1} | **Type**: Fix\n## Trigger\n> export run {i}\n## Workflow\n1. do {i}\n## Issues\n- Late job {i} -> restart\n## Tags\nLanguages: SQL | {tags}\n")


def _told(out, *names):
    return {n: sorted(map(str, out[n].collect())) for n in names if n in out}


def test_every_field_of_the_configuration_matters(spark, tmp_path):
    _notes(tmp_path / "src")
    run = lambda **fields: pipeline.run_pipeline(spark, str(tmp_path / "src"), str(tmp_path / "run"), Config(**fields))
    names = ("enriched", "events", "signatures", "final", "audit", "packages", "rollup_prompts")
    base = _told(run(), *names)
    assert base["audit"] == [] and len(base["packages"]) > 1
    # from the last stage to the first, so that what doesn't depend on a field is resumed
    for fields in ({"packages_of": ("frontend-skill",)}, {"max_packages": 1}, {"skip_synthesis": True}, {"audit_of": "frontend-skill"}, {"audit_min_size": 2}):
        assert _told(run(**fields), *names) != base, fields
    for fields in ({"rollups": {"one": ("backend", "frontend")}}, {"min_bucket_size": 4}, {"first_buckets": 1}, {"max_cards": 1}, {"domains": ("only",)}, {"patterns": ("only",)}):
        out = run(**fields, dry_run=True)
        assert {r.stage: r.status for r in out["status"].collect()}["extractions"] == "resumed" and "final" not in out
        assert _told(out, *names) != {n: base[n] for n in names if n in out}, fields
    assert set(Config.__dataclass_fields__) == {"domains", "patterns", "rollups", "min_bucket_size", "first_buckets", "max_cards", "audit_min_size", "audit_of", "skip_synthesis", "dry_run", "max_packages", "packages_of", "key_by_name"}


def test_deciders_of_a_run(spark, tmp_path):
    """Every decider is asked with its prompt, and its answer decides; names that two skills share stay apart."""
    _notes(tmp_path / "src")

    def merge(groups, prompts):
        assert prompts.filter("prompt like 'Rollup: %'").count() == groups.count()
        return groups.select("rollup", F.to_json(F.struct(F.lit("split").alias("recommendation"), F.array(F.struct(F.lit("same").alias("skill_name"), "cluster_names")).alias("skills"))).alias("answer"))

    def audit_all(prompts):
        assert prompts.filter("prompt like '%Document: %'").count() == prompts.count()
        return prompts.select("cluster_name", F.lit('{"is_pure": false, "recommendation": "split", "split_into": [{"skill_name": "p"}], "reasoning": "r"}').alias("answer"))

    ask = pipeline.Deciders(
        enrich=lambda vocabulary, prompt: F.when(prompt.contains("Card: "), F.lit('{"domains": ["llm"], "patterns": ["etl"], "confidence": 1}')),
        assign=lambda card, clusters: json.dumps({"decision": "new_cluster", "cluster_name": "c-" + card["doc_id"]}),
        merge=merge, audit=audit_all, synthesize=lambda prompt: F.to_json(F.struct(F.lit("same").alias("skill_name"), prompt.alias("skill_md"))),
    )
    out = pipeline.run_pipeline(spark, str(tmp_path / "src"), str(tmp_path / "run"), Config(audit_min_size=2), deciders=ask)
    assert out["enriched"].filter("bucket_key = 'llm__etl'").count() == 3 and out["clusters"].count() == 12
    final = out["final"].collect()
    assert {r.cluster_name for r in final} == {"same"} and len({r.cluster_id for r in final}) == len(final) == 3 and sum(r.member_count for r in final) == 12
    assert out["audit_splits"].count() == 3 and out["audit_kept"].count() == 0 and out["audit_summary"].first().splits == 3
    assert out["representatives"].count() == 3 and out["packages"].filter("state = 'processed'").count() == 3
    assert out["packages"].filter("files[0].contents like '%Documents: [{%'").count() == 3
    assert tuple(out["enrichment_summary"].first())[:3] == (12, 3, 3) and out["fold_summary"].first().opened == 12
    written = tables.write_packages(out["packages"], f"file://{tmp_path}/skills").collect()
    assert len({r.skill_name for r in written}) == 3 and all(r.written for r in written)


def test_command_line(spark, tmp_path, capsys):
    _notes(tmp_path / "src", 4)
    assert pipeline.main([str(tmp_path / "src"), str(tmp_path / "run"), "--dry-run"]) == 0
    assert "rollup_prompts" in capsys.readouterr().out and not (tmp_path / "run/final").exists()


def test_changes_are_told_by_the_latest_entry(spark, tmp_path):
    from inkwell.sources.markdown import changed

    known = spark.createDataFrame([("a", "1", 0), ("a", "2", 1), ("b", "1", 0)], "path string, hash string, batch int")
    new = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "path string, hash string")
    assert sorted(r.path for r in changed(new, known, "batch").collect()) == ["a", "c"]


def test_streamed_rejects(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "SR-PTD_bad.md").write_bytes(b"\xff")
    (src / "SR-PTD_a.md").write_text("## Trigger\n> a\n")
    args = [str(tmp_path / x) for x in ("src", "sink", "known", "cp")]
    incremental.stream_extractions(spark, *args).awaitTermination(120)
    assert [r.path.rpartition("/")[2] for r in spark.read.parquet(args[2] + "-rejects").collect()] == ["SR-PTD_bad.md"]
    assert spark.read.parquet(args[2]).count() == 1 and spark.read.parquet(args[1]).count() == 1


def test_sample_equals_the_rule(spark):
    """Candidates found within tasks give what ranking whole clusters gives."""
    import hashlib

    rng = random.Random(9)
    rows, want = [], {}
    for c, n in enumerate((8, 9, 30, 60, 300)):
        mine = [(f"c{c}", n, i, f"c{c}d{i}", rng.choice(["high", "low", None]), rng.choice([0, 0, 1]), rng.choice([0, 1])) for i in range(n)]
        rows += mine
        size, first = min(12, max(8, n // 4)), []
        kind = lambda r: "a_priority" if r[4] == "high" else "b_issues" if r[5] else "c_artifacts" if r[6] else "d_other"
        for s, k in audit.FIRST.items():
            first += [r for r in mine if kind(r) == s][:k]
        rest = sorted((r for r in mine if r not in first), key=lambda r: (hashlib.md5((r[3] + "audit").encode()).hexdigest(), r[2]))
        want[f"c{c}"] = [r[3] for r in (first + rest)[: n if n <= size else size]]
    m = spark.createDataFrame(rows, "cluster_name string, member_count long, position int, doc_id string, priority string, n_issues int, n_artifacts int")
    got = {}
    for r in audit.sample(m.repartition(5)).orderBy("cluster_name", "sample_rank").collect():
        got.setdefault(r.cluster_name, []).append(r.doc_id)
    assert got == want


def test_streamed_extractions(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "SR-PTD_a.md").write_text("## Trigger\n> a\n")
    args = [str(tmp_path / x) for x in ("src", "sink", "known", "cp")]
    incremental.stream_extractions(spark, *args).awaitTermination(120)
    (src / "SR-PTD_b.md").write_text("## Trigger\n> b\n")
    incremental.stream_extractions(spark, *args).awaitTermination(120)
    assert sorted(r.trigger.what_triggered for r in spark.read.parquet(args[1]).collect()) == ["a", "b"]


def test_synthesis_routes_states(spark):
    kind = "cluster_name string, cluster_description string, trigger_phrases array<string>, state string, parts array<struct<place:int,doc_id:string,payload:string>>"
    df = spark.createDataFrame([("a", "about", ["t"], "ready", [(0, "d", "{}")]), ("b", "", [], "skipped", None)], kind)
    got = {r.cluster_name: r for r in synthesis.packages(df, synthesis.template_answer()).collect()}
    assert got["a"].state == "processed" and [f.path for f in got["a"].files] == ["SKILL.md", "traceability.json", "references/sources.md"]
    assert got["b"].state == "skipped" and got["b"].files == []
    assert synthesis.packages(df, F.lit("not json")).filter("cluster_name = 'a'").first().state == "failed"
