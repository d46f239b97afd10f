"""Registered queries of the engine's operators over the test tables, whole tables each."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import audit as A
from ..operators import cards as C
from ..operators import clusters as I
from ..operators import enrich as T
from ..operators import extract as X
from ..operators import merge as M
from ..operators import representatives as R
from ..operators import responses as P
from ..operators import sections as S
from ..operators import synthesis as D
from ..session import ship
from ..sources import tables
from ..sources.markdown import changed, manifest
from . import adapters as ad

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def _joined(items: Column | str) -> Column:
    return F.array_join(items, "|")


def _notes(spark: SparkSession, sf: str) -> DataFrame:
    return ad.order_notes(spark, sf)


def _each(df: DataFrame, column: str) -> DataFrame:
    """o_orderkey, r: a row per element. An outer explode, because a plain one makes the optimizer infer a filter on the
    array and push a copy of its whole expression below every projection."""
    return df.select("o_orderkey", F.explode_outer(column).alias("r")).filter(F.col("r").isNotNull())


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    return X.extract(_notes(spark, sf))


@query
def tag_normalize(spark, sf):
    p = ad.table(spark, sf, "part")
    raw = F.concat(F.lit("  "), "p_type", F.lit("\t/ "), "p_brand", F.lit(" (É"), F.col("p_size").cast("string"), F.lit(") "))
    return p.select("p_partkey", tx.normalize_tag(raw).alias("tag"))


@query
def tag_distinct(spark, sf):
    c = ad.table(spark, sf, "customer")
    items = F.array(F.lower("c_mktsegment"), F.col("c_mktsegment"), F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")), F.col("c_name"))
    return c.select("c_custkey", _joined(tx.distinct_ignoring_case(items)).alias("kept"))


@query
def doc_id_hash(spark, sf):
    return _notes(spark, sf).select("o_orderkey", tx.doc_id(F.col("path"), F.col("content")).alias("doc_id"))


@query
def format_detect(spark, sf):
    return _notes(spark, sf).select("o_orderkey", S.detect_format(F.col("content")).alias("format_detected"))


@query
def section_split(spark, sf):
    d = X.split_documents(_notes(spark, sf))
    rows = d.select("o_orderkey", F.explode_outer("raw_sections").alias("section", "body")).filter("section is not null")
    return rows.select("o_orderkey", "section", F.md5(F.encode("body", "UTF-8")).alias("body_md5"), F.length("body").cast("long").alias("n_chars"))


@query
def header_metadata(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", *[F.col(f"metadata.{c}").alias(c) for c in ("date", "task_type", "domain", "complexity", "time_spent", "repo_branch")])


@query
def trigger_fields(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", F.col("trigger.what_triggered").alias("what_triggered"), _joined("trigger.keywords_phrases").alias("keywords"), F.size("trigger.context_markers").cast("long").alias("n_markers"))


@query
def context_fields(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", *[F.col(f"context_inputs.{c}").alias(c) for c in ("objective", "environment", "requirements", "problem_statement", "starting_state")])


@query
def workflow_steps(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", F.col("workflow.workflow_type").alias("workflow_type"), _joined("workflow.high_level_steps").alias("steps"), F.size("workflow.detailed_step_log").cast("long").alias("n_steps"))


@query
def decision_rows(spark, sf):
    e = _extracted(spark, sf)
    return _each(e, "workflow.decision_points").select("o_orderkey", "r.decision", "r.options", "r.choice", "r.rationale")


@query
def knowledge_sources(spark, sf):
    e = _extracted(spark, sf)
    return _each(e, "knowledge_accessed.sources").select("o_orderkey", "r.type", "r.detail")


@query
def code_blocks(spark, sf):
    e = _extracted(spark, sf)
    return _each(e, "code_written.blocks").select("o_orderkey", "r.language", "r.code", "r.heading", "r.reuse_flag")


@query
def artifact_rows(spark, sf):
    e = _extracted(spark, sf)
    return _each(e, "outputs_produced.artifacts").select("o_orderkey", "r.name", "r.type", "r.template_potential", "r.notes")


@query
def issue_rows(spark, sf):
    e = _extracted(spark, sf)
    return _each(e, "issues_and_fixes.items").select("o_orderkey", "r.issue", "r.cause", "r.fix", "r.prevention")


@query
def verification_rows(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", _joined(F.transform("verification.checks", lambda c: F.concat(c["test"], F.lit("="), c["result"]))).alias("checks"), _joined(F.transform("verification.success_criteria_met", lambda c: F.concat(c["criterion"], F.lit("="), c["met"].cast("string")))).alias("criteria"))


@query
def assessment_scores(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", *[F.col(f"skill_assessment.{c}").cast("long").alias(c) for c in ("reusability_score", "frequency_score", "consistency_score", "complexity_score", "codifiability_score", "toolability_score")], F.col("skill_assessment.extraction_priority").alias("extraction_priority"))


@query
def tag_families(spark, sf):
    e = _extracted(spark, sf)
    return e.select("o_orderkey", *[_joined(f"tags.{c}").alias(c) for c in ("languages", "frameworks", "tools", "domains", "patterns", "services")])


@query
def parse_warnings(spark, sf):
    return _extracted(spark, sf).select("o_orderkey", _joined("parse_warnings").alias("warnings"))


@query
def note_cards(spark, sf):
    c = C.cards(_extracted(spark, sf))
    return c.select("doc_id", F.col("scores.reusability_total").cast("long").alias("total"), _joined("trigger.keywords").alias("keywords"), _joined("workflow_steps").alias("steps"), _joined("artifacts").alias("artifacts"), _joined("issues").alias("issues"), "bucket_key")


@query
def extraction_summary(spark, sf):
    e = _extracted(spark, sf)
    return X.summary(e, spark.createDataFrame([], "path string, error string"))


@query
def bucket_rows(spark, sf):
    b = C.buckets(ad.document_cards(spark, sf))
    return b.select("bucket_key", F.md5(_joined("doc_ids")).alias("ids_md5"), "primary_domain", "primary_pattern", "doc_count")


@query
def bucket_stats(spark, sf):
    return C.bucket_stats(C.bucket_sizes(ad.document_cards(spark, sf)))


@query
def bucket_topn(spark, sf):
    return C.top_buckets(C.bucket_sizes(ad.document_cards(spark, sf)))


@query
def bucket_file_names(spark, sf):
    c = ad.table(spark, sf, "customer").select(F.concat(F.substring("c_mktsegment", 1, 1), F.when(F.col("c_nationkey") % 2 == 0, "/").otherwise("-"), (F.col("c_nationkey") % 3).cast("string")).alias("key"))
    return tables.key_collisions(c, "key").select("name", "n", _joined("keys").alias("keys"))


@query
def needs_enrichment(spark, sf):
    return T.candidates(ad.document_cards(spark, sf)).select("doc_id", "bucket_key")


@query
def enrichment_limit(spark, sf):
    return T.candidates(ad.document_cards(spark, sf), 25).select("doc_id")


@query
def response_parse(spark, sf):
    a = ad.event_answers(spark, sf).withColumn("p", P.parse(P.inside_fence(F.col("answer")), P.ENRICHMENT))
    return a.select("event_id", F.col("p").isNotNull().alias("parsed"), F.coalesce(_joined("p.domains"), F.lit("")).alias("domains"), F.col("p.confidence").alias("confidence"), F.col("p.reasoning").alias("reasoning"))


@query
def vocab_filter(spark, sf):
    a = ad.event_answers(spark, sf).withColumn("p", P.parse(P.inside_fence(F.col("answer")), P.ENRICHMENT))
    old = F.array(F.col("event_type"))
    return a.select("event_id", _joined(T.in_vocabulary(F.col("p.domains"), T.DOMAINS, old)).alias("domains"), _joined(T.in_vocabulary(F.col("p.patterns"), T.PATTERNS, old)).alias("patterns"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    cards = ad.document_cards(spark, sf).withColumn("number", F.substring("doc_id", 4, 8).cast("long"))
    answers = ad.event_answers(spark, sf).select(F.col("event_id").alias("number"), "answer")
    return T.enrich(cards.join(answers, "number", "left"), F.coalesce("answer", F.lit("")))


@query
def enrich_merge(spark, sf):
    e = _enriched(spark, sf)
    return e.select("doc_id", "bucket_key", _joined("tags.domains").alias("domains"), _joined("tags.patterns").alias("patterns"), F.col("_enrichment.enriched").alias("enriched"), F.col("_enrichment.original_bucket_key").alias("original_bucket"))


@query
def enrich_rules(spark, sf):
    e = T.enrich(ad.document_cards(spark, sf), T.rule_decider())
    return e.select("doc_id", "bucket_key", F.col("_enrichment.confidence").alias("confidence"))


@query
def enrich_replaced(spark, sf):
    cards = ad.document_cards(spark, sf)
    done = _enriched(spark, sf).filter("_enrichment.enriched").select("doc_id", "bucket_key")
    return T.merge_back(cards.select("doc_id", "bucket_key", F.size("artifacts").cast("long").alias("n_artifacts")), done)


@query
def bucket_changes(spark, sf):
    return T.bucket_changes(_enriched(spark, sf))


@query
def enrichment_prompt(spark, sf):
    said = T.prompt((("x", "y"), ("z",)))
    return T.candidates(ad.document_cards(spark, sf)).select("doc_id", F.md5(F.regexp_extract(said, r"(?s)^(.*)\nCard: ", 1)).alias("lists_md5"), F.get_json_object(F.regexp_extract(said, r"(?s)\nCard: (.*)$", 1), "$.doc_id").alias("card_id"))


@query
def enrichment_summary(spark, sf):
    return T.summary(_enriched(spark, sf))


@query
def bucket_first(spark, sf):
    cards = ad.document_cards(spark, sf)
    return I.members_in_order(C.bucket_members(cards), cards, 2, first=3).select("bucket_key", "bucket_size", "position", "doc_id")


@query
def bucket_regrouped(spark, sf):
    return C.bucket_sizes(_enriched(spark, sf))


@query
def bucket_join_cards(spark, sf):
    cards = ad.document_cards(spark, sf)
    m = I.members_in_order(C.bucket_members(cards), cards.filter(F.col("has_code")), 3)
    return m.select("bucket_key", "bucket_size", "position", "doc_id")


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as buckets: a role's first turn opens its cluster, later ones join it."""
    c = ad.table(spark, sf, "conversations")
    first = c.groupBy("conv_id", "role").agg(F.min("turn").alias("opened"))
    c = c.join(first, ["conv_id", "role"]).join(c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("bucket_size")), "conv_id")
    none = F.array().cast("array<string>")
    phrase = F.concat(F.lit("len"), (F.length("text") % 3).cast("string"))
    answer = F.to_json(F.struct(F.when(F.col("turn") == F.col("opened"), "new_cluster").otherwise("assign").alias("decision"), F.col("role").alias("cluster_name"), F.lit(0.5).alias("confidence"), F.struct(F.array(phrase, phrase).alias("trigger_phrases"), none.alias("typical_outputs")).alias("updated_signature")))
    return c.select(
        F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("bucket_key"), "bucket_size", F.col("turn").alias("position"), F.concat(F.lit("t"), F.col("turn").cast("string")).alias("doc_id"),
        F.struct(*[none.alias(f) for f in ("languages", "frameworks", "tools")], F.array("role").alias("domains"), none.alias("patterns")).alias("tags"), F.struct(none.alias("keywords")).alias("trigger"), none.alias("artifacts"), answer.alias("answer"),
    )


@query
def incremental_fold(spark, sf):
    c = I.clusters(I.fold(_turns(spark, sf), answer="answer"))
    return c.select("bucket_key", "cluster_ord", "cluster_name", "member_count", _joined("member_doc_ids").alias("members"), F.size("trigger_phrases").cast("long").alias("n_phrases"), "singleton")


@query
def assignment_log(spark, sf):
    return I.assignments(I.fold(_turns(spark, sf), answer="answer"))


def _odd_turns(spark: SparkSession, sf: str) -> DataFrame:
    """The same with confidences as text, null signatures and names that nothing has."""
    odd = F.when(F.col("position") % 3 == 0, F.lit("high")).when(F.col("position") % 3 == 1, F.lit("0.25"))
    told = F.from_json("answer", "decision string, cluster_name string")
    t = _turns(spark, sf)
    return t.withColumn("answer", F.to_json(F.struct(told["decision"].alias("decision"), told["cluster_name"].alias("cluster_name"), odd.alias("confidence"), F.lit(None).cast("string").alias("updated_signature")), {"ignoreNullFields": "false"}))


@query
def fold_odd_answers(spark, sf):
    return I.clusters(I.fold(_odd_turns(spark, sf), answer="answer")).select("bucket_key", "cluster_name", "member_count", F.size("member_doc_ids").cast("long").alias("n_members"))


@query
def log_odd_answers(spark, sf):
    return I.assignments(I.fold(_odd_turns(spark, sf), answer="answer"))


@query
def fold_summary(spark, sf):
    events = I.fold(_turns(spark, sf), answer="answer")
    return I.summary(events)


@query
def assignment_prompt(spark, sf):
    cards = ad.document_cards(spark, sf)
    shown = _clusters(spark, sf).groupBy("bucket_key").agg(F.collect_list(I.signature()).alias("signatures"))
    p = cards.join(shown, "bucket_key").select("doc_id", I.assignment_prompt(I.card_summary(), F.when(F.col("has_code"), F.col("signatures")).otherwise(F.array().cast("array<string>"))).alias("prompt"))
    return p.select("doc_id", F.md5("prompt").alias("prompt_md5"))


@query
def fold_by_rules(spark, sf):
    c = I.clusters(I.fold(_turns(spark, sf)))
    return c.select("bucket_key", "cluster_name", "member_count")


@query
def fold_totals(spark, sf):
    totals = I.run_totals(I.clusters(I.fold(_turns(spark, sf), answer="answer")))
    return totals.orderBy(F.desc("n_clusters"), F.desc("n_docs"), "bucket_key").limit(10)


def _clusters(spark: SparkSession, sf: str) -> DataFrame:
    return ad.bucket_clusters(ad.document_cards(spark, sf))


@query
def cluster_signature(spark, sf):
    return _clusters(spark, sf).select("cluster_name", F.md5(I.signature()).alias("signature_md5"))


@query
def card_summary(spark, sf):
    return ad.document_cards(spark, sf).select("doc_id", F.md5(I.card_summary()).alias("summary_md5"))


@query
def domain_rollup(spark, sf):
    return M.signatures(_clusters(spark, sf)).select("cluster_name", "domain_rollup", "member_count")


@query
def rollup_groups(spark, sf):
    g = M.rollup_groups(M.signatures(_clusters(spark, sf)))
    return g.select("rollup", F.col("member_count").alias("n_clusters"), "total_docs", _joined("domains").alias("domains"), _joined("patterns").alias("patterns"), _joined("trigger_phrases").alias("triggers"), _joined("typical_outputs").alias("outputs"))


@query
def lost_by_name(spark, sf):
    c = _clusters(spark, sf).withColumn("cluster_name", F.element_at(F.split("bucket_key", "__"), -1))
    return M.lost_by_name(c)


@query
def signatures_by_name(spark, sf):
    c = _clusters(spark, sf).withColumn("cluster_name", F.element_at(F.split("bucket_key", "__"), -1))
    return M.signatures(c, by_name=True).select("cluster_name", "bucket_key")


def _final(spark: SparkSession, sf: str) -> DataFrame:
    # in a run these are stage tables; here several plans read them
    sigs = M.signatures(_clusters(spark, sf)).persist()
    groups = M.rollup_groups(sigs)
    return M.final_clusters(M.skills(groups, M.rule_answers(groups)), sigs).persist()


@query
def skill_clusters(spark, sf):
    f = _final(spark, sf)
    return f.select("cluster_name", "domain_rollup", "member_count", F.md5(_joined("member_doc_ids")).alias("members_md5"), _joined("trigger_phrases").alias("triggers"), F.size("source_buckets").cast("long").alias("n_buckets"))


@query
def rollup_prompt(spark, sf):
    return M.rollup_prompt(M.rollup_groups(M.signatures(_clusters(spark, sf)))).select("rollup", F.regexp_extract("prompt", "(?m)^Domains: .*$", 0).alias("domains"), F.regexp_extract("prompt", "(?m)^Rollup: .*$", 0).alias("head"), F.size(F.split("prompt", "\n")).cast("long").alias("n_lines"))


@query
def skills_across_rollups(spark, sf):
    """Each rollup's one skill, named alike in all, names all clusters of all rollups and one that nothing has."""
    sigs = M.signatures(_clusters(spark, sf))
    groups = M.rollup_groups(sigs)
    every = sigs.agg(F.concat(F.sort_array(F.collect_list("cluster_name")), F.array(F.lit("nothing"))).alias("names"))
    answers = groups.select("rollup").join(F.broadcast(every)).select("rollup", F.to_json(F.struct(F.lit("split").alias("recommendation"), F.array(F.struct(F.lit("same").alias("skill_name"), F.col("names").alias("cluster_names"))).alias("skills"))).alias("answer"))
    f = M.final_clusters(M.skills(groups, answers), sigs)
    return f.select("cluster_id", "cluster_name", "member_count", F.md5(_joined("member_doc_ids")).alias("members_md5"))


@query
def merge_fallback(spark, sf):
    groups = M.rollup_groups(M.signatures(_clusters(spark, sf)))
    broken = groups.select("rollup", F.when(F.col("rollup") == "misc", "no json").otherwise(F.concat(F.lit('{"recommendation": "split", "skills": [{"skill_name": "a", "cluster_names": []}, {"skill_name": "b", "cluster_names": ["x"]}]}'))).alias("answer"))
    s = M.skills(groups, broken)
    return s.select("rollup", "skill_name", "decided", F.when(F.size("cluster_names") == 1, F.get("cluster_names", F.lit(0))).otherwise("all").alias("names"))


@query
def doc_to_cluster(spark, sf):
    return M.doc_to_cluster(_final(spark, sf))


@query
def merge_reduction(spark, sf):
    s = M.merge_summary(_clusters(spark, sf), _final(spark, sf))
    return s.select("input_clusters", "output_clusters", F.round("reduction_percent", 6).alias("reduction_percent"))


@query
def audit_candidates(spark, sf):
    return A.candidates(_clusters(spark, sf)).select("cluster_name", "member_count", A.sample_size(F.col("member_count")).cast("long").alias("sample_size"))


@query
def stratified_sample(spark, sf):
    cards = ad.document_cards(spark, sf)
    placed = A.candidates(_clusters(spark, sf)).select("cluster_name", "member_count", F.posexplode("member_doc_ids").alias("position", "doc_id"))
    m = placed.join(cards.select("doc_id", F.col("scores.extraction_priority").alias("priority"), F.size("issues").alias("n_issues"), F.size("artifacts").alias("n_artifacts")), "doc_id")
    return A.sample(m).select("cluster_name", "doc_id", "stratum")


@query
def audit_results(spark, sf):
    c = _clusters(spark, sf)
    fence = "```"
    answer = F.when(F.col("member_count") % 3 == 0, "broken").when(F.col("member_count") % 3 == 1, fence + 'json\n{"is_pure": false, "recommendation": "split", "confidence": 0.75}\n' + fence).otherwise('{"is_pure": true, "recommendation": "keep_as_is", "confidence": 0.5}')
    return A.results(c.withColumn("answer", answer)).select("cluster_name", "is_pure", "recommendation", "confidence")


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    c = A.candidates(_clusters(spark, sf))
    answer = F.when(F.col("member_count") % 2 == 0, '{"is_pure": false, "recommendation": "split", "confidence": 0.75, "split_into": [{"skill_name": "a", "description": "", "doc_ids_from_sample": []}, {"skill_name": "b"}]}').otherwise("broken")
    return A.results(c.withColumn("answer", answer))


@query
def audit_splits(spark, sf):
    return A.splits(_audited(spark, sf)).select("cluster_name", F.size("split_into").cast("long").alias("n_parts"), "confidence")


@query
def audit_kept(spark, sf):
    return A.kept(_audited(spark, sf))


@query
def audit_summary(spark, sf):
    return A.summary(_audited(spark, sf))


@query
def audit_card_text(spark, sf):
    return ad.document_cards(spark, sf).select("doc_id", F.md5(A.card_text()).alias("text_md5"))


@query
def audit_prompt(spark, sf):
    cards = ad.document_cards(spark, sf)
    placed = A.candidates(_clusters(spark, sf)).select("cluster_name", "member_count", F.posexplode("member_doc_ids").alias("position", "doc_id"))
    m = placed.join(cards.select("doc_id", F.col("scores.extraction_priority").alias("priority"), F.size("issues").alias("n_issues"), F.size("artifacts").alias("n_artifacts"), A.card_text().alias("text")), "doc_id")
    p = A.prompts(A.sample(m))
    return p.select("cluster_name", F.size(F.split("prompt", "\n---\n")).cast("long").alias("n_cards"), F.regexp_extract("prompt", "(?m)^Document: (.*)$", 1).alias("first_doc"))


@query
def rep_count(spark, sf):
    return _clusters(spark, sf).select("cluster_name", "member_count", R.rep_count(F.col("member_count")).cast("long").alias("target"))


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return _clusters(spark, sf).select(F.col("bucket_key").alias("cluster_id"), F.posexplode("member_doc_ids").alias("position", "doc_id"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    cards = ad.document_cards(spark, sf)
    # every eleventh document has no card, as if its file were missing
    kept = cards.filter(F.substring("doc_id", 4, 8).cast("long") % 11 != 0)
    return R.scores(_members(spark, sf), kept, ad.card_extractions(cards))


@query
def rep_score(spark, sf):
    s = _scored(spark, sf)
    return s.select("cluster_id", "doc_id", F.col("total_score").cast("long").alias("total_score"), "has_issues", "has_code", "has_artifacts")


@query
def rep_select(spark, sf):
    chosen = R.select(_scored(spark, sf))
    return chosen.select("cluster_id", "doc_id", F.col("sel_rank").cast("long").alias("sel_rank"), "why_selected", F.col("total_score").cast("long").alias("total_score"))


@query
def coverage_status(spark, sf):
    r = R.representatives(R.select(_scored(spark, sf)))
    return r.select("cluster_id", _joined("representative_doc_ids").alias("reps"), "has_issues_doc", "has_code_doc", "has_artifacts_doc", "status", F.col("actual_count").cast("long").alias("actual_count"))


def _reps(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """clusters, representatives, members, known: with gaps to find. A foreign id is added to every third pattern."""
    members = _members(spark, sf)
    reps = R.representatives(R.select(_scored(spark, sf))).filter(F.col("cluster_size") > 2)
    third = F.substring("cluster_id", -1, 1).cast("int") % 3 == 0
    reps = reps.withColumn("representative_doc_ids", F.when(third, F.concat("representative_doc_ids", F.array(F.lit("doc99999999")))).otherwise(F.col("representative_doc_ids")))
    known = members.filter(F.substring("doc_id", 4, 8).cast("long") % 5 != 0)
    return members.select("cluster_id").distinct(), reps, members, known


@query
def known_ids(spark, sf):
    _, _, members, known = _reps(spark, sf)
    return R.all_doc_ids(known, members)


@query
def rep_summary(spark, sf):
    return R.summary(R.representatives(R.select(_scored(spark, sf))))


@query
def sanity_missing_rep(spark, sf):
    clusters, reps, _, _ = _reps(spark, sf)
    return R.missing_reps(clusters, reps)


@query
def sanity_unresolved(spark, sf):
    _, reps, _, known = _reps(spark, sf)
    return R.unresolved_reps(reps, known)


@query
def sanity_orphans(spark, sf):
    _, reps, members, _ = _reps(spark, sf)
    return R.orphan_reps(reps, members)


@query
def sanity_class(spark, sf):
    _, reps, _, _ = _reps(spark, sf)
    return R.coverage_class(reps)


@query
def sanity_verdict(spark, sf):
    clusters, reps, members, known = _reps(spark, sf)
    return R.verdict(R.findings(clusters, reps, members, known))


def _packages(spark: SparkSession, sf: str) -> DataFrame:
    final = _final(spark, sf)
    members = final.select("cluster_id", F.posexplode("member_doc_ids").alias("position", "doc_id"))
    cards = ad.document_cards(spark, sf)
    reps = R.representatives(R.select(R.scores(members, cards, ad.card_extractions(cards)))).filter("cluster_id != 'misc/0'")
    return D.inputs(final, reps, cards.filter("has_code").select("doc_id", F.to_json(F.struct("doc_id")).alias("payload")))


@query
def synthesis_input(spark, sf):
    return _packages(spark, sf).select("cluster_name", "state", F.coalesce(_joined(F.transform("parts", lambda p: p["doc_id"])), F.lit("")).alias("documents"))


@query
def synthesis_prompt(spark, sf):
    p = _packages(spark, sf).filter("state = 'ready'").select("cluster_name", D.prompt().alias("prompt"))
    return p.select("cluster_name", F.regexp_extract("prompt", "(?m)^Domains: .*$", 0).alias("domains"), F.regexp_extract("prompt", r"(?m)^Documents: (.*)$", 1).alias("documents"))


@query
def skill_files(spark, sf):
    p = D.packages(_packages(spark, sf), D.template_answer())
    return p.select("cluster_name", "state", F.explode_outer("files").alias("f")).filter("f is not null").select("cluster_name", "state", "f.path", F.length("f.contents").cast("long").alias("n_chars"))


@query
def synthesis_summary(spark, sf):
    return D.summary(D.packages(_packages(spark, sf), D.template_answer()))


@query
def manifest_changes(spark, sf):
    files = _notes(spark, sf).select("path", F.encode("content", "UTF-8").alias("content"), F.lit(None).cast("timestamp").alias("modified"), "o_orderkey")
    now = manifest(files).withColumn("o_orderkey", F.regexp_extract("path", r"_(\d+)\.md$", 1).cast("long"))
    before = now.filter(F.col("o_orderkey") % 10 != 0).withColumn("hash", F.when(F.col("o_orderkey") % 7 == 0, F.lit("old")).otherwise(F.col("hash")))
    return changed(now, before).select("o_orderkey")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["rep_select"](spark, sf_dir)

