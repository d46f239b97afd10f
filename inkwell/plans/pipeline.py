"""The whole run: documents to packages, every stage a Parquet table that a later run can resume from.

Stages are DataFrame -> DataFrame and lazy inside; they are materialised at their ends only. A stage's table is used
again if a marker written after it names the same inputs.
"""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import cards as C
from ..operators import clusters as I
from ..operators import enrich as T
from ..operators import extract as X
from ..operators import merge as M
from ..operators import representatives as R
from ..operators import synthesis as D
from ..session import ship
from ..sources import markdown
from .config import Config

Vocabulary = tuple[tuple[str, ...], tuple[str, ...]]


def fingerprint(files: DataFrame) -> str:
    """Of all paths and contents, whatever their order: sums of hashes, not a list."""
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path", "content").cast("decimal(38,0)")).alias("s")).first()
    return hashlib.md5(f"{r.n}:{r.s}".encode()).hexdigest()


class Run:
    """Stage tables under ``root``; ``resume`` uses those whose marker fits."""

    def __init__(self, spark: SparkSession, root: str, inputs: str, resume: bool = True):
        self.spark, self.root, self.inputs, self.resume, self.status = spark, root.rstrip("/"), inputs, resume, {}

    def using(self, config: Config, *names: str) -> None:
        """From here on stages depend on these fields too; those before are resumed when the fields change."""
        self.inputs += json.dumps({n: getattr(config, n) for n in names}, sort_keys=True)

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path, mark = f"{self.root}/{name}", f"{self.root}/_{name}.done"
        if self.resume:
            try:
                if self.spark.read.json(mark).first().inputs == self.inputs:
                    self.status[name] = "resumed"
                    return self.spark.read.parquet(path)
            except AnalysisException:
                pass
        made = make()
        made.write.mode("overwrite").parquet(path)
        self.spark.createDataFrame([(self.inputs,)], "inputs string").coalesce(1).write.mode("overwrite").json(mark)
        self.status[name] = "done"
        return self.spark.read.schema(made.schema).parquet(path)


@dataclass
class Deciders:
    """What answers the prompts of a run; by default rules that need no service and agree between runs."""

    #: Column of answers for cards, from the vocabulary and a Column with the prompt.
    enrich: Callable[[Vocabulary, Column], Column] = lambda vocabulary, prompt: T.rule_decider(vocabulary)
    #: Answer for a card and the clusters so far.
    assign: I.Decider = I.rule_decider
    #: (rollup, answer) for rollup groups; their prompts are given as (rollup, prompt).
    merge: Callable[[DataFrame, DataFrame], DataFrame] = lambda groups, prompts: M.rule_answers(groups)
    #: (cluster_name, answer) for (cluster_name, prompt).
    audit: Callable[[DataFrame], DataFrame] = A.rule_answers
    #: Column of answers for clusters, from a Column with the prompt.
    synthesize: Callable[[Column], Column] = lambda prompt: D.template_answer()


def run_pipeline(spark: SparkSession, source: str, root: str, config: Config | None = None, resume: bool = True, deciders: Deciders | None = None) -> dict[str, DataFrame]:
    """All stages over a folder of notes; the tables by name. A stage that fails stops the run.

    With ``config.dry_run`` nothing is asked for beyond the prompts: the run stops after the rollups.
    """
    config, ask = config or Config(), deciders or Deciders()
    files = markdown.scan_directory(spark, source)
    run = Run(spark, root, fingerprint(files), resume)
    docs, rejects = markdown.decode(files)
    out: dict[str, DataFrame] = {"rejects": run.stage("rejects", lambda: rejects)}
    ex = out["extractions"] = run.stage("extractions", lambda: X.extract(docs.select("path", "content")).drop("path", "content"))
    out["extraction_summary"] = run.stage("extraction_summary", lambda: X.summary(ex, out["rejects"]))
    card = out["cards"] = run.stage("cards", lambda: C.cards(ex))
    run.using(config, "domains", "patterns", "max_cards")
    prompt = T.prompt(config.vocabulary)
    out["enrichment_prompts"] = run.stage("enrichment_prompts", lambda: T.candidates(card, config.max_cards).select("doc_id", prompt.alias("prompt")))

    def enriched() -> DataFrame:
        answer = ask.enrich(config.vocabulary, prompt)
        if config.max_cards is None:
            return T.enrich(card, answer, config.vocabulary)
        chosen = out["enrichment_prompts"].select("doc_id", F.lit(True).alias("_chosen"))
        return T.enrich(card.join(chosen, "doc_id", "left"), answer, config.vocabulary, only=F.col("_chosen").isNotNull()).drop("_chosen")

    rich = out["enriched"] = run.stage("enriched", enriched)
    out["enrichment_summary"] = run.stage("enrichment_summary", lambda: T.summary(rich))
    out["buckets"] = run.stage("buckets", lambda: C.bucket_sizes(rich))
    run.using(config, "min_bucket_size", "first_buckets")
    events = out["events"] = run.stage("events", lambda: I.fold(I.members_in_order(C.bucket_members(rich), rich, config.min_bucket_size, config.first_buckets), ask.assign))
    out["fold_summary"] = run.stage("fold_summary", lambda: I.summary(events))
    groups_of = out["clusters"] = run.stage("clusters", lambda: I.clusters(events))
    run.using(config, "key_by_name", "rollups")
    sigs = out["signatures"] = run.stage("signatures", lambda: M.signatures(groups_of, config.key_by_name, config.rollups))
    groups = out["rollups"] = run.stage("rollups", lambda: M.rollup_groups(sigs))
    prompts = out["rollup_prompts"] = run.stage("rollup_prompts", lambda: M.rollup_prompt(groups))
    if not config.dry_run:
        _from_rollups(run, out, ex, rich, groups, prompts, sigs, config, ask)
    out["status"] = spark.createDataFrame(list(run.status.items()), "stage string, status string")
    return out


def _from_rollups(run: Run, out: dict[str, DataFrame], ex: DataFrame, rich: DataFrame, groups: DataFrame, prompts: DataFrame, sigs: DataFrame, config: Config, ask: Deciders) -> None:
    wanted = run.stage("skills", lambda: M.skills(groups, ask.merge(groups, prompts)))
    final = out["final"] = run.stage("final", lambda: M.final_clusters(wanted, sigs))
    out["merge_summary"] = run.stage("merge_summary", lambda: M.merge_summary(sigs, final))
    members = final.select("cluster_id", "cluster_name", "member_count", F.posexplode("member_doc_ids").alias("position", "doc_id"))
    run.using(config, "audit_min_size", "audit_of")
    # the audit: candidates, sampled cards, prompts, answers, and what they come to
    large = A.candidates(final, config.audit_of, config.audit_min_size).select("cluster_id")
    told = rich.select("doc_id", F.col("scores.extraction_priority").alias("priority"), F.size("issues").alias("n_issues"), F.size("artifacts").alias("n_artifacts"), A.card_text().alias("text"))
    sampled = members.join(large, "cluster_id", "left_semi").withColumn("cluster_name", F.col("cluster_id")).join(told, "doc_id")
    asked = out["audit_prompts"] = run.stage("audit_prompts", lambda: A.prompts(A.sample(sampled)))
    sizes = final.select(F.col("cluster_id").alias("cluster_name"), "member_count")
    audited = out["audit"] = run.stage("audit", lambda: A.results(sizes.join(ask.audit(asked), "cluster_name")))
    out["audit_splits"], out["audit_kept"] = A.splits(audited), A.kept(audited)
    out["audit_summary"] = run.stage("audit_summary", lambda: A.summary(audited))
    reps = out["representatives"] = run.stage("representatives", lambda: R.representatives(R.select(R.scores(members.select("cluster_id", "position", "doc_id"), rich, ex))))
    out["representatives_summary"] = run.stage("representatives_summary", lambda: R.summary(reps))
    out["findings"] = run.stage("findings", lambda: R.findings(final.select("cluster_id"), reps, members.select("cluster_id", "doc_id"), ex.select("doc_id")))
    if config.skip_synthesis:
        return
    run.using(config, "max_packages", "packages_of")
    ready = out["synthesis_input"] = run.stage("synthesis_input", lambda: D.inputs(D.wanted(final, config.packages_of, config.max_packages), reps, ex.select("doc_id", D.payload().alias("payload"))).withColumn("prompt", D.prompt()))
    out["packages"] = run.stage("packages", lambda: D.packages(ready, ask.synthesize(F.col("prompt"))))
    out["synthesis_summary"] = run.stage("synthesis_summary", lambda: D.summary(out["packages"]))


def main(arguments: list[str] | None = None) -> int:
    """``python -m inkwell.plans.pipeline SOURCE ROOT``: a run over a folder of notes; 1 if the checks find an issue."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("source", help="folder of notes")
    parser.add_argument("root", help="folder of the stage tables")
    parser.add_argument("--config", help="JSON file with fields of Config")
    parser.add_argument("--no-resume", action="store_true", help="make all stages anew")
    parser.add_argument("--dry-run", action="store_true", help="stop after the rollups and their prompts")
    parser.add_argument("--skip-synthesis", action="store_true")
    parser.add_argument("--max-cards", type=int, help="enrich the first so many cards")
    parser.add_argument("--first-buckets", type=int, help="cluster the first so many buckets")
    parser.add_argument("--cluster", action="append", default=[], help="make the package of this cluster only; may be repeated")
    a = parser.parse_args(arguments)
    config = Config.load(a.config) if a.config else Config()
    changes = {"dry_run": a.dry_run or None, "skip_synthesis": a.skip_synthesis or None, "max_cards": a.max_cards, "first_buckets": a.first_buckets, "packages_of": tuple(a.cluster) or None}
    config = replace(config, **{k: v for k, v in changes.items() if v is not None})
    spark = SparkSession.builder.getOrCreate()
    ship(spark)
    out = run_pipeline(spark, a.source, a.root, config, not a.no_resume)
    out["status"].show(100, False)
    return int("findings" in out and not out["findings"].filter("severity = 'issue'").isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
