"""Incremental clustering: documents of a bucket are taken in order, each joins a cluster or opens one.

The fold is sequential within a bucket by its nature. It runs as a stream over rows sorted by bucket and position, so a
task holds the clusters of one bucket and not its documents; assignments leave it as they are made.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import nonempty

CANDIDATES, THRESHOLD = 10, 0.25
FAMILIES = ("domains", "patterns", "frameworks", "languages", "tools")
EVENTS = (
    "bucket_key string, event string, ord long, cluster_ord long, doc_id string, decision string, cluster_name string, confidence double, "
    "cluster_description string, member_count long, singleton boolean, tags string, trigger_phrases array<string>, typical_outputs array<string>"
)
#: Takes a card (dict) and the clusters so far; returns the answer's text.
Decider = Callable[[dict, list[dict]], str]


def members_in_order(members: DataFrame, cards: DataFrame, min_size: int = 1, first: int | None = None) -> DataFrame:
    """Cards of buckets that are large enough, with their position and the bucket's size; unknown ids drop out.

    members: bucket_key, doc_id, a row each; no bucket is ever one value. ``first``: the first so many buckets in order of key.
    """
    sizes = members.groupBy("bucket_key").agg(F.count(F.lit(1)).alias("bucket_size")).filter(F.col("bucket_size") >= min_size)
    if first is not None:
        sizes = sizes.orderBy("bucket_key").limit(first)
    place = F.row_number().over(Window.partitionBy("bucket_key").orderBy("doc_id")).cast("long") - 1
    placed = members.select("bucket_key", "doc_id", place.alias("position")).join(sizes, "bucket_key")
    return placed.join(cards.drop("bucket_key"), "doc_id")


def rule_decider(card: dict, clusters: list[dict]) -> str:
    """Joins the first of the closest among the first ten clusters, by Jaccard over all tags, or opens a new one."""
    own = {t for f in FAMILIES for t in card["tags"].get(f) or []}
    best, score = None, 0.0
    for c in clusters[:CANDIDATES]:
        theirs = {t for f in FAMILIES for t in c["tags"].get(f) or []}
        s = len(own & theirs) / len(own | theirs) if own | theirs else 0.0
        if s > score:
            best, score = c["cluster_name"], s
    if best is not None and score >= THRESHOLD:
        return json.dumps({"decision": "assign", "cluster_name": best, "confidence": score})
    return json.dumps({"decision": "new_cluster", "cluster_name": f"{card['bucket_key']}-{len(clusters) + 1}", "confidence": 1.0})


def _unfenced(text: str) -> str:
    text = text.strip()
    if not text.startswith("```"):
        return text
    lines = text.split("\n")[1:]
    end = next((i for i, x in enumerate(lines) if x.startswith("```")), len(lines))
    return "\n".join(lines[:end])


def step(card: dict, clusters: list[dict], answer: str, bucket_size: int) -> tuple[int, str | None, float | None]:
    """Apply one answer to the clusters; (cluster's place, decision and confidence for the log, or None without a log row)."""
    def opened(name: str, description: str, phrases: list, outputs: list, singleton: bool) -> int:
        clusters.append({"cluster_name": name, "cluster_description": description, "member_count": 1, "tags": card["tags"], "trigger_phrases": list(phrases), "typical_outputs": list(outputs), "singleton": singleton})
        return len(clusters) - 1

    try:  # all of the answer is read before any cluster is touched
        d = json.loads(_unfenced(answer))
        new = d.get("decision") == "new_cluster"
        name = d.get("cluster_name", f"cluster-{len(clusters) + 1}" if new else "")
        confidence, description = _number(d.get("confidence", 0)), _text(d.get("cluster_description", ""))
        at = None if new else next((i for i, c in enumerate(clusters) if c["cluster_name"] == name), None)
        more = d.get("updated_signature") or {}
        added = {} if at is None else {f: [x for x in more.get(f) or [] if x and isinstance(x, str)] for f in ("trigger_phrases", "typical_outputs")}
        name = _text(d.get("cluster_name", f"cluster-{len(clusters) + 1}"))
    except Exception:  # noqa: BLE001  any malformed answer
        return opened(f"singleton-{card['doc_id'][:20]}", "Auto-created singleton cluster", [], [], True), None, None
    if new:
        return opened(name, description, card["keywords"], card["artifacts"], bucket_size == 1), "new_cluster", confidence
    if at is None:
        return opened(name, description, card["keywords"], card["artifacts"], False), None, None
    c = clusters[at]
    c["member_count"] += 1
    c["singleton"] = False
    for field, given in added.items():
        known = set(c[field])  # as it stood before: repeats within one answer are all taken
        c[field] += [x for x in given if x not in known]
    return at, "assign", confidence


def _number(value: object) -> float | None:
    """A confidence of any kind is accepted; null in the log if it isn't a number."""
    try:
        out = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    return out if math.isfinite(out) else None


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def fold(members: DataFrame, decider: Decider = rule_decider, answer: str | None = None) -> DataFrame:
    """Events: ``member`` rows (bucket, position, cluster, decision) and, at a bucket's end, a ``cluster`` row each.

    ``answer`` names a column that holds the answer's text instead of asking the decider (replay).
    """
    cols = ["bucket_key", "bucket_size", "position", "doc_id", F.to_json("tags").alias("tags"), F.col("trigger.keywords").alias("keywords"), "artifacts"]
    rows = members.select(*cols, *([F.col(answer).alias("answer")] if answer else [])).repartition("bucket_key").sortWithinPartitions("bucket_key", "position")
    names = [c.split()[0] for c in EVENTS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, clusters = None, []

        def closing() -> list[dict]:
            return [{"bucket_key": bucket, "event": "cluster", "ord": i, "cluster_ord": i} | c | {"tags": json.dumps(c["tags"])} for i, c in enumerate(clusters)]

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.bucket_key != bucket:
                    out += closing()
                    bucket, clusters = r.bucket_key, []
                listed = lambda x: list(x) if x is not None else []
                card = {"doc_id": r.doc_id, "bucket_key": r.bucket_key, "tags": json.loads(r.tags), "keywords": listed(r.keywords), "artifacts": listed(r.artifacts)}
                at, decision, confidence = step(card, clusters, r.answer if answer else decider(card, clusters), r.bucket_size)
                out.append({"bucket_key": bucket, "event": "member", "ord": r.position, "cluster_ord": at, "doc_id": r.doc_id, "decision": decision, "cluster_name": clusters[at]["cluster_name"], "confidence": confidence})
            yield _frame(out, names)
        yield _frame(closing(), names)

    return rows.mapInPandas(run, EVENTS)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=names)
    for c in ("ord", "cluster_ord", "member_count"):
        f[c] = f[c].astype("Int64")
    f["singleton"] = f["singleton"].astype("boolean")
    f["confidence"] = f["confidence"].astype("float64")
    return f.astype(object).where(f.notna(), None)


def assignments(events: DataFrame) -> DataFrame:
    """The log: rows of decisions that were carried out as asked."""
    return events.filter("event = 'member' and decision is not null").select("bucket_key", "doc_id", "decision", "cluster_name", "confidence")


def clusters(events: DataFrame) -> DataFrame:
    """One row per cluster with its members in order."""
    kind = "struct<languages:array<string>,frameworks:array<string>,tools:array<string>,domains:array<string>,patterns:array<string>>"
    rows = events.filter("event = 'cluster'").select("bucket_key", "cluster_ord", "cluster_name", "cluster_description", "member_count", F.from_json("tags", kind).alias("top_tags"), "trigger_phrases", "typical_outputs", "singleton")
    ids = events.filter("event = 'member'").groupBy("bucket_key", "cluster_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "doc_id"))), lambda m: m["doc_id"]).alias("member_doc_ids"))
    return rows.join(ids, ["bucket_key", "cluster_ord"])


def summary(events: DataFrame) -> DataFrame:
    """One row: buckets, documents, clusters, decisions carried out of each kind, and documents put by without one."""
    member, cluster = F.col("event") == "member", F.col("event") == "cluster"
    return events.agg(
        F.count_distinct("bucket_key").alias("buckets"), F.count_if(member).alias("documents"), F.count_if(cluster).alias("clusters"), F.count_if(cluster & F.col("singleton")).alias("singletons"),
        F.count_if(member & (F.col("decision") == "assign")).alias("assigned"), F.count_if(member & (F.col("decision") == "new_cluster")).alias("opened"), F.count_if(member & F.col("decision").isNull()).alias("fallbacks"),
    )


def run_totals(clusters: DataFrame) -> DataFrame:
    """Buckets by number of clusters, most first."""
    return clusters.groupBy("bucket_key").agg(F.count(F.lit(1)).alias("n_clusters"), F.sum("member_count").alias("n_docs"), F.count_if("singleton").alias("n_singletons"))


def signature() -> Column:
    """A cluster as a prompt shows it."""
    cut = lambda name, n: F.array_join(F.slice(nonempty(F.col(name)), 1, n), ", ")
    return F.concat_ws(
        "\n", F.concat(F.lit("Name: "), F.col("cluster_name")), F.concat(F.lit("About: "), F.substring(F.coalesce("cluster_description", F.lit("")), 1, 200)),
        F.concat(F.lit("Domains: "), cut("top_tags.domains", 5)), F.concat(F.lit("Patterns: "), cut("top_tags.patterns", 5)),
        F.concat(F.lit("Triggers: "), cut("trigger_phrases", 5)), F.concat(F.lit("Outputs: "), cut("typical_outputs", 5)), F.concat(F.lit("Documents: "), F.col("member_count").cast("string")),
    )


def card_summary() -> Column:
    """A card as a prompt shows it."""
    cut = lambda name, n: F.array_join(F.slice(nonempty(F.col(name)), 1, n), ", ")
    return F.concat_ws(
        "\n", F.concat(F.lit("Document: "), F.col("doc_id")), F.concat(F.lit("Trigger: "), F.substring(F.coalesce("trigger.what_triggered", F.lit("")), 1, 200)),
        F.concat(F.lit("Keywords: "), cut("trigger.keywords", 5)), F.concat(F.lit("Domains: "), cut("tags.domains", 3)), F.concat(F.lit("Patterns: "), cut("tags.patterns", 3)),
        F.concat(F.lit("Steps: "), cut("workflow_steps", 3)), F.concat(F.lit("Artifacts: "), cut("artifacts", 3)),
    )


def assignment_prompt(card: Column, signatures: Column) -> Column:
    """``signatures``: array of texts in order of creation, of which the first ten are shown."""
    shown = F.array_join(F.slice(signatures, 1, CANDIDATES), "\n\n")
    first = F.concat(F.lit("This is the first document: open a cluster for it.\n\n"), card)
    return F.when(F.size(signatures) == 0, first).otherwise(F.concat(F.lit("Assign the document to a cluster or open a new one. Answer with JSON.\n\nClusters:\n"), shown, F.lit("\n\n"), card))
