"""Representatives under a coverage guarantee, without a loop, and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLAGS = ("issues", "code", "artifacts")


def rep_count(size: Column) -> Column:
    return F.when(size <= 5, F.least(F.lit(3), size)).when(size <= 15, F.lit(5)).otherwise(F.lit(8)).cast("int")


def scores(members: DataFrame, cards: DataFrame, extractions: DataFrame) -> DataFrame:
    """members (cluster_id, position, doc_id) with scores and flags; a document without a card scores 0.

    cards: doc_id, scores, issues, artifacts; extractions: doc_id, code_written.
    """
    c = cards.select("doc_id", F.lit(True).alias("_card"), F.col("scores.extraction_priority").alias("_priority"), F.col("scores.reusability_total").alias("_total"), (F.size("issues") > 0).alias("_issues"), (F.size("artifacts") > 0).alias("_artifacts"))
    e = extractions.select("doc_id", F.exists("code_written.blocks", lambda b: b["reuse_flag"]).alias("_code"))
    m = members.join(c, "doc_id", "left").join(e, "doc_id", "left")
    has = F.col("_card").isNotNull()
    flag = lambda name: has & F.coalesce(F.col(f"_{name}"), F.lit(False))
    priority = F.when(~has, 0).when(F.col("_priority") == "high", 30).when(F.col("_priority") == "medium", 20).when(F.col("_priority") == "low", 10).otherwise(0)
    reuse = F.when(has, F.least(F.lit(25), F.coalesce("_total", F.lit(0)))).otherwise(0)
    m = m.select("cluster_id", "position", "doc_id", priority.alias("priority_score"), reuse.alias("reusability_score"), *[flag(f).alias(f"has_{f}") for f in FLAGS])
    return m.withColumn("total_score", F.col("priority_score") + F.col("reusability_score") + F.when(F.col("has_issues"), 15).otherwise(0) + F.when(F.col("has_code"), 15).otherwise(0) + F.when(F.col("has_artifacts"), 10).otherwise(0))


#: No cluster has more representatives.
MOST = 8


def candidates(scored: DataFrame) -> DataFrame:
    """The rows among which the choice is made: of each cluster the best MOST, and the first with each flag; with cluster_size.

    Both are found within tasks before rows are dealt by cluster, so that no task sorts a large cluster.
    """
    by = Window.partitionBy("cluster_id").orderBy(F.desc("total_score"), "position")
    best = scored.withColumn("_rn", F.row_number().over(by)).filter(F.col("_rn") <= MOST).drop("_rn")
    row = F.struct((-F.col("total_score")).alias("k"), "position", F.struct(*scored.columns).alias("row"))
    sums = scored.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"), *[F.min(F.when(F.col(f"has_{f}"), row)).alias(f"_{f}") for f in FLAGS])
    first = sums.select(F.explode(F.array(*[F.col(f"_{f}.row") for f in FLAGS])).alias("row")).filter("row is not null").select("row.*")
    places = sums.select("cluster_id", "cluster_size", *[F.col(f"_{f}.position").alias(f"_{f}") for f in FLAGS])
    return best.union(first).dropDuplicates(["cluster_id", "position"]).join(places, "cluster_id")


def select(scored: DataFrame) -> DataFrame:
    """The chosen documents: cluster_id, doc_id, sel_rank, why_selected, and their scores.

    Greedy choice has a closed form: the first half of the places go by score; the first document with each flag is a
    candidate too; what is left goes by score. Documents of a cluster must differ.
    """
    by = Window.partitionBy("cluster_id")
    ranked = candidates(scored).withColumn("rn", F.row_number().over(by.orderBy(F.desc("total_score"), "position"))).withColumn("target_count", rep_count(F.col("cluster_size")))
    for f in FLAGS:
        ranked = ranked.withColumn(f"first_{f}", F.coalesce(F.col(f"_{f}") == F.col("position"), F.lit(False)))
    ranked = ranked.drop(*[f"_{f}" for f in FLAGS])
    ahead = (F.col("rn") <= F.floor(F.col("target_count") / 2)) | F.col("first_issues") | F.col("first_code") | F.col("first_artifacts")
    chosen = ranked.withColumn("_ahead", ahead.cast("int")).withColumn("sel_rank", F.row_number().over(by.orderBy(F.desc("_ahead"), "rn"))).filter(F.col("sel_rank") <= F.col("target_count"))
    covers = F.concat_ws(", ", *[F.when(F.col(f"first_{f}"), f"{f} coverage") for f in FLAGS])
    why = F.when(covers != "", covers).otherwise(F.concat(F.lit("high score ("), F.col("total_score").cast("string"), F.lit(")")))
    return chosen.withColumn("why_selected", why).drop("_ahead", "rn")


def representatives(chosen: DataFrame) -> DataFrame:
    """One row per cluster: ids in order, details, coverage."""
    detail = F.struct("sel_rank", "doc_id", "why_selected", "total_score", "priority_score", "reusability_score", *[f"has_{f}" for f in FLAGS])
    r = chosen.groupBy("cluster_id").agg(
        F.array_sort(F.collect_list(detail)).alias("selection_details"), *[F.bool_or(f"first_{f}").alias(f"has_{f}_doc") for f in FLAGS],
        F.max("target_count").alias("target_count"), F.count(F.lit(1)).cast("int").alias("actual_count"), F.max("cluster_size").alias("cluster_size"),
    )
    return r.withColumn("representative_doc_ids", F.transform("selection_details", lambda d: d["doc_id"])).withColumn("status", F.when(F.col("has_issues_doc") & F.col("has_code_doc") & F.col("has_artifacts_doc"), "OK").otherwise("PARTIAL"))


def split_applies(min_part: Column, max_part: Column, listed: Column) -> Column:
    """A split is carried out if its parts are large and alike, or if it is asked for."""
    return listed | ((min_part >= 5) & (max_part / min_part < 5))


def all_doc_ids(extractions: DataFrame, stems: DataFrame) -> DataFrame:
    return extractions.select("doc_id").union(stems.select("doc_id")).distinct()


def summary(reps: DataFrame) -> DataFrame:
    """One row: clusters, representatives, and clusters by status."""
    return reps.agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("actual_count"), F.lit(0)).cast("long").alias("representatives"), F.count_if(F.col("status") == "OK").alias("ok"), F.count_if(F.col("status") != "OK").alias("partial"))


def missing_reps(clusters: DataFrame, reps: DataFrame) -> DataFrame:
    return clusters.select("cluster_id").join(reps.select("cluster_id"), "cluster_id", "left_anti")


def _each_rep(reps: DataFrame) -> DataFrame:
    return reps.select("cluster_id", F.explode("representative_doc_ids").alias("doc_id"))


def unresolved_reps(reps: DataFrame, known: DataFrame) -> DataFrame:
    """cluster_id, n: representatives without an extraction."""
    return _each_rep(reps).join(known.select("doc_id"), "doc_id", "left_anti").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def orphan_reps(reps: DataFrame, members: DataFrame) -> DataFrame:
    """cluster_id, n: representatives that aren't members (members: cluster_id, doc_id)."""
    return _each_rep(reps).join(members.select("cluster_id", "doc_id"), ["cluster_id", "doc_id"], "left_anti").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def coverage_class(reps: DataFrame) -> DataFrame:
    i, c, a = (F.col(f"has_{f}_doc") for f in FLAGS)
    return reps.select("cluster_id", F.when(~(i | c | a), "THIN").when(~(i & c), "PARTIAL").otherwise("OK").alias("coverage"))


def findings(clusters: DataFrame, reps: DataFrame, members: DataFrame, known: DataFrame) -> DataFrame:
    """severity, cluster_id, message of all checks."""
    say = lambda df, severity, text: df.select(F.lit(severity).alias("severity"), "cluster_id", text.alias("message"))
    out = say(missing_reps(clusters, reps), "issue", F.concat(F.lit("MISSING REP FILE: "), "cluster_id"))
    out = out.union(say(unresolved_reps(reps, known), "issue", F.concat("cluster_id", F.lit(": "), F.col("n").cast("string"), F.lit(" reps missing extractions"))))
    out = out.union(say(orphan_reps(reps, members), "issue", F.concat("cluster_id", F.lit(": "), F.col("n").cast("string"), F.lit(" reps not in member_doc_ids"))))
    return out.union(say(coverage_class(reps).filter("coverage = 'THIN'"), "warning", F.concat("cluster_id", F.lit(": THIN SKILL - no issues/code/artifacts"))))


def verdict(found: DataFrame) -> DataFrame:
    """One row: issues, warnings, exit_code (1 if there is an issue)."""
    return found.agg(F.count_if(F.col("severity") == "issue").alias("issues"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("exit_code", (F.col("issues") > 0).cast("int"))
