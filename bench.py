"""Headline queries, timed: one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the cores."""

from __future__ import annotations

import json
import os
import time

from inkwell.plans.queries import QUERIES
from inkwell.session import session

HEADLINE = ("bucket_stats", "section_split", "tag_families", "workflow_steps", "code_blocks", "note_cards", "enrich_merge", "incremental_fold", "rollup_groups", "skill_clusters", "rep_select", "coverage_status", "sanity_verdict", "stratified_sample")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus, partitions=8 if cpus == "*" else max(8, int(cpus)))
    queries = dict(QUERIES)
    names = list(HEADLINE)
    try:
        from inkwell.llm.registry import QUERIES as more

        queries |= more
        names += list(more)
    except ImportError:
        pass
    queries[names[0]](spark, sf_dir).collect()  # starts the executors and compiles
    took = {}
    for name in names:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rstrip("/").rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
