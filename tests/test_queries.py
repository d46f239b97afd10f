"""Registered queries against SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import pytest

from inkwell.plans.oracle import ORACLE_SQL
from inkwell.plans.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    if not SF.exists():
        pytest.skip("no test tables")
    c = duckdb.connect()
    for p in SF.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


@pytest.mark.parametrize("name", ["bucket_rows", "rep_select", "stratified_sample", "decision_rows", "tag_families", "incremental_fold", "rollup_groups", "sanity_verdict", "enrich_merge", "skills_across_rollups", "fold_odd_answers", "log_odd_answers", "skill_clusters", "audit_prompt", "skill_files", "synthesis_prompt", "assignment_prompt"])
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, str(SF))
    rel = con.sql(ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    theirs = list(rel.columns)
    want = sorted(tuple(canon(r[theirs.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(tuple(canon(r[c]) for c in cols) for r in df.collect()) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
