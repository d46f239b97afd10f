"""The pipeline's stages on a small corpus with planted cases."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

import corpus_pipeline
from inkwell.llm import common
from inkwell.llm.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = Path(tmp_path_factory.mktemp("sf"))
    item = " ".join("".join(rng.choice(["an", "er", "tho", "st", "ing", "ou"]) for _ in range(3)) for _ in range(30))
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(["an", "er", "tho", "st", "ing", "ou"]) for _ in range(rng.randint(1, 3))) for _ in range(120)]
        toxic, junk = i % 10 == 3, i % 10 == 7
        for _ in range(4 * toxic):
            words.insert(rng.randrange(100), rng.choice(["idiot", "moron"]))
        rows.append([i, " ".join(w + "%%%" * junk for w in words), "en", f"src{i % 4}", 1])
        labels.append((i, int(not junk), int(toxic)))
    rows += [[1000, rows[0][1], "en", "src0", 1], [1001, rows[5][1] + " tail", "en", "src1", 1], [1002, rows[1][1] + " " + item, "en", "src2", 1], [1003, None, None, None, None]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, corpus).cache()
        assert docs.columns == columns
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(i % 10 != 3 for i in kept["toxicity"] if i < 600) and len(kept["toxicity"]) > 530
    assert all(i % 10 != 7 for i in kept["quality"] if i < 600) and {i for i in range(600) if i % 10 not in (3, 7)} <= kept["quality"]
    assert 1000 not in kept["simhash_dedup"] and 0 in kept["simhash_dedup"]
    assert kept["simhash_dedup"] - kept["decontamination"] == {1002} & kept["simhash_dedup"] and 1002 in kept["quality"]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, corpus)
    assert mixed.columns == [*columns, "copy_no"] and {r.doc_id for r in mixed.collect()} <= kept["decontamination"]


def test_repeated_ids(spark, corpus, tmp_path):
    """Texts that differ under one id, and rows without an id, pass all stages; reruns agree."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    more = docs.union(docs.selectExpr("doc_id + 1", "text", "lang", "source", "n_chars").limit(200)).union(docs.selectExpr("cast(null as long)", "concat(text, ' other')", "lang", "source", "n_chars").limit(20))
    more.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    first = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert first and sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == first


def test_held_tables_are_deleted(spark):
    df = common.hold(spark.range(3), "test")
    path = Path(common._held[id(df)].removeprefix("file://"))
    assert path.exists()
    common.release(df, df)
    assert not path.exists()


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def __init__(self, **held):
            self.held = held

        def get(self, key, default=None):
            return self.held.get(key.replace(".", "_"), default)

    class Session:
        def __init__(self, **held):
            self.conf = Conf(**held)

    with pytest.raises(ValueError, match="checkpoint.dir"):
        common.shared_dir(Session(spark_master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        common.shared_dir(Session(spark_master="local-cluster[3,2,1000]"))
    assert common.shared_dir(Session(spark_master="spark://host:7077", spark_checkpoint_dir="file:///x/")) == "file:///x"
    assert common.shared_dir(Session(spark_master="local[4]")).startswith("file://")


def test_names():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


def test_stages_carry_columns_of_any_name(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").selectExpr("*", "doc_id as `a.b`", "1 as target", "2 as score", "3 as size", "'r' as row", "4 as copy_no", "5L as component_id", "6 as rank")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.hold(stage(spark, docs, corpus), name)
        assert docs.columns == columns + ["mix_copy_no"] * (name == "source_mix")
    rows = docs.collect()
    assert rows and all(r["a.b"] == r.doc_id and r.copy_no == 4 and r.row == "r" for r in rows)


def test_stages_on_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*spark.read.parquet(f"{corpus}/documents.parquet").columns, "copy_no"] and out.count() == 0
