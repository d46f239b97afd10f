"""The cleaning pipeline over ``documents``: five stages of the training-data operators, each written and read again.

All stages but the last return the columns of documents; the last returns them once per copy taken, with the copy's
number. Every stage learns what it learns from its own input and the labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import decontam, mixing, quality, simhash, toxicity
from inkwell.llm.common import hold, table
from inkwell.session import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(mixing.mix(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("source_mix", mix_sources),
]

#: SQL has no trained classifiers: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = hold(stage(spark, docs, sf_dir), name)
    return docs
