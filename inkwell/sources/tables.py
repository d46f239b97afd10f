"""JSON and Parquet tables: explicit schemas, corrupt rows apart, table-level fallback, sinks by key."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_json_table(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt): one JSON record a file, files that begin with ``_`` left out, unreadable records apart."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_]*.json").load(path)
    text = F.col("content").cast("string")
    rows = files.select("path", text.alias("raw"), F.from_json(text, wanted).alias("row"))
    bad = F.try_parse_json("raw").isNull()
    return rows.filter(~bad).select("row.*"), rows.filter(bad).select("path", "raw")


def first_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of the tables that exists: a fallback for whole tables, not rows."""
    for path in paths[:-1]:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            continue
    return spark.read.parquet(paths[-1])


def safe_key(key: Column) -> Column:
    """A key as a file name: slashes become hyphens."""
    return F.translate(key, "/\\", "--")


def key_collisions(df: DataFrame, key: str) -> DataFrame:
    """Keys that would share a file name."""
    return df.select(safe_key(F.col(key)).alias("name"), F.col(key).alias("key")).distinct().groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("key")).alias("keys")).filter("n > 1")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _whole(uri: str) -> str:
    """The path as the driver sees it: a relative one would mean another folder on each executor."""
    return uri if "://" in uri or uri.startswith("/") else os.path.abspath(uri)


def _put(store: fs.FileSystem, at: str, content: bytes) -> None:
    """Write under another name and move: a task that dies or runs twice never leaves half a file."""
    folder, _, name = at.rpartition("/")
    own = f"{folder}/_writing-{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(content)
    store.move(own, at)


def write_json_records(df: DataFrame, path: str, key: str) -> DataFrame:
    """One JSON file per row, named by its key, in a folder that all executors share; returns the names written."""
    path = _whole(path)
    rows = df.select(safe_key(F.col(key)).alias("name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist(), strict=True):
                _put(store, f"{base}/{name}.json", json.dumps(json.loads(body), ensure_ascii=False, indent=2).encode())
            yield pa.RecordBatch.from_arrays([batch.column("name")], names=["name"])

    return rows.mapInArrow(run, "name string")


def safe_path(path: str | None, default: str) -> str | None:
    """The relative path, or None where it is absolute or climbs out of its folder."""
    p = PurePosixPath((path or default).replace("\\", "/"))
    return None if p.is_absolute() or ".." in p.parts or not p.parts or ":" in p.parts[0] else str(p)


def write_packages(packages: DataFrame, path: str) -> DataFrame:
    """Folders of packages (skill_name, files: array of path and contents); returns skill_name, path, written.

    Paths that would leave the package's folder are refused.
    """
    path = _whole(path)
    # names that several packages share are told apart by their cluster
    named = packages.withColumn("skill_name", F.coalesce("skill_name", F.lit("unknown-skill")))
    if "cluster_id" in packages.columns:
        shared = named.groupBy("skill_name").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        named = named.join(shared, "skill_name", "left").withColumn("skill_name", F.when(F.col("_n").isNull(), F.col("skill_name")).otherwise(F.concat_ws("-", "skill_name", "cluster_id")))
    packages = named
    rows = packages.select(safe_key(F.coalesce("skill_name", F.lit("unknown-skill"))).alias("skill_name"), F.explode("files").alias("file")).select("skill_name", "file.path", "file.contents")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            done = []
            for name, at, text in zip(*(batch.column(c).to_pylist() for c in ("skill_name", "path", "contents")), strict=True):
                to, folder = safe_path(at, "references/unknown.md"), safe_path(name, "unknown-skill")
                done.append(to is not None and folder is not None)
                if done[-1]:
                    full = f"{base}/{folder}/{to}"
                    store.create_dir(full.rpartition("/")[0], recursive=True)
                    _put(store, full, (text or "").encode())
            yield pa.RecordBatch.from_arrays([batch.column("skill_name"), batch.column("path"), pa.array(done, pa.bool_())], names=["skill_name", "path", "written"])

    return rows.mapInArrow(run, "skill_name string, path string, written boolean")
