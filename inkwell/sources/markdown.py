"""Markdown document sources: recursive scans with a filter on names, UTF-8 checks, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that the directory scan keeps; a fixed value of the format.
NAME_GLOB = "{SR-PTD,task_doc}*.md"


def scan_directory(spark: SparkSession, path: str, glob: str = NAME_GLOB) -> DataFrame:
    """path, content (bytes), modified; every matching file below the folder once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "content", F.col("modificationTime").alias("modified"))


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    """One file, whatever its name."""
    return spark.read.format("binaryFile").load(path).select("path", "content", F.col("modificationTime").alias("modified"))


def decode(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects): valid UTF-8 with line ends as ``\\n``; and path, error of the rest."""
    valid = F.is_valid_utf8(F.col("content").cast("string")) & F.col("content").isNotNull()
    texts = files.filter(valid).withColumn("content", F.regexp_replace(F.col("content").cast("string"), r"\r\n?", "\n"))
    return texts, files.filter(~valid).select("path", F.lit("invalid UTF-8").alias("error"))


def manifest(files: DataFrame) -> DataFrame:
    """path, hash, modified of every file: what incremental runs compare."""
    return files.select("path", F.md5("content").alias("hash"), "modified")


def changed(new: DataFrame, known: DataFrame, order: str | None = None) -> DataFrame:
    """Files that are new or whose content differs from the known manifest.

    ``order``: a column of the known by which the last entry of a path counts, so that a file that goes back to an earlier
    content has changed.
    """
    last = known.select("path", "hash") if order is None else known.groupBy("path").agg(F.max_by("hash", order).alias("hash"))
    return new.join(last, ["path", "hash"], "left_anti")
