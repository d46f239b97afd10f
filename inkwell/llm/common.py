"""What the training-data operators share: tables, the shared folder, corpus-wide sums."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: str | None = None
_held: dict[int, str] = {}
_scratch: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one of our own where that is unset and all runs on
    one machine (tests). On a cluster without such a folder this raises: a local folder would lose rows."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir isn't set: executors of {master} share no other folder")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="inkwell-")
        atexit.register(shutil.rmtree, _own_dir.removeprefix("file://"), ignore_errors=True)
    return _own_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends if not before."""
    path = f"{shared_dir(spark)}/inkwell/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_clear)
    _scratch.add(path)
    return path


def hold(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and survives lost executors.

    ``release`` deletes the table once nothing reads it any more; tables that a query's result still reads go when the
    application ends.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _held[id(out)] = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``hold``."""
    for df in tables:
        path = _held.pop(id(df), None)
        if path is not None:
            delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _scratch.discard(path)


def _clear() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_scratch) if spark is not None else ():
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001  the session has ended: the folder is the cluster's to clean
            return


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def held_out(column: str, n: int, rest: int) -> Column:
    """True where the remainder is ``rest``; a null id is never held out."""
    return F.coalesce(crc_mod(column, n) == rest, F.lit(False))


def labelled_sample(labels: DataFrame, target: str, n: int, rest: int, bound: int) -> DataFrame:
    """At most ``bound`` rows (doc_id, target) of the labels outside the held-out fold, chosen by hash of the id.

    Repeated ids give one row with the larger label; null ids and labels give none.
    """
    return (
        labels.select("doc_id", F.col(target).cast("int").alias("target"))
        .filter((crc_mod("doc_id", n) != rest) & F.col("target").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("target").alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def corpus_sum(df: DataFrame, fill: Callable[[pa.RecordBatch, np.ndarray], None], length: int, salts: int = 16) -> np.ndarray:
    """Element-wise sum over all rows of a table of ``length`` float64 values, filled by ``fill(batch, table)``.

    Each task adds up its own rows, so that one table of fixed size leaves it; those are folded as streams in
    two levels. What reaches the driver is one table, ``8 * length`` bytes whatever the input.
    """
    piece = 8192
    schema = "shard int, vals binary"
    arrow = pa.schema([("shard", pa.int32()), ("vals", pa.binary())])

    def emit(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for shard, vals in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([vals.tobytes()], pa.binary())], schema=arrow)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            fill(batch, total)
        yield from emit({i // piece: total[i : i + piece] for i in range(0, length, piece) if total[i : i + piece].any()})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, vals in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vals = np.frombuffer(vals)
                if shard in sums:
                    sums[shard] += vals
                else:
                    sums[shard] = vals.copy()
        yield from emit(sums)

    parts = df.mapInArrow(part, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    once = parts.repartition("shard", "salt").select("shard", "vals").mapInArrow(fold, schema)
    total = np.zeros(length)
    for row in once.repartition("shard").mapInArrow(fold, schema).collect():
        vals = np.frombuffer(row.vals)
        total[row.shard * piece : row.shard * piece + len(vals)] += vals
    return total


def filter_texts(docs: DataFrame, keep: Callable[[list[str]], np.ndarray | list[bool]]) -> DataFrame:
    """The rows whose whole texts ``keep`` is true for, with all their columns; a narrow map.

    Arrow maps look up columns by name, which fails on names with dots: but for ``text``, columns go by their place.
    """
    plain = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(texts(batch)), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def utf16_units(text: str) -> np.ndarray | None:
    """The 16-bit code units; None for texts with characters beyond them."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    return None if ((units & 0xF800) == 0xD800).any() else units


def chunks(items: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items with about ``limit`` characters each, one item at least."""
    start, n = 0, 0
    for i, item in enumerate(items):
        if n and n + len(item) > limit:
            yield start, i
            start, n = i, 0
        n += len(item)
    if items:
        yield start, len(items)
