"""Mixing sources to target weights by systematic sampling (operator 6); DataFrame functions only.

Every document of a source is expected ``target / source_size`` times. Within a source the documents stand in an
order (size class, hash bucket, size, id, hash of the row); the expected copies are prefix-summed along it, one offset per source is
added, and a document is emitted once for each integer that its interval crosses. The order by size keeps the words
taken near the target.

No task needs a whole source: ranks are counted within (source, size class, hash bucket). The counts of those cells are
prefix-summed in two levels, at most 450 classes within a source and 256 buckets within a class. Sources may be as many as
web domains: they are ranked and their targets found over range partitions, of which only totals meet in one task.

Defined results: null texts have size 0; a null source is a source of its own, the last; rows of equal size and id stand in
the order of a hash of all their columns, so that those that tie are equal rows; sources without words get target 0; extra
columns are carried by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, hold, release

WEIGHTS, CAP, SEED = (1, 2, 3), 3, "mix-1"


def _fraction(text: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of md5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def running(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with running sums along ``order``, this row included, and the held table that they read; ``order`` must
    tell all rows apart.

    Range partitions are summed apart and moved on by the totals of those before them: one number per partition meets in
    one task, never the rows.
    """
    placed = hold(rows.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    starts = totals.select("_part", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_{k}") for k in sums])
    own = placed.select("*", *[F.sum(c).over(so_far).alias(f"_own_{k}") for k, c in sums.items()])
    # one row per partition of a sort
    return own.join(F.broadcast(starts), "_part").select(*rows.columns, *[(F.col(f"_{k}") + F.col(f"_own_{k}")).alias(k) for k in sums]), placed


def source_targets(cells: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets by water-filling: the level at which capped shares and the weighted rest add up to all words."""
    sources = cells.groupBy("skey").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    ranked, first = running(sources, [F.col("source").asc_nulls_last()], {"place": F.lit(1)}, "mix-sources")
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    s = ranked.select("skey", "source", "source_size", w.cast("long").alias("w"), (F.col("source_size") * cap).alias("limit"))
    ratio = F.col("limit") / F.col("w")
    s, second = running(s, [ratio, F.col("source").asc_nulls_last()], {"limits": F.col("limit"), "ws": F.col("w")}, "mix-levels")
    whole = s.agg(F.sum("source_size").alias("words"), F.sum("w").alias("ws")).first()
    level = (F.lit(whole.words) - (F.col("limits") - F.col("limit"))).cast("double") / (F.lit(whole.ws) - (F.col("ws") - F.col("w")))
    s = s.withColumn("level", level)
    # the first source (by cap over weight) that the level leaves below its cap fixes the level
    fixed = F.lit(s.agg(F.min(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.struct(ratio.alias("ratio"), "level")))["level"].alias("level")).first().level).cast("double")
    target = F.when(fixed * F.col("w") >= F.col("limit"), F.col("limit").cast("double")).otherwise(fixed * F.col("w"))
    s = s.withColumn("target", F.coalesce(target, F.lit(0.0)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _fraction(F.concat(F.lit(SEED), F.lit(":"), F.col("skey")))
    out = hold(s.select("skey", "source_size", "target", rate.alias("rate"), offset.alias("offset")), "mix-targets")
    release(first, second)
    return out


def row_hash(docs: DataFrame) -> Column:
    """Of all columns; maps, which have no hash, as JSON."""
    plain = lambda f: F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else F.col(f"`{f.name}`")
    return F.xxhash64(*[plain(f) for f in docs.schema.fields])


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, carry: Sequence[str] | None = None) -> DataFrame:
    """Columns row (struct of the input columns, or of those in ``carry``), size, source_size, target, copies, taken; one row per document."""
    skey = F.coalesce(F.concat(F.lit("v"), F.col("source")), F.lit("n"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digits = F.col("size").cast("string")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"),
        F.col("source").alias("source"),
        F.col("doc_id").alias("key_id"),
        row_hash(docs if carry is None else docs.select(*dict.fromkeys([*(f"`{c}`" for c in carry), "text"]))).alias("key_hash"),
        skey.alias("skey"),
        size.alias("size"),
        F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(""))), 1, 2), 16, 10).cast("int").alias("bucket"),
    ).withColumn("class", F.length(digits) * 100 + F.rpad(F.substring(digits, 1, 2), 2, "0").cast("int"))
    cell = ["skey", "class", "bucket"]
    # two plans read the counts; held, they cost one pass over the texts
    cells = hold(base.groupBy(*cell).agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-cells")
    # two levels, so that no task has all cells of a source: class totals along the source, then cells along the class
    so_far = lambda *keys: F.coalesce(F.sum("n").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = cells.groupBy("skey", "class").agg(F.sum("n").alias("n")).select("skey", "class", so_far("skey", "class").alias("class_start"))
    starts = cells.select(*cell, so_far(*cell).alias("start")).join(classes, ["skey", "class"]).select(*cell, (F.col("class_start") + F.col("start")).alias("start"))
    ranked = base.drop("source").withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy("size", "key_id", "key_hash")))
    # every row has its cell and source; outer joins spare a filter on the keys, for which texts would be read for size again
    placed = ranked.join(starts, cell, "left").join(source_targets(cells, weights, cap), "skey", "left")
    at = F.col("start") + F.col("rank")
    crossed = F.floor(F.col("rate") * at + F.col("offset")) - F.floor(F.col("rate") * (at - 1) + F.col("offset"))
    copies = F.least(crossed, F.lit(cap)).cast("long")
    return placed.select("row", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: the input's columns once per copy, numbered in ``copy_no`` (``mix_copy_no`` if that is taken)."""
    names = mixed.schema["row"].dataType.names
    number = "mix_copy_no" if "copy_no" in names else "copy_no"
    return mixed.filter("copies > 0").select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(number))
