"""URL filters: longest-match rules, then a Bloom filter cascade over listed keys (operator 9).

A page's keys are its host, the host's parent domains, and the address without query (host and path). The cascade's first
level encodes the listed keys. Of the other keys of the corpus, those that pass it are its false positives, and the next
level encodes them; of the listed keys those that pass that are encoded in turn, until none passes wrongly. Over the
corpus's complete key universe (every key that occurs in it) membership is then exact, and rows are judged by testing
levels only, without a join. Only keys that pass the first level, a small share, meet the list itself while it is built.

Keys are hashed natively (xxhash64); a level's bits are gathered as 64-bit words by ``bit_or``. A cascade is cut by key
hash into shards of about SHARD_BYTES; shards are broadcast in groups of about GROUP_BYTES, each group in one narrow pass
that adds its findings to the rows, so that a list of any length is judged in the same way.

Defined results: a null url, or one without ``://``, has an empty host and path and fits nothing, so it is allowed;
repeated rows each give a row; repeated or null listed keys count once or not; an empty list blocks nothing; extra columns
are ignored, whatever their names. Of rules of one length that fit, the first in code point order wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hold, release

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_KEY, HASHES = 10, 7
#: Aimed-at sizes of a shard, and of the shards that are broadcast at once.
SHARD_BYTES, GROUP_BYTES = 4_000_000, 64_000_000
#: False positives of one level, about.
FALSE_SHARE = 0.0082
#: Rules as (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Hosts on the query's list; a subdomain of a listed host is listed with it.
LISTED = ("spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org", "blog.example.net", "m.example.org")
#: Names on the query's list that stand for the part of a public list that the corpus doesn't meet.
FEED_NAMES, FEED_SUFFIX = 200_000, ".feed.invalid"
#: Addresses of the corpus are on the query's list if the first digits of their md5 are below this.
LISTED_BELOW = "20"


def feed(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The query's list (key): LISTED, FEED_NAMES names by rule, and an eighth of the corpus's addresses, as no real list is at hand."""
    hosts = spark.createDataFrame([(h,) for h in LISTED], "key string")
    names = spark.range(FEED_NAMES).select(F.concat(F.lit("n"), F.col("id").cast("string"), F.lit(FEED_SUFFIX)).alias("key"))
    own = pages.select(F.concat(host_of("url"), path_of("url")).alias("key")).filter((F.col("key") != "") & (F.md5("key") < LISTED_BELOW))
    return hosts.union(names).union(own)


def host_of(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def domains(host: Column) -> Column:
    """The host and its parent domains; empty for an empty host."""
    parts = F.split(host, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(F.length(host) > 0, every).otherwise(F.array().cast("array<string>"))


def keys_of(host: Column, path: Column) -> Column:
    """All keys of an address: domains, and host with path."""
    return F.when(F.length(host) > 0, F.array_append(domains(host), F.concat(host, path))).otherwise(F.array().cast("array<string>"))


def hashes(key: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(key, F.lit(2 * seed)), F.xxhash64(key, F.lit(2 * seed + 1))


@dataclass
class Cascade:
    """Levels of the keys of one shard."""

    levels: list[np.ndarray]  # words of 64 bits

    @property
    def size(self) -> int:
        return sum(x.nbytes for x in self.levels)

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Levels passed before the first miss; an odd number means listed."""
        n = np.zeros(len(h1), np.int64)
        live = np.arange(len(h1))
        for i, words in enumerate(self.levels):
            live = live[_test(words, _positions(h1[live], h2[live], i, len(words) * 64))]
            n[live] += 1
        return n


@dataclass
class Sharded:
    """Cascades by shard; a key's shard is its second hash modulo their number."""

    shards: list[Cascade]
    seed: int = 0

    @property
    def levels(self) -> int:
        return max((len(c.levels) for c in self.shards), default=0)

    def groups(self, limit: int = GROUP_BYTES) -> Iterator[dict[int, Cascade]]:
        """Shards that are broadcast together."""
        group: dict[int, Cascade] = {}
        for i, c in enumerate(self.shards):
            if group and sum(x.size for x in group.values()) + c.size > limit:
                yield group
                group = {}
            if c.levels:
                group[i] = c
        if group:
            yield group

    def listed(self, h1: np.ndarray, h2: np.ndarray, group: dict[int, Cascade] | None = None) -> np.ndarray:
        shard = shard_of(h2, len(self.shards))
        return _listed(h1, h2, shard, group if group is not None else dict(enumerate(self.shards)))


def shard_of(h2: np.ndarray, n: int) -> np.ndarray:
    return (h2.view(np.uint64) >> np.uint64(40)) % np.uint64(max(1, n))


def _listed(h1: np.ndarray, h2: np.ndarray, shard: np.ndarray, group: dict[int, Cascade]) -> np.ndarray:
    out = np.zeros(len(h1), bool)
    for i, cascade in group.items():
        mine = np.flatnonzero(shard == i)
        if len(mine):
            out[mine] = cascade.passes(h1[mine], h2[mine]) % 2 == 1
    return out


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Double hashing, another sequence for each level."""
    step = (h2.view(np.uint64) * np.uint64(2 * level + 3)) | np.uint64(1)
    start = h1.view(np.uint64) ^ (step >> np.uint64(7)) * np.uint64(level + 1)
    return (start[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)


def _test(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(1)


def _level(keys: DataFrame, sizes: dict[int, int], level: int, shards: int) -> dict[int, np.ndarray]:
    """Filters of the keys (h1, h2) of each shard: bits found in the tasks, gathered by bit_or. The driver gets the level itself."""
    bits = {s: 64 * max(1, -(-n * BITS_PER_KEY // 64)) for s, n in sizes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
            shard = shard_of(h2, shards)
            for s in np.unique(shard).tolist():
                mine = shard == s
                at = np.sort(_positions(h1[mine], h2[mine], level, bits[s]).ravel())
                word = (at >> np.uint64(6)).astype(np.int64)
                first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), s), pa.int64()), pa.array(word[first]), pa.array(mask.view(np.int64))], names=["shard", "word", "mask"])

    out = {s: np.zeros(n // 64, np.uint64) for s, n in bits.items()}
    found = keys.select("h1", "h2").mapInArrow(run, "shard long, word long, mask long").groupBy("shard", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    shard, word, mask = (found.column(c).to_numpy() for c in ("shard", "word", "mask"))
    for s in out:
        mine = shard == s
        out[s][word[mine]] = mask[mine].view(np.uint64)
    return out


def _passing(keys: DataFrame, filters: dict[int, np.ndarray], level: int, shards: int) -> DataFrame:
    """Those keys that pass the level."""
    shared = keys.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
            shard, passed = shard_of(h2, shards), np.zeros(len(h1), bool)
            for s, words in shared.value.items():
                mine = np.flatnonzero(shard == s)
                if len(mine):
                    passed[mine] = _test(words, _positions(h1[mine], h2[mine], level, len(words) * 64))
            yield batch.filter(pa.array(passed))

    return keys.mapInArrow(run, keys.schema)


def build_cascade(universe: DataFrame, listed: DataFrame, shard_bytes: int = SHARD_BYTES, seed: int = 0) -> Sharded:
    """Exact over ``universe`` (column key) for the keys in ``listed`` (column key).

    Levels shrink by FALSE_SHARE, so they end after a few. Keys of equal hashes would pass for ever: when a level doesn't
    shrink, the cascade is built anew with other hashes. On the driver: the levels themselves, a bounded number of bits a key.
    """
    h1, h2 = hashes(F.col("key"), seed)
    hashed = lambda df: df.select("key").filter("key is not null").distinct().select("key", h1.alias("h1"), h2.alias("h2"))
    names, keys = hold(hashed(listed), "listed-keys"), hold(hashed(universe), "keys")
    n, others = names.count(), keys.count()
    shards = max(1, math.ceil(max(n, others * FALSE_SHARE) * BITS_PER_KEY / 8 / shard_bytes))
    out = Sharded([Cascade([]) for _ in range(shards)], seed)
    # by turns: what the level encodes, and the other kind, of which some pass it
    encoded, other, level, made = names, keys, 0, [names, keys]
    while n:
        sizes = {int(r.s): r.n for r in encoded.groupBy(F.pmod(F.shiftrightunsigned("h2", 40), F.lit(shards)).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
        filters = _level(encoded, sizes, level, shards)
        for s, words in filters.items():
            cascade = out.shards[s]
            # a shard without false positives ends a level earlier than others
            cascade.levels.append(words)
        passed = _passing(other, filters, level, shards)
        if not level:
            # of the keys that pass the first level, the listed ones do so rightly
            passed = passed.join(names.select("key"), "key", "left_anti")
        passed = hold(passed, "passed-keys")
        made.append(passed)
        encoded, other = passed, encoded
        before, n, level = n, passed.count(), level + 1
        if level > 8 and n >= before:
            release(*made)
            return build_cascade(universe, listed, shard_bytes, seed + 1)
    release(*made)
    return out


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, shard_bytes: int = SHARD_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """page_id, host, path, rule, listed, verdict for every page."""
    address = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of("url").alias("host"), path_of("url").alias("path"))
    keys = keys_of(F.col("host"), F.col("path"))
    cascade = build_cascade(address.select(F.explode(keys).alias("key")), listed, shard_bytes)
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    n, schema = len(cascade.shards), "page_id long, host string, path string, listed boolean, h1 array<long>, h2 array<long>"
    rows = address.withColumn("listed", F.lit(False)).withColumn("h1", F.transform(keys, lambda k: hashes(k, cascade.seed)[0])).withColumn("h2", F.transform(keys, lambda k: hashes(k, cascade.seed)[1]))
    for i, group in enumerate(cascade.groups(group_bytes)):
        shared = pages.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h1, h2 = batch.column("h1"), batch.column("h2")
                n_keys = np.diff(h1.offsets.to_numpy())
                a, b = (h.flatten().to_numpy(zero_copy_only=False) for h in (h1, h2))
                found = batch.column("listed").to_numpy(zero_copy_only=False).copy()
                np.logical_or.at(found, np.repeat(np.arange(len(n_keys)), n_keys), _listed(a, b, shard_of(b, n), shared.value))
                yield batch.set_column(batch.schema.get_field_index("listed"), "listed", pa.array(found))

        rows = (hold(rows, "judged") if i and i % 8 == 0 else rows).mapInArrow(run, schema)
    return rows.select("page_id", "host", "path", name.alias("rule"), "listed", F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
