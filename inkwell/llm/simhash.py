"""SimHash near-dedup (operator 5): fingerprints, broadcast BK-trees of shards, connected components.

Linking at r = 4 differing bits over all fingerprints must neither compare all pairs nor broadcast a tree that grows with
the corpus. The 64 bits are cut into r + s blocks; fingerprints within r bits agree on s blocks at least, so each distinct
fingerprint goes to the shards named by s of its blocks (``plan``: s = 1, five shards each, up to four million
fingerprints; s = 2, fifteen, up to a billion; of each block as many bits are used as make shards of about AIM members).
Shards above TREE members are cut into parts.

Every part's BK-tree (children keyed by integer Hamming distance to the parent) is built once, in a bundle of trees of
bounded size, and broadcast: bundles lie in the shared folder and every task that has queries for a bundle loads it. They
don't go through the driver, which must never hold the fingerprints of all documents. A query walks the trees of its
shard's parts and follows only edges within the radius of its distance. ``work`` tells how many nodes that visits.

A task emits links that connect what it found; large-star/small-star rounds over these give the components. Copies are
collapsed to one fingerprint first. Nothing is collected.

Defined results: null, empty and wordless texts have fingerprint zero, linked like any other; a null id gets its row and
is never the smallest id (a component of null ids only has component null); repeated rows each give a row; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_path, hold, new_path, release, texts

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Members that shards are meant to have, and members that one tree has at most, about.
AIM, TREE = 1024, 4096
#: Nodes of a bundle of trees: so many at most, about (40 bytes each), and so many at least before there are more bundles than partitions need.
BUNDLE, SMALL_BUNDLE = 500_000, 8_192
#: Queries that are walked at once.
QUERIES = 50_000
#: Lists of at most so many ids or keys (8 to 12 bytes each) are broadcast; longer ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -n] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[n - 1 :].tolist(), strict=True)], np.uint64)
    out = 0
    for bit in range(8):
        # eight counters of 8 bits to a number: sums of up to 255 hashes don't overflow
        lanes = (hashes >> np.uint64(bit)) & _LANES
        part = np.add.reduceat(lanes, np.arange(0, len(lanes), 255))
        counts = part.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)  # little-endian: byte i holds bit 8 i + bit
        for i in np.flatnonzero(2 * counts > len(hashes)).tolist():
            out |= 1 << (8 * i + bit)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for every document; a narrow map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def bk_forest(fps: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A BK-tree for each group, built level by level: (parent, edge, root); each tree is that of inserting in order.

    ``group``: sorted group numbers from 0. An item goes down from its tree's root to the child at its own distance until
    there is none; of the items that would open the same edge, the first becomes the child.
    """
    root = np.searchsorted(group, group, "left")
    parent, edge = np.full(len(fps), -1), np.zeros(len(fps), np.int64)
    items, at = np.flatnonzero(root != np.arange(len(fps))), root.copy()
    while len(items):
        d = np.bitwise_count(fps[items] ^ fps[at[items]]).astype(np.int64)
        slots, first, back = np.unique(at[items] * 65 + d, return_index=True, return_inverse=True)
        child = items[first]  # items stay in order, so the first is the smallest
        parent[child], edge[child] = at[child], d[first]
        at[items] = child[back]
        items = items[at[items] != items]
    return parent, edge, root


class Bundle:
    """Trees over the fingerprints of many shards, with children in order of (parent, edge)."""

    def __init__(self, tree: np.ndarray, fps: np.ndarray):
        """Both in order of (tree, fingerprint)."""
        self.fps = fps
        self.trees, self.roots, group = np.unique(tree, return_index=True, return_inverse=True)
        parent, edge, _ = bk_forest(fps, group)
        kids = np.flatnonzero(parent >= 0)
        self.kids = kids[np.lexsort((kids, edge[kids], parent[kids]))]
        self.slots = parent[self.kids] * 65 + edge[self.kids]

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, fps=self.fps, trees=self.trees, roots=self.roots, kids=self.kids, slots=self.slots)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Bundle:
        self = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as saved:
            for name in ("fps", "trees", "roots", "kids", "slots"):
                setattr(self, name, saved[name])
        return self

    def has(self, tree: np.ndarray) -> np.ndarray:
        """Which of the trees there are: no member may have come to a part."""
        return np.isin(tree, self.trees)

    def size_of(self, tree: np.ndarray) -> np.ndarray:
        return np.diff(np.append(self.roots, len(self.fps)))[np.searchsorted(self.trees, tree)]

    def search(self, tree: np.ndarray, fps: np.ndarray, radius: int = RADIUS, frontier: int = 1_000_000) -> tuple[np.ndarray, np.ndarray, int]:
        """Links (larger, smaller) that connect the queries with all nodes of their trees within the radius, and the nodes visited."""
        found, held, visited = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))], 0, 0
        waiting = [(np.arange(len(fps)), self.roots[np.searchsorted(self.trees, tree)])]
        while waiting:
            query, node = waiting.pop()
            if len(query) > frontier:
                waiting += [(query[i : i + frontier], node[i : i + frontier]) for i in range(0, len(query), frontier)]
                continue
            visited += len(query)
            mine, theirs = fps[query], self.fps[node]
            d = np.bitwise_count(mine ^ theirs).astype(np.int64)
            hit = (d <= radius) & (theirs < mine)
            if hit.any():
                found.append((mine[hit], theirs[hit]))
                held += int(hit.sum())
                if held > frontier:
                    found = [spanning(found)]
                    held = len(found[0][0])
                    frontier = max(frontier, 2 * held)
            low = np.searchsorted(self.slots, node * 65 + np.maximum(d - radius, 0), "left")
            n = np.searchsorted(self.slots, node * 65 + np.minimum(d + radius, 64), "right") - low
            if n.any():
                places = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                waiting.append((np.repeat(query, n), self.kids[places]))
        return *spanning(found), visited


def spanning(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One link per item to the smallest that the links lead to."""
    items, both = np.unique(np.concatenate([x for pair in pairs for x in pair]), return_inverse=True)
    lengths = np.cumsum([0] + [len(x) for pair in pairs for x in pair])
    parts = [both[a:b] for a, b in zip(lengths, lengths[1:], strict=False)]
    a, b = np.concatenate(parts[::2]), np.concatenate(parts[1::2])
    label = np.arange(len(items))
    while True:  # smallest label over the links and along labels, until none changes
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == old).all() and (label[a] == label[b]).all():
            break
    linked = label != np.arange(len(items))
    return items[linked], items[label[linked]]


def _by_run(batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bundle, tree, fp) of rows in order of bundle: runs of one bundle, whole or in pieces of about ``limit``."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n, now = 0, None
    joined = lambda: tuple(np.concatenate(x) for x in zip(*held, strict=True))
    for batch in batches:
        bundle, tree, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bundle", "tree", "fp"))
        cuts = np.flatnonzero(np.diff(bundle)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bundle)], strict=True):
            if start == end:
                continue
            if held and (bundle[start] != now or (limit and n >= limit)):
                yield now, *joined()
                held, n = [], 0
            now = int(bundle[start])
            held.append((tree[start:end], fp[start:end]))
            n += end - start
    if held:
        yield now, *joined()


def plan(n: int, aim: int = AIM, radius: int = RADIUS) -> tuple[int, int, int]:
    """(blocks, blocks that a shard's name has, bits used of each) for ``n`` fingerprints."""
    shared = 1
    while shared < 3 and n > aim << (64 // (radius + shared) * shared):
        shared += 1
    blocks = radius + shared
    return blocks, shared, min(64 // blocks, max(0, math.ceil(math.log2(max(1, n / aim)) / shared)))


def shard_names(n: int, aim: int = AIM, radius: int = RADIUS) -> list:
    """Columns that name the shards of column fp; two fingerprints within the radius have one name in common at least."""
    blocks, shared, bits = plan(n, aim, radius)
    if not bits:
        return [F.lit(0).cast("long")]
    starts = [round(64 * i / blocks) for i in range(blocks)]
    parts = [F.shiftrightunsigned(F.col("fp"), a).bitwiseAND((1 << bits) - 1) for a in starts]
    return [F.xxhash64(F.lit(i), *[parts[x] for x in chosen]) for i, chosen in enumerate(combinations(range(blocks), shared))]


def search_trees(fps: DataFrame, aim: int = AIM, tree: int = TREE, bundle: int = BUNDLE) -> DataFrame:
    """Rows (a, b) of links that connect all distinct fingerprints (column fp) within RADIUS bits, directly or by steps;
    and rows of work done (queries, nodes in their trees, visited), with null links. Held."""
    spark = fps.sparkSession
    n = fps.count()
    names = shard_names(n, aim)
    rows = fps.select("fp", F.explode(F.array(*names)).alias("shard"))
    hot = hold(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree).select("shard", F.ceil(F.col("n") * 2 / tree).cast("int").alias("parts")), "hot-shards")
    n_hot = hot.count()
    if n_hot:
        rows = rows.join(F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot, "shard", "left")
    else:
        rows = rows.withColumn("parts", F.lit(None).cast("int"))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    of = lambda part: F.when(F.col("parts").isNull(), F.col("shard")).otherwise(F.xxhash64("shard", part))
    nodes = n * len(names)
    n_bundles = max(1, math.ceil(nodes / bundle), min(int(spark.conf.get("spark.sql.shuffle.partitions")), nodes // SMALL_BUNDLE))
    n_slices = math.ceil(nodes / n_bundles / QUERIES)
    # a member is in the tree of one part of its shard
    mine = F.pmod(F.xxhash64("fp", F.lit("part")), parts).cast("int")
    members = rows.select(of(mine).alias("tree"), "fp").withColumn("bundle", F.pmod("tree", F.lit(n_bundles)))
    base = new_path(spark, "bk-trees")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(base)
        store.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for number, own, fp in _by_run(batches, None):
            with store.open_output_stream(f"{folder}/_writing-{number}-{attempt}", compression=None) as out:
                out.write(Bundle(own, fp.view(np.uint64)).save())
            store.move(f"{folder}/_writing-{number}-{attempt}", f"{folder}/{number}.npz")
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(fp)], pa.int64())], names=["bundle", "nodes"])

    built = members.repartition("bundle").sortWithinPartitions("bundle", "tree", "fp").mapInArrow(build, "bundle long, nodes long").agg(F.coalesce(F.sum("nodes"), F.lit(0)).alias("n")).first().n
    if built != nodes:
        raise RuntimeError(f"{built} of {nodes} nodes are in trees under {base}")
    # a query visits all parts of its shards; a bundle's queries are dealt to several tasks, those of a hot shard to as many as it has parts
    asked = rows.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    asked = asked.select(of(F.col("part")).alias("tree"), "fp", F.pmod(F.xxhash64("fp", F.lit("slice")), F.greatest(parts, F.lit(max(1, n_slices)))).alias("slice")).withColumn("bundle", F.pmod("tree", F.lit(n_bundles)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(base)
        loaded, at = None, None
        kinds = [pa.int64()] * 5
        for number, own, fp in _by_run(batches, QUERIES):
            if at != number:
                at, loaded = number, None
                # all nodes are in trees (counted above): a bundle that isn't there has none
                if store.get_file_info(f"{folder}/{number}.npz").type == fs.FileType.File:
                    with store.open_input_file(f"{folder}/{number}.npz") as file:
                        loaded = Bundle.load(file.read())
            if loaded is None:
                continue
            there = loaded.has(own)
            own, fp = own[there], fp[there]
            larger, smaller, visited = loaded.search(own, fp.view(np.uint64))
            nothing = np.full(len(larger), None)
            columns = [larger.view(np.int64), smaller.view(np.int64), nothing, nothing, nothing]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["a", "b", "queries", "nodes", "visited"])
            totals = [None, None, len(fp), int(loaded.size_of(own).sum()), visited]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(totals, kinds, strict=True)], names=["a", "b", "queries", "nodes", "visited"])

    asked = asked.repartition("bundle", "slice").sortWithinPartitions("bundle", "tree", "fp").select("bundle", "tree", "fp")
    found = hold(asked.mapInArrow(search, "a long, b long, queries long, nodes long, visited long"), "tree-links")
    delete_path(spark, base)
    release(hot)
    return found


def near_links(found: DataFrame) -> DataFrame:
    return found.filter("a is not null").select("a", "b").distinct()


def work(found: DataFrame) -> DataFrame:
    """One row: queries, nodes in the trees that they were put to, nodes visited."""
    return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("queries", "nodes", "visited")])


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component, by large-star and small-star rounds.

    Every round is held in the shared folder; rounds grow with the logarithm of the components' size.
    """
    edges = hold(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # held, so that both sides of the joins are plain exchanges, of which a hot node's rows can be split
        low = hold(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large-star-least")
        # large-star: larger neighbours of u, and not u itself, go to the smallest around u
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = hold(large, "large-star")
        # small-star: u and its smaller neighbours go to the smallest of these
        least = hold(large.groupBy("u").agg(F.min("v").alias("m")), "small-star-least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        before, edges = edges, hold(small.filter("u != v").distinct(), "small-star")
        release(before, low, large, least)
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for every document."""
    own = hold(fingerprints(docs), "fingerprints")
    smallest = hold(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = search_trees(smallest.select("fp"))
    roots = components(near_links(found))
    release(found)
    # only linked fingerprints need a component other than their own; each join is between held tables (see components)
    pairs = roots.union(roots.select("root", F.col("root").alias("same")).distinct())
    linked = hold(pairs.join(smallest, F.col("node") == F.col("fp")).select("node", "root", "least"), "linked")
    least = hold(linked.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    own_component = hold(linked.join(least, "root").select("node", "component_id"), "component-of")
    named = smallest.join(own_component, F.col("fp") == F.col("node"), "left").select("fp", F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    named = hold(named, "named-fingerprints")
    release(smallest, linked, least, own_component)
    return own.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with the smallest id of their component; rows that share this id all stay, and so do null ids."""
    dropped = hold(near_duplicates(docs).filter("doc_id != component_id").select("doc_id").distinct(), "near-copies")
    n = dropped.count()
    return docs.join(F.broadcast(dropped) if n <= BROADCAST_ROWS else dropped, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
