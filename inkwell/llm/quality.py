"""Quality classifier (operator 4): random-indexing word vectors, pooled, and a two-layer network.

1. Every token has a sparse random index vector fixed by its hash. Over the whole training fold each token's context
   vector is the sum of its neighbours' index vectors, two to either side (every row; a row of sums per bucket leaves a task).
2. A document is the mean of its tokens' context vectors, divided by their lengths plus a constant, with its share of distinct tokens and its length.
3. A two-layer numpy network is fitted on a bounded labelled sample; a temperature fitted on rows set aside from it
   calibrates its probabilities.

Tokens are runs of letters, of digits or of one kind of sign; a word of capitals counts as one marker token. They are
hashed into 2 ** 18 buckets, so that words rarely share one and yet the tables have a bound whatever the vocabulary: 25 MB
of vectors. Only buckets that occur are gathered and kept.

Defined results: null and empty texts pool to a zero vector and get its score; repeated rows each give a row; extra
columns are ignored; with labels of one kind or none the score is that kind's share (0.5 without labels); a null id is
never held out and never learned from; texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, crc_mod, filter_texts, held_out, labelled_sample, texts, utf16_units

FOLDS, HELD = 5, 0
#: Labelled documents that the network is fitted on, at most.
SAMPLE = 20_000
THRESHOLD = 0.3
BUCKETS, DIMS, NONZERO, REACH = 1 << 18, 48, 4, 2
#: Buckets whose sums travel together.
SHARD = 1024
#: Added to a context vector's length before it is divided by it: words met a few times only, whose contexts tell of the
#: few documents that they are from, count less.
SHRINK = 20.0
HIDDEN, EPOCHS, SEED = 32, 60, 7
_TOKENS = re.compile(r"[^\W\d_]+|\d+|([^\w\s])\1*|_+")


def index_vectors(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket's index vector isn't zero, one place in each of NONZERO parts of the vector, and the signs there."""
    k = np.arange(NONZERO, dtype=np.uint64)
    h = (buckets.astype(np.uint64)[:, None] * np.uint64(NONZERO) + k + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    part = DIMS // NONZERO
    return (k * np.uint64(part) + (h >> np.uint64(8)) % np.uint64(part)).astype(np.int64), 1.0 - 2.0 * (h & np.uint64(1)).astype(np.float64)


class _Buckets(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > 300_000:
            self.clear()
        name = "<caps>" if len(token) > 1 and token.isupper() else token.lower()
        self[token] = bucket = zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS
        return bucket


@cache
def _classes() -> np.ndarray:
    """Of each 16-bit code unit the class that a token keeps to: 0 white space, 1 letter, 2 digit, 3 underscore, or the sign itself."""
    of = lambda c: 0 if c.isspace() else 3 if c == "_" else 2 if c.isdecimal() else 1 if c.isalnum() else 4 + ord(c)
    return np.array([of(chr(i)) for i in range(1 << 16)], np.int32)


def split_tokens(text: str) -> list[str]:
    """What _TOKENS finds, in order: spaces are put where the class changes, but in texts with characters beyond 16 bits."""
    try:
        units, codec = np.frombuffer(text.encode("latin-1"), np.uint8), "latin-1"
    except UnicodeEncodeError:
        units, codec = utf16_units(text), "utf-16-le"
        if units is None:
            return [m[0] for m in _TOKENS.finditer(text)]
    if not len(units):
        return []
    classes = _classes()[units]
    places = np.arange(len(units))
    places[1:] += np.cumsum(classes[1:] != classes[:-1])
    out = np.full(places[-1] + 1, 32, units.dtype)
    out[places] = np.where(classes > 0, units, units.dtype.type(32))
    return out.tobytes().decode(codec).split()


def tokenise(text: str, buckets: _Buckets) -> np.ndarray:
    found = split_tokens(text)
    return np.fromiter(map(buckets.__getitem__, found), np.int64, len(found))


class Sums:
    """Sums of context vectors of the buckets met so far."""

    def __init__(self) -> None:
        self.index = np.full(BUCKETS, -1, np.int32)
        self.values = np.zeros((1024, DIMS))
        self.n = 0

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """Row numbers of buckets that differ; new ones get a row."""
        new = buckets[self.index[buckets] < 0]
        if len(new):
            self.index[new] = np.arange(self.n, self.n + len(new))
            self.n += len(new)
            while self.n > len(self.values):
                self.values = np.concatenate((self.values, np.zeros_like(self.values)))
        return self.index[buckets]

    def add(self, buckets: np.ndarray, values: np.ndarray) -> None:
        rows = self.rows(buckets)  # first: it may move the table
        self.values[rows] += values

    def shards(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, buckets, sums) of all that were met."""
        met = np.flatnonzero(self.index >= 0)
        for part in np.split(met, np.flatnonzero(np.diff(met // SHARD)) + 1):
            if len(part):
                yield int(part[0]) // SHARD, part, self.values[self.index[part]]


def packed(values: np.ndarray) -> bytes:
    """Sums, which are whole numbers, in the narrowest type that holds them, deflated: most are 0 or 1."""
    top = np.abs(values).max(initial=0)
    kind = next((k for k in "bhiq" if top <= np.iinfo(k).max), "q")
    return kind.encode() + zlib.compress(values.astype(kind).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), data[:1].decode()).astype(np.float64).reshape(-1, DIMS)


def add_contexts(ids: np.ndarray, sums: Sums) -> None:
    """Add the neighbours' index vectors to each token's row; -1 separates documents."""
    met = np.zeros(BUCKETS, bool)
    met[ids[ids >= 0]] = True
    kinds = np.flatnonzero(met)
    row_of = np.zeros(BUCKETS, np.int64)
    row_of[kinds] = np.arange(len(kinds))
    apart = ids < 0
    own = row_of[np.maximum(ids, 0)]
    base = own * DIMS
    reach = []  # for each gap, whether both tokens are of one document
    for gap in range(1, REACH + 1):
        broken = apart[: len(ids) - gap].copy()
        for i in range(1, gap + 1):
            broken |= apart[i : len(ids) - gap + i]
        reach.append(~broken)
    places, signs = index_vectors(kinds)
    found = np.zeros(len(kinds) * DIMS)
    for k in range(NONZERO if len(kinds) else 0):
        place, sign = places[own, k], signs[own, k]
        for gap, one in enumerate(reach, 1):
            at = np.concatenate((base[:-gap] + place[gap:], base[gap:] + place[:-gap]))
            found += np.bincount(at, np.concatenate((one * sign[gap:], one * sign[:-gap])), minlength=len(found))
    sums.add(kinds, found.reshape(len(kinds), DIMS))


@dataclass
class Vectors:
    index: np.ndarray  # of each bucket the row of its vector, or -1
    values: np.ndarray

    def of(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which buckets have a vector, and their vectors."""
        at = self.index[buckets]
        return at >= 0, self.values[at[at >= 0]]


def word_vectors(sums: Sums) -> Vectors:
    values = sums.values[: sums.n]
    norm = np.linalg.norm(values, axis=1, keepdims=True)
    return Vectors(sums.index, (values / (norm + SHRINK)).astype(np.float16))


def pool(text: str, vectors: Vectors, buckets: _Buckets) -> np.ndarray:
    out = np.zeros(DIMS + 2, np.float32)
    ids = tokenise(text, buckets)
    if len(ids):
        kinds, n = np.unique(ids, return_counts=True)
        known, found = vectors.of(kinds)
        out[:DIMS] = n[known].astype(np.float32) @ found.astype(np.float32) / len(ids)
        out[DIMS] = len(kinds) / len(ids)
        out[DIMS + 1] = np.log1p(len(ids)) / 10
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def loss_and_gradients(params: list[np.ndarray], z: np.ndarray, y: np.ndarray, decay: float = 1e-4) -> tuple[float, list[np.ndarray]]:
    """Mean logistic loss with weight decay, and its gradients by the parameters (w1, b1, w2, b2)."""
    w1, b1, w2, b2 = params
    h = np.tanh(z @ w1 + b1)
    logit = np.clip(h @ w2 + b2, -30, 30)
    loss = float(np.logaddexp(0, np.where(y > 0, -logit, logit)).mean() + decay / 2 * ((w1 * w1).sum() + (w2 * w2).sum()))
    d = (1 / (1 + np.exp(-logit)) - y) / len(y)
    dh = np.outer(d, w2) * (1 - h * h)
    return loss, [z.T @ dh + decay * w1, dh.sum(0), h.T @ d + decay * w2, np.array([d.sum()])]


def best_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """Of 60 temperatures from 0.5 to 5 the one of least logistic loss."""
    return float(min(np.geomspace(0.5, 5, 60), key=lambda t: np.logaddexp(0, np.where(y > 0, -logit, logit) / t).mean()))


def train_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the logistic loss; the temperature is the one of least loss on every fifth row, which training never sees."""
    rng = np.random.default_rng(seed)
    aside = np.arange(len(y)) % 5 == 4
    xa, ya, x, y = x[aside], y[aside], x[~aside], y[~aside]
    net = Network(x.mean(0), x.std(0) + 1e-3, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    params = [net.w1, net.b1, net.w2, np.array([0.0])]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    z, step = (x - net.mean) / net.scale, 0
    for _ in range(max(EPOCHS, min(400, 300_000 // len(y)))):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 256):
            rows = order[at : at + 256]
            step += 1
            for i, g in enumerate(loss_and_gradients(params, z[rows], y[rows])[1]):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(params[3][0])
    if len(set(ya.tolist())) == 2:
        net.temperature = best_temperature(net.logits(xa), ya)
    return net


@dataclass
class Model:
    """``shared``: the vectors as a broadcast, made once for fitting and scoring."""

    vectors: Vectors
    network: Network | None
    share: float
    shared: Broadcast | None = None


def scores_of(items: list[str], vectors: Vectors, network: Network | None, share: float, buckets: _Buckets) -> np.ndarray:
    if network is None:
        return np.full(len(items), share)
    if not items:
        return np.zeros(0)
    return network.probability(np.stack([pool(t, vectors, buckets) for t in items]).astype(np.float64))


def fit_vectors(docs: DataFrame, salts: int = 16) -> Vectors:
    """Context vectors of all rows. Each task adds up its own rows; what it met is folded as streams in two levels."""
    schema = "shard int, buckets binary, vals binary"
    arrow = pa.schema([("shard", pa.int32()), ("buckets", pa.binary()), ("vals", pa.binary())])

    def emit(sums: Sums) -> Iterator[pa.RecordBatch]:
        for shard, buckets, values in sums.shards():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([buckets.astype(np.int32).tobytes()], pa.binary()), pa.array([packed(values)], pa.binary())], schema=arrow)

    def add_all(sums: Sums, rows: Iterator[tuple[bytes, bytes]]) -> None:
        for buckets, values in rows:
            sums.add(np.frombuffer(buckets, np.int32), unpacked(values))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known, apart = Sums(), _Buckets(), np.array([-1])
        for batch in batches:
            items = texts(batch)
            for a, b in chunks(items, 2_000_000):
                add_contexts(np.concatenate([x for t in items[a:b] for x in (tokenise(t, known), apart)]), sums)
        yield from emit(sums)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            add_all(sums, zip(batch.column("buckets").to_pylist(), batch.column("vals").to_pylist(), strict=True))
        yield from emit(sums)

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(part, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    once = parts.repartition("shard", "salt").select("shard", "buckets", "vals").mapInArrow(fold, schema)
    total = Sums()
    # in order of bucket, so that the rows don't depend on the order of arrival
    add_all(total, ((r.buckets, r.vals) for r in sorted(once.repartition("shard").mapInArrow(fold, schema).collect(), key=lambda r: r.shard)))
    return word_vectors(total)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the rows outside the held-out fold. The driver gets the vectors (200 MB of sums at most, 25 MB when rounded) and ``sample`` pooled vectors at most."""
    train = docs.select("doc_id", "text").filter(crc_mod("doc_id", FOLDS) != HELD)
    vectors = fit_vectors(train)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            pooled = [pool(t, shared.value, buckets).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("target"), pa.array(pooled, pa.binary())], names=["doc_id", "target", "x"])

    chosen = labelled_sample(labels, "quality", FOLDS, HELD, sample)
    rows = train.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "target")
    # one row a document: repeated rows would lift the bound; of different texts of one id the least vector counts, in any order
    found = sorted((r.doc_id, r.target, bytes(r.x)) for r in rows.mapInArrow(run, "doc_id long, target int, x binary").groupBy("doc_id").agg(F.min("target").alias("target"), F.min("x").alias("x")).collect())
    y = np.array([r[1] for r in found], np.float64)
    if len(set(y.tolist())) < 2:
        return Model(vectors, None, float(y.mean()) if len(y) else 0.5, shared)
    return Model(vectors, train_network(np.stack([np.frombuffer(r[2], np.float32) for r in found]).astype(np.float64), y), float(y.mean()), shared)


def _scorer(model: Model, docs: DataFrame):
    shared = model.shared or docs.sparkSession.sparkContext.broadcast(model.vectors)
    network, share, buckets = model.network, model.share, _Buckets()

    def scores(items: list[str]) -> np.ndarray:
        return scores_of(items, shared.value, network, share, buckets)

    return scores


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; a narrow map."""
    scores = _scorer(model, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scores(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", FOLDS, HELD).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents predicted to be of quality, with all their columns; a narrow map."""
    scores = _scorer(model, docs)
    return filter_texts(docs, lambda items: scores(items) >= THRESHOLD)
