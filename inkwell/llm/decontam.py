"""Benchmark decontamination by pigeonhole edit matching (operator 3).

Texts and test items are put in lower case with every run of non-alphanumerics as one space. An item of m characters may
differ by k = floor(ERROR_RATE * m) edits; it is cut into k + 1 pieces, one of which must occur unchanged in any passage
within k edits. An Aho-Corasick automaton finds piece hits in whole texts, and Myers' bit-parallel distance verifies
the text around each.

Items so short that no edit is allowed (fewer than 1 / ERROR_RATE characters) must occur as whole words, or "art" would
be found in "start".

Items go to the tasks in blocks of bounded size; every block is held against all documents.

Defined results: null and empty texts match nothing; items that are null or have no letter or digit match nothing; equal
items all match; repeated rows each give a row; extra columns are ignored; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_texts, hold, release, texts

ERROR_RATE = 0.06
#: Characters of items in one broadcast block.
BLOCK_CHARS = 8_000_000
_GAPS = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _GAPS.sub(" ", (text or "").lower()).strip()


def pieces(item: str, rate: float = ERROR_RATE) -> list[tuple[int, str]]:
    """The item cut into one piece more than it may have edits, with their places."""
    n = int(rate * len(item)) + 1
    cuts = [round(i * len(item) / n) for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def pattern_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def substring_distance(masks: dict[str, int], m: int, text: str, enough: int) -> int:
    """Myers: the least edit distance between the pattern and any substring of the text; stops at ``enough`` or less."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
                if best <= enough:
                    return best
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return best


class Matcher:
    """The items of one block, ready to be held against texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items = [(i, n) for i, n in ((i, normalise(t)) for i, t in items) if n]
        self.places: dict[str, list[tuple[int, int]]] = {}
        self.masks = [pattern_masks(n) for _, n in self.items]
        self.budget = [int(rate * len(n)) for _, n in self.items]
        for at, (_, n) in enumerate(self.items):
            if not self.budget[at]:
                self.places.setdefault(f" {n} ", []).append((at, 0))
            else:
                for start, piece in pieces(n, rate):
                    self.places.setdefault(piece, []).append((at, start + 1))  # the text gets a space ahead
        self.automaton = ahocorasick.Automaton()
        for piece in self.places:
            self.automaton.add_word(piece, piece)
        if self.places:
            self.automaton.make_automaton()

    def match(self, text: str) -> dict[int, int]:
        """Item ids in the text, with their least distances: 0 for an exact passage, else one within the budget."""
        text = normalise(text)
        found: dict[int, int] = {}
        if not self.places or not text:
            return found
        text = f" {text} "
        exact: set[int] = set()
        tried: set[tuple[int, int]] = set()
        for end, piece in self.automaton.iter(text):
            for at, start in self.places[piece]:
                if at in exact:
                    continue
                i, item = self.items[at]
                k = self.budget[at]
                if not k:
                    d = 0
                else:
                    first = end + 1 - len(piece) - (start - 1)
                    near = at, first // (k // 2 + 1)
                    if near in tried:
                        continue  # begins within k // 2 of a place whose window, below, went that far to either side
                    tried.add(near)
                    reach = k + k // 2 + 1
                    window = text[max(0, first - reach) : first + len(item) + reach]
                    d = 0 if item in window else substring_distance(self.masks[at], len(item), window, 0)
                if d <= k:
                    if not d:
                        exact.add(at)
                    found[i] = min(d, found.get(i, d))
        return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in order of id, in blocks of about BLOCK_CHARS; the driver holds one partition's share at a time."""
    block: list[tuple[int, str]] = []
    n = 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null and text is not null").orderBy("item_id").toLocalIterator():
        block.append((r.item_id, r.text))
        n += len(r.text)
        if n >= BLOCK_CHARS:
            yield block
            block, n = [], 0
    if block:
        yield block


class _Shared:
    """Broadcasts of blocks; those that a held table has used up are destroyed."""

    def __init__(self) -> None:
        self.live: list[Broadcast] = []
        self.table: DataFrame | None = None

    def matcher(self, docs: DataFrame, block: list[tuple[int, str]]):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        self.live.append(shared)
        made: list[Matcher] = []

        def matcher() -> Matcher:
            if not made:
                made.append(Matcher(shared.value))
            return made[0]

        return matcher

    def cut(self, rows: DataFrame, name: str) -> DataFrame:
        """Every fourth pass is held, so that plans stay short and the driver keeps few blocks."""
        if len(self.live) < 4:
            return rows
        out = hold(rows, name)
        for b in self.live:
            b.destroy()
        self.live = []
        if self.table is not None:
            release(self.table)
        self.table = out
        return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_ids (sorted), least_distance, contaminated for every document; one narrow pass per block of items.

    Every pass adds its findings to the row, so that nothing is shuffled.
    """
    none = F.array().cast("array<long>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), none.alias("item_ids"), F.lit(None).cast("long").alias("least_distance"))
    schema, shared = rows.schema, _Shared()
    for block in _blocks(benchmark):
        rows = shared.cut(rows, "matched")
        matcher = shared.matcher(docs, block)

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [matcher().match(t) for t in texts(batch)]
                ids = [sorted({*before, *f}) for before, f in zip(batch.column("item_ids").to_pylist(), found, strict=True)]
                least = [min([*f.values(), *([] if x is None else [x])], default=None) for x, f in zip(batch.column("least_distance").to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int64())), pa.array(least, pa.int64())], names=["doc_id", "text", "item_ids", "least_distance"])

        rows = rows.mapInArrow(run, schema)
    return rows.select("doc_id", F.size("item_ids").cast("long").alias("n_items"), "item_ids", "least_distance", (F.size("item_ids") > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a test item, with all their columns; one narrow pass per block of items."""
    out, shared = docs, _Shared()
    for block in _blocks(benchmark):
        out = shared.cut(out, "decontaminated")
        matcher = shared.matcher(docs, block)
        out = filter_texts(out, lambda items, matcher=matcher: [not matcher().match(t) for t in items])
    return out
