"""Language identification by spans (operator 10).

1. Letter trigrams of the whole training fold are counted per language (``corpus_sum``: every row, one fixed table).
2. The script ranges of a word leave only languages that use this script.
3. Every word has a score per language; Viterbi with a switching penalty labels the words, so that runs of one
   language become spans. The document's language is the one with most letters.

Any number of languages is learned: the model takes 128 KB for each, and what is held at once while texts are scored has
a bound of its own (long texts go through Viterbi in blocks of words, of which bits remain).

Defined results: null texts and texts without a letter are ``und`` with score 0; repeated rows each give a row; extra
columns are ignored; without training rows all are ``und``; a null id is never held out and never learned from; ties go
to the language first in order; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, corpus_sum, crc_mod, held_out, texts

FOLDS, HELD = 5, 0
TABLE = 1 << 15
#: Languages counted in one pass; more take more passes, so that a task's table has a bound whatever the column holds.
COUNTED = 128
#: Scores (words times languages) that are held at once.
HELD_SCORES = 4_000_000
SWITCH, SMOOTH = 12.0, 0.5
#: A language uses a script that makes up this share of its letters.
SCRIPT_SHARE = 0.02

#: Starts of ranges and their scripts; fixed values of the Unicode block layout.
SCRIPT_STARTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Other"),
    (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"),
    (0x3100, "Han"), (0x3130, "Hangul"), (0x31A0, "Han"), (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"),
    (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x33480, "Other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_STARTS))
_STARTS = np.array([x for x, _ in SCRIPT_STARTS])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
_LETTER = np.array([chr(i).isalpha() for i in range(0x33480)] + [False])


def letters(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the text in lower case: places of letters, first letters of words among those, trigram keys, scripts."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    is_letter = _LETTER[np.minimum(points, 0x33480)]
    at = np.flatnonzero(is_letter)
    if not len(at):
        return at, at, at, at
    own = np.where(is_letter, points, 0)
    before, after = np.concatenate(([0], own[:-1])), np.concatenate((own[1:], [0]))
    keys = (before[at] * 0x9E3779B1 + own[at] * 0x85EBCA77 + after[at] * 0xC2B2AE3D) & 0xFFFFFFFFFFFF
    keys = (keys ^ (keys >> 17) ^ (keys >> 31)) % TABLE
    starts = np.flatnonzero(before[at] == 0)
    return at, starts, keys, _SCRIPT[np.searchsorted(_STARTS, points[at], "right") - 1]


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # TABLE x languages, log-probabilities
    uses: np.ndarray  # scripts x languages, bool

    def words(self, lowered: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First places, letter counts, and scores per language of the words."""
        at, starts, keys, scripts = letters(lowered)
        if not len(at):
            return at, at, np.zeros((0, len(self.languages)), np.float32)
        return at[starts], np.diff(np.append(starts, len(at))), self.scored(keys, starts, scripts[starts])

    def scored(self, keys: np.ndarray, starts: np.ndarray, scripts: np.ndarray) -> np.ndarray:
        """Scores per language of words that begin at ``starts`` among the letters, in ``scripts``."""
        found = np.add.reduceat(self.scores[keys], starts, axis=0)
        fits = self.uses[scripts]
        fits |= ~fits.any(1, keepdims=True)
        return np.where(fits, found, np.float32(-1e6))


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Labels of the words of several documents at once; ``sizes``: words per document, in order, none 0.

    All documents take a step together; those that have ended drop out.
    """
    order = np.argsort(-sizes, kind="stable")
    firsts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    labels = np.zeros(len(scores), np.int32)
    switch_to = np.zeros(len(scores), np.int32)
    switched = np.zeros(scores.shape, bool)
    best = scores[firsts].astype(np.float64)
    live = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), "right")  # documents of more than t words
    for t in range(1, int(sizes[0])):
        n = live[t]
        rows, now = firsts[:n] + t, best[:n]
        top = now.argmax(1)
        moved = np.take_along_axis(now, top[:, None], 1) - penalty
        switch = moved > now
        switched[rows], switch_to[rows] = switch, top
        best[:n] = np.where(switch, moved, now) + scores[rows]
    state = best.argmax(1).astype(np.int32)
    for t in range(int(sizes[0]) - 1, -1, -1):
        n = live[t]
        rows, now = firsts[:n] + t, state[:n]
        labels[rows] = now
        if t:
            state[:n] = np.where(switched[rows, now], switch_to[rows], now)
    return labels


def viterbi_blocks(blocks: Iterator[np.ndarray], penalty: float = SWITCH) -> np.ndarray:
    """The same for one document whose scores come in blocks of words: only a bit per word and language is kept."""
    best: np.ndarray | None = None
    bits: list[np.ndarray] = []
    switch_to: list[np.ndarray] = []
    for block in blocks:
        switched, to = np.zeros(block.shape, bool), np.zeros(len(block), np.int32)
        for t, row in enumerate(block.astype(np.float64)):
            if best is None:
                best = row
                continue
            top = int(best.argmax())
            moved = best[top] - penalty
            switched[t], to[t] = moved > best, top
            best = np.maximum(best, moved) + row
        bits.append(np.packbits(switched, axis=1))
        switch_to.append(to)
    state = int(best.argmax())
    labels: list[np.ndarray] = []
    for packed, to in zip(reversed(bits), reversed(switch_to), strict=True):
        own = np.zeros(len(to), np.int32)
        for t in range(len(to) - 1, -1, -1):
            own[t] = state
            if packed[t, state >> 3] >> (7 - (state & 7)) & 1:
                state = int(to[t])
        labels.append(own)
    return np.concatenate(labels[::-1])


def _label_long(lowered: str, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, starts, keys, scripts = letters(lowered)
    ends = np.append(starts[1:], len(at))
    step = max(1, HELD_SCORES // len(model.languages) // 8)  # words have several letters, whose scores are gathered first

    def blocks() -> Iterator[np.ndarray]:
        for i in range(0, len(starts), step):
            a, b = starts[i], ends[min(i + step, len(starts)) - 1]
            yield model.scored(keys[a:b], starts[i : i + step] - a, scripts[starts[i : i + step]])

    return at[starts], ends - starts, viterbi_blocks(blocks())


def label_texts(items: list[str], model: Model) -> list[tuple[np.ndarray, np.ndarray, np.ndarray] | None]:
    """Per text the words' (place, letters, label); None without a letter. Places are those of the text in lower case."""
    out: list = [None] * len(items)
    if not model.languages:
        return out
    order = sorted(range(len(items)), key=lambda i: len(items[i]))  # alike lengths together
    limit = min(500_000, max(1000, HELD_SCORES // len(model.languages)))  # a word and its score vector for every two characters at most
    for a, b in chunks([items[i] for i in order], limit):
        if b - a == 1 and len(items[order[a]]) > limit:
            lowered = items[order[a]].lower()
            if len(letters(lowered)[0]):
                out[order[a]] = _label_long(lowered, model)
            continue
        found = [(i, model.words(items[i].lower())) for i in order[a:b]]
        found = [(i, w) for i, w in found if len(w[0])]
        if not found:
            continue
        sizes = np.array([len(w[0]) for _, w in found])
        labels = np.split(viterbi(np.concatenate([w[2] for _, w in found]), sizes), np.cumsum(sizes)[:-1])
        for (i, w), own in zip(found, labels, strict=True):
            out[i] = (w[0], w[1], own)
    return out


def predict_texts(items: list[str], model: Model) -> list[tuple[str, float]]:
    out = []
    for found in label_texts(items, model):
        if found is None:
            out.append(("und", 0.0))
        else:
            share = np.bincount(found[2], found[1], len(model.languages))
            out.append((model.languages[int(share.argmax())], float(share.max() / share.sum())))
    return out


def text_spans(text: str, model: Model) -> list[tuple[int, int, str]]:
    """(first place, place after the last letter, language) of the spans of one language, in order."""
    found = label_texts([text], model)[0]
    if found is None:
        return []
    spans: list[tuple[int, int, str]] = []
    for at, n, label in zip(*(x.tolist() for x in found), strict=True):
        name = model.languages[label]
        if spans and spans[-1][2] == name:
            spans[-1] = (spans[-1][0], at + n, name)
        else:
            spans.append((at, at + n, name))
    return spans


def fit(docs: DataFrame) -> Model:
    """Learn from text and lang of the rows outside the held-out fold, all of them."""
    train = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").filter((crc_mod("doc_id", FOLDS) != HELD) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(r.lang for r in train.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((TABLE, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    scores, uses = np.zeros((TABLE, len(languages)), np.float32), np.zeros((len(SCRIPTS), len(languages)), bool)
    totals, common = np.zeros(len(languages)), np.zeros(TABLE)
    for a in range(0, len(languages), COUNTED):
        part = languages[a : a + COUNTED]
        rows = train if len(part) == len(languages) else train.filter(F.col("lang").isin(part))
        table = _count(rows.select("text", "lang"), part)
        trigrams, scripts = table[:, :TABLE], table[:, TABLE:]
        scores[:, a : a + COUNTED] = trigrams.T  # whole numbers, exact to 2 ** 24 and within 1e-7 beyond
        totals[a : a + COUNTED] = trigrams.sum(1)
        common += ((trigrams + 1e-9) / (trigrams.sum(1, keepdims=True) + 1e-9 * TABLE)).sum(0)
        uses[:, a : a + COUNTED] = (scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(1, keepdims=True))).T
    # every language is smoothed towards the mean of all
    common = common / len(languages) + 1e-7
    for i in range(len(languages)):
        scores[:, i] = np.log((scores[:, i].astype(np.float64) + SMOOTH * TABLE * common / 50) / (totals[i] + SMOOTH * TABLE / 50 * common.sum()))
    return Model(languages, scores, uses)


def _count(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Trigrams and scripts per language, a row each."""
    number, width = {x: i for i, x in enumerate(languages)}, TABLE + len(SCRIPTS)

    def fill(batch: pa.RecordBatch, table: np.ndarray) -> None:
        by: dict[str, list[str]] = {}
        for text, lang in zip(texts(batch), batch.column("lang").to_pylist(), strict=True):
            by.setdefault(lang, []).append(text)
        for lang, items in by.items():
            own = table[number[lang] * width : (number[lang] + 1) * width]
            for a, b in chunks(items, 500_000):
                _, _, keys, scripts = letters("\n".join(items[a:b]).lower())
                own[:TABLE] += np.bincount(keys, minlength=TABLE)
                own[TABLE:] += np.bincount(scripts, minlength=len(SCRIPTS))

    return corpus_sum(rows, fill, width * len(languages)).reshape(len(languages), width)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; a narrow map."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = predict_texts(texts(batch), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", FOLDS, HELD).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, spans: the spans of each text, places counted in the text in lower case."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"start": a, "end": b, "lang": x} for a, b, x in text_spans(t, shared.value)] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, spans array<struct<start:int,end:int,lang:string>>")
