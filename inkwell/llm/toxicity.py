"""Toxicity by noisy-channel deobfuscation (operator 8).

1. A character trigram model over the words of the whole training fold (``corpus_sum``: every row, one fixed table).
2. Spans that look disguised (letters mixed with look-alike digits and signs, letters spaced out, letters repeated)
   are lattices of possible readings; Viterbi picks the likeliest under the model and the channel's costs.
3. Words and word beginnings of the labelled sample become a lexicon where they occur in toxic documents far above
   the base rate, after many different words (copies of one text are evidence once). Restored text is scored by the
   lexicon entries it holds and by the mean log-likelihood ratio of all its counted features; a logistic calibration on
   labelled rows set aside makes the score a probability.

Defined results: null, empty and wordless texts score as texts without any feature; repeated rows each give a row; extra
columns are ignored; with no labelled rows, or labels of one kind only, the lexicon is empty and all scores are low;
a null id is never held out and never learned from; texts are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, corpus_sum, crc_mod, filter_texts, held_out, hold, labelled_sample, release, texts, utf16_units

FOLDS, HELD = 4, 2
#: Labelled documents that the lexicon is fitted on, at most.
SAMPLE = 40_000
THRESHOLD = 0.3
#: An entry needs this log-likelihood ratio against the base rate, and this share of toxic among its documents.
MIN_EVIDENCE, MIN_PRECISION = 14.0, 0.6
PREFIXES = (4, 5, 6)
LETTERS = 28  # boundary, a-z, any other letter

#: What a sign may stand for, besides nothing.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SIGN_COST, DROP_COST, DOUBLE_COST = 1.0, 9.0, 1.5
#: Longer spans are decoded each time, so that the memory of those seen has a bound.
LONGEST_KEPT = 64
_SIGNS = "".join(re.escape(c) for c in LOOKALIKES)
_L = r"[^\W\d_]"
#: Disguises by signs: signs within letters; a sign before letters; letters spaced out. Every attempt begins behind a
#: boundary, so the search is linear. Letters repeated three times or more are found by ``triples``.
DISGUISED = re.compile(
    rf"(?<![^\s.,;:?'\"-])(?:{_L}+(?:[{_SIGNS}]{{1,2}}{_L}+)+|[{_SIGNS}]{{1,2}}{_L}+(?:[{_SIGNS}]{{1,2}}{_L}+)*)(?:[{_SIGNS}]{{1,2}})?(?![^\s.,;:?!'\"-])"
    rf"|(?<![^\s])(?:{_L}|[{_SIGNS}])(?:[ .\-_*](?:{_L}|[{_SIGNS}])){{3,}}(?![^\s.,;:?!])"
)
_WORDS = re.compile(rf"{_L}+")
#: Of ASCII characters: 1 letters, 2 signs. Others are letters, as far as finding suspicious lines goes, or signs.
_KIND = np.array([("a" <= chr(i) <= "z") + 2 * (chr(i) in LOOKALIKES) for i in range(129)], np.uint8)
_ODD_SIGNS = np.array([ord(c) for c in LOOKALIKES if ord(c) >= 128], np.uint32)
#: The same of all Latin-1, and Latin-1 with spaces for what is no letter.
_LATIN_KINDS = bytes(int(_KIND[i]) if i < 128 else 2 if i in _ODD_SIGNS else 1 for i in range(256))
_LATIN_LETTERS = bytes(i if _WORDS.fullmatch(chr(i)) else 32 for i in range(256))
#: What is remembered of words seen, at most, in each process.
WORDS_KEPT = 300_000


@cache
def _letters() -> np.ndarray:
    """Of each 16-bit code unit, whether it is a letter."""
    return np.array([bool(_WORDS.fullmatch(chr(i))) for i in range(1 << 16)])


def words_of(lowered: str) -> list[str]:
    """The runs of letters, in order: split at what is no letter by tables, but in texts with characters beyond 16 bits."""
    try:
        return lowered.encode("latin-1").translate(_LATIN_LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        units = utf16_units(lowered)
        if units is None:
            return _WORDS.findall(lowered)
        return np.where(_letters()[units], units, np.uint16(32)).tobytes().decode("utf-16-le").split()


def _codes(text: str) -> np.ndarray:
    """0 for what is no letter, 1 to 26 for a-z, 27 for other letters."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(len(points), np.int64)
    small = (points >= 97) & (points <= 122)
    out[small] = points[small] - 96
    odd = np.flatnonzero(points >= 128)
    if len(odd):
        kinds, back = np.unique(points[odd], return_inverse=True)
        out[odd] = np.array([27 if chr(p).isalpha() else 0 for p in kinds.tolist()], np.int64)[back]
    return out


def count_trigrams(text: str, counts: np.ndarray) -> None:
    """Add the letter trigrams of the words, with a boundary on either side."""
    c = np.concatenate(([0, 0], _codes(text.lower()), [0]))
    keys = (c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:]
    keys = keys[(c[1:-1] > 0) | (c[2:] > 0)]
    keys[(keys // LETTERS) % LETTERS == 0] %= LETTERS  # what stands before a boundary doesn't count
    counts += np.bincount(keys, minlength=len(counts))


def language_model(counts: np.ndarray) -> np.ndarray:
    """Costs -log p(c | a, b), backed off to -log p(c | b), as a table a, b, c."""
    n3 = counts.reshape(LETTERS, LETTERS, LETTERS)
    n2 = n3.sum(0)
    p2 = (n2 + 0.1) / (n2.sum(1, keepdims=True) + 0.1 * LETTERS)
    p3 = (n3 + 5 * p2[None]) / (n3.sum(2, keepdims=True) + 5)
    return -np.log(p3)


def _code(ch: str) -> int:
    o = ord(ch)
    return o - 96 if 97 <= o <= 122 else 27 if ch.isalpha() else 0


def _runs(span: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of one character: code points, lengths, and whether they are letters."""
    points = np.frombuffer(span.encode("utf-32-le", "replace"), np.uint32)
    starts = np.flatnonzero(np.concatenate(([True], points[1:] != points[:-1])))
    kinds, back = np.unique(points[starts], return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in kinds.tolist()], bool)[back]
    return points[starts], np.diff(np.append(starts, len(points))), letter


def _options(ch: str, n: int, letter: bool, spaced: bool, last: bool) -> list[tuple[str, float]]:
    """What a run of ``n`` times ``ch`` may stand for, and the channel's costs."""
    if letter:
        return [(ch * n, 0.0)] if n < 2 else [(ch, 0.0 if n > 2 else DOUBLE_COST), (ch * 2, 0.5 if n > 2 else 0.0)]
    spare = ch in "!|" and last  # an exclamation mark rather than a letter
    meant = LOOKALIKES.get(ch, "")
    dropped = 0.1 if spaced and ch in " .-_*" else DROP_COST if meant and not spare else 1.0
    return [("", dropped)] + [(x, SIGN_COST) for x in meant] + [(x * 2, SIGN_COST + 1) for x in meant if n > 1]


def decode(span: str, costs: list[list[list[float]]]) -> str:
    """The likeliest word behind a disguised span. The states are the last two letters chosen.

    After two single letters every path is in the same state, so stretches of these stand as they are, and only the runs
    between them are searched: time and memory grow in proportion to the span, with a small factor for its plain part.
    """
    span = span.lower()
    if not span:
        return ""
    spaced = bool(re.match(r".[ .\-_*].[ .\-_*]", span))
    points, sizes, letter = _runs(span)
    places = np.concatenate(([0], np.cumsum(sizes)))
    open_runs = np.flatnonzero(~letter | (sizes > 1))
    if not len(open_runs):
        return span
    out: list[str] = []
    at = 0  # the first run that isn't written yet
    for part in np.split(open_runs, np.flatnonzero(np.diff(open_runs) > 2) + 1):
        first, last = int(part[0]), int(part[-1])
        out.append(span[places[at] : places[first]])
        before = [_code(c) for c in span[places[max(0, first - 2)] : places[first]]][-2:]
        start = tuple([0, 0, *before][-2:])
        after = min(last + 3, len(points))  # two single letters, or the end
        states: dict[tuple[int, int], float] = {start: 0.0}
        back: list[dict[tuple[int, int], tuple[tuple[int, int], str]]] = []
        for i in range(first, after):
            options = _options(chr(points[i]), int(sizes[i]), bool(letter[i]), spaced, i == len(points) - 1)
            best: dict[tuple[int, int], float] = {}
            came: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
            for (a, b), cost in states.items():
                for letters, extra in options:
                    x, y, total = a, b, cost + extra
                    for z in map(_code, letters):
                        total += costs[x][y][z]
                        x, y = y, z
                    if (x, y) not in best or total < best[x, y]:
                        best[x, y], came[x, y] = total, ((a, b), letters)
            states = best
            back.append(came)
        end = after == len(points)
        state = min(states, key=lambda s: states[s] + (costs[s[0]][s[1]][0] if end else 0.0))
        chosen: list[str] = []
        for came in reversed(back):
            state, letters = came[state]
            chosen.append(letters)
        out += reversed(chosen)
        at = after
    out.append(span[places[at] :])
    return "".join(out)


def _points(lowered: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, and which of them may be letters and signs."""
    try:
        latin = lowered.encode("latin-1")
        kind = np.frombuffer(latin.translate(_LATIN_KINDS), np.uint8)
        return np.frombuffer(latin, np.uint8), (kind & 1) > 0, (kind & 2) > 0
    except UnicodeEncodeError:
        pass
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)
    kind = _KIND[np.minimum(points, 128)]
    odd = points >= 128
    if odd.any():
        kind[odd] = np.where(np.isin(points[odd], _ODD_SIGNS), 2, 1)
    return points, (kind & 1) > 0, (kind & 2) > 0


def _lines(lowered: str, places: np.ndarray) -> list[tuple[int, int]]:
    """The lines that hold any of the places."""
    out: list[tuple[int, int]] = []
    i = 0
    while i < len(places):
        x = int(places[i])
        end = lowered.find("\n", x)
        out.append((lowered.rfind("\n", 0, x) + 1, end if end >= 0 else len(lowered)))
        i = int(np.searchsorted(places, out[-1][1], "left"))
    return out


def suspicious_lines(lowered: str, seen: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int]]:
    """The lines that may hold a disguise by signs, by what the alternatives of DISGUISED need; no disguise spans lines.

    ``seen``: what ``_points`` gives, if at hand.
    """
    points, letter, sign = seen or _points(lowered)
    if len(points) < 2:
        return []
    places = [np.flatnonzero(sign[:-1] & letter[1:])]
    alone = (letter | sign)[:-1] & ~letter[1:]  # then a separator
    places.append(np.flatnonzero(alone[:-4] & alone[2:-2] & alone[4:]))
    return _lines(lowered, np.unique(np.concatenate(places)))


def triples(lowered: str, seen: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int]]:
    """The words (runs of letters) with a letter three times in a row."""
    points, letter, _ = seen or _points(lowered)
    if len(points) < 3:
        return []
    same = np.concatenate(([False], points[1:] == points[:-1]))
    places = np.flatnonzero(same[1:-1] & same[2:] & ~same[:-2] & letter[2:])  # the first of each run
    out: list[tuple[int, int]] = []
    for start, end in _lines(lowered, places):
        mine = places[np.searchsorted(places, start) : np.searchsorted(places, end)]
        i = 0
        for m in _WORDS.finditer(lowered, start, end):
            while i < len(mine) and mine[i] < m.start():
                i += 1  # a run of what is no letter
            if i == len(mine):
                break
            if mine[i] < m.end():
                out.append(m.span())
                i = int(np.searchsorted(mine, m.end()))
    return out


class _Bits(dict):
    """Of 64 bits, the one of a word."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = bit = 1 << (zlib.crc32(word.encode("utf-8", "replace")) & 63)
        return bit


@dataclass
class Restorer:
    """Restores texts; remembers the spans it has seen, up to a bound on memory."""

    costs: list[list[list[float]]]
    seen: dict[str, str] = field(default_factory=dict)
    bits: _Bits = field(default_factory=_Bits)

    def spans(self, lowered: str) -> list[tuple[int, int, str]]:
        """(start, end, restored) of the disguised spans, in order; where two begin at one place, that by signs."""
        seen = _points(lowered)
        found = [m.span() for a, b in suspicious_lines(lowered, seen) for m in DISGUISED.finditer(lowered, a, b)]
        repeated = triples(lowered, seen)
        if repeated:
            found = sorted([(a, 0, b) for a, b in found] + [(a, 1, b) for a, b in repeated])
            found = [(a, b) for a, _, b in found]
        out: list[tuple[int, int, str]] = []
        for a, b in found:
            if not out or a >= out[-1][1]:
                out.append((a, b, self._read(lowered[a:b])))
        return out

    def _read(self, span: str) -> str:
        if len(span) > LONGEST_KEPT:
            return decode(span, self.costs)
        if span not in self.seen:
            if len(self.seen) > 200_000:
                self.seen.clear()
            self.seen[span] = decode(span, self.costs)
        return self.seen[span]

    def restore(self, text: str) -> str:
        lowered, out, at = text.lower(), [], 0
        for start, end, word in self.spans(lowered):
            out += [lowered[at:start], word]
            at = end
        return "".join([*out, lowered[at:]])

    def words(self, text: str) -> set[str]:
        """The words of the restored text; of disguised spans the plain readings too."""
        lowered = text.lower()
        found = set(words_of(lowered))
        for _, _, word in self.spans(lowered):
            found.update(words_of(word))
        return found

    def contexts(self, text: str) -> dict[str, int]:
        """The same words, each with a bit set for the word before every occurrence."""
        lowered, found, bit = text.lower(), {}, self.bits[""]
        for w in words_of(lowered):
            found[w] = found.get(w, 0) | bit
            bit = self.bits[w]
        for start, _, word in self.spans(lowered):
            bit = self.bits[lowered[max(0, start - 8) : start]]
            for w in words_of(word):
                found[w] = found.get(w, 0) | bit
        return found


def features(word: str) -> tuple[str, ...]:
    """The word, and its beginnings, marked by ``*``."""
    return (word, *(word[:n] + "*" for n in PREFIXES if len(word) > n))


class _Features(dict):
    """The features of a word that are wanted (None: all)."""

    def __init__(self, wanted: Collection[str] | None) -> None:
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = found = tuple(f for f in features(word) if self.wanted is None or f in self.wanted)
        return found


class _Numbers(dict):
    """Of each word the row in ``table``: the numbers of its features, -1 where they have none."""

    def __init__(self, numbers: dict[str, int]) -> None:
        self.table = array("i")
        self.whole = {f: i for f, i in numbers.items() if not f.endswith("*")}
        self.starts = [(n, {f[:-1]: i for f, i in numbers.items() if f.endswith("*") and len(f) == n + 1}) for n in PREFIXES]

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        size = len(word)
        self.table.append(self.whole.get(word, -1))
        self.table.extend([numbers.get(word[:n], -1) if size > n else -1 for n, numbers in self.starts])
        return row

    def of(self, words: Collection[str]) -> np.ndarray:
        """The numbers of the features of the words, each once, in order."""
        if len(self) > WORDS_KEPT:
            self.clear()
            del self.table[:]
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        found = np.unique(np.frombuffer(self.table, np.int32).reshape(-1, 1 + len(PREFIXES))[rows])
        return found[np.searchsorted(found, 0) :]


@dataclass
class Model:
    """``lexicon``: entries and their share of toxic; ``weights``: log-likelihood ratios of all counted features;
    ``calibration``: bias and factors of the two, fitted on rows set aside."""

    costs: list[list[list[float]]]
    lexicon: dict[str, float]
    base: float
    weights: dict[str, float] = field(default_factory=dict)
    calibration: tuple[float, float, float] = (0.0, 1.0, 1.0)

    @cached_property
    def _tables(self) -> tuple[_Numbers, np.ndarray, np.ndarray]:
        """Numbers of the features known, and by number shares of toxic and weights, nan where there are none."""
        known = sorted(self.lexicon.keys() | self.weights.keys())
        by_number = lambda values: np.array([values.get(f, math.nan) for f in known])
        return _Numbers({f: i for i, f in enumerate(known)}), by_number(self.lexicon), by_number(self.weights)

    def evidence(self, words: set[str]) -> tuple[float, float]:
        """Log-odds by the lexicon, and the mean weight of the features."""
        numbers, shares, weights = self._tables
        found = numbers.of(words)
        hits = shares[found]
        hits = hits[~np.isnan(hits)].tolist()
        p = 1 - (1 - max(hits)) / (1 + 0.1 * (len(hits) - 1)) if hits else min(0.29, self.base / 4)
        p = min(max(p, 1e-4), 1 - 1e-4)
        known = weights[found]
        known = known[~np.isnan(known)]
        return math.log(p / (1 - p)), float(known.mean()) if len(known) else 0.0  # by number: sums don't depend on the order of sets

    def score(self, words: set[str]) -> float:
        a, b = self.evidence(words)
        bias, by_lexicon, by_weights = self.calibration
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, bias + by_lexicon * a + by_weights * b))))


def calibrate(x: np.ndarray, y: np.ndarray, prior: tuple[float, ...] = (0.0, 1.0, 1.0), strength: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton's steps, drawn to ``prior``: without rows it is the prior. x has a first column of ones."""
    start = np.array(prior)
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + strength * (w - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def distinct_contexts(mask: int) -> float:
    """Of how many different words the 64 bits tell, by linear counting; all bits set: 64 or more."""
    free = 64 - (mask & 0xFFFFFFFFFFFFFFFF).bit_count()
    return 64 * math.log(64 / free) if free else math.inf


def _count_features(docs: DataFrame, costs: list, wanted: set[str] | None) -> DataFrame:
    """(feature, n, mask, n_fit, mask_fit): documents that hold it and its contexts, of all rows and of those not set aside.

    Added up within each task; of the wanted features only, if given.
    """
    shared = docs.sparkSession.sparkContext.broadcast((costs, wanted))
    names = ["feature", "n", "mask", "n_fit", "mask_fit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, wanted = shared.value
        restorer, counts, known = Restorer(costs), {}, _Features(wanted)

        def emit() -> pa.RecordBatch:
            n, masks, n_fit, masks_fit = zip(*counts.values(), strict=True)
            signed = lambda m: pa.array(np.array(m, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(n, pa.int64()), signed(masks), pa.array(n_fit, pa.int64()), signed(masks_fit)], names=names)

        for batch in batches:
            for text, aside in zip(texts(batch), batch.column("aside").to_pylist(), strict=True):
                own: dict[str, int] = {}
                for word, mask in restorer.contexts(text).items():
                    for f in known[word]:
                        own[f] = own.get(f, 0) | mask
                for f, mask in own.items():
                    n, before, n_fit, before_fit = counts.get(f, (0, 0, 0, 0))
                    counts[f] = (n + 1, before | mask, n_fit, before_fit) if aside else (n + 1, before | mask, n_fit + 1, before_fit | mask)
            if len(counts) > 500_000:
                yield emit()
                counts.clear()
        if counts:
            yield emit()

    rows = docs.select(F.col("text").cast("string").alias("text"), "aside").mapInArrow(run, "feature string, n long, mask long, n_fit long, mask_fit long")
    return rows.groupBy("feature").agg(F.sum("n").alias("n"), F.bit_or("mask").alias("mask"), F.sum("n_fit").alias("n_fit"), F.bit_or("mask_fit").alias("mask_fit"))


def fit_language_model(docs: DataFrame) -> np.ndarray:
    def fill(batch: pa.RecordBatch, counts: np.ndarray) -> None:
        items = texts(batch)
        for a, b in chunks(items, 500_000):
            count_trigrams("\n".join(items[a:b]), counts)

    return language_model(corpus_sum(docs.select(F.col("text").cast("string").alias("text")), fill, LETTERS**3))


def _without_loose(lexicon: dict[str, float], evidence: dict[str, float]) -> dict[str, float]:
    """Leave out beginnings of which one surer continuation has most of the evidence: what else begins so isn't toxic."""
    loose = set()
    for f, p in lexicon.items():
        for n in PREFIXES:
            start = f[:n] + "*"
            if start != f and len(f) > n and lexicon.get(start, 1) + 0.01 < p and 2 * evidence[f] >= evidence[start]:
                loose.add(start)
    return {f: p for f, p in lexicon.items() if f not in loose}


def make_model(costs: list, toxic: dict[str, tuple[int, int]], clean: dict[str, int], n1: int, n0: int) -> Model:
    """From each feature's toxic documents and contexts, its clean documents, and the numbers of documents."""
    base = n1 / (n1 + n0)
    least = least_documents(base)
    evidence = {f: t for f, (n, mask) in toxic.items() if (t := min(n, distinct_contexts(mask))) >= least}
    lexicon = {}
    for f, t in evidence.items():
        c = clean.get(f, 0)
        p = t / (t + c)
        if p > base and t * math.log(p / base) + (c * math.log((1 - p) / (1 - base)) if c else 0) >= MIN_EVIDENCE:
            smooth = (t + base) / (t + c + 1)
            if smooth >= MIN_PRECISION:
                lexicon[f] = smooth
    weights = {f: max(-3.0, min(3.0, math.log((n + 1) / (n1 + 2)) - math.log((clean.get(f, 0) + 1) / (n0 + 2)))) for f, (n, _) in toxic.items() if n}
    return Model(costs, _without_loose(lexicon, evidence), base, weights)


def least_documents(base: float) -> int:
    return max(2, math.floor(MIN_EVIDENCE / -math.log(base)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the rows outside the held-out fold.

    Every fifth labelled document is set aside: a model of the others is calibrated on it, and the model of all takes
    that calibration. What reaches the driver: one model table, features with enough documents, two numbers for each row
    set aside (a fifth of ``sample`` at most, copies of an id apart).
    """
    train = docs.select("doc_id", "text").filter(crc_mod("doc_id", FOLDS) != HELD)
    costs = fit_language_model(train).tolist()
    chosen = labelled_sample(labels, "toxic", FOLDS, HELD, sample)
    rows = train.join(F.broadcast(chosen), "doc_id").withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)) == 4)  # at most `sample` ids
    totals = {(r.target, r.aside): r.n for r in rows.groupBy("target", "aside").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = lambda target, *parts: sum(totals.get((target, x), 0) for x in parts)
    n1, n0 = of(1, False, True), of(0, False, True)
    if not n1 or not n0:
        return Model(costs, {}, 0.0)
    least = least_documents(n1 / (n1 + n0))
    counted = hold(_count_features(rows.filter("target = 1"), costs, None).filter(F.col("n") >= least), "toxic-features")
    # at most sample * words / least features; their counts in the other documents decide
    toxic = {r.feature: r for r in counted.toLocalIterator()}
    release(counted)
    clean = {r.feature: r for r in _count_features(rows.filter("target = 0"), costs, set(toxic)).toLocalIterator()}
    model = make_model(costs, {f: (r.n, r.mask) for f, r in toxic.items()}, {f: r.n for f, r in clean.items()}, n1, n0)
    if of(1, False) and of(0, False):
        part = make_model(costs, {f: (r.n_fit, r.mask_fit) for f, r in toxic.items()}, {f: r.n_fit for f, r in clean.items()}, of(1, False), of(0, False))
        model.calibration = _calibration(rows.filter("aside"), part)
    return model


def _calibration(rows: DataFrame, model: Model) -> tuple[float, ...]:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value.costs)
        for batch in batches:
            found = [shared.value.evidence(restorer.words(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("target"), pa.array([a for a, _ in found], pa.float64()), pa.array([b for _, b in found], pa.float64())], names=["target", "a", "b"])

    plain = rows.select(F.col("text").cast("string").alias("text"), "target").mapInArrow(run, "target int, a double, b double")
    # equal pairs are counted, so that repeated rows add no bulk, and sorted, so that sums agree between runs
    found = sorted((r.target, r.a, r.b, r.n) for r in plain.groupBy("target", "a", "b").agg(F.count(F.lit(1)).alias("n")).collect())
    x = np.array([(1.0, a, b) for _, a, b, _ in found]).reshape(-1, 3)
    y, n = np.array([float(t) for t, *_ in found]), np.array([float(k) for *_, k in found])
    weight = np.minimum(n, 5.0)  # a text that is repeated many times is evidence a few times
    return calibrate(np.repeat(x, weight.astype(int), 0), np.repeat(y, weight.astype(int)))


def _scorer(model: Model, docs: DataFrame):
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made: list[Restorer] = []

    def scores(items: list[str]) -> np.ndarray:
        if not made:
            made.append(Restorer(shared.value.costs))
        return np.array([shared.value.score(made[0].words(t)) for t in items], np.float64)

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


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns; a narrow map."""
    scores = _scorer(model, docs)
    return filter_texts(docs, lambda items: scores(items) < THRESHOLD)
