"""Quality rules by repetition coverage (operator 2).

Defined results: null and empty texts have no words, so all counts are 0 and the base rules fail; repeated rows
each give their own row; extra columns are ignored; an empty table gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

SPACES, SYMBOLS = "\x20\x09\x0a\x0b\x0c\x0d", "#*$%&|<>"
#: Largest share of a text's word characters that may lie in second and later copies of n-grams of n words.
NGRAM_LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
#: The same for lines equal to an earlier line, by characters and by count.
LINE_CHARS_LIMIT, LINES_LIMIT = 0.30, 0.50
MIN_WORDS = 50
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_share double, dup_line_char_share double, " + ", ".join(f"dup_{n}gram_share double" for n in NGRAM_LIMITS) + ", base_failed boolean, kept boolean"
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _covered(repeated: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``n`` words that starts where ``repeated`` is set."""
    edges = np.zeros(total + 1, np.int32)
    starts = np.flatnonzero(repeated)
    edges[starts] += 1
    np.subtract.at(edges, starts + n, 1)
    return np.cumsum(edges[:-1]) > 0


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Where a key occurs twice or more, and where it occurred before; None if all differ."""
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    if not equal.any():
        return None
    every, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][equal]] = True
    every[order[1:][equal]] = True
    every[order[:-1][equal]] = True
    return every, later


def measure(text: str | None) -> dict[str, float]:
    """All counts and shares of one text."""
    text = text or ""
    words = text.encode().split()  # bytes split at the six ASCII white-space characters
    n = len(words)
    out: dict[str, float] = {f"dup_{k}gram_share": 0.0 for k in NGRAM_LIMITS}
    out |= {"n_words": n, "word_chars": len(text) - sum(map(text.count, SPACES)), "n_symbols": sum(map(text.count, SYMBOLS)), "n_repeat_words": 0}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    seen: set[str] = set()
    dup_chars = 0
    if len(set(lines)) < len(lines):
        for x in lines:
            dup_chars += len(x) * (x in seen)
            seen.add(x)
    out["n_dup_lines"] = len(lines) - len(set(lines))
    out["dup_line_share"] = out["n_dup_lines"] / max(1, len(lines))
    out["dup_line_char_share"] = dup_chars / max(1, sum(map(len, lines)))
    if n < 3:
        return out
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 21:  # three numbers would not fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    found = _repeats(pairs[:-1] * len(number) + ids[2:])
    if found is None:  # then no longer n-gram repeats either
        return out
    out["n_repeat_words"] = int(_covered(found[0], 3, n).sum())
    size = np.fromiter((len(w.decode()) for w in words), np.int64, n)
    total = max(1, size.sum())
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    rolling = mixed
    for k in range(2, max(NGRAM_LIMITS) + 1):
        if k > n:
            break
        rolling = rolling[:-1] * _MULTIPLIER + mixed[k - 1 :]
        if k in NGRAM_LIMITS:
            found = _repeats(rolling)
            if found is None:
                break
            out[f"dup_{k}gram_share"] = float(size[_covered(found[1], k, n)].sum() / total)
    return out


def judge(m: dict[str, float]) -> tuple[bool, bool]:
    """(base_failed, kept)."""
    failed = m["n_words"] < MIN_WORDS or 100 * m["n_repeat_words"] > 50 * m["n_words"]
    repeats = m["dup_line_share"] > LINES_LIMIT or m["dup_line_char_share"] > LINE_CHARS_LIMIT or any(m[f"dup_{k}gram_share"] > x for k, x in NGRAM_LIMITS.items())
    return failed, not failed and not repeats


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, shares and verdict; a narrow map without a shuffle."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts(batch):
                m = measure(text)
                m["base_failed"], m["kept"] = judge(m)
                rows.append(m)
            columns = [batch.column("doc_id")]
            for name, kind in (x.split() for x in SCHEMA.split(", ")[1:]):
                columns.append(pa.array([r[name] for r in rows], {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind]))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
