"""Operators on documents, against brute force and on odd tables."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from inkwell.llm import decontam, langid, licenses, mixing, quality, repetition, simhash, toxicity
from inkwell.llm.common import crc_mod

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, predicted string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977} the and of" for i in range(20_000))
    texts = [None, "", "   \n\t", "one", "A b\u00a0c\u0085d e", "la la la la la la", long, "é" * 300, "idi0t !!! $$$ \U0001f600", "Ping pong\nPing pong\nPing pong"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, 1, 0.0, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[5], (None, "null id here", "fr", "s", 1, None, None, None, None)]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(12)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


# --- repetition -----------------------------------------------------------------------------------------------------


def brute_repetition(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_repetition_equals_brute_force(odd):
    got = {(r.doc_id, r.n_words): r for r in repetition.repetition_rules(odd).collect()}
    rows = odd.select("doc_id", "text").collect()
    assert repetition.repetition_rules(odd).count() == len(rows)
    for r in rows:
        b = brute_repetition(r.text)
        g = got[r.doc_id, b[0]]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == b
        assert g.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (g.kept and g.base_failed)


def test_repetition_random_and_shares():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", "ä", "\x1c", " ", " ", "\n", "#", "\x85"]) for _ in range(rng.randint(0, 120)))
        m = repetition.measure(text)
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == brute_repetition(text)
    words = [f"w{i}" for i in range(60)]
    m = repetition.measure(" ".join(words + words[:20]))
    assert m["dup_5gram_share"] == pytest.approx(sum(map(len, words[:20])) / sum(map(len, words + words[:20])))
    assert repetition.judge(repetition.measure(" ".join(f"x{i}" for i in range(200)))) == (False, True)
    assert not repetition.judge(repetition.measure("\n".join(["same line here"] * 40)))[1]


def brute_shares(text):
    """Characters of words in second and later copies of n-grams, and of lines equal to an earlier one, over all of them."""
    words, out = WORD.findall(text), {}
    for n in repetition.NGRAM_LIMITS:
        seen, hit = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if gram in seen:
                hit |= set(range(i, i + n))
            seen.add(gram)
        out[n] = sum(len(words[i]) for i in hit) / max(1, sum(map(len, words)))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    later = [x for i, x in enumerate(lines) if x in lines[:i]]
    return out, len(later) / max(1, len(lines)), sum(map(len, later)) / max(1, sum(map(len, lines)))


def test_shares_and_verdict_equal_brute_force():
    rng = random.Random(21)
    kept = 0
    for i in range(300):
        words = [rng.choice(["a", "be", "see", "deep", "\u00e9t\u00e9", "f#"] + [f"w{k}" for k in range(30 * (i % 5))]) for _ in range(rng.randint(0, 140))]
        if i % 3 == 0 and words:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(4, 40)]
        text = "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words)
        m = repetition.measure(text)
        grams, lines, chars = brute_shares(text)
        assert {n: m[f"dup_{n}gram_share"] for n in grams} == pytest.approx(grams)
        assert (m["dup_line_share"], m["dup_line_char_share"]) == pytest.approx((lines, chars))
        n, repeats = brute_repetition(text)[0], brute_repetition(text)[4]
        failed = n < 50 or 100 * repeats > 50 * n
        over = lines > repetition.LINES_LIMIT or chars > repetition.LINE_CHARS_LIMIT or any(grams[k] > x for k, x in repetition.NGRAM_LIMITS.items())
        assert repetition.judge(m) == (failed, not failed and not over)
        kept += not failed and not over
    assert 20 < kept < 280


# --- simhash --------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest id per row by repeated passes over all pairs."""
    best = [i for i, _ in fps]
    changed = True
    while changed:
        changed = False
        for a in range(len(fps)):
            for b in range(len(fps)):
                if (fps[a][1] ^ fps[b][1]).bit_count() <= 4 and best[b] is not None and (best[a] is None or best[b] < best[a]):
                    best[a], changed = best[b], True
    return best


def test_fingerprint_equals_brute_force(odd):
    for text in [r.text for r in odd.collect()] + [" ".join(f"A{i}" for i in range(n)) for n in (3, 4, 5, 300)]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_near_duplicates_equal_brute_force(spark, odd):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(500)]
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for g in range(12):
        words = [rng.choice(vocabulary) for _ in range(300)]
        for c in range(5):
            mine = words[:]
            for _ in range(c):
                mine[rng.randrange(len(mine))] = "changed"
            rows.append((100 + 10 * g + c, " ".join(mine)))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    want = sorted(((i is None, i, f"{fp:016x}", c) for (i, fp), c in zip(fps, brute_components(fps), strict=True)), key=str)
    assert sorted(((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def _planted(seed, n=40):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base[: n // 2]:
        for _ in range(8):
            fps.add(int(b) ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(1, 5), replace=False)))
    return sorted(fps)


@pytest.mark.parametrize(("aim", "tree", "bundle"), [(1024, 4096, 500_000), (16, 4096, 500_000), (16, 8, 60), (1, 4, 40)])
def test_links_find_every_pair(spark, aim, tree, bundle):
    """Also when hot shards are cut into parts, trees lie in many bundles, and shards are named by one block or two."""
    fps = _planted(3)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    found = simhash.search_trees(spark.createDataFrame([(x,) for x in signed], "fp long"), aim=aim, tree=tree, bundle=bundle)
    roots = {r.node: r.root for r in simhash.components(simhash.near_links(found)).collect()}
    group = [roots.get(x, x) for x in signed]
    assert brute_components(list(zip(range(len(fps)), fps, strict=True))) == [group.index(g) for g in group]


def test_plan_keeps_shards_small():
    assert simhash.plan(100) == (5, 1, 0) and simhash.plan(10_000)[:2] == (5, 1) and simhash.plan(10**8)[:2] == (6, 2) and simhash.plan(10**11)[:2] == (7, 3)
    for n in (5_000, 10**6, 10**7, 10**9, 10**10):
        _, shared, bits = simhash.plan(n)
        assert n / 2 ** (shared * bits) <= 2 * simhash.AIM


def test_trees_prune_and_find_all_pairs():
    rng = np.random.default_rng(4)
    fps = np.unique(np.concatenate([rng.integers(0, 2**63, 3000, dtype=np.uint64), np.uint64(5) ^ (np.uint64(1) << rng.integers(0, 12, 50).astype(np.uint64))]))
    tree = np.sort(rng.integers(-2, 2, len(fps)))
    bundle = simhash.Bundle.load(simhash.Bundle(tree, fps).save())
    larger, smaller, visited = bundle.search(tree, fps, frontier=500)
    label = {int(a): int(b) for a, b in zip(larger, smaller, strict=True)}
    for t in np.unique(tree):
        mine = fps[tree == t]
        near = np.argwhere(np.bitwise_count(mine[:, None] ^ mine[None, :]) <= 4)
        linked = {frozenset((label.get(int(mine[i]), int(mine[i])), label.get(int(mine[j]), int(mine[j])))) for i, j in near}
        assert all(len(x) == 1 for x in linked)
    assert visited < 0.45 * bundle.size_of(tree).sum()
    parent, edge, _ = simhash.bk_forest(fps, np.unique(tree, return_inverse=True)[1])
    for i in np.flatnonzero(parent >= 0):
        assert edge[i] == int(fps[i] ^ fps[parent[i]]).bit_count()


def test_work_is_told(spark):
    fps = spark.range(5000).select(F.xxhash64("id").alias("fp"))
    w = simhash.work(simhash.search_trees(fps)).first()
    assert w.queries == 25_000 and 0 < w.visited < 0.5 * w.nodes


def test_keep_one(spark, empty):
    docs = spark.createDataFrame([(5, "a b c d e"), (2, "A B C D E"), (9, "other words are here now"), (5, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect() if r.doc_id) == [2, 9]
    assert simhash.keep_one(empty).count() == 0 and simhash.keep_one(empty).columns == empty.columns
    odd = docs.selectExpr("text", "1 as `a.b`", "doc_id", "0L as component_id", "'x' as fp")
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [2, 9]


# --- decontamination ------------------------------------------------------------------------------------------------


def brute_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = random.Random(5)
    for _ in range(200):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        assert decontam.substring_distance(decontam.pattern_masks(pattern), len(pattern), text, -1) == brute_distance(pattern, text)


def test_matcher_finds_all_within_budget():
    rng = random.Random(6)
    letters = "abcdefghij "
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(60, 200)))) for i in range(12)]
    matcher = decontam.Matcher(items)
    for _ in range(120):
        i, item = rng.choice(items)
        passage = list(decontam.normalise(item))
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(passage))
            passage[at : at + 1] = rng.choice([[], [rng.choice(letters)], [passage[at], rng.choice(letters)]])
        text = "".join(rng.choice(letters) for _ in range(150)) + "".join(passage) + "".join(rng.choice(letters) for _ in range(100))
        norm = decontam.normalise(text)
        want = {j for j, t in items if brute_distance(decontam.normalise(t), norm) <= int(decontam.ERROR_RATE * len(decontam.normalise(t)))}
        assert set(matcher.match(text)) == want


def test_short_items_match_whole_words_only():
    matcher = decontam.Matcher([(1, "Art-5"), (2, "x"), (3, "two words"), (4, "?!"), (5, "sixteen letters")])
    assert matcher.match("An art 5 piece") == {1: 0} and matcher.match("smart 5, art 55") == {} and matcher.match("x") == {2: 0}
    assert matcher.match("in TWO\nWORDS, x") == {2: 0, 3: 0} and matcher.match("two wordsmiths, sixteen letter") == {} and matcher.match("?!") == {}


def test_least_distance_whatever_comes_first():
    item = "the quick brown fox jumps over the lazy dog and runs away again"
    near = item.replace("quick", "quack").replace("lazy", "lazi")
    matcher = decontam.Matcher([(1, item)])
    gap = " " + "0123 " * 40
    assert matcher.match(near + gap + item) == matcher.match(item + gap + near) == {1: 0}
    assert matcher.match(near) == {1: 2} and matcher.match(near + gap + item.replace("quick", "quack")) == {1: 1}


def test_contamination_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, "Ping, pong -- ping pong ping pong"), (2, None), (3, ""), (4, "ONE"), (4, "one"), (None, "x"), (6, "!!")], "item_id long, text string")
    got = {r.doc_id: r for r in decontam.contamination(odd, bench).collect()}
    assert got[3].item_ids == [4] and got[3].contaminated and got[0].n_items == 0
    assert got[9].item_ids == [1] and got[6].item_ids == [] and got[1].item_ids == []
    assert decontam.keep_uncontaminated(odd, bench).count() == odd.count() - 2
    assert decontam.contamination(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(odd, bench.limit(0)).collect())


def test_blocks_of_items_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"intro {i} " + "the quick brown fox jumps over item number %d of many" % i) for i in range(6)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, "The quick brown fox jumps over item number %d of many" % i) for i in range(0, 6, 2)] + [(100 + i, f"no such item {i}") for i in range(7)], "item_id long, text string")
    whole = sorted((r.doc_id, tuple(r.item_ids), r.contaminated) for r in decontam.contamination(docs, bench).collect())
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 10)
    assert sorted((r.doc_id, tuple(r.item_ids), r.contaminated) for r in decontam.contamination(docs, bench).collect()) == whole


# --- mixing ---------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Reshare the excess until no target is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        target = fixed | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return target
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix(spark):
    rng = random.Random(7)
    rows = []
    for s, n in (("big", 900), ("a", 40), ("b", 3), (None, 60), ("none", 2), ("é", 80)):
        rows += [(len(rows) + i, " ".join(["w"] * (0 if s == "none" else rng.randint(1, 60))), s) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).select("row.*", "size", "source_size", "target", "copies", "taken").collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = brute_targets(dict(sizes)), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60 + 0.02 * want[s]
    again = mixing.mix(docs.repartition(3)).select("row.doc_id", "taken").collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted(map(tuple, again))
    out = mixing.emit(mixing.mix(docs))
    assert out.count() == sum(r.copies for r in got) and out.columns == [*docs.columns, "copy_no"]


def test_mix_of_repeated_ids_agrees(spark):
    """Rows of one id and size that differ in text only, and rows without an id: the copies of each text are the same in any order."""
    rng = random.Random(31)
    rows = [(i % 7 if i % 5 else None, " ".join(f"w{rng.randint(0, 9)}{i}" for _ in range(1 + i % 4)), f"s{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = None
    for shape in (docs, docs.repartition(1), docs.repartition(7, "text"), docs.orderBy(F.desc("text")).coalesce(2)):
        got = Counter((r.doc_id, r.text, r.copy_no) for r in mixing.emit(mixing.mix(shape)).collect())
        assert want is None or got == want
        want = got


def test_many_sources(spark):
    """Targets over range partitions equal resharing by a loop; ties in size, nulls and empty sources included."""
    rng = random.Random(32)
    sizes = {f"host{i:04d}": rng.choice([0, 1, 1, 1, 7, rng.randint(1, 3000)]) for i in range(900)} | {None: 40}
    cells = spark.createDataFrame([(("n" if s is None else "v" + s), s, n // 2 if part else n - n // 2) for s, n in sizes.items() for part in (0, 1)], "skey string, source string, words long")
    got = {r.skey: r for r in mixing.source_targets(cells.repartition(5)).collect()}
    want = brute_targets(sizes)
    assert len(got) == len(sizes)
    for s, t in want.items():
        r = got["n" if s is None else "v" + s]
        assert r.source_size == sizes[s] and r.target == pytest.approx(t)


def test_mix_odd(odd, empty):
    got = mixing.mix(odd).select("row.doc_id", "size", "taken").collect()
    assert len(got) == odd.count() and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.emit(mixing.mix(empty)).count() == 0


# --- licenses -------------------------------------------------------------------------------------------------------


def test_licenses(spark, odd, empty):
    texts = dict(reversed(licenses.known_texts()))
    whole = {p.stem: p.read_text() for p in (licenses.DATA / "licenses").glob("*.txt")}
    mit, apache, gpl = whole["MIT"], whole["Apache-2.0"], whole["GPL-3.0"]
    varied = "Copyright (c) 2020 Some One\n\n" + mit.replace("sublicense", "sub-licence").replace(". ", ".\n").upper()
    reflowed = "\u2014 " + "\r\n\n ".join(" ".join(x.split()) for x in apache.replace("License", "Licence").replace('"', "\u201c").split("\n\n"))
    header = 'intro\n\n# Licensed under the Apache Licence, Version 2.0 (the "License");\n# you may not use this file except\n# in compliance with the License.\n\nend'
    rows = [(1, varied), (2, mit + " more"), (3, "text\nReleased under the MIT Licence!\nend"), (4, None), (5, whole["ISC"]), (6, reflowed), (7, "\u00a9 2019 x\n" + gpl.title()), (8, header), (9, "SPDX-License-Identifier: MIT"), (10, "license of no kind\nlicense of no kind")]
    rows.append(rows[2])
    known = licenses.known_digests(spark, licenses.known_texts())
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known)
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].license_id for i in range(1, 11)] == ["MIT", None, None, None, "ISC", "Apache-2.0", "GPL-3.0", None, "MIT", None]
    assert got[3].notices == "MIT" and got[3].n_license_lines == 1 and got[4].digest is None and found.count() == len(rows)
    assert got[8].notices == "Apache-2.0" and got[8].n_license_lines == 2 and got[9].notices == "MIT" and (got[10].notices, got[10].n_license_lines) == ("", 2)
    assert known.count() > 45 and set(whole) < {r.license_id for r in known.collect()}
    assert licenses.scan(odd, known).count() == odd.count() and licenses.scan(empty, known).count() == 0
    assert all(licenses.MARK in t.lower() for t in texts.values() if "\n" not in t.strip())


# --- trained operators ----------------------------------------------------------------------------------------------


def _corpus(n, seed=8):
    rng = random.Random(seed)
    syllables = {"en": "the and of ing th er tion".split(), "de": "der und sch ein ung keit ich".split(), "fr": "les que eau ment ou tre ré".split()}
    bad, rows = ["moron", "clown", "idiot"], []
    for i in range(n):
        lang = rng.choice(list(syllables))
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(60)]
        toxic, junk = rng.random() < 0.3, rng.random() < 0.3
        for _ in range(3 * toxic):
            words.insert(rng.randrange(60), rng.choice(bad))
        rows.append((i, " ".join(w + "&&&" for w in words) if junk else " ".join(words), lang, "s", int(not junk), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    rows = _corpus(800)
    return spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string"), spark.createDataFrame([(r[0], r[4], r[5]) for r in rows], "doc_id long, quality int, toxic int")


def _accuracy(scored, truth, column):
    j = scored.join(truth, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col(column)).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert j.n > 100
    return j.a


def test_quality_held_out(corpus):
    docs, labels = corpus
    scored = quality.score(docs, quality.fit(docs, labels))
    assert _accuracy(scored, labels, "quality") > 0.97
    assert scored.filter((F.col("score") < 0) | (F.col("score") > 1) | (F.col("predicted") != (F.col("score") >= 0.3).cast("int"))).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(corpus):
    docs, labels = corpus
    other = labels.withColumn("quality", F.when(crc_mod("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.score(docs, quality.fit(docs, x)).orderBy("doc_id").collect() for x in (labels, other))
    assert a == b


def test_toxicity_held_out(corpus):
    docs, labels = corpus
    assert _accuracy(toxicity.score(docs, toxicity.fit(docs, labels)), labels, "toxic") > 0.97


def test_toxicity_restores_disguises(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    restorer = toxicity.Restorer(model.costs)
    for said, meant in (("m0r0n", "moron"), ("cl0wn", "clown"), ("1d1ot", "idiot"), ("m o r o n", "moron"), ("i.d.i.o.t", "idiot"), ("mooooron", "moron")):
        assert restorer.restore(f"the {said} und") == f"the {meant} und"
        assert model.score(restorer.words(f"the {said} und")) >= toxicity.THRESHOLD
    assert model.score(restorer.words("the und les")) < toxicity.THRESHOLD


def brute_decode(span, costs):
    """All readings of the lattice, by enumeration."""
    spaced = bool(re.match(r".[ .\-_*].[ .\-_*]", span))
    runs = [(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", span, re.S)]
    best = None
    for choice in itertools.product(*[toxicity._options(ch, n, ch.isalpha(), spaced, i == len(runs) - 1) for i, (ch, n) in enumerate(runs)]):
        cost, a, b = sum(x for _, x in choice), 0, 0
        for z in map(toxicity._code, "".join(x for x, _ in choice)):
            cost += costs[a][b][z]
            a, b = b, z
        cost += costs[a][b][0]
        if best is None or cost < best[0]:
            best = cost, "".join(x for x, _ in choice)
    return best


def _costs(seed=3):
    counts = np.zeros(toxicity.LETTERS**3)
    for _, text, *_ in _corpus(60, seed):
        toxicity.count_trigrams(text, counts)
    return toxicity.language_model(counts).tolist()


def _path_cost(span, out, costs):
    """The cheapest way in which the lattice gives ``out``."""
    spaced = bool(re.match(r".[ .\-_*].[ .\-_*]", span))
    runs = [(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", span, re.S)]
    ways = {0: 0.0}
    for i, (ch, n) in enumerate(runs):
        after = {}
        for at, cost in ways.items():
            for x, extra in toxicity._options(ch, n, ch.isalpha(), spaced, i == len(runs) - 1):
                if out.startswith(x, at):
                    after[at + len(x)] = min(cost + extra, after.get(at + len(x), math.inf))
        ways = after
    cost, a, b = ways[len(out)], 0, 0
    for z in map(toxicity._code, out):
        cost += costs[a][b][z]
        a, b = b, z
    return cost + costs[a][b][0]


def _odd_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    pool = "aabbzé ²½_ªµ١٢0129!!??--  \n\t\x1c\x85\xa0 …—€漢字жЖİıßŉ𝔘😀\x00\x0b$@|"
    return ["".join(rng.choice(pool[: rng.randint(3, len(pool))]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_words_and_tokens_by_tables_equal_patterns():
    """Latin-1, other texts of 16 bits, and texts beyond, where the patterns themselves are used."""
    for text in _odd_texts(3000, 3):
        assert toxicity.words_of(text) == toxicity._WORDS.findall(text)
        assert quality.split_tokens(text) == [m[0] for m in quality._TOKENS.finditer(text)]


def test_evidence_equals_sets_of_features(monkeypatch):
    """With few words remembered, so that they are forgotten between texts."""
    monkeypatch.setattr(toxicity, "WORDS_KEPT", 20)
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    known = sorted({f for w in words[:150] for f in toxicity.features(w)})
    lexicon = {f: 0.6 + 0.3 * rng.random() for f in known[::9]}
    weights = {f: rng.uniform(-3, 3) for f in known if rng.random() < 0.8}
    model = toxicity.Model([], lexicon, 0.05, weights)
    for n in (0, 1, 5, 40, 3, 100):
        chosen = set(rng.sample(words, n))
        found = {f for w in chosen for f in toxicity.features(w)}
        hits = [lexicon[f] for f in found & lexicon.keys()]
        p = 1 - (1 - max(hits)) / (1 + 0.1 * (len(hits) - 1)) if hits else 0.05 / 4
        mean = [weights[f] for f in found & weights.keys()]
        assert model.evidence(chosen) == pytest.approx((np.log(p / (1 - p)), np.mean(mean) if mean else 0.0))


def test_decode_equals_enumeration():
    rng, costs = random.Random(13), _costs()
    for _ in range(1500):
        span = "".join(rng.choice("abeinorst" * 2 + "013$!|. -*\u00e9") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(1, 9)))
        assert _path_cost(span, toxicity.decode(span, costs), costs) == pytest.approx(brute_decode(span, costs)[0])


def test_suspicious_places_hold_every_disguise():
    """Searching in suspicious lines and words with triples finds what a search of whole texts finds."""
    rng = random.Random(14)
    repeated = re.compile(rf"{toxicity._L}+")
    found = 0
    for i in range(6000):
        text = "".join(rng.choice("aabcdiost013!$@|. -_*'\n,&\u00e9\u00b2\u20ac") * (rng.choice([1, 1, 2, 3]) if i % 2 else 1) for _ in range(rng.randint(0, 40)))
        signs = [m.span() for m in toxicity.DISGUISED.finditer(text)]
        assert signs == [m.span() for a, b in toxicity.suspicious_lines(text) for m in toxicity.DISGUISED.finditer(text, a, b)]
        words = [m.span() for m in repeated.finditer(text) if re.search(rf"({toxicity._L})\1\1", m[0])]
        assert words == toxicity.triples(text)
        found += len(signs) + len(words)
    assert found > 3000


def test_long_words_take_linear_time():
    restorer = toxicity.Restorer(_costs())
    for text in ("a1 " + "xyz" * 333_333 + "aaa", "m0r" + "ab" * 500_000, "abcd" * 250_000 + " cl0wn", "a1b" * 300_000 + "&"):
        began = time.perf_counter()
        restorer.words(text)
        assert time.perf_counter() - began < 5  # well under a second where nothing else runs
    assert not restorer.seen or max(map(len, restorer.seen)) <= toxicity.LONGEST_KEPT


def test_calibration():
    rng = np.random.default_rng(15)
    assert toxicity.calibrate(np.zeros((0, 3)), np.zeros(0)) == pytest.approx((0.0, 1.0, 1.0))
    x = np.column_stack([np.ones(20_000), rng.normal(0, 1, 20_000), rng.normal(0, 1, 20_000)])
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(x @ np.array([-1.0, 0.5, 2.0]))))).astype(float)
    assert toxicity.calibrate(x, y) == pytest.approx((-1.0, 0.5, 2.0), abs=0.1)


def test_toxicity_scores_are_graded(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    plain, one = toxicity.Restorer(model.costs).words("the and of ing"), {"the", "moron"}
    assert model.score(plain) < 0.2 < 0.8 < model.score(one) and model.score(one) <= model.score(one | {"idiot"})
    scores = {r.score for r in toxicity.score(docs, model).collect()}
    assert len(scores) > 300 and all(0 < s < 1 for s in scores)


def brute_viterbi(scores, penalty):
    best = [(list(scores[0])[k], [k]) for k in range(scores.shape[1])]
    for row in scores[1:]:
        best = [max(((b[0] - penalty * (b[1][-1] != k) + row[k], b[1] + [k]) for b in best), key=lambda x: x[0]) for k in range(scores.shape[1])]
    return max(best, key=lambda x: x[0])


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(9)
    sizes = np.array([1, 7, 3, 7, 2, 30])
    scores = rng.normal(0, 5, (sizes.sum(), 3))
    labels = langid.viterbi(scores, sizes, 6.0)
    at = 0
    for n in sizes:
        part, own = scores[at : at + n], labels[at : at + n]
        total = part[np.arange(n), own].sum() - 6.0 * (own[1:] != own[:-1]).sum()
        assert total == pytest.approx(brute_viterbi(part, 6.0)[0])
        at += n


def test_viterbi_in_blocks_equals_viterbi():
    rng = np.random.default_rng(16)
    for languages, n in ((3, 57), (20, 31), (1, 5)):
        scores = rng.normal(0, 5, (n, languages)).astype(np.float32)
        whole = langid.viterbi(scores, np.array([n]), 6.0)
        for step in (1, 4, 100):
            assert langid.viterbi_blocks((scores[i : i + step] for i in range(0, n, step)), 6.0).tolist() == whole.tolist()


def test_a_thousand_languages(spark, monkeypatch):
    """Values of a noisy column are learned in passes, and long texts are labelled in blocks, as short ones are."""
    rng = random.Random(17)
    rows = _corpus(200)
    noisy = [(5000 + i, "".join(rng.choice("\u03b1\u03b2\u03b3\u03b4") for _ in range(9)) + " x", f"noise{i:04d}", "s", 0, 0) for i in range(1250)]
    docs = spark.createDataFrame([r[:4] for r in rows + noisy], "doc_id long, text string, lang string, source string")
    model = langid.fit(docs)
    assert 950 < len(model.languages) <= 1003 and model.languages == sorted(model.languages)
    held = [(r[1], r[2]) for r in rows if crc32(str(r[0]).encode()) % 5 == 0]
    want = langid.predict_texts([t for t, _ in held], model)
    assert sum(a[0] == b[1] for a, b in zip(want, held, strict=True)) > 0.9 * len(held)
    monkeypatch.setattr(langid, "HELD_SCORES", 20_000)
    long = " ".join(t for t, _ in held)
    assert len(long) > 1000 and langid.predict_texts([t for t, _ in held], model) == want
    spans = langid.text_spans(long, model)
    monkeypatch.undo()
    assert spans == langid.text_spans(long, model)


def test_counting_in_passes_changes_nothing(spark, corpus, monkeypatch):
    docs, _ = corpus
    model = langid.fit(docs)
    monkeypatch.setattr(langid, "COUNTED", 2)
    again = langid.fit(docs)
    assert model.languages == again.languages and np.allclose(model.scores, again.scores, atol=1e-6) and (model.uses == again.uses).all()


def brute_scores(text, model):
    """Per word the sum of its trigrams' log-probabilities, for languages that use its first letter's script."""
    padded = "\0" + text + "\0"
    out, word = [], None
    for i, ch in enumerate(text, 1):
        if not ch.isalpha():
            word = None
            continue
        a, b, c = (ord(x) if x.isalpha() else 0 for x in padded[i - 1 : i + 2])
        key = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFFFFFF
        key = (key ^ (key >> 17) ^ (key >> 31)) % langid.TABLE
        if word is None:
            script = [name for start, name in langid.SCRIPT_STARTS if start <= ord(ch)][-1]
            fits = model.uses[langid.SCRIPTS.index(script)]
            word = [i - 1, 0, np.zeros(len(model.languages)), fits if fits.any() else ~fits]
            out.append(word)
        word[1] += 1
        word[2] += model.scores[key]
    return out


def test_word_scores_equal_brute_force(corpus):
    model = langid.fit(corpus[0])
    rng = random.Random(18)
    for _ in range(200):
        text = "".join(rng.choice(["the", "der", "que", "\u00e9", " ", "1", "-", "\u0436", "\u4e2d", "\U0001f600", "\n"]) for _ in range(rng.randint(0, 25)))
        at, sizes, scores = model.words(text)
        want = brute_scores(text, model)
        assert at.tolist() == [w[0] for w in want] and sizes.tolist() == [w[1] for w in want]
        for got, (_, _, total, fits) in zip(scores, want, strict=True):
            assert got[fits] == pytest.approx(total[fits], rel=1e-4) and (got[~fits] < -1e5).all()


def brute_contexts(docs, buckets):
    """Context vectors by a loop over words and neighbours."""
    out = {}
    for text in docs:
        ids = quality.tokenise(text, buckets).tolist()
        for i, here in enumerate(ids):
            row = out.setdefault(here, np.zeros(quality.DIMS))
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if j != i:
                    places, signs = quality.index_vectors(np.array([ids[j]]))
                    for p, x in zip(places[0], signs[0], strict=True):
                        row[p] += x
    return out


def test_contexts_equal_brute_force(spark):
    rng = random.Random(19)
    docs = [" ".join(rng.choice(["the", "CAPS", "a1", "x", "!!", "word", "\u00e9t\u00e9"]) for _ in range(rng.randint(0, 12))) for _ in range(60)] + ["", "one"]
    want = brute_contexts(docs, quality._Buckets())
    got = quality.fit_vectors(spark.createDataFrame([(t,) for t in docs], "text string").repartition(5))
    assert set(np.flatnonzero(got.index >= 0).tolist()) == set(want)
    for bucket, row in want.items():
        assert got.values[got.index[bucket]] == pytest.approx(row / (np.linalg.norm(row) + quality.SHRINK), abs=1e-3)
    vectors, text = got, docs[0] + " unseen"
    ids = quality.tokenise(text, quality._Buckets()).tolist()
    mean = sum(vectors.values[vectors.index[i]] if vectors.index[i] >= 0 else np.zeros(quality.DIMS) for i in ids) / len(ids)
    assert quality.pool(text, vectors, quality._Buckets())[: quality.DIMS] == pytest.approx(mean, abs=1e-3)


def test_sums_are_packed_without_loss():
    rng = np.random.default_rng(23)
    for top in (0, 1, 127, 128, 40_000, 2**31, 2**50):
        values = rng.integers(-top, top + 1, (7, quality.DIMS)).astype(np.float64)
        assert (quality.unpacked(quality.packed(values)) == values).all()
    assert quality.unpacked(quality.packed(np.zeros((0, quality.DIMS)))).shape == (0, quality.DIMS)


def test_index_vectors():
    places, signs = quality.index_vectors(np.arange(quality.BUCKETS))
    assert all(len(set(r)) == quality.NONZERO for r in places[:1000].tolist()) and places.min() == 0 and places.max() == quality.DIMS - 1
    assert abs(signs.mean()) < 0.01 and set(np.unique(signs)) == {-1.0, 1.0}


def test_gradients_equal_differences():
    rng = np.random.default_rng(20)
    params = [rng.normal(0, 1, shape) for shape in ((5, 4), (4,), (4,), (1,))]
    z, y = rng.normal(0, 1, (30, 5)), rng.integers(0, 2, 30).astype(float)
    _, gradients = quality.loss_and_gradients(params, z, y)
    for p, g in zip(params, gradients, strict=True):
        for at in np.ndindex(p.shape):
            old = p[at]
            p[at] = old + 1e-6
            up, _ = quality.loss_and_gradients(params, z, y)
            p[at] = old - 1e-6
            down, _ = quality.loss_and_gradients(params, z, y)
            p[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_temperature_is_the_best_of_all():
    rng = np.random.default_rng(22)
    logit = rng.normal(0, 4, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-logit / 2))).astype(float)  # twice as sure as it should be
    loss = lambda t: np.mean([math.log1p(math.exp(-x / t)) if k else math.log1p(math.exp(x / t)) for x, k in zip(logit, y, strict=True)])
    best = quality.best_temperature(logit, y)
    assert best == pytest.approx(2, rel=0.15) and all(loss(best) <= loss(t) + 1e-12 for t in np.geomspace(0.5, 5, 60))


def test_quality_by_vocabulary_size(spark):
    """Words of a large vocabulary keep vectors of their own, and accuracy doesn't fall as the vocabulary grows."""
    words = [f"word{i}" for i in range(30_000)]
    assert len({zlib.crc32(w.encode()) % quality.BUCKETS for w in words}) > 0.94 * len(words) > len({zlib.crc32(w.encode()) % 4096 for w in words})
    for size in (200, 20_000):
        rng = random.Random(size)
        rows = []
        for i in range(900):
            junk = i % 3 == 0
            own = [f"w{rng.randrange(size)}" for _ in range(60)]
            rows.append((i, " ".join(w + ("" if not junk or rng.random() < 0.5 else " buy now") for w in own), int(not junk)))
        docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
        labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
        assert _accuracy(quality.score(docs, quality.fit(docs, labels)), labels, "quality") > 0.97


def test_fits_of_repeated_ids_agree(spark, corpus):
    """Different texts under one id: the fit is the same however rows are dealt."""
    docs, labels = corpus
    more = docs.union(docs.select((F.col("doc_id") + 1).alias("doc_id"), "text", "lang", "source"))
    want = None
    for shape in (more, more.repartition(1), more.repartition(6, "text")):
        a, b = quality.fit(shape, labels), toxicity.fit(shape, labels)
        got = (a.network.w1.tolist(), a.network.temperature, b.lexicon, b.weights, b.calibration)
        assert want is None or got == want
        want = got


def test_language(spark, corpus):
    docs, _ = corpus
    model = langid.fit(docs)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got > 0.97
    mixed = "the ingthe andtion ofing ther " * 8 + "derung schein ichkeit undsch " * 8
    spans = langid.text_spans(mixed, model)
    assert [s[2] for s in spans] == ["en", "de"] and abs(spans[1][0] - mixed.index("derung")) < 12
    more = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(10_000 + i, "привет как дела мой друг", "ru") for i in range(20)], "doc_id long, text string, lang string"))
    assert langid.predict_texts(["дела", "123 !", ""], langid.fit(more)) == [("ru", 1.0), ("und", 0.0), ("und", 0.0)]


def test_trained_operators_on_odd_tables(spark, odd, empty, labels):
    none = labels.limit(0)
    for fit, score in ((quality.fit, quality.score), (toxicity.fit, toxicity.score)):
        for l in (labels, none):
            got = score(odd, fit(odd, l)).collect()
            assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
            assert all(not r.held_out for r in got if r.doc_id is None)
        assert score(empty, fit(empty, labels)).count() == 0
    got = {r.doc_id: r for r in langid.predict(odd, langid.fit(odd)).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und" and got[0].score == 0
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    kept = quality.keep_good(odd, quality.fit(odd, none))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.keep_clean(odd, toxicity.fit(odd, none)).count() == odd.count()
