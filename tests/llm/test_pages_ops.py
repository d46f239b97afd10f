"""WARC round trips and salvage; URL rules and the Bloom filter cascade."""

from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkwell.llm import urlfilter, warc
from inkwell.llm.common import new_path

PAGES = "page_id long, url string, html string, payload string, refers_to string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "x" * 200
    rows = [(7, "http://a.org/1", big), (3, "http://b.org/ü?q=1", big), (9, None, None), (4, "nothing", ""), (5, "http://c.de/", "é" * 49), (6, "http://c.de/", "é" * 49), (8, "", "é" * 50), (2, "x://Y.Example.ORG/es/1#f", "é" * 50), (None, "http://n.org", "n" * 150), (3, "http://b.org/ü?q=1", big)]
    rows += [(100 + i, f"https://h{i % 5}.example.com/fr/{i}", ("page " + str(i)) * 50) for i in range(40)]
    return spark.createDataFrame([(*r, "p", "r") for r in rows], PAGES)


def test_round_trip(spark, pages):
    got = warc.round_trip(pages).collect()
    rows = pages.collect()
    first = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            first[body] = min(r.page_id, first.get(body, r.page_id))
    want = []
    for r in rows:
        body = (r.html or "").encode()
        refers = first.get(body) if first.get(body) != r.page_id else None
        want.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    assert all(r.gaps_before == 1 for r in got)  # every archive has a torn beginning
    whole = warc.round_trip(pages, torn=False).collect()
    assert sorted([tuple(r)[:5] for r in whole], key=str) == sorted(want, key=str) and not any(r.gaps_before for r in whole)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_hold_the_payloads(spark, pages):
    path = new_path(spark, "test-warc")
    made = warc.write_archives(warc.classify(pages), path, roll=2000).collect()
    assert len(made) > 1 and sum(r.n_records for r in made) == pages.count()
    back = warc.read_archives(spark, path)
    assert back.filter("kind = 'gap'").count() == 0
    bodies = {r.page_id: bytes(r.payload).decode() for r in back.filter("record_type = 'response' and page_id is not null").collect()}
    for r in pages.filter("page_id >= 100").collect():
        assert bodies[r.page_id] == r.html


def test_payloads_above_the_part_size(spark, pages, monkeypatch):
    """Long payloads leave in parts, and nothing is dropped for its size."""
    path = new_path(spark, "test-warc-parts")
    warc.write_archives(warc.classify(pages), path, torn=True).collect()
    whole = {(r.page_id, r.start): bytes(r.payload) for r in warc.read_archives(spark, path).filter("record_type = 'response' and kind = 'record'").collect()}
    rows = warc.read_archives(spark, path, part_bytes=64).collect()
    parts = {}
    for r in sorted((r for r in rows if r.kind == "part"), key=lambda r: (r.file, r.start, r.part)):
        assert r.part == len(parts.setdefault((r.page_id, r.start), [])) and len(r.payload) <= 64
        parts[r.page_id, r.start].append(bytes(r.payload))
    for r in (r for r in rows if r.kind == "record" and r.record_type == "response"):
        key = (r.page_id, r.start)
        assert (bytes(r.payload) if r.payload is not None else b"".join(parts[key])) == whole[key] and r.payload_bytes == len(whole[key])
    assert len(parts) > 40
    none = warc.read_archives(spark, path, payloads=False)
    assert none.filter("payload is not null or kind = 'part'").count() == 0 and none.filter("kind = 'record'").count() == pages.count()


@pytest.mark.parametrize("zipped", [True, False])
def test_records_longer_than_a_block(zipped, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 4096)
    rng = random.Random(5)
    bodies = [bytes(rng.randrange(256) for _ in range(n)) for n in (10, 70_000, 300, 20_000)]
    data = b""
    for i, body in enumerate(bodies):
        one = warc.record("response", i, None, body, hashlib.sha256(body).hexdigest(), None)
        data += b"junk\r\nWARC/1.1\r\n" + (gzip.compress(one, mtime=0) if zipped else one)
    found = [x for x in warc.salvage(data, keep=10**6) if isinstance(x, warc.Record)]
    assert [x.payload for x in found] == bodies and [x.n_bytes for x in found] == [len(b) for b in bodies]
    assert [x.payload for x in warc.salvage(data, keep=1000) if isinstance(x, warc.Record)] == [bodies[0], None, bodies[2], None]
    archive = warc.Archive(data)
    assert b"".join(warc.payload_parts(archive, found[1].start, 999)) == bodies[1]


def test_damaged_archives_are_accounted_for(spark, pages):
    """Bytes are destroyed after writing: all other records come back, the gaps are logged, and the loss raises."""
    path = new_path(spark, "test-warc-damage")
    written = sum(r.n_records for r in warc.write_archives(warc.classify(pages), path, torn=True).collect())
    folder = Path(path.removeprefix("file://"))
    whole = {r.page_id: (r.file, r.start, r.end) for r in warc.read_archives(spark, path, payloads=False).filter("page_id >= 100").collect()}
    for lost in (105, 117):
        file, start, end = whole[lost]
        at = folder / Path(file).name
        data = bytearray(at.read_bytes())
        data[start + 20 : end - 20] = bytes(end - start - 40)
        at.write_bytes(bytes(data))
    found = warc.read_archives(spark, path, payloads=False)
    assert {r.page_id for r in found.filter("page_id >= 100").collect()} == set(whole) - {105, 117}
    with pytest.raises(RuntimeError, match="2 of"):
        warc.account(found, path, written)
    gaps = spark.read.parquet(warc.gap_log(path)).collect()
    spans = {(g.file, g.start, g.end) for g in gaps}
    assert whole[105] in spans and whole[117] in spans and all(g.reason for g in gaps)
    ok = warc.account(found, path, written - 2)
    assert ok.count() == written - 2 and not folder.exists()


def _members(n, zipped):
    out = []
    for i in range(n):
        body = (f"<p>{i}</p>" * 30).encode() + (b"\r\nWARC/1.1\r\nfake line" if i % 3 == 0 else b"")
        data = warc.record("response", i, f"http://h/{i}", body, hashlib.sha256(body).hexdigest(), None)
        out.append(gzip.compress(data, mtime=0) if zipped else data)
    return out


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_recovers_later_records(zipped):
    rng = random.Random(1)
    parts = _members(12, zipped)
    whole = b"".join(parts)
    assert [x.headers["warc-record-id"] for x in warc.salvage(whole)] == [f"<urn:page:{i}>" for i in range(12)]
    starts = [sum(map(len, parts[:i])) for i in range(13)]
    for _ in range(60):
        hurt = rng.randrange(12)
        data = bytearray(whole)
        at = rng.randrange(starts[hurt] + 40, starts[hurt + 1] - 8)
        data[at] ^= 0xFF
        found = list(warc.salvage(bytes(data)))
        ids = [x.headers.get("warc-record-id") for x in found if isinstance(x, warc.Record)]  # plain headers have no checksum of their own
        assert set(ids) >= {f"<urn:page:{i}>" for i in range(12) if i != hurt}
        spans = [(x.start, x.end) for x in found]
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    cut = list(warc.salvage(whole[: starts[6] + 30] + whole[starts[8] :]))
    gaps = [x for x in cut if isinstance(x, warc.Gap)]
    assert len(gaps) == 1 and gaps[0].start == starts[6] and len([x for x in cut if isinstance(x, warc.Record)]) == 10
    assert [type(x) for x in warc.salvage(b"junk" * 10)] == [warc.Gap] and list(warc.salvage(b"")) == []


def _universe(spark, n=20_000):
    return spark.range(n).select(F.concat(F.lit("host"), F.col("id").cast("string"), F.lit(".example")).alias("key"))


def _told(cascade, df):
    a, b = urlfilter.hashes(F.col("key"), cascade.seed)
    keys = df.select("key", a.alias("a"), b.alias("b")).toPandas()
    return dict(zip(keys.key, cascade.listed(keys.a.to_numpy(), keys.b.to_numpy()).tolist(), strict=True))


@pytest.mark.parametrize("shard_bytes", [10**6, 300])
def test_cascade_is_exact(spark, shard_bytes):
    universe = _universe(spark)
    inside = universe.filter("hash(key) % 7 = 0")
    listed = inside.union(spark.createDataFrame([("elsewhere",), (None,), ("host7.example",), ("host7.example",)], "key string"))
    cascade = urlfilter.build_cascade(universe, listed, shard_bytes)
    assert cascade.levels > 2 and (len(cascade.shards) > 10) == (shard_bytes == 300)
    want = {r.key for r in listed.collect()}
    assert all(x == (k in want) for k, x in _told(cascade, universe).items())
    assert sum(len(g) for g in cascade.groups(1000)) == len(cascade.shards) or shard_bytes == 10**6
    assert urlfilter.build_cascade(universe, listed.limit(0)).levels == 0


def test_cascade_of_a_long_list(spark):
    """A list of 10^5 names over a corpus that meets few of them."""
    universe = _universe(spark, 60_000)
    listed = spark.range(100_000).select(F.concat(F.lit("n"), F.col("id").cast("string"), F.lit(".feed.invalid")).alias("key")).union(universe.filter("hash(key) % 50 = 0"))
    cascade = urlfilter.build_cascade(universe, listed)
    want = {r.key for r in universe.filter("hash(key) % 50 = 0").collect()}
    assert cascade.levels > 2 and all(x == (k in want) for k, x in _told(cascade, universe).items())


def test_keys_of_equal_hashes_end(spark, monkeypatch):
    """Keys that no level can tell apart: the cascade is built anew with other hashes."""
    once = urlfilter.hashes
    monkeypatch.setattr(urlfilter, "hashes", lambda key, seed: (F.lit(5).cast("long") + F.length(key) * 0, F.lit(9).cast("long") + F.length(key) * 0) if not seed else once(key, seed))
    universe = _universe(spark, 20)
    cascade = urlfilter.build_cascade(universe, universe.filter("key < 'host12'"))
    want = {r.key for r in universe.filter("key < 'host12'").collect()}
    assert cascade.seed == 1 and all(x == (k in want) for k, x in _told(cascade, universe).items())


def test_url_rules(spark, pages):
    listed = spark.createDataFrame([("h1.example.com",), ("c.de",), (None,), ("h2.example.com/fr/102",)], "key string")
    got = {(r.page_id, r.host, r.path): (r.rule, r.listed, r.verdict) for r in urlfilter.judge(pages, listed).collect()}
    assert got[2, "y.example.org", "/es/1"] == ("example.org/es/", False, "block")
    assert got[7, "a.org", "/1"] == ("org/", False, "allow")
    assert got[5, "c.de", "/"] == (None, True, "block")
    assert got[9, "", ""] == (None, False, "allow") and got[4, "", ""] == (None, False, "allow")
    assert got[101, "h1.example.com", "/fr/1"] == ("com/fr/", True, "allow")
    assert got[102, "h2.example.com", "/fr/2"][1] is False
    whole = sorted(map(str, urlfilter.judge(pages, listed).collect()))
    assert sorted(map(str, urlfilter.judge(pages, listed, shard_bytes=1, group_bytes=1).collect())) == whole
    clash = pages.selectExpr("*", "'x' as host", "'y' as path", "1 as rule", "2 as listed", "'z' as verdict", "0L as h1", "0L as h2", "'k' as key")
    assert sorted(map(str, urlfilter.judge(clash, listed).collect())) == whole
    assert urlfilter.judge(pages.limit(0), listed).count() == 0 and urlfilter.judge(pages, listed.limit(0)).filter("listed").count() == 0


def test_the_query_list(spark, pages):
    listed = urlfilter.feed(spark, pages)
    assert listed.count() >= 10**5 and urlfilter.judge(pages, listed).count() == pages.count()
