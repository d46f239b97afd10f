"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives (operator 7).

Every record is a gzip member of its own. The reader checks each member or plain record (version line, headers, length,
payload digest). Where a check fails it searches for the next valid member or version line, goes on from there, and logs
the bytes between as a quarantined gap.

Archives are read as streams: of a record, whatever its size, one piece and the running digests are held. Payloads of up
to PART_BYTES are kept while they are checked; longer ones are read again once they have proved whole, and leave as parts.

Archives go to the shared folder under names fixed by partition and number; a file is written under another name first
and then moved, so a task that is run again, after a lost executor or by speculation, replaces its files by equal ones.

Defined results: a null html is an empty payload; a null url gives a record without a target; a null page_id gives a
record without an id, which is never referred to; rows that repeat the smallest page_id of a payload are all responses;
extra columns are ignored; an empty table gives no archive and no rows. If fewer records are read back than were written,
``round_trip`` raises and names the gap log.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_path, hold, new_path, release

#: Equal payloads of at least so many bytes are stored once.
MIN_REVISIT = 100
#: A new archive is begun beyond so many bytes.
ROLL_BYTES = 32_000_000
#: Lists of at most so many digests (64 digits and an id each, so 50 MB at most) are broadcast.
BROADCAST_ROWS = 500_000
#: Longer payloads leave the reader in parts of this size.
PART_BYTES = 64_000_000
#: Bytes of a file that are held at once while places are sought in it.
BLOCK_BYTES = 1 << 20
EPOCH = "2020-01-01T00:00:00Z"


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, not compressed. A revisit has the HTTP header only, and the payload's digest and length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {EPOCH}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    n_bytes: int
    digest: str
    payload: bytes | None  # None: longer than was to be kept


@dataclass
class Gap:
    start: int
    end: int
    reason: str


class Damaged(ValueError):
    pass


class Archive:
    """A file that can be read at any place, a block of which is held."""

    def __init__(self, source: bytes | io.IOBase | pa.NativeFile):
        self.file = io.BytesIO(source) if isinstance(source, bytes) else source
        self.size = self.file.seek(0, 2)
        self.at, self.block = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``."""
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if n > BLOCK_BYTES:
            self.file.seek(at)
            return self.file.read(n)
        if not (self.at <= at and at + n <= self.at + len(self.block)):
            self.file.seek(at)
            self.at, self.block = at, self.file.read(BLOCK_BYTES)
        return self.block[at - self.at : at - self.at + n]

    def find(self, pattern: re.Pattern[bytes], at: int, longest: int) -> int:
        """The first place from ``at`` where the pattern, of up to ``longest`` bytes, is found; the size if nowhere."""
        while at < self.size:
            piece = self.read(at, BLOCK_BYTES)
            m = pattern.search(piece)
            if m:
                return at + m.start()
            at += max(1, len(piece) - longest + 1)
        return self.size


class Plain:
    """The bytes of an archive from a place on."""

    def __init__(self, archive: Archive, at: int):
        self.archive, self.at = archive, at

    def read(self, n: int) -> bytes:
        piece = self.archive.read(self.at, min(n, BLOCK_BYTES))
        self.at += len(piece)
        return piece

    def end(self) -> int:
        return self.at


class Member:
    """The content of the gzip member at a place."""

    def __init__(self, archive: Archive, at: int):
        self.archive, self.at, self.step = archive, at, 4096
        self.inflate, self.waiting = zlib.decompressobj(31), b""

    def read(self, n: int) -> bytes:
        try:
            while not self.inflate.eof:
                if not self.waiting:
                    self.waiting = self.archive.read(self.at, self.step)
                    self.at, self.step = self.at + len(self.waiting), min(4 * self.step, 65536)
                    if not self.waiting:
                        raise Damaged("member doesn't end")
                out = self.inflate.decompress(self.waiting, min(n, BLOCK_BYTES))
                self.waiting = self.inflate.unconsumed_tail
                if out:
                    return out
        except zlib.error as e:
            raise Damaged(f"bad member: {e}") from e
        return b""

    def end(self) -> int:
        if self.read(1):
            raise Damaged("more than one record in a member")
        return self.at - len(self.inflate.unused_data)


def _head(stream: Plain | Member, begun: bytes, what: str) -> tuple[bytes, bytes]:
    """What stands before the first empty line, and what has been read of the rest."""
    held, seen = bytearray(begun), 0
    while True:
        stop = held.find(b"\r\n\r\n", max(0, seen - 3))
        if stop >= 0:
            return bytes(held[:stop]), bytes(held[stop + 4 :])
        seen = len(held)
        more = stream.read(8192)
        if not more:
            raise Damaged(f"{what} doesn't end")
        held += more


def _headers(head: bytes) -> dict[str, str]:
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or line.endswith((b"WARC/1.0", b"WARC/1.1")):  # a cut may have joined two records
            raise Damaged("bad header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return headers


def _payload(archive: Archive, at: int) -> tuple[Plain | Member, dict[str, str], Iterator[tuple[bytes, bytes]]]:
    """The stream at ``at``, the record's headers, and the pieces of its block, each with what of it is payload."""
    member = archive.read(at, 3) == b"\x1f\x8b\x08"
    stream: Plain | Member = Member(archive, at) if member else Plain(archive, at)
    begun = b""
    while len(begun) < 10 and (more := stream.read(8192)):
        begun += more
    if begun[:10] not in (b"WARC/1.0\r\n", b"WARC/1.1\r\n"):
        raise Damaged("no version line")
    head, rest = _head(stream, begun, "the header")
    headers = _headers(head)
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no length")
    left = int(length)
    if not member and stream.at - len(rest) + left > archive.size:
        raise Damaged("length leads beyond the file")

    def pieces() -> Iterator[tuple[bytes, bytes]]:
        nonlocal rest, left
        http: bytearray | None = bytearray() if "application/http" in headers.get("content-type", "") else None
        while left:
            piece = (rest or stream.read(min(left, 65536)))[:left]
            rest = rest[len(piece) :]
            if not piece:
                raise Damaged("the block doesn't end")
            left -= len(piece)
            if http is None:
                yield piece, piece
                continue
            seen = len(http)
            http += piece
            stop = http.find(b"\r\n\r\n", max(0, seen - 3))
            yield piece, bytes(http[stop + 4 :]) if stop >= 0 else b""
            if stop >= 0:
                http = None
        if http is not None:
            raise Damaged("no HTTP header")
        end = rest[:4]
        rest = rest[4:]
        while len(end) < 4 and (more := stream.read(4 - len(end))):
            end += more
        if end != b"\r\n\r\n":
            raise Damaged("length doesn't lead to the record's end")
        if rest and isinstance(stream, Member):
            raise Damaged("more than one record in a member")
        if isinstance(stream, Plain):
            stream.at -= len(rest)

    return stream, headers, pieces()


def _record(archive: Archive, at: int, keep: int) -> Record:
    """The record at ``at``, checked whole; payloads of up to ``keep`` bytes are kept."""
    stream, headers, pieces = _payload(archive, at)
    block, payload, kept, n = hashlib.sha256(), hashlib.sha256(), [], 0
    for piece, part in pieces:
        block.update(piece)
        payload.update(part)
        n += len(part)
        if n <= keep:
            kept.append(part)
        else:
            kept = []
    end = stream.end()
    claimed = headers.get("warc-block-digest", "")
    if claimed.startswith("sha256:") and claimed[7:] != block.hexdigest():
        raise Damaged("block digest differs")
    claimed = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and claimed.startswith("sha256:") and claimed[7:] != payload.hexdigest():
        raise Damaged("payload digest differs")
    return Record(at, end, headers, n, payload.hexdigest(), b"".join(kept) if n <= keep else None)


def payload_parts(archive: Archive, at: int, size: int) -> Iterator[bytes]:
    """The payload of a record that has proved whole, in parts of ``size`` bytes."""
    held = bytearray()
    for _, part in _payload(archive, at)[2]:
        held += part
        while len(held) >= size:
            yield bytes(held[:size])
            del held[:size]
    if held:
        yield bytes(held)


#: Where a member or a plain record may begin.
_BEGINS = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def salvage(source: bytes | io.IOBase | pa.NativeFile | Archive, keep: int = PART_BYTES) -> Iterator[Record | Gap]:
    """All valid records in order, and the gaps between them."""
    archive = source if isinstance(source, Archive) else Archive(source)
    at, gap, reason = 0, None, ""
    while at < archive.size:
        try:
            found = _record(archive, at, keep)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = archive.find(_BEGINS, at + 1, 7)
            continue
        if gap is not None:
            yield Gap(gap, at, reason)
            gap = None
        yield found
        at = found.end
    if gap is not None:
        yield Gap(gap, archive.size, reason)


def classify(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to (null for responses). Only digests are shuffled while their repeats are few."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    repeats = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    repeats = hold(repeats.filter("n > 1").select("payload_digest", "first"), "payloads")
    few = repeats.count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(repeats) if few else repeats, "payload_digest", "left")
    return rows.select("page_id", "url", "payload", "payload_digest", F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, path: str, roll: int = ROLL_BYTES, torn: bool = False) -> DataFrame:
    """Write the rows of ``classify`` as archives under ``path``; returns the manifest (file, n_records, n_bytes).

    ``torn``: every archive begins with the first half of its first record, as a writer leaves it that died and began
    again: a drill, so that reading back has to salvage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        context = TaskContext.get()
        part, attempt, number = context.partitionId(), context.taskAttemptId(), 0
        out, n, size, made, begins = None, 0, 0, [], False

        def name() -> str:
            return f"{base}/part-{part:06d}-{number:05d}.warc.gz"

        def close() -> None:
            nonlocal out, n, size, number
            out.close()
            store.move(f"{base}/_writing-{part}-{number}-{attempt}", name())
            made.append((name().rpartition("/")[2], n, size))
            out, n, size, number = None, 0, 0, number + 1

        for batch in batches:
            for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/_writing-{part}-{number}-{attempt}", compression=None)
                    begins = True
                data = gzip.compress(record("response" if refers is None else "revisit", page_id, url, payload, digest, refers), 5, mtime=0)
                if begins and torn:
                    out.write(data[: len(data) // 2])
                    size += len(data) // 2
                begins = False
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll:
                    close()
        if out is not None:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*made, strict=True)], names=["file", "n_records", "n_bytes"])

    return hold(rows.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInArrow(run, "file string, n_records long, n_bytes long"), "warc-manifest")


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def _uri(path: str) -> str:
    return re.sub(r"^file:/(?!/)", "file:///", path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows of kind ``record`` (page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) and of kind
    ``gap``, with file, start, end, and ``gaps_before``: the gaps in the file ahead.

    A payload of more than ``part_bytes`` is null in its record's row and follows in rows of kind ``part``, numbered from 0
    in ``part``. Without ``payloads`` none is kept.
    """
    schema = "kind string, file string, start long, end long, reason string, gaps_before long, part long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    arrow = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in schema.split(", "))])

    def rows_of(file: str) -> Iterator[tuple]:
        store, at = fs.FileSystem.from_uri(_uri(file))
        with store.open_input_file(at) as opened:
            archive, gaps = Archive(opened), 0
            for x in salvage(archive, part_bytes if payloads else 0):
                if isinstance(x, Gap):
                    yield ("gap", file, x.start, x.end, x.reason, gaps, *[None] * 8)
                    gaps += 1
                    continue
                h, kind = x.headers, x.headers.get("warc-type")
                length, digest = x.n_bytes, x.digest
                if kind == "revisit":
                    length, digest = int(h.get("warc-payload-length", "0")), h.get("warc-payload-digest", "").removeprefix("sha256:")
                ids = _page(h.get("warc-record-id")), h.get("warc-target-uri"), length, digest, kind, _page(h.get("warc-refers-to"))
                yield ("record", file, x.start, x.end, None, gaps, None, *ids, x.payload if payloads and kind != "revisit" else None)
                if payloads and x.payload is None:
                    for number, part in enumerate(payload_parts(archive, x.start, part_bytes)):
                        yield ("part", file, x.start, x.end, None, gaps, number, *ids, part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)
        for batch in batches:
            rows, size = [], 0
            for file in batch.column("path").to_pylist():
                for row in rows_of(file):
                    rows.append(row)
                    size += 200 + len(row[-1] or b"")
                    if size > 8_000_000:
                        yield made(rows)
                        rows, size = [], 0
            if rows:
                yield made(rows)

    # names and sizes only: the content is streamed where it is read
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path)
    return files.select("path").mapInArrow(run, schema)


def round_trip(pages: DataFrame, torn: bool = True) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back: the records, without payloads.

    Every archive has a torn beginning (see ``write_archives``), so all records come by way of salvage. The gaps are written
    as a table, ``gap_log`` names its path; records that were written and not read back raise.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    manifest = write_archives(classify(pages), path, torn=torn)
    written = manifest.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n")).first().n
    release(manifest)
    if not written:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, gaps_before long")
    return account(read_archives(spark, path, payloads=False), path, written)


def gap_log(path: str) -> str:
    return f"{path}-gaps"


def account(found: DataFrame, path: str, written: int) -> DataFrame:
    """The records of the archives under ``path``; the gaps go to the gap log, the archives go when all were read back."""
    rows = hold(found.drop("payload"), "warc-records")
    spark = rows.sparkSession
    rows.filter("kind = 'gap'").select("file", "start", "end", "reason").write.mode("overwrite").parquet(gap_log(path))
    n = rows.filter("kind = 'record'").count()
    if n < written:
        raise RuntimeError(f"{written - n} of {written} records under {path} were not read back; the gaps are in {gap_log(path)}")
    delete_path(spark, path)
    return rows.filter("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "gaps_before")
