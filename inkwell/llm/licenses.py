"""License scans by canonical digest (operator 1).

A text is normalised as license matching guidelines advise: lower case, copyright lines dropped, every run of
non-alphanumerics one space, equivalent spellings unified. The SHA-256 of what is left is hash-joined to the digests of
known texts: whole licenses (a file each in ``data/licenses``) and notices and standard headers (``data/notices.tsv``).
Entire texts are looked up, and so are lines and paragraphs that speak of a license, all in the one table; it is
broadcast only up to a number of rows.

Only documents that speak of a license at all have their parts exploded and gathered again, by their digests.

Defined results: null texts have a null digest and no license; texts without words have the digest of the empty
string, which is no known license; repeated rows each give a row; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of known digests (64 digits and a name each) of at most so many rows are broadcast: 10 MB.
BROADCAST_ROWS = 100_000
DATA = Path(__file__).resolve().parent / "data"

COPYRIGHT_LINE = r"(?m)^[^\S\n]*(?:copyright[^\S\n]*(?:\(c\)|©|[0-9<\[{]|by )|©|\(c\)[^\S\n]*(?:copyright|[0-9<\[{])|all rights reserved)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Equivalent spellings, as substrings of normalised text.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("organisation", "organization"),
    ("copyright owner", "copyright holder"), ("authorisation", "authorization"), ("per cent", "percent"), ("merchantibility", "merchantability"),
)

#: Lines and paragraphs are worth normalising if they hold this.
MARK = "licen"
PARAGRAPHS = r"\n[ \t\r]*\n"


def known_texts(folder: Path = DATA) -> list[tuple[str, str]]:
    """(license, text) of all whole licenses and notices."""
    whole = [(p.stem, p.read_text()) for p in sorted((folder / "licenses").glob("*.txt"))]
    return whole + [tuple(x.split("\t")) for x in (folder / "notices.tsv").read_text().splitlines() if x]


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.trim(F.regexp_replace(out, NOT_WORD, " "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, texts: Iterable[tuple[str, str]]) -> DataFrame:
    """(digest, license_id) of the texts, a row per digest."""
    rows = spark.createDataFrame(list(texts), "license_id string, text string")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, license_id (of the entire text), notices (licenses of known lines and paragraphs, sorted, comma-joined), n_license_lines."""
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    speaks = lambda x: F.coalesce(F.contains(F.lower(x), F.lit(MARK)), F.lit(False))
    silent = rows.filter(~speaks(F.col("text"))).select("doc_id", digest(F.col("text")).alias("digest")).join(known, "digest", "left")
    silent = silent.select("doc_id", "digest", "license_id", F.lit("").alias("notices"), F.lit(0).cast("long").alias("n_license_lines"))
    told = rows.filter(speaks(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    lines = F.filter(F.split("text", "\n"), speaks)
    paragraphs = F.filter(F.split("text", PARAGRAPHS), lambda x: speaks(x) & F.contains(x, F.lit("\n")))
    part = lambda kind, x: F.struct(F.lit(kind).alias("kind"), digest(x).alias("digest"))
    parts = F.concat(F.array(part("text", F.col("text"))), F.transform(lines, lambda x: part("line", x)), F.transform(paragraphs, lambda x: part("paragraph", x)))
    units = told.select("row", "doc_id", F.explode(parts).alias("unit")).select("row", "doc_id", "unit.kind", "unit.digest").join(known, "digest", "left")
    whole = F.col("kind") == "text"
    found = units.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max(F.when(whole, F.col("digest"))).alias("digest"), F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(F.when(~whole, F.col("license_id")))), ",").alias("notices"), F.count_if(F.col("kind") == "line").alias("n_license_lines"),
    )
    return silent.unionByName(found.drop("row"))
