"""The subpackage's queries, with production parameters over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import decontam, langid, licenses, mixing, quality, repetition, simhash, toxicity, urlfilter, warc
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark, licenses.known_texts()))


def op2_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op3_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_simhash_bk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "copies", "taken")


def op7_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.feed(spark, pages))


def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (
        op1_license_scan, op2_repetition_rules, op3_edit_decontamination, op4_quality_classifier, op5_simhash_bk,
        op6_source_mix, op7_warc_salvage, op8_toxicity, op9_url_filter, op10_language_spans,
    )
}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    line = licenses.COPYRIGHT_LINE.removeprefix("(?m)").replace(r"[^\S\n]", r"[ \t\r\f\v]")
    out = f"regexp_replace(lower({text}), {_quoted('(?m)' + line)}, ' ', 'g')"
    out = f"trim(regexp_replace({out}, {_quoted(licenses.NOT_WORD)}, ' ', 'g'))"
    for a, b in licenses.SPELLINGS:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return f"sha256({out})"


def _license_sql() -> str:
    known = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.known_texts())
    return f"""
WITH known AS (SELECT {_canonical_sql("t")} AS digest, min(id) AS license_id FROM (VALUES {known}) AS k(id, t) GROUP BY 1),
told AS (SELECT row_number() OVER () AS r, text FROM (SELECT DISTINCT text FROM documents WHERE contains(lower(text), '{licenses.MARK}'))),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS x FROM told),
paragraphs AS (SELECT r, unnest(string_split_regex(text, '{licenses.PARAGRAPHS}')) AS x FROM told),
parts AS (
  SELECT r, x, 1 AS n FROM lines WHERE contains(lower(x), '{licenses.MARK}')
  UNION ALL SELECT r, x, 0 FROM paragraphs WHERE contains(lower(x), '{licenses.MARK}') AND contains(x, chr(10))),
found AS (
  SELECT told.text, sum(p.n)::BIGINT AS n, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS notices
  FROM told JOIN parts p ON told.r = p.r LEFT JOIN known k ON {_canonical_sql("p.x")} = k.digest GROUP BY told.text)
SELECT d.doc_id, {_canonical_sql("d.text")} AS digest, k.license_id, coalesce(f.notices, '') AS notices, coalesce(f.n, 0)::BIGINT AS n_license_lines
FROM documents d LEFT JOIN known k ON {_canonical_sql("d.text")} = k.digest LEFT JOIN found f ON f.text = d.text"""


def _repetition_sql() -> str:
    """Windows of n words as joined text; a word is covered if one of the n windows around it is a later copy (of three words: any copy)."""
    limits = repetition.NGRAM_LIMITS
    lead = lambda n: " || ' ' || ".join(["w"] + [f"lead(w, {k}) OVER o" for k in range(1, n)])
    grams = ", ".join(f"CASE WHEN i + {n - 1} <= n THEN {lead(n)} END AS g{n}" for n in (3, *limits))
    copies = ", ".join(["g3 IS NOT NULL AND count(*) OVER (PARTITION BY r, g3) > 1 AS c3"] + [f"g{n} IS NOT NULL AND row_number() OVER (PARTITION BY r, g{n} ORDER BY i) > 1 AS c{n}" for n in limits])
    covered = ", ".join(f"bool_or(c{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS k{n}" for n in (3, *limits))
    shares = ", ".join(f"coalesce(sum(length(w)) FILTER (WHERE k{n}), 0) / greatest(1, sum(length(w))) AS dup_{n}gram_share" for n in limits)
    zero = ", ".join(f"coalesce(dup_{n}gram_share, 0.0)::DOUBLE AS dup_{n}gram_share" for n in limits)
    over = " OR ".join([f"dup_line_share > {repetition.LINES_LIMIT}", f"dup_line_char_share > {repetition.LINE_CHARS_LIMIT}"] + [f"dup_{n}gram_share > {x}" for n, x in limits.items()])
    word = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT r, regexp_extract_all(text, '{word}+') AS ws FROM d),
words AS (SELECT r, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM listed),
grams AS (SELECT r, i, w, {grams} FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
copied AS (SELECT r, i, w, {copies} FROM grams),
covered AS (SELECT r, w, {covered} FROM copied),
by_words AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(*) FILTER (WHERE k3) AS n_repeat_words, {shares} FROM covered GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
numbered AS (SELECT r, x, row_number() OVER (PARTITION BY r, x ORDER BY i) AS k FROM lines WHERE regexp_matches(x, '{word}')),
by_lines AS (
  SELECT r, count(*) FILTER (WHERE k > 1) AS n_dup_lines, count(*) FILTER (WHERE k > 1) / count(*) AS dup_line_share,
    coalesce(sum(length(x)) FILTER (WHERE k > 1), 0) / sum(length(x)) AS dup_line_char_share FROM numbered GROUP BY r),
m AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(dup_line_share, 0.0)::DOUBLE AS dup_line_share, coalesce(dup_line_char_share, 0.0)::DOUBLE AS dup_line_char_share, {zero}
  FROM d LEFT JOIN by_words w ON d.r = w.r LEFT JOIN by_lines l ON d.r = l.r),
b AS (SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT ({over}) AS kept FROM b"""


def _fraction_sql(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT::DOUBLE / 4294967296.0)"


_MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, text AS body, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
base AS (
  SELECT *, length(size::VARCHAR) * 100 + rpad(substr(size::VARCHAR, 1, 2), 2, '0')::INT AS class,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, body, '')), 1, 2))::INT AS bucket FROM sized),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, {mixing.CAP} * sum(size)::BIGINT AS lim,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM base GROUP BY source),
leveled AS (
  SELECT *, lim::DOUBLE / w AS ratio,
    (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY lim::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM src),
chosen AS (SELECT lev FROM leveled WHERE lev * w <= lim ORDER BY ratio, lev LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN c.lev * w >= lim THEN lim::DOUBLE ELSE c.lev * w END AS target,
    {_fraction_sql(f"'{mixing.SEED}:' || coalesce('v' || source, 'n')")} AS u FROM leveled, chosen c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, bucket, size, doc_id) AS k FROM base),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, t.u, r.k, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, least(floor(rate * k + u) - floor(rate * (k - 1) + u), {mixing.CAP})::BIGINT AS copies,
  least(floor(rate * k + u) - floor(rate * (k - 1) + u), {mixing.CAP})::BIGINT * size AS taken FROM placed"""

_WARC_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(octet_length(encode(html)), 0)::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {warc.MIN_REVISIT} GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN f.first IS NULL OR f.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first = page_id THEN NULL ELSE f.first END AS refers_to, 1 AS gaps_before
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest"""


def _url_sql() -> str:
    rules = sorted(urlfilter.RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for h, p, _ in rules]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, rules, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, rules, strict=True))
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in urlfilter.LISTED)
    listed = f"{listed} OR (host <> '' AND md5(host || path) < '{urlfilter.LISTED_BELOW}')"
    return f"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule, ({listed}) AS listed,
  CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict FROM p"""


ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": _license_sql(),
    "op2_repetition_rules": _repetition_sql(),
    "op6_source_mix": _MIX_SQL,
    "op7_warc_salvage": _WARC_SQL,
    "op9_url_filter": _url_sql(),
}
