"""Text functions as Columns, with Python's regular-expression semantics on Java's engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's strip removes.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is named, also within lambda functions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def py(pattern: str, flags: str = "") -> str:
    """Unicode classes, and only ``\\n`` as a line end, as in Python; ``flags`` of i, m, s."""
    return f"(?dU{flags}){pattern}"


def strip(text: Column) -> Column:
    """Without white space at either end; looks at the ends only, where a pattern would go through the whole text."""
    return F.btrim(text, F.lit(SPACE))


def first(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """The group of the first match, stripped; null without a match."""
    p = py(pattern, flags)
    return F.when(F.regexp_like(text, F.lit(p)), strip(F.regexp_extract(text, p, group)))


def every(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """The group of all matches, in order; empty text where the group took no part."""
    return F.regexp_extract_all(text, F.lit(py(pattern, flags)), F.lit(group))


def rows(text: Column, pattern: str, names: list[str], flags: str = "") -> Column:
    """All matches as structs of their groups, named in order."""
    groups = [every(text, pattern, flags, i + 1) for i in range(len(names))]
    return F.arrays_zip(*[g.alias(n) for g, n in zip(groups, names, strict=True)])


def normalize_tag(tag: Column) -> Column:
    """Strip, lower case, white space to hyphens, nothing but word characters and hyphens."""
    hyphened = F.regexp_replace(F.lower(strip(tag)), r"(?U)\s+", "-")
    return F.regexp_replace(hyphened, r"(?U)[^\w\-]", "")


def distinct_ignoring_case(items: Column) -> Column:
    """The first spelling of each item, in order; items that differ by case and outer white space only are one."""
    def firsts(found: Column) -> Column:
        keys = F.transform(found, lambda x: strip(F.lower(x)))
        return let(keys, lambda k: F.filter(found, lambda x, i: F.array_position(k, F.get(k, i)) == i + 1))

    return let(items, firsts)


def text_list() -> Column:
    return F.array().cast("array<string>")


def nonempty(items: Column) -> Column:
    """Null as an empty list of texts."""
    return F.coalesce(items, text_list())


def doc_id(path: Column, content: Column) -> Column:
    """File stem and the first 8 digits of the content's md5."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.concat(stem, F.lit("_"), F.substring(F.md5(F.encode(content, "UTF-8")), 1, 8))
