"""Fenced code blocks: pairing of fences, headings and blocks is a string search with state, done in Arrow batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

BLOCK = "struct<language:string,code:string,heading:string,reuse_flag:boolean,notes:string>"
#: The same as a type object: workers import this module without a session that could parse text.
BLOCKS = ArrayType(StructType([StructField(n, BooleanType() if n == "reuse_flag" else StringType()) for n in ("language", "code", "heading", "reuse_flag", "notes")]))
# Fixed values of the format.
FENCED = re.compile(r"```(\w*)\n(.*?)```", re.S)
REUSABLE = re.compile(r"\[x\]\s*(?:Definitely|Likely)\s*reusable|reusable|should.*become.*skill.*\[x\]", re.I)
AROUND = 500


def find_blocks(content: str, nearest: bool = False) -> list[dict]:
    """Blocks in the order in which fence lines take them.

    Every fence line, closing ones too, takes the first block left whose code lies at or after the first place of this
    line's text, with the heading in force there; so a block may carry an earlier block's heading. With ``nearest`` each
    block gets the last heading before it instead.
    """
    found = [(m[1], m[2], m.start()) for m in FENCED.finditer(content)]
    if nearest:
        def title(at: int) -> str | None:
            marks = re.findall(r"^###.*", content[:at], re.M)
            return marks[-1].lstrip("#").strip() if marks else None

        return [_block(lang, code, title(at), content, at) for lang, code, at in found]
    out, heading = [], None
    for line in content.split("\n"):
        if line.startswith("###"):
            heading = line.lstrip("#").strip()
        elif line.startswith("```"):
            place = content.find(line)
            taken = next((i for i, (_, code, _) in enumerate(found) if content.find(code.strip(), place) >= 0), None)
            if taken is not None:
                lang, code, _ = found.pop(taken)
                out.append(_block(lang, code, heading, content, place))
    return out


def _block(lang: str, code: str, heading: str | None, content: str, place: int) -> dict:
    near = content[max(0, place - AROUND) : place + len(code) + AROUND]
    return {"language": lang or None, "code": code.strip(), "heading": heading, "reuse_flag": bool(REUSABLE.search(near)), "notes": None}


def merged_blocks(section: str | None, content: str | None, nearest: bool = False) -> list[dict]:
    """The section's blocks, then the whole document's; the first of equal code stays."""
    seen: dict[str, dict] = {}
    for block in find_blocks(section or "", nearest) + find_blocks(content or "", nearest):
        seen.setdefault(hashlib.md5(block["code"].encode()).hexdigest(), block)
    return list(seen.values())


@F.pandas_udf(BLOCKS)
def code_blocks(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for section, content in batches:
        yield pd.Series([merged_blocks(s, c) for s, c in zip(section, content, strict=True)])


@F.pandas_udf(BLOCKS)
def code_blocks_nearest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for section, content in batches:
        yield pd.Series([merged_blocks(s, c, True) for s, c in zip(section, content, strict=True)])
