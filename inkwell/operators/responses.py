"""Answers of deciders: three ways to unwrap fences, and parsing that tells malformed from empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import py, strip

ENRICHMENT = "struct<domains:array<string>,patterns:array<string>,confidence:double,reasoning:string>"
ASSIGNMENT = "struct<decision:string,cluster_name:string,cluster_description:string,confidence:double,reason:string,updated_signature:struct<trigger_phrases:array<string>,typical_outputs:array<string>>>"
MERGE = "struct<recommendation:string,skills:array<struct<skill_name:string,skill_description:string,activation_triggers:array<string>,cluster_names:array<string>,estimated_doc_count:int>>,rationale:string>"
AUDIT = "struct<is_pure:boolean,sub_topics:array<string>,recommendation:string,split_into:array<struct<skill_name:string,description:string,doc_ids_from_sample:array<string>>>,confidence:double,reasoning:string>"
PACKAGE = "struct<skill_name:string,description:string,skill_md:string,references_files:array<struct<path:string,contents:string>>,scripts_files:array<struct<path:string,contents:string>>,assets_files:array<struct<path:string,contents:string>>,traceability:struct<source_doc_ids:array<string>,section_sources:map<string,array<string>>>>"


def inside_fence(text: Column) -> Column:
    """If the text starts with a fence, the lines up to the next fence line, or all the rest."""
    t = strip(text)
    return F.when(t.startswith("```"), F.regexp_extract(t, py(r"^```[^\n]*\n?(.*?)(?:\n```.*)?$", "s"), 1)).otherwise(t)


def without_fences(text: Column) -> Column:
    """An opening fence with its language, and a closing fence, cut off."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"^```(?:json)?\s*", ""), r"\s*```$", "")


def without_fence_lines(text: Column) -> Column:
    """The first line dropped if it is a fence, and the last one too."""
    t = strip(text)
    lines = F.split(t, "\n")
    lines = F.when(F.get(lines, F.lit(0)).startswith("```"), F.slice(lines, 2, F.size(lines))).otherwise(lines)
    lines = F.when(strip(F.get(lines, F.size(lines) - 1)) == "```", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return F.array_join(lines, "\n")


def parse(text: Column, kind: str) -> Column:
    """The answer as a struct; null if it isn't a JSON object."""
    return F.when(F.try_parse_json(text).isNotNull() & strip(text).startswith("{"), F.from_json(text, kind))
