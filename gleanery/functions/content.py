"""Chat content as Columns: parts of a message (arrays of VARIANT), assets, links anywhere in a node, message envelopes."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import strip

# fixed values: content types whose parts hold text, and how asset types are named
TEXT_TYPES = ("text", "multimodal_text", "tool_result", "code", "json", "user_editable_context")
ASSET_SUFFIX, AV_TYPE, AUDIO_TYPE = "_asset_pointer", "real_time_user_audio_video_asset_pointer", "audio_asset_pointer"
ROLES = ("system", "user", "assistant")

ASSET = "struct<content_type:string,format:string,size_bytes:bigint,asset_pointer:string>"
_URL = re.compile(r"https?://[^\s\")]+", re.I)


def _is_object(p: Column) -> Column:
    return F.schema_of_variant(p).startswith("OBJECT")


def _is_text(p: Column) -> Column:
    return F.schema_of_variant(p) == "STRING"


def part_types(kind: Column, parts: Column) -> Column:
    """``str`` of a string part; of an object its content type, or ``dict``.  Empty for types that hold no text."""
    one = lambda p: F.when(_is_text(p), "str").when(_is_object(p), F.coalesce(F.nullif(F.try_variant_get(p, "$.content_type", "string"), F.lit("")), F.lit("dict")))
    return F.when(kind.isin(*TEXT_TYPES), F.filter(F.transform(parts, one), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def parts_text(kind: Column, parts: Column, null_text: str | None = "None") -> Column:
    """Texts of the string parts and of the objects that have one, joined by line feeds, stripped.  A text that is null
    counts as ``null_text``; with None it is left out."""

    def one(p: Column) -> Column:
        inner = F.try_variant_get(p, "$.text", "variant")
        said = F.when(F.is_variant_null(inner), F.lit(null_text)).when(_is_text(inner), F.try_variant_get(inner, "$", "string")).otherwise(F.to_json(inner))
        return F.when(_is_text(p), F.try_variant_get(p, "$", "string")).when(_is_object(p) & inner.isNotNull(), said)

    text = strip(F.array_join(F.filter(F.transform(parts, one), lambda x: x.isNotNull()), "\n"))
    return F.when(kind.isin(*TEXT_TYPES), text).otherwise("")


def part_assets(parts: Column) -> Column:
    """Array of ASSET: every part whose type says it points to one; audio and video parts add their nested audio."""

    def pick(p: Column, at: str, kind: Column) -> Column:
        return F.struct(
            kind.alias("content_type"), F.try_variant_get(p, f"{at}.format", "string").alias("format"), F.try_variant_get(p, f"{at}.size_bytes", "bigint").alias("size_bytes"), F.try_variant_get(p, f"{at}.asset_pointer", "string").alias("asset_pointer")
        )

    def one(p: Column) -> Column:
        kind = F.when(_is_object(p), F.try_variant_get(p, "$.content_type", "string"))
        own = F.when(kind.endswith(ASSET_SUFFIX), pick(p, "$", kind))
        audio = F.when((kind == AV_TYPE) & (F.try_variant_get(p, f"$.{AUDIO_TYPE}.asset_pointer", "string") != ""), pick(p, f"$.{AUDIO_TYPE}", F.lit(AUDIO_TYPE)))
        return F.array_compact(F.array(own, audio))

    return F.flatten(F.transform(parts, one)).cast(f"array<{ASSET}>")


def _walk(value, found: set[str]) -> None:
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            todo += v.values()
        elif isinstance(v, list):
            todo += v
        elif isinstance(v, str):
            found.update(_URL.findall(v))


def deep_urls(node: Column) -> Column:
    """Sorted distinct links of every string value in a JSON text, however deep; escapes are resolved first, which no
    pattern over the JSON text could do.  Texts without ``http`` are not parsed."""

    @F.pandas_udf("array<string>")
    def walk(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[str]:
            found: set[str] = set()
            _walk(json.loads(t), found)
            return sorted(found)

        return texts.map(lambda t: one(t) if t and "http" in t.lower() else [])

    return walk(node)


def as_variant(text: Column) -> Column:
    return text.cast("variant")


def envelope(role: Column, text: Column, tool_call: Column, tool_result: Column, tool_name: Column, recipient: Column, raw: Column) -> Column:
    """A turn as a chat message, or null for other roles: a call has the tool's name and arguments, a result its name and
    raw content (JSON text), the rest role and text.  Fields that don't apply are null and left out of the JSON."""
    body = F.coalesce(F.try_parse_json(raw), as_variant(F.coalesce(text, F.lit(""))))
    blank = F.lit(None)
    shape = "struct<role:string,tool_call:struct<name:string,arguments:variant>,name:string,content:variant>"
    call = F.struct(F.lit("assistant").alias("role"), F.struct(F.coalesce(F.nullif(tool_name, F.lit("")), F.nullif(recipient, F.lit("")), F.lit("tool")).alias("name"), body.alias("arguments")).alias("tool_call"), blank.cast("string").alias("name"), blank.cast("variant").alias("content"))
    none = blank.cast("struct<name:string,arguments:variant>").alias("tool_call")
    result = F.struct(F.lit("tool").alias("role"), none, F.coalesce(F.nullif(tool_name, F.lit("")), F.lit("tool")).alias("name"), body.alias("content"))
    plain = F.struct(role.alias("role"), none, blank.cast("string").alias("name"), as_variant(F.coalesce(text, F.lit(""))).alias("content"))
    return F.when(tool_call, call.cast(shape)).when(tool_result, result.cast(shape)).when(role.isin(*ROLES), plain.cast(shape))
