"""JSON that models write: the first object in a text, response texts, nested keys."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_DECODER = json.JSONDecoder()


def first_object(text: str | None) -> dict | None:
    """The first JSON object that decodes, from any opening brace on; text around it, fences included, is ignored."""
    cleaned = (text or "").strip()
    if "```" in cleaned:
        cleaned = re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", cleaned, flags=re.M), flags=re.M)
    at = cleaned.find("{")
    while at >= 0:
        try:
            found = _DECODER.raw_decode(cleaned, at)[0]
        except (ValueError, RecursionError):
            found = None
        if isinstance(found, dict):
            return found
        at = cleaned.find("{", at + 1)
    return None


@F.pandas_udf(StringType())
def _extract(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if (o := first_object(x)) is None else json.dumps(o, ensure_ascii=False, separators=(",", ":"), sort_keys=True))


def extract_object(text: Column) -> Column:
    """first_object() as compact JSON with sorted keys; null if there is none."""
    return _extract(text)


def find_uri(value: object) -> str:
    """The first fileUri or file_uri in nested JSON, depth first."""
    if isinstance(value, dict):
        for key in ("fileUri", "file_uri"):
            if isinstance(value.get(key), str) and value[key]:
                return value[key]
        value = list(value.values())
    if isinstance(value, list):
        for item in value:
            if uri := find_uri(item):
                return uri
    return ""


@F.pandas_udf(StringType())
def _uris(values: pd.Series) -> pd.Series:
    return values.map(lambda x: find_uri(_decoded(x)))


def _decoded(text: str | None) -> object:
    try:
        return json.loads(text or "null")
    except (ValueError, RecursionError):
        return None


def find_uri_column(value: Column) -> Column:
    """find_uri() of JSON texts; empty where there is none or the text isn't JSON."""
    return _uris(value)


def output_key(uri: Column) -> Column:
    """A result's key: the file's base name without its extension."""
    return F.regexp_replace(F.regexp_extract(uri, r"([^/]*)\z", 1), r"\.[^.]*\z", "")


def response_text(response: Column) -> Column:
    """The text of a JSON response: its own, or else that of all parts of all candidates."""
    parts = F.from_json(response, "struct<text:string,candidates:array<struct<content:struct<parts:array<struct<text:string>>>>>>")
    texts = F.flatten(F.transform(F.coalesce(parts["candidates"], F.array()), lambda c: F.coalesce(c["content"]["parts"], F.array())))
    return F.coalesce(F.when(parts["text"] != "", parts["text"]), F.array_join(F.transform(texts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))
