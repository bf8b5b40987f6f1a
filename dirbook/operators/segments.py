"""Recognised segments: strict normalisation of model responses, quality summaries of columns and books."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirbook.functions.jsons import first_object
from dirbook.operators import strict
from dirbook.operators.rules import NO_CONTINUITY, SHORT_TYPES, TYPES
from dirbook.operators.scans import unused

HINTS = "struct<phone:string,name:string,address:string>"
CONTINUITY = "struct<sameEntry:boolean,previousSegmentId:string,mergedCleanText:string,confidence:double,reason:string>"
SEGMENT = (
    "segmentId string, sequence int, entryType string, rawText string, cleanText string, indentLevel int, startsMidEntry boolean, endsMidEntry boolean, "
    f"entryHints {HINTS}, phones array<string>, names array<string>, addresses array<string>, reviewFlags array<string>, continuityFromPrevious {CONTINUITY}, confidence double"
)


class Invalid(ValueError):
    """A response that breaks the schema; all of it is rejected."""


def _need(value, kind, name: str):
    if type(value) is kind:
        return value
    wrong_bool = isinstance(value, bool) and kind is not bool
    if wrong_bool or not isinstance(value, kind):
        raise Invalid(f"{name} is {type(value).__name__}")
    return value


def _integer(value, name: str) -> int:
    if not -(1 << 31) <= _need(value, int, name) < 1 << 31:
        raise Invalid(f"{name} is beyond 32 bits")
    return value


def _texts(owner: dict, key: str, name: str) -> list[str]:
    given = owner.get(key)
    if given is None and key not in owner:
        return []
    found = {}
    for x in _need(given, list, f"{name}.{key}"):
        if text := (x if type(x) is str else _need(x, str, f"{name}.{key}")).strip():
            found[text] = None
    return list(found)


def _as_text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False) if value else ""


def _flag(flags: list[str], **when: bool) -> list[str]:
    return list(dict.fromkeys([*flags, *(name for name, on in when.items() if on)]))


def _clamped(value: float) -> float:
    return min(1.0, max(0.0, float(value)))


def _compact(row: dict, i: int, page: int, column: int) -> dict:
    name = f"r[{i}]"
    kind = SHORT_TYPES.get(_need(row.get("t"), str, f"{name}.t").strip())
    if kind is None:
        raise Invalid(f"{name}.t is unknown")
    text = _need(row.get("x", ""), str, f"{name}.x").rstrip()
    indent = _integer(row.get("i", 0), f"{name}.i")
    phones, names, addresses, flags = _texts(row, "p", name), _texts(row, "n", name), _texts(row, "a", name), _texts(row, "f", name)
    starts, ends = row.get("s") is True, row.get("e") is True
    if starts or ends or len(phones) > 1 or len(addresses) > 1:
        flags = _flag(flags, starts_mid_entry=starts, ends_mid_entry=ends, multi_phone=len(phones) > 1, multi_address=len(addresses) > 1)
    return {
        "segmentId": f"{page:04d}-{column:02d}-{i:04d}", "sequence": i, "entryType": kind, "rawText": text, "cleanText": text, "indentLevel": max(0, indent),
        "startsMidEntry": starts, "endsMidEntry": ends, "entryHints": {"phone": phones[0] if phones else "", "name": names[0] if names else "", "address": addresses[0] if addresses else ""},
        "phones": phones, "names": names, "addresses": addresses, "reviewFlags": flags, "continuityFromPrevious": NO_CONTINUITY.copy(), "confidence": 1.0,
    }


def _continuity(value, i: int, name: str) -> dict:
    value = _need({} if value is None else value, dict, name)
    found = {"sameEntry": _need(value.get("sameEntry", False), bool, f"{name}.sameEntry")}
    found |= {k: _need(value.get(k, ""), str, f"{name}.{k}").strip() for k in ("previousSegmentId", "mergedCleanText", "reason")}
    found["confidence"] = _clamped(_need(value.get("confidence", 0.0), (int, float), f"{name}.confidence"))
    if found["sameEntry"] and i != 1:
        return NO_CONTINUITY | {"reason": "continuity is only valid for the first segment"}
    return found


def _standard(row: dict, i: int, page: int, column: int) -> dict:
    name = f"segments[{i}]"
    hints = _need(row.get("entryHints", {}), dict, f"{name}.entryHints")
    kind = _need(row.get("entryType"), str, f"{name}.entryType").strip()
    if kind not in TYPES:
        raise Invalid(f"{name}.entryType is unknown")
    lists = {k: _texts(row, k, name) for k in ("phones", "names", "addresses", "reviewFlags")}
    given = {}
    for hint, key in (("phone", "phones"), ("name", "names"), ("address", "addresses")):
        value = _need(hints.get(hint, ""), str, f"{name}.entryHints.{hint}").strip() or next(iter(lists[key]), "")
        given[hint] = value
        if value and value not in lists[key]:
            lists[key] = [value, *lists[key]]
    continuity = _continuity(row.get("continuityFromPrevious"), i, f"{name}.continuityFromPrevious")
    same = continuity["sameEntry"]
    starts = _need(row.get("startsMidEntry", False), bool, f"{name}.startsMidEntry") or same
    ends = _need(row.get("endsMidEntry", False), bool, f"{name}.endsMidEntry")
    flags = _flag(lists["reviewFlags"], starts_mid_entry=starts, ends_mid_entry=ends, continued_from_previous=same, multi_phone=len(lists["phones"]) > 1, multi_address=len(lists["addresses"]) > 1)
    return {
        "segmentId": _as_text(row.get("segmentId")) or f"{page:04d}-{column:02d}-{i:04d}", "sequence": _integer(row.get("sequence", i), f"{name}.sequence"), "entryType": kind,
        "rawText": _need(row.get("rawText", ""), str, f"{name}.rawText").rstrip(), "cleanText": _need(row.get("cleanText", ""), str, f"{name}.cleanText").strip(),
        "indentLevel": max(0, _integer(row.get("indentLevel", 0), f"{name}.indentLevel")), "startsMidEntry": starts, "endsMidEntry": ends, "entryHints": given,
        "phones": lists["phones"], "names": lists["names"], "addresses": lists["addresses"], "reviewFlags": flags, "continuityFromPrevious": continuity,
        "confidence": _clamped(_need(row.get("confidence", 1.0), (int, float), f"{name}.confidence")),
    }


def normalize_response(payload: dict, page: int, column: int) -> list[dict]:
    """Segments of a response in the compact, the slim or the full schema. One bad row rejects the response."""
    compact = "r" in payload and "segments" not in payload
    rows = _need(payload.get("r" if compact else "segments", []), list, "rows")
    make = _compact if compact else _standard
    return [make(_need(row, dict, f"row {i}"), i, page, column) for i, row in enumerate(rows, 1)]


_TEXT, _LIST = pa.string(), pa.list_(pa.string())
_CONTINUITY = pa.struct([("sameEntry", pa.bool_()), ("previousSegmentId", _TEXT), ("mergedCleanText", _TEXT), ("confidence", pa.float64()), ("reason", _TEXT)])
#: SEGMENT as an Arrow type.
_SEGMENT = pa.struct([
    ("segmentId", _TEXT), ("sequence", pa.int32()), ("entryType", _TEXT), ("rawText", _TEXT), ("cleanText", _TEXT), ("indentLevel", pa.int32()), ("startsMidEntry", pa.bool_()), ("endsMidEntry", pa.bool_()),
    ("entryHints", pa.struct([("phone", _TEXT), ("name", _TEXT), ("address", _TEXT)])), ("phones", _LIST), ("names", _LIST), ("addresses", _LIST), ("reviewFlags", _LIST), ("continuityFromPrevious", _CONTINUITY), ("confidence", pa.float64()),
])


def normalize_responses(responses: DataFrame, *keys: str) -> DataFrame:
    """responses(page, column, text, keys...) with `segments` (array) or `error` (string), one of them null.

    Strict about types, which from_json is not: it would read 1 as "1". Whole numbers beyond 32 bits and text that is not
    Unicode are errors. Python in Arrow batches of typed rows, one pass, no shuffle.
    """
    names = [*keys, "page", "column"]

    def segments_of(text: str | None, page: int, column: int) -> list[dict]:
        payload = first_object(text)
        if payload is None:
            raise Invalid("no JSON object")
        if "\\ud" in text.lower():  # half of a pair that stands for one character
            try:
                json.dumps(payload, ensure_ascii=False).encode()
            except UnicodeEncodeError:
                raise Invalid("text is not Unicode") from None
        return normalize_response(payload, page, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments, errors = [], []
            for page, column, text in zip(*(batch[c].to_pylist() for c in ("page", "column", "text"))):
                try:
                    segments.append(segments_of(text, page, column))
                    errors.append(None)
                except Invalid as e:
                    segments.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(segments, pa.list_(_SEGMENT)), pa.array(errors, _TEXT)], [*names, "segments", "error"])

    numbers = {c: F.col(c).cast("int") for c in ("page", "column")}
    kinds = [f"{c} {responses.schema[c].dataType.simpleString()}" for c in keys]
    return responses.select(*names, "text").withColumns(numbers).mapInArrow(run, ", ".join([*kinds, "page int, column int", f"segments {_array_type()}", "error string"]))


def strict_responses(responses: DataFrame, *keys: str) -> DataFrame:
    """normalize_responses() with all texts that are plainly JSON objects kept on the JVM as VARIANT (see strict.py); only others, such as
    fenced ones, go to Python. The same rows; where Python workers are at hand, the parser above takes less CPU time."""
    numbers = {c: F.col(c).cast("int") for c in ("page", "column")}
    payload, plain = unused(responses, "payload"), unused(responses, "plain")
    read = responses.select(*keys, "page", "column", F.col("text").cast("string").alias("text")).withColumns(numbers).withColumn(payload, F.try_parse_json("text"))
    sorted_out = read.withColumn(plain, strict.plain(F.col("text"), F.col(payload)))
    told = sorted_out.where(plain).select(*keys, "page", "column", strict.outcome(F.col(payload), F.col("page"), F.col("column"), _array_type()).alias(payload))
    told = told.select(*keys, "page", "column", F.col(f"{payload}.segments").alias("segments"), F.col(f"{payload}.error").alias("error"))
    return told.unionByName(normalize_responses(sorted_out.where(~F.col(plain)).drop(payload, plain), *keys))


def _array_type() -> str:
    fields = ",".join(f"{name}:{kind}" for name, kind in (x.split(" ", 1) for x in SEGMENT.split(", ")))
    return f"array<struct<{fields}>>"


def expand_segments(documents: DataFrame) -> DataFrame:
    """A row for each segment of documents(book, file_key, segments), with its place in the file."""
    keys = [c for c in documents.columns if c != "segments"]
    return documents.select(*keys, F.posexplode("segments").alias("pos", "s")).select(*keys, "pos", "s.*")


def conditions(phone: Column, confidence: Column, phones: Column, mid: Column, continued: Column, flags: Column) -> dict[str, Column]:
    """What the quality summary counts of segments."""
    return {
        "without_phone": F.trim(F.coalesce(phone, F.lit(""))) == "",
        "low_confidence": F.coalesce(confidence, F.lit(0.0)) < 0.60,
        "multi_phone": F.size(F.filter(F.coalesce(phones, F.array().cast("array<string>")), lambda x: F.trim(x) != "")) > 1,
        "mid_entry": F.coalesce(mid, F.lit(False)),
        "continued": F.coalesce(continued, F.lit(False)),
        "flagged": F.size(F.coalesce(flags, F.array().cast("array<string>"))) > 0,
    }


def quality_rollup(segments: DataFrame, counted: dict[str, Column], book: str, column: str) -> DataFrame:
    """Counts for each column, each book and all: one pass by rollup. Levels: 0 column, 1 book, 3 all."""
    aggs = [F.count("*").alias("segments"), *[F.count_if(c).alias(n) for n, c in counted.items()]]
    return segments.rollup(book, column).agg(*aggs, F.grouping_id().alias("level"))


def column_flags(counts: DataFrame) -> Column:
    """Flags of a column from its counts, sorted as they are listed."""
    c = lambda name: counts[name]
    flags = F.array(
        F.when(c("segments") == 0, F.lit("empty_segments")),
        F.when((c("segments") > 0) & (c("without_phone") * 2 > c("segments")), F.lit("many_segments_without_phone")),
        F.when(c("low_confidence") > 0, F.lit("low_confidence_segments")),
        F.when(c("mid_entry") > 0, F.lit("mid_entry_segments")),
        F.when(c("continued") > 0, F.lit("continued_from_previous_segments")),
    )
    return F.filter(flags, lambda x: x.isNotNull())
