"""Strict segments on the JVM: responses as VARIANT, types checked value by value, both schemas as column functions.

from_json would read 1 as "1" and drop what doesn't fit. Here a value keeps the type it was written with (schema_of_variant), and the first
that breaks the schema, in the order in which fields are read, is the response's error. A response whose text isn't plainly a JSON object
goes to the parser in Arrow batches instead: one in a fence or between words, with a key twice, an escaped half of a character pair, a number of
19 digits or more, or an id that is no text or whole number. Both give the same rows and errors. Measured side by side, an interpreted
lambda for each value costs several times the parser's time, so the parser is what stages use; this is for where no Python may run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dirbook.functions.text import strip
from dirbook.operators.rules import NO_CONTINUITY, SHORT_TYPES, TYPES



def get(owner: Column, key: str) -> Column:
    """The value of a key, as VARIANT; null if the key isn't there."""
    return F.try_variant_get(owner, f"$.{key}", "variant")


def kind(value: Column) -> Column:
    """The type of a value as errors name it: that of a JSON decoder. A value that isn't there is NoneType, too."""
    s = F.schema_of_variant(value)
    named = F.when(s == "STRING", F.lit("str")).when(s == "BIGINT", F.lit("int")).when(s == "BOOLEAN", F.lit("bool")).when(s.startswith("OBJECT"), F.lit("dict")).when(s.startswith("ARRAY"), F.lit("list"))
    return named.when(s.isNull() | (s == "VOID"), F.lit("NoneType")).otherwise(F.lit("float"))


#: How the type that a value was written with starts, for each kind.
_STARTS = {"str": ("STRING",), "int": ("BIGINT",), "bool": ("BOOLEAN",), "float": ("DECIMAL", "DOUBLE", "FLOAT"), "list": ("ARRAY",), "dict": ("OBJECT",), "NoneType": ("VOID",)}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often it is used, within lambdas as well."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def wrong(value: Column, name: Column, *kinds: str, required: bool = False) -> Column:
    """What is wrong with a value's type, null if nothing; one that isn't there is fine unless required."""
    fits = F.schema_of_variant(value).rlike("^(" + "|".join(s for k in kinds for s in _STARTS[k]) + ")")
    bad = ~F.coalesce(fits, F.lit(not required))
    return F.when(bad, F.concat(name, F.lit(" is "), kind(value)))


def as_text(value: Column, default: str = "") -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(default))


def items(value: Column) -> Column:
    """The elements of a list; none if it isn't there."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))


def first_of(errors: Column) -> Column:
    return F.get(F.filter(errors, lambda x: x.isNotNull()), F.lit(0))


def wrong_texts(owner: Column, key: str, name: Column) -> Column:
    value, label = get(owner, key), F.concat(name, F.lit(f".{key}"))
    return F.coalesce(wrong(value, label, "list"), first_of(F.transform(items(value), lambda x: wrong(x, label, "str", required=True))))


def texts(owner: Column, key: str) -> Column:
    """Stripped, without empty ones and repeats, in order."""
    return F.array_distinct(F.filter(F.transform(items(get(owner, key)), lambda x: strip(as_text(x))), lambda x: x != ""))


def wrong_integer(value: Column, name: Column) -> Column:
    n = F.try_variant_get(value, "$", "bigint")
    return F.coalesce(wrong(value, name, "int"), F.when((n < -(1 << 31)) | (n >= 1 << 31), F.concat(name, F.lit(" is beyond 32 bits"))))


def integer(value: Column, default: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "bigint"), default).cast("int")


def true(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "boolean"), F.lit(False))


def clamped(value: Column, default: float) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.try_variant_get(value, "$", "double"), F.lit(default))))


def flagged(flags: Column, **when: Column) -> Column:
    return F.array_distinct(F.concat(flags, F.filter(F.array(*[F.when(on, F.lit(name)) for name, on in when.items()]), lambda x: x.isNotNull())))


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)[\s\x1c-\x1f\x85]+$", "")


def head(found: Column) -> Column:
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def prepended(value: Column, found: Column) -> Column:
    return F.when((value != "") & ~F.array_contains(found, value), F.concat(F.array(value), found)).otherwise(found)


def _default_id(page: Column, column: Column, i: Column) -> Column:
    return F.format_string("%04d-%02d-%04d", page, column, i)


def compact_error(row: Column, i: Column) -> Column:
    name = F.format_string("r[%d]", i)
    t = get(row, "t")
    known = F.when(~strip(as_text(t)).isin(*SHORT_TYPES), F.concat(name, F.lit(".t is unknown")))
    lists = [wrong_texts(row, k, name) for k in "pnaf"]
    return F.coalesce(wrong(t, F.concat(name, F.lit(".t")), "str", required=True), known, wrong(get(row, "x"), F.concat(name, F.lit(".x")), "str"), wrong_integer(get(row, "i"), F.concat(name, F.lit(".i"))), *lists)


def compact(row: Column, i: Column, page: Column, column: Column) -> Column:
    short = F.create_map(*[F.lit(x) for pair in SHORT_TYPES.items() for x in pair])
    none = F.struct(*[F.lit(v).alias(k) for k, v in NO_CONTINUITY.items()])
    is_true = lambda k: (F.schema_of_variant(get(row, k)) == "BOOLEAN") & true(get(row, k))
    read = F.struct(
        short[strip(as_text(get(row, "t")))].alias("t"), rstrip(as_text(get(row, "x"))).alias("x"), F.greatest(F.lit(0), integer(get(row, "i"), F.lit(0))).alias("i"),
        *[texts(row, k).alias(k) for k in "pnaf"], *[F.coalesce(is_true(k), F.lit(False)).alias(k) for k in "se"],
    )
    return let(read, lambda b: F.struct(
        _default_id(page, column, i).alias("segmentId"), i.alias("sequence"), b["t"].alias("entryType"), b["x"].alias("rawText"), b["x"].alias("cleanText"), b["i"].alias("indentLevel"), b["s"].alias("startsMidEntry"), b["e"].alias("endsMidEntry"),
        F.struct(head(b["p"]).alias("phone"), head(b["n"]).alias("name"), head(b["a"]).alias("address")).alias("entryHints"), b["p"].alias("phones"), b["n"].alias("names"), b["a"].alias("addresses"),
        flagged(b["f"], starts_mid_entry=b["s"], ends_mid_entry=b["e"], multi_phone=F.size(b["p"]) > 1, multi_address=F.size(b["a"]) > 1).alias("reviewFlags"), none.alias("continuityFromPrevious"), F.lit(1.0).alias("confidence"),
    ))


_LISTS = ("phones", "names", "addresses", "reviewFlags")
_HINTS = (("phone", "phones"), ("name", "names"), ("address", "addresses"))
_SAID = ("previousSegmentId", "mergedCleanText", "reason")


def standard_error(row: Column, i: Column) -> Column:
    name = F.format_string("segments[%d]", i)
    at = lambda key: F.concat(name, F.lit(f".{key}"))
    hints, t, continuity = get(row, "entryHints"), get(row, "entryType"), get(row, "continuityFromPrevious")
    inside = lambda key, *kinds: wrong(get(continuity, key), at(f"continuityFromPrevious.{key}"), *kinds)
    return F.coalesce(
        wrong(hints, at("entryHints"), "dict"),
        wrong(t, at("entryType"), "str", required=True),
        F.when(~strip(as_text(t)).isin(*TYPES), at("entryType is unknown")),
        *[wrong_texts(row, k, name) for k in _LISTS],
        *[wrong(get(hints, h), at(f"entryHints.{h}"), "str") for h, _ in _HINTS],
        wrong(continuity, at("continuityFromPrevious"), "dict", "NoneType"),
        inside("sameEntry", "bool"), *[inside(k, "str") for k in _SAID], inside("confidence", "int", "float"),
        wrong(get(row, "startsMidEntry"), at("startsMidEntry"), "bool"),
        wrong(get(row, "endsMidEntry"), at("endsMidEntry"), "bool"),
        wrong_integer(get(row, "sequence"), at("sequence")),
        wrong(get(row, "rawText"), at("rawText"), "str"),
        wrong(get(row, "cleanText"), at("cleanText"), "str"),
        wrong_integer(get(row, "indentLevel"), at("indentLevel")),
        wrong(get(row, "confidence"), at("confidence"), "int", "float"),
    )


def standard(row: Column, i: Column, page: Column, column: Column) -> Column:
    own = get(row, "segmentId")
    number = F.try_variant_get(own, "$", "bigint")
    hints, continuity = get(row, "entryHints"), get(row, "continuityFromPrevious")
    read = F.struct(
        *[texts(row, k).alias(k) for k in _LISTS], *[strip(as_text(get(hints, h))).alias(h) for h, _ in _HINTS], *[strip(as_text(get(continuity, k))).alias(k) for k in _SAID],
        true(get(continuity, "sameEntry")).alias("claimed"), clamped(get(continuity, "confidence"), 0.0).alias("sure"), true(get(row, "startsMidEntry")).alias("starts"), true(get(row, "endsMidEntry")).alias("ends"),
        F.when(F.schema_of_variant(own) == "STRING", as_text(own)).when(number != 0, number.cast("string")).otherwise(F.lit("")).alias("id"),
    )

    def hinted(b: Column) -> Column:
        return F.struct(b.alias("b"), *[F.when(b[h] != "", b[h]).otherwise(head(b[k])).alias(h) for h, k in _HINTS], (b["claimed"] & (i == 1)).alias("same"), (b["claimed"] & (i != 1)).alias("stray"))

    def listed(c: Column) -> Column:
        return F.struct(c.alias("c"), *[prepended(c[h], c["b"][k]).alias(k) for h, k in _HINTS])

    def made(d: Column) -> Column:
        c, b = d["c"], d["c"]["b"]
        told = {k: F.when(c["stray"], F.lit(NO_CONTINUITY[k])).otherwise(b[k]) for k in _SAID}
        told["reason"] = F.when(c["stray"], F.lit("continuity is only valid for the first segment")).otherwise(b["reason"])
        starts = b["starts"] | c["same"]
        flags = flagged(b["reviewFlags"], starts_mid_entry=starts, ends_mid_entry=b["ends"], continued_from_previous=c["same"], multi_phone=F.size(d["phones"]) > 1, multi_address=F.size(d["addresses"]) > 1)
        return F.struct(
            F.when(b["id"] != "", b["id"]).otherwise(_default_id(page, column, i)).alias("segmentId"), integer(get(row, "sequence"), i).alias("sequence"), strip(as_text(get(row, "entryType"))).alias("entryType"),
            rstrip(as_text(get(row, "rawText"))).alias("rawText"), strip(as_text(get(row, "cleanText"))).alias("cleanText"), F.greatest(F.lit(0), integer(get(row, "indentLevel"), F.lit(0))).alias("indentLevel"),
            starts.alias("startsMidEntry"), b["ends"].alias("endsMidEntry"), F.struct(*[c[h].alias(h) for h, _ in _HINTS]).alias("entryHints"),
            d["phones"].alias("phones"), d["names"].alias("names"), d["addresses"].alias("addresses"), flags.alias("reviewFlags"),
            F.struct(c["same"].alias("sameEntry"), told["previousSegmentId"].alias("previousSegmentId"), told["mergedCleanText"].alias("mergedCleanText"), F.when(c["stray"], F.lit(0.0)).otherwise(b["sure"]).alias("confidence"), told["reason"].alias("reason")).alias("continuityFromPrevious"),
            clamped(get(row, "confidence"), 1.0).alias("confidence"),
        )

    return let(read, lambda b: let(hinted(b), lambda c: let(listed(c), lambda d: made(d))))


def plain(text: Column, payload: Column) -> Column:
    """Whether a text can be taken as VARIANT."""
    odd_id = F.exists(items(get(payload, "segments")), lambda row: wrong(get(row, "segmentId"), F.lit(""), "str", "int", "NoneType").isNotNull())
    return F.coalesce(F.schema_of_variant(payload).startswith("OBJECT") & ~text.rlike(r"(?i)\\ud|[0-9]{19}") & ~odd_id, F.lit(False))


def outcome(payload: Column, page: Column, column: Column, segment: str) -> Column:
    """(error, segments) of a payload that is plain: one of them is null; the segments are an array of type `segment`."""
    short = get(payload, "r").isNotNull() & get(payload, "segments").isNull()
    listed = F.when(short, get(payload, "r")).otherwise(get(payload, "segments"))

    def told(x: Column) -> Column:
        each = lambda of: F.transform(x["rows"], of)

        def row_error(check: Callable[[Column, Column], Column]) -> Column:
            one = lambda row, i: F.coalesce(wrong(row, F.format_string("row %d", i + 1), "dict", required=True), check(row, i + 1))
            return first_of(each(one))

        error = F.coalesce(x["wrong"], F.when(x["short"], row_error(compact_error)).otherwise(row_error(standard_error)))
        made = lambda make: each(lambda row, i: make(row, i + 1, page, column)).cast(segment)
        segments = F.when(x["short"], made(compact)).otherwise(made(standard))
        return let(error, lambda e: F.struct(e.alias("error"), F.when(e.isNull(), segments).alias("segments")))

    return let(F.struct(short.alias("short"), wrong(listed, F.lit("rows"), "list").alias("wrong"), items(listed).alias("rows")), told)
