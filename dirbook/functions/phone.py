"""Telephone numbers: extraction, normalisation of two kinds, candidate lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dirbook.functions.text import normalized, strip, without_space

# fixed values: what a number looks like in print, its area code, its dashes, what needs no tidying
PATTERN = r"(?:※?[0-9]{2,4}[-()（）]?[0-9]{1,4}[-()（）]?[0-9]{2,4}(?:代表|代)?|※?[0-9]{3,4}-[0-9]{3,4}(?:代表|代)?|※?[0-9]{3,4}(?:代表|代)?)"
AREA_CODE = "06"
DASHES = "－‐‑‒–—―ー"
PLAIN = r"^(?:[0-9]{3,4}-[0-9]{3,4}|[0-9]{2,4}-[0-9]{1,4}-[0-9]{2,4})\z"
CANONICAL = r"^06-[0-9]{3}-[0-9]{4}\z"


def first_number(text: Column) -> Column:
    """The first number in a text, or the empty string."""
    return F.regexp_extract(text, PATTERN, 0)


def with_area_code(number: Column) -> Column:
    bare = F.when(number.startswith("※"), F.substring(number, 2, 1 << 30)).otherwise(number)
    return F.when(number == "", F.lit("")).when(bare.startswith("0"), bare).otherwise(F.concat(F.lit(AREA_CODE + "-"), bare))


def _tidy(number: Column) -> Column:
    dashed = F.btrim(F.regexp_replace(without_space(number), "--+", "-"), F.lit("-"))
    return F.regexp_replace(dashed, "(?:代表|代)$", "")


def export_number(phone: Column, fallback: Column | None = None, nfkc: bool = True) -> Column:
    """As entries are exported: brackets are dashes, a missing area code is added; a blank number is looked for in the fallback."""
    found = normalized(phone, nfkc)
    if fallback is not None:
        found = F.when(found == "", first_number(normalized(fallback, nfkc))).otherwise(found)
    return with_area_code(_tidy(F.translate(found, "()（）", "----")))


def publish_number(phone: Column, nfkc: bool = True) -> Column:
    """As tables are published: all dashes alike, no area code added."""
    return _tidy(F.translate(normalized(phone, nfkc), DASHES, "-" * len(DASHES)))


def number_candidates(values: Column, fallback: Column) -> Column:
    """Distinct numbers of an array of texts that are normalised already, or else the one in the fallback.

    Each step's array is bound to a variable before the next uses it, so nothing is computed twice for an element. Separators
    are made one before the split, as a split by a single character takes no expression; empty parts fall away later. Where all are plain already, none of that is done."""
    parts = F.flatten(F.transform(F.filter(values, lambda v: v != ""), lambda v: F.split(F.translate(F.btrim(v, F.lit("{}")), "、，/|", ",,,,"), ",")))
    hits = F.transform(parts, lambda p: F.coalesce(F.nullif(first_number(p), F.lit("")), p))
    tidy = F.transform(hits, lambda p: _tidy(F.translate(strip(p), "()（）", "----")))
    ready = F.when(F.forall(values, lambda v: v.rlike(PLAIN)), values).otherwise(tidy)
    found = F.array_distinct(F.filter(F.transform(ready, with_area_code), lambda x: x != ""))
    spoken = F.array(_tidy(F.translate(first_number(normalized(fallback, nfkc=False)), "()（）", "----")))
    other = F.filter(F.transform(spoken, with_area_code), lambda x: x != "")
    return F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, f).otherwise(other))[0]


def only_numbers(text: Column, numbers: Column) -> Column:
    """Whether a text holds nothing but numbers and marks."""
    rest = F.regexp_replace(F.regexp_replace(text, PATTERN, ""), r"(?U)[\s.．\-‐ー―−–—()（）{}［］\[\]、,，/|…・:：]+", "")
    return (F.size(numbers) > 0) & (text != "") & (rest == "")
