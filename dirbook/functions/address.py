"""Addresses to prefecture, municipality, area and lot, by dictionaries of the directory's date.

Longest-prefix matching is one generated regular expression for each dictionary and exact lookups are literal maps, so the
whole split is built-in column work without a join or a Python call (but for NFKC, where the text needs it).
"""

from __future__ import annotations

import re
import unicodedata
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirbook import dictionary as D
from dirbook.functions.text import normalized, without_space

LOT = r"([0-9]+(?:-[0-9]+)*)$"
WARD = r"(?:大阪市)?([^\s,]{1,12}?区)"


def valid_from(as_of: Column) -> Column:
    """The dictionary for a date: the latest that isn't after it, by string order; the earliest for null."""
    return F.when(as_of >= D.LATE, F.lit(D.LATE)).otherwise(F.lit(D.EARLY))


def lot_number(area: Column) -> Column:
    return F.regexp_extract(area, LOT, 1)


def without_lot(area: Column) -> Column:
    return F.trim(F.regexp_replace(area, LOT, ""))


def local_name(municipality: Column) -> Column:
    """What follows the district, without its last 市, 町, 村 or 区."""
    return F.regexp_replace(F.regexp_replace(municipality, "^.*郡", ""), "[市町村区]$", "")


def _literal(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def longest_prefix(address: Column, version: str) -> Column:
    """The longest prefix that is shorter than the address, or the empty string."""
    return F.regexp_extract(address, f"^({'|'.join(D.starts(version))})(.+)$", 1)


def _commas(column: Column) -> Column:
    return F.regexp_replace(column, "^,+|,+$", "")


def _after(column: Column, head: Column) -> Column:
    return F.substring(column, F.char_length(head) + 1, F.lit(1 << 30))


def _resolved(prefix: Column, rest: Column, version: str) -> Column:
    """(prefecture, municipality, rest) of an address split in two, null if the prefix means nothing."""
    towns: dict[str, dict[str, str]] = {}
    for name, town in D.profile(version).towns.items():
        towns.setdefault(town[: town.index("郡") + 1], {})[name] = town
    district = F.try_element_at(_literal(D.district_names()), prefix)
    town = F.lit("")
    for where, names in towns.items():
        longest = "|".join(sorted(names, key=lambda x: (-len(x), x)))
        town = F.when(district == where, F.regexp_extract(rest, f"^({longest})", 1)).otherwise(town)
    full = F.try_element_at(_literal({f"{d}|{n}": t for d, names in towns.items() for n, t in names.items()}), F.concat_ws("|", district, town))
    in_district = F.when((town != "") & full.isNotNull(), F.struct(F.lit(D.OSAKA).alias("prefecture"), full.alias("municipality"), _commas(_after(rest, town)).alias("rest")))
    known = {p: "\t".join(x) for p, x in D.lookup(version).items()}
    place = F.split(F.try_element_at(_literal(known), prefix), "\t")
    names = F.array_sort(
        F.filter(F.array(prefix, local_name(prefix), local_name(place[1])), lambda x: F.char_length(x) >= 2),
        lambda a, b: F.char_length(b) - F.char_length(a),
    )
    repeated = F.get(F.filter(names, lambda x: rest.startswith(x)), 0)
    plain = F.when(repeated.isNull(), rest).otherwise(_commas(_after(rest, repeated)))
    by_name = F.when(place.isNotNull(), F.struct(place[0].alias("prefecture"), place[1].alias("municipality"), plain.alias("rest")))
    return F.coalesce(in_district, by_name)


def _split(address: Column, version: str) -> Column:
    comma = F.instr(address, ",")
    head, tail = F.substring_index(address, ",", 1), F.substring(address, comma + 1, F.lit(1 << 30))
    by_comma = F.when((comma > 1), _resolved(head, tail, version))
    longest = longest_prefix(address, version)
    by_prefix = F.when(longest != "", _resolved(longest, _after(address, longest), version))
    ward = F.regexp_extract(address, WARD, 1)
    whole = F.regexp_extract(address, WARD, 0)
    after_ward = _commas(F.substring(address, F.instr(address, whole) + F.char_length(whole), F.lit(1 << 30)))
    by_ward = F.struct(F.lit(D.OSAKA).alias("prefecture"), F.concat(F.lit("大阪市"), ward).alias("municipality"), F.when(ward == "", address).otherwise(after_ward).alias("rest"))
    return F.when(address == "", F.struct(F.lit(D.OSAKA).alias("prefecture"), F.lit("大阪市").alias("municipality"), F.lit("").alias("rest"))).otherwise(F.coalesce(by_comma, by_prefix, by_ward))


def tidy_address(address: Column, nfkc: bool = True) -> Column:
    return without_space(F.translate(normalized(address, nfkc), "、，", ",,"))


def split_text(text: str, version: str) -> tuple[str, str, str]:
    """(prefecture, municipality, rest) of one address, as split_address() gives them, for code that folds rows in Python."""
    address = re.sub(r"[^\S\x1c-\x1f]+", "", unicodedata.normalize("NFKC", text or "").strip().translate({ord(c): "," for c in "、，"}))
    if not address:
        return D.OSAKA, "大阪市", ""
    head, comma, tail = address.partition(",")
    longest = next((p for p in D.starts(version) if address.startswith(p) and address != p), "")
    towns = D.profile(version).towns
    for prefix, rest in ([(head, tail)] if comma else []) + [(longest, address[len(longest) :])]:
        if not prefix:
            continue
        district = D.district_names().get(prefix)
        names = [n for n, t in towns.items() if district and t.startswith(district) and rest.startswith(n)]
        if names:
            name = max(names, key=len)
            return D.OSAKA, towns[name], rest[len(name) :].strip(",")
        if place := D.lookup(version).get(prefix):
            local = [re.sub("[市町村区]$", "", x.rpartition("郡")[2]) for x in (prefix, place[1])]
            said = max((x for x in (prefix, *local) if len(x) > 1 and rest.startswith(x)), key=len, default="")
            return *place, rest[len(said) :].strip(",") if said else rest
    if m := re.search(WARD, address, re.ASCII):
        return D.OSAKA, "大阪市" + m[1], address[m.end() :].strip(",")
    return D.OSAKA, "大阪市", address


def split_address(df: DataFrame, address: str, as_of: str, nfkc: bool = True) -> DataFrame:
    """df with prefecture, municipality, area and lot of its column `address` at the date in `as_of`.

    In order: the text before the first comma, or else the longest dictionary prefix, is a district before a town of its
    own or a known name; otherwise the first ward name found; otherwise all of it is an area of the city.
    """
    text, at = tidy_address(F.col(address), nfkc), valid_from(F.col(as_of))
    tidy = df.withColumn("__address", text).withColumn("__version", at)
    split = F.when(F.col("__version") == D.LATE, _split(F.col("__address"), D.LATE)).otherwise(_split(F.col("__address"), D.EARLY))
    # through a generator, so that filters on the parts don't make the optimizer write the split out again
    found = tidy.select("*", F.explode(F.array(split)).alias("__found"))
    rest = F.col("__found.rest")
    parts = {"prefecture": F.col("__found.prefecture"), "municipality": F.col("__found.municipality"), "area": without_lot(rest), "lot": lot_number(rest)}
    return found.withColumns(parts).drop("__address", "__version", "__found")
