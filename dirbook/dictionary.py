"""Municipality dictionaries of two dates, as maps for column expressions and as a reference table.

A dictionary is valid from its date on; an unknown date counts as the latest because dates are compared as strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

OSAKA, EARLY, LATE = "大阪府", "1963-02-01", "1968-03-01"

# fixed values: wards, cities, towns and their abbreviations as the directories use them
WARDS = ("北区", "都島区", "福島区", "此花区", "東区", "西区", "港区", "大正区", "天王寺区", "南区", "大淀区", "浪速区", "西淀川区", "東淀川区", "東成区", "生野区", "旭区", "城東区", "阿倍野区", "住吉区", "東住吉区", "西成区")
WARD_INITIALS = {"都": "都島区", "福": "福島区", "此": "此花区", "大": "大正区", "天": "天王寺区", "浪": "浪速区", "西淀": "西淀川区", "東淀": "東淀川区", "生": "生野区", "城": "城東区", "阿": "阿倍野区", "住": "住吉区", "東住": "東住吉区"}
CITIES = ("大阪市", "堺市", "岸和田市", "豊中市", "池田市", "吹田市", "泉大津市", "高槻市", "貝塚市", "守口市", "枚方市", "茨木市", "八尾市", "泉佐野市", "富田林市", "寝屋川市", "河内長野市", "松原市", "大東市", "和泉市", "箕面市", "柏原市", "羽曳野市", "布施市", "枚岡市", "河内市")
MERGED_CITIES, NEW_CITIES = ("布施市", "河内市", "枚岡市"), ("門真市", "摂津市", "高石市", "藤井寺市", "東大阪市")
TOWNS = ("三島郡島本町", "三島郡三島町", "豊能郡能勢町", "豊能郡東能勢村", "北河内郡門真町", "北河内郡四條畷町", "北河内郡交野町", "泉北郡高石町", "泉北郡忠岡町", "泉南郡熊取町", "泉南郡田尻町", "泉南郡岬町", "泉南郡泉南町", "泉南郡南海町", "泉南郡東鳥取町", "南河内郡太子町", "南河内郡河南町", "南河内郡美原町", "南河内郡千早赤阪村", "南河内郡狭山町", "南河内郡美陵町")
FORMER_TOWNS = ("三島郡三島町", "北河内郡門真町", "泉北郡高石町", "南河内郡美陵町")
DISTRICTS = {"北河内郡": ("北河", "北河内", "北河内郡"), "南河内郡": ("南河", "南河内", "南河内郡"), "泉北郡": ("泉北", "泉北郡"), "泉南郡": ("泉南", "泉南郡"), "三島郡": ("三島郡",), "豊能郡": ("豊能", "豊能郡")}
CITY_INITIALS = {EARLY: {"豊": "豊中市", "吹": "吹田市", "守": "守口市", "布": "布施市"}, LATE: {"豊": "豊中市", "吹": "吹田市", "守": "守口市", "三島": "摂津市", "藤": "藤井寺市", "美陵": "藤井寺市", "布": "東大阪市", "布施": "東大阪市", "河内": "東大阪市", "枚岡": "東大阪市"}}
NEIGHBOURS = {"尼": "尼崎市", "尼崎": "尼崎市", "伊丹": "伊丹市", "西宮": "西宮市", "芦屋": "芦屋市", "神戸": "神戸市"}
NEIGHBOUR_PREFECTURE = "兵庫県"


class Entry(NamedTuple):
    """A prefix that stands for a municipality. Of equal prefixes the least precedence counts; `starts`: whether an
    address may begin with it without a separator."""

    prefix: str
    kind: str
    prefecture: str
    municipality: str
    precedence: int
    starts: bool


class Profile(NamedTuple):
    valid_from: str
    wards: tuple[str, ...]
    cities: tuple[str, ...]
    towns: dict[str, str]
    city_names: dict[str, str]


@cache
def profile(valid_from: str) -> Profile:
    late = valid_from == LATE
    cities = tuple(c for c in CITIES if not (late and c in MERGED_CITIES)) + (NEW_CITIES if late else ())
    names = {town.split("郡", 1)[1]: town for town in TOWNS if not (late and town in FORMER_TOWNS)}
    towns = names | {name[:-1]: town for name, town in names.items()}
    return Profile(valid_from, tuple(WARDS), cities, towns, {c[:-1]: c for c in cities if c != "大阪市"} | CITY_INITIALS[valid_from])


def district_names() -> dict[str, str]:
    return {name: district for district, names in DISTRICTS.items() for name in names}


def entries(valid_from: str) -> Iterator[Entry]:
    """All prefixes of a dictionary, in the order in which they are looked up."""
    p = profile(valid_from)
    for ward in p.wards:
        yield Entry("大阪市" + ward, "city_ward", OSAKA, "大阪市" + ward, 1, False)
        yield Entry(ward, "ward", OSAKA, "大阪市" + ward, 2, True)
    for name, ward in ({w[:-1]: w for w in p.wards} | WARD_INITIALS).items():
        yield Entry(name, "ward_name", OSAKA, "大阪市" + ward, 3, True)
    for city in p.cities:
        yield Entry(city, "city", OSAKA, city, 4, True)
    for name, city in p.city_names.items():
        yield Entry(name, "city_name", OSAKA, city, 5, True)
    for name, town in p.towns.items():
        yield Entry(name, "town", OSAKA, town, 6, True)
    for town in sorted(set(p.towns.values())):
        yield Entry(town, "town_full", OSAKA, town, 7, True)
    for name, city in NEIGHBOURS.items():
        yield Entry(name, "neighbour", NEIGHBOUR_PREFECTURE, city, 8, True)


@cache
def lookup(valid_from: str) -> dict[str, tuple[str, str]]:
    """Prefix to (prefecture, municipality)."""
    found: dict[str, tuple[str, str]] = {}
    for e in entries(valid_from):
        found.setdefault(e.prefix, (e.prefecture, e.municipality))
    return found


@cache
def starts(valid_from: str) -> tuple[str, ...]:
    """Prefixes an address may begin with, longest first."""
    return tuple(sorted({e.prefix for e in entries(valid_from) if e.starts} | set(district_names()), key=lambda x: (-len(x), x)))


@cache
def hints(valid_from: str, strict_parity: bool = True) -> tuple[str, ...]:
    """Names that hint at a municipality at the start of an area, longest first. By the original rules, of neighbouring
    cities it is the prefecture that counts, not their names; strict_parity=False takes the names."""
    p = profile(valid_from)
    names = {w[:-1] for w in p.wards} | set(WARD_INITIALS) | set(p.wards) | set(p.city_names) | set(p.cities) | set(p.towns)
    names |= {NEIGHBOUR_PREFECTURE} if strict_parity else set(NEIGHBOURS)
    return tuple(sorted(names, key=lambda x: (-len(x), x)))


@cache
def municipalities(valid_from: str) -> tuple[str, ...]:
    p = profile(valid_from)
    return tuple(sorted({"大阪市", *("大阪市" + w for w in p.wards), *p.cities, *p.towns.values(), *NEIGHBOURS.values()}))


def table(spark: SparkSession) -> DataFrame:
    """dict_prefix(valid_from, prefix, kind, prefecture, municipality, precedence, starts): both dictionaries, under 400 rows."""
    rows = [(v, *e) for v in (EARLY, LATE) for e in entries(v)]
    return spark.createDataFrame(rows, "valid_from string, prefix string, kind string, prefecture string, municipality string, precedence int, starts boolean")
