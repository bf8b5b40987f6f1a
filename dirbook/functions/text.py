"""Text columns: normalisation, compact forms, keys. Built-in functions but for NFKC, which Spark lacks."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# fixed values: white space of any script, with the separators that str.strip() takes for such
WHITE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _normalize(values: pa.Array) -> pa.Array:
    """Only texts that aren't ASCII leave Arrow."""
    wide = pc.fill_null(pc.invert(pc.string_is_ascii(values)), False)
    texts = values.filter(wide).to_numpy(zero_copy_only=False)
    return pc.replace_with_mask(values, wide, pa.array([unicodedata.normalize("NFKC", x) for x in texts], values.type)) if len(texts) else values


@F.arrow_udf(StringType())
def _nfkc(values: pa.Array) -> pa.Array:
    return _normalize(values)


@F.arrow_udf(ArrayType(StringType()))
def _nfkc_lists(values: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
    return pa.ListArray.from_arrays(offsets, _normalize(values.flatten()), mask=values.is_null())


def composed(column: Column) -> Column:
    """In compatibility composition."""
    return _nfkc(column)


def composed_lists(column: Column) -> Column:
    """Arrays of texts, each in compatibility composition."""
    return _nfkc_lists(column)


def strip(column: Column) -> Column:
    """Without white space, of any script, at either end."""
    return F.btrim(column, F.lit(WHITE))


def normalized(column: Column, nfkc: bool = True) -> Column:
    """Compatibility composed and stripped; null counts as empty. nfkc=False for columns known to be composed already."""
    text = F.coalesce(column, F.lit(""))
    return strip(_nfkc(text) if nfkc else text)


def without_space(column: Column) -> Column:
    return F.regexp_replace(column, r"(?U)\s+", "")


# fixed values: characters that three comparisons disregard
COMPACT_ADDRESS = r"(?U)[\s,，、・.．:：()（）{}［］\[\]「」『』]+"


def compact_address(column: Column) -> Column:
    return F.regexp_replace(column, COMPACT_ADDRESS, "")


def comparable(column: Column) -> Column:
    return F.regexp_replace(column, r"(?U)[\s,、，・･.．\-‐ー―−–—()（）\[\]［］{}]+", "")


def location_id(prefecture: Column, municipality: Column, area: Column) -> Column:
    return F.concat_ws("\t", prefecture, municipality, area)


def book_date(book: Column) -> Column:
    """The date in a book's name as an ISO string, without calendar checks; "unknown-date" if it has none."""
    era = F.regexp_extract(book, _BOOK, 1)
    start = F.coalesce(*[F.when(era == name, F.lit(year)) for name, year in ERAS.items()])
    part = lambda i: F.regexp_extract(book, _BOOK, i).try_cast("int")
    return F.when(book.rlike(_BOOK), F.format_string("%04d-%02d-%02d", start + part(2), part(3), part(4))).otherwise(F.lit("unknown-date"))


def dated(book: str | None) -> str:
    """book_date() of one name, for code that folds rows in Python."""
    found = re.search(_BOOK.replace("(.+)$", r"[^\n\r\x85\u2028\u2029]+(?:\r\n|[\n\r\x85\u2028\u2029])?\Z"), book or "")
    if not found:
        return "unknown-date"
    year, month, day = (int(found[i]) if int(found[i]) < 1 << 31 else None for i in (2, 3, 4))
    shown = lambda n, width: "null" if n is None else f"{n:0{width}d}"
    return "-".join((shown(None if year is None else ERAS[found[1]] + year, 4), shown(month, 2), shown(day, 2)))


# fixed values: years before the first of each era, and book types, longer names before what they end in
ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018}
BOOK_TYPES = ("50音別電話番号簿", "職業別電話番号簿", "電話番号簿")
_BOOK = r"^(明治|大正|昭和|平成|令和)([0-9]+)年([0-9]+)月([0-9]+)日(.+)$"


def book_type(book: Column) -> Column:
    rest = F.regexp_extract(book, _BOOK, 5)
    ends = F.coalesce(*[F.when(rest.endswith(t), F.lit(t)) for t in BOOK_TYPES], F.lit(BOOK_TYPES[-1]))
    return F.when(book.rlike(_BOOK), ends).otherwise(F.lit(BOOK_TYPES[-1]))


def book_region(book: Column) -> Column:
    rest = F.regexp_extract(book, _BOOK, 5)
    region = F.coalesce(*[F.when(rest.endswith(t), F.substring(rest, F.lit(1), F.char_length(rest) - len(t))) for t in BOOK_TYPES], rest)
    return F.when(book.rlike(_BOOK), F.when(region == "", F.lit("unknown-region")).otherwise(region)).otherwise(book)


def book_filename(book: Column) -> Column:
    safe = lambda c: F.translate(c, "/", "・")
    return F.concat_ws("-", book_date(book), safe(book_region(book)), F.concat(safe(book_type(book)), F.lit(".csv.gz")))
