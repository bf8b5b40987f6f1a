"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from dirbook.operators.segments import SEGMENT

ROW_FIELDS = ("phone", "name", "prefecture", "municipality", "area", "lot")
# fixed values: the header of exported tables
HEADER = ("電話番号", "名前", "都道府県", "市区町村", "町域", "番地")


def _struct(ddl: str) -> str:
    return ",".join(f"{name}:{kind}" for name, kind in (x.split(" ", 1) for x in ddl.split(", ")))


#: A column document: segments of one column image, and where they come from.
DOCUMENT = f"book string, page int, column int, image string, imageSha256 string, promptVersion string, ocrOutputSchema string, model string, segments array<struct<{_struct(SEGMENT)}>>"
#: A page's layout with its quality.
LAYOUT = "book string, page string, columnCount int, cropRect struct<x:int,y:int,width:int,height:int>, columns array<struct<column:int,x1:int,x2:int>>, quality struct<pageInkRatio:double,widthCoefficientOfVariation:double,medianColumnInkRatio:double,maxEdgeTextInkRatio:double,flags:array<string>>"
#: A line of batch results that could not be used.
QUARANTINE = "file string, line long, output_key string, error string"
