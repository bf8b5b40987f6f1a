"""The engine's functions for SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dirbook.functions import jsons, phone, similarity, text
from dirbook.functions.address import split_text
from dirbook.operators.export import expand


#: functions.phone.export_number() in SQL.
_NORMALIZE_PHONE = r"""
CREATE OR REPLACE TEMPORARY FUNCTION normalize_phone(printed STRING) RETURNS STRING RETURN
regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(nfkc(coalesce(printed, '')), '()（）', '----'), r'(?U)\s+', ''), '-+', '-'), '^-|-$', ''), '(?:代表|代)$', ''),
  '^※(?=0)', ''), '^(?:※|(?=[^0]))', '{area}-')
"""


def register(spark: SparkSession) -> None:
    """nfkc(s), seq_ratio(a, b), normalize_phone(s), split_address(s, as_of), first_json(s) and the table function
    expand_candidates(phones, names, addresses)."""
    spark.udf.register("nfkc", text._nfkc)
    spark.udf.register("seq_ratio", similarity._ratio)
    spark.sql(_NORMALIZE_PHONE.replace("{area}", phone.AREA_CODE))
    spark.udf.register("first_json", jsons._extract)

    def split(address: pd.Series, as_of: pd.Series) -> pd.DataFrame:  # type: ignore[no-untyped-def]
        rows = [split_text(a or "", "1968-03-01" if d is not None and d >= "1968-03-01" else "1963-02-01") for a, d in zip(address, as_of)]
        return pd.DataFrame(rows, columns=["prefecture", "municipality", "rest"])

    spark.udf.register("split_address", F.pandas_udf(split, "prefecture string, municipality string, rest string"))

    @F.udtf(returnType="phone string, name string, address string")
    class ExpandCandidates:
        def eval(self, phones: list, names: list, addresses: list):
            yield from expand(list(phones or []), list(names or []), list(addresses or []))

    spark.udtf.register("expand_candidates", ExpandCandidates)
