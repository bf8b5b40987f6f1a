"""Similarity of areas: the ratio of matching blocks, which no built-in computes, in Arrow batches."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

ELSEWHERE = 0.82


@F.pandas_udf(DoubleType())
def _ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Not symmetric: left is the suspicious one. Pairs repeat, so each distinct one is compared once a batch."""
    pairs = pd.DataFrame({"a": left, "b": right})
    each = pairs.drop_duplicates()
    scores = {(a, b): SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in each.itertuples(index=False)}
    return pd.Series([scores[p] for p in pairs.itertuples(index=False, name=None)], dtype="float64")


@F.pandas_udf(DoubleType())
def _rounded(values: pd.Series, digits: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or x != x else round(x, int(d)) for x, d in zip(values, digits)], dtype="float64")


def rounded(value: Column, digits: int) -> Column:
    """Rounded by the number's exact binary value, ties to even; built-in rounding goes by its decimal text, ties up."""
    return _rounded(value, F.lit(digits))


def similarity(left: Column, right: Column, same_municipality: Column) -> Column:
    """Of comparable areas; less where the municipalities differ."""
    return _ratio(left, right) * F.when(same_municipality, F.lit(1.0)).otherwise(F.lit(ELSEWHERE))
