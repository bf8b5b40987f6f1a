"""Ordered operators: sections, carrying values forward, islands, chunks, as-of and range lookups.

Those that run along a key do so as distributed scans (see scans.py), as one book or user may hold all rows; the dealt rows are written
to the shared folder when the plan is made. In `order`, a minus before a name means descending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirbook.operators.scans import places, running_last, running_sum, unused


def sections(df: DataFrame, reset: Column, book: str, order: list[str], out: str = "section") -> DataFrame:
    """df with a running number that grows at each reset row of its book."""
    return running_sum(df, reset.cast("long"), [book], order, out)


def carry_forward(df: DataFrame, value: Column, partition: list[str], order: list[str], out: str) -> DataFrame:
    """df with the last non-null value up to each row."""
    return running_last(df, value, partition, order, out)


def in_order(df: DataFrame, order: list[str], out: str = "place") -> DataFrame:
    """df with places from 0 in order."""
    return places(df, order, out)


def chunked(df: DataFrame, order: list[str], size: int, out: str = "chunk") -> DataFrame:
    """df with numbers of chunks of `size` rows in order."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    return in_order(df, order, out).withColumn(out, F.floor(F.col(out) / size).cast("long"))


def islands(df: DataFrame, flag: Column, partition: list[str], order: str) -> DataFrame:
    """(partition, first, last, length) of each run of rows with the flag at consecutive places."""
    run = unused(df, "run")
    number = F.row_number().over(Window.partitionBy(*partition).orderBy(order))
    marked = df.where(flag).withColumn(run, F.col(order) - number)
    return marked.groupBy(*partition, run).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length")).drop(run)


def asof_backward(left: DataFrame, right: DataFrame, key: str, at: str, value: str, out: str) -> DataFrame:
    """left with the value of the latest right row of its key at or before it: one union and one scan, no join."""
    side, v = unused(left, "side"), unused(left, "v")
    both = left.withColumn(side, F.lit(0)).withColumn(v, F.lit(None).cast(right.schema[value].dataType))
    other = right.select(key, at, F.col(value).alias(v)).withColumn(side, F.lit(1))
    merged = both.unionByName(other, allowMissingColumns=True)
    return running_last(merged, F.col(v), [key], [at, f"-{side}"], out).where(F.col(side) == 0).drop(side, v)


def range_first(left: DataFrame, right: DataFrame, key: str, at: str, value: str, out: str) -> DataFrame:
    """left with the first right value from its own place up to before the next left row's: scanned backward, what comes next is either
    a left row, which hides all beyond it, or a value."""
    side, v = unused(left, "side"), unused(left, "v")
    both = left.withColumn(side, F.lit(1)).withColumn(v, F.lit(None).cast(right.schema[value].dataType))
    other = right.select(key, at, F.col(value).alias(v)).withColumn(side, F.lit(0))
    merged = both.unionByName(other, allowMissingColumns=True)
    event = F.when((F.col(side) == 1) | F.col(v).isNotNull(), F.struct(F.col(v).alias("value")))
    found = running_last(merged, event, [key], [at, f"-{side}"], out, backward=True, inclusive=False)
    return found.where(F.col(side) == 1).withColumn(out, F.col(f"`{out}`.value")).drop(side, v)


def moving_average(df: DataFrame, value: str, width: int, partition: list[str], order: str, out: str) -> DataFrame:
    """Means over `width` rows, half of them before, where rows beyond either end count as the end row."""
    half = width // 2
    whole = Window.partitionBy(*partition).orderBy(order)
    near = whole.rowsBetween(-half, width - half - 1)
    ends = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, size = F.row_number().over(whole), F.count("*").over(ends)
    low = F.greatest(F.lit(half) - (place - 1), F.lit(0))
    high = F.greatest(F.lit(width - half - 1) - (size - place), F.lit(0))
    total = F.sum(value).over(near) + low * F.first(value).over(ends) + high * F.last(value).over(ends)
    return df.withColumn(out, total / width)


def first_crossing(df: DataFrame, crossed: Column, partition: list[str], order: str) -> DataFrame:
    """(partition, first, last): the outermost places where the condition holds, null if nowhere."""
    return df.groupBy(*partition).agg(F.min(F.when(crossed, F.col(order))).alias("first"), F.max(F.when(crossed, F.col(order))).alias("last"))
