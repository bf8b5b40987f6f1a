"""Running values over ordered rows, where one key may hold all of them.

A window runs a key in one task. Here rows are dealt by ranges of (key, order), so that a large key spreads over as many tasks as it
needs; each range is scanned by itself, its total or last value is reduced to one row for each key, and what ranges of the same key
before it come to is added. Ranges are contiguous, so only the first key of a range can have ranges before it: what is carried over
borders has a row a range at most, and is broadcast.

The dealt rows are written once to the shared folder and read from there: range borders come from a sample, so a second evaluation could
cut elsewhere. Null keys are a key of their own; nulls come first in ascending order and last in descending order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirbook.sources.shared import shared_folder

Order = Sequence[str]


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever case counts."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def ordering(order: Order, backward: bool = False) -> list[Column]:
    """Sort columns of names, where a minus before a name means descending."""
    found = []
    for name in order:
        down = name.startswith("-")
        column = F.col(f"`{name.removeprefix('-')}`")
        found.append(column.desc_nulls_last() if down != backward else column.asc_nulls_first())
    return found


def written(df: DataFrame) -> DataFrame:
    """df's rows, written to the shared folder and read again."""
    path = shared_folder(df.sparkSession, "scan")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, keys: Sequence[str], order: Order, part: str) -> DataFrame:
    """df dealt by ranges of keys and order, with the number of its range in `part`; written, so that it stays so."""
    ranges = [F.col(f"`{k}`").asc_nulls_first() for k in keys] + ordering(order)
    return written(df.repartitionByRange(*ranges).withColumn(part, F.spark_partition_id()))


def _with_carry(rows: DataFrame, totals: DataFrame, keys: Sequence[str], part: str, carry: str, value: Column, backward: bool) -> DataFrame:
    """rows with `value` over the totals(part, keys, ...) of their key's ranges before theirs; null where there are none."""
    before = Window.partitionBy(*keys).orderBy(*ordering([part], backward)).rowsBetween(Window.unboundedPreceding, -1)
    borders = totals.withColumn(carry, value.over(before)).withColumn("n", F.count("*").over(before)).where("n > 0")
    named = borders.select(F.col(part).alias(f"{part}_of"), *[F.col(f"`{k}`").alias(f"{carry}_{i}") for i, k in enumerate(keys)], carry)
    same = F.col(part) == F.col(f"{part}_of")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"{carry}_{i}"))
    return rows.join(F.broadcast(named), same, "left").drop(f"{part}_of", *[f"{carry}_{i}" for i in range(len(keys))])


def running_sum(df: DataFrame, value: Column, keys: Sequence[str], order: Order, out: str) -> DataFrame:
    """df with the sum of `value` of its key's rows up to and with each row; nulls count nothing."""
    names = part, own, carry = unused(df, "part"), unused(df, "own"), unused(df, "carry")
    rows = dealt(df.withColumn(own, value), keys, order, part)
    local = Window.partitionBy(part, *keys).orderBy(*ordering(order)).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy(part, *keys).agg(F.sum(own).alias(own))
    joined = _with_carry(rows.withColumn(own, F.sum(own).over(local)), totals, keys, part, carry, F.sum(own), False)
    return joined.withColumn(out, F.when(F.col(own).isNull(), F.col(carry)).otherwise(F.col(own) + F.coalesce(F.col(carry), F.lit(0)))).drop(*(n for n in names if n != out))


def running_last(df: DataFrame, value: Column, keys: Sequence[str], order: Order, out: str, backward: bool = False, inclusive: bool = True) -> DataFrame:
    """df with the nearest value that isn't null: up to and with each row (`inclusive`) or before it, or, backward, from it or after it."""
    names = part, own, carry = unused(df, "part"), unused(df, "own"), unused(df, "carry")
    rows = dealt(df.withColumn(own, value), keys, order, part)
    window = Window.partitionBy(part, *keys).orderBy(*ordering(order, backward))
    local = F.last(own, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    newest = Window.partitionBy(part, *keys).orderBy(*ordering(order, not backward))
    whole = newest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = rows.select(part, *keys, F.first(own, ignorenulls=True).over(whole).alias(own), F.row_number().over(newest).alias(carry))
    totals = each.where(F.col(carry) == 1).drop(carry)
    joined = _with_carry(rows.withColumn(own, local), totals, keys, part, carry, F.last(own, ignorenulls=True), backward)
    return joined.withColumn(out, F.coalesce(F.col(own), F.col(carry))).drop(*(n for n in names if n != out))


def places(df: DataFrame, order: Order, out: str) -> DataFrame:
    """df with places from 0 in order, from counts of sorted ranges; the counts, one row a range, are all that is gathered."""
    part, own = unused(df, "part"), unused(df, "own")
    ranged = df.repartitionByRange(*ordering(order)).sortWithinPartitions(*ordering(order)).withColumn(part, F.spark_partition_id()).withColumn(own, F.monotonically_increasing_id())
    rows = written(ranged)
    counts = rows.groupBy(F.col(part).alias("p")).agg(F.count("*").alias("n"), F.min(own).alias("first"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("p").alias(f"{part}_of"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(f"{own}_base"))
    placed = rows.join(F.broadcast(bases), F.col(part) == F.col(f"{part}_of")).withColumn(f"{own}_place", F.col(own) + F.col(f"{own}_base"))
    return placed.drop(part, own, f"{part}_of", f"{own}_base").withColumn(out, F.col(f"{own}_place")).drop(f"{own}_place")


def row_numbers(df: DataFrame, keys: Sequence[str], order: Order, out: str) -> DataFrame:
    """df with numbers from 1 in order within each key, for few keys: counts of sorted ranges, a row for each key of a range, are broadcast."""
    part, own, base = unused(df, "part"), unused(df, "own"), unused(df, "base")
    ranges = [F.col(f"`{k}`").asc_nulls_first() for k in keys] + ordering(order)
    rows = written(df.repartitionByRange(*ranges).sortWithinPartitions(*ranges).withColumn(part, F.spark_partition_id()).withColumn(own, F.monotonically_increasing_id()))
    counts = rows.groupBy(part, *keys).agg(F.count("*").alias("n"), F.min(own).alias("first"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(f"`{k}`").alias(f"{base}_{i}") for i, k in enumerate(keys)]
    bases = counts.select(F.col(part).alias(f"{part}_of"), *named, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias(base))
    same = F.col(part) == F.col(f"{part}_of")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"{base}_{i}"))
    placed = rows.join(F.broadcast(bases), same)
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(own) + F.col(base)).alias(out))
