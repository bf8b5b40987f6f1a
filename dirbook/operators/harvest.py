"""Harvesting batch results: matching them to requests, leaving out what exists, quarantining the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dirbook.operators.windows import unused

# fixed values: states of a batch job that end it
SUCCESS = ("JOB_STATE_SUCCEEDED", "JOB_STATE_PARTIALLY_SUCCEEDED")
TERMINAL = (*SUCCESS, "JOB_STATE_FAILED", "JOB_STATE_CANCELLED", "JOB_STATE_EXPIRED")


def harvest(results: DataFrame, requests: DataFrame, existing: DataFrame | None = None, key: str = "output_key") -> DataFrame:
    """results with `status`: saved, skipped (the output exists) or unmatched (no request; to be quarantined)."""
    known, there = unused(results, "known"), unused(results, "there")
    out = results.join(requests.select(key).distinct().withColumn(known, F.lit(True)), key, "left")
    if existing is None:
        out = out.withColumn(there, F.lit(None).cast("boolean"))
    else:
        out = out.join(existing.select(key).distinct().withColumn(there, F.lit(True)), key, "left")
    status = F.when(F.col(known).isNull(), F.lit("unmatched")).when(F.col(there), F.lit("skipped")).otherwise(F.lit("saved"))
    return out.withColumn("status", status).drop(known, there)


def missing_results(requests: DataFrame, results: DataFrame, key: str = "output_key", listed: int = 100) -> DataFrame:
    """(output_key, others): requests without a result, the first of them by key one by one, the rest as a count."""
    missing = requests.select(key).distinct().join(results.select(key).distinct(), key, "left_anti")
    first = missing.orderBy(key).limit(listed)
    rest = missing.agg(F.greatest(F.count("*") - listed, F.lit(0)).alias("others")).where("others > 0").select(F.lit(None).cast("string").alias(key), F.col("others"))
    return first.select(F.col(key).cast("string").alias(key), F.lit(0).cast("long").alias("others")).unionByName(rest)


def write_if_absent(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't there yet: what an idempotent append writes."""
    return df.join(existing.select(key).distinct(), key, "left_anti")


def zip_by_place(left: DataFrame, right: DataFrame, group: str, order_left: str, order_right: str) -> DataFrame:
    """Rows of both sides by their place within a group; `side` tells where one side has no partner."""
    place = lambda order: F.row_number().over(Window.partitionBy(group).orderBy(order))
    a, b = left.withColumn("place", place(order_left)), right.withColumn("place", place(order_right))
    side = F.when(F.col(order_right).isNull(), F.lit("left")).when(F.col(order_left).isNull(), F.lit("right")).otherwise(F.lit("both"))
    return a.join(b, [group, "place"], "full").withColumn("side", side)
