"""The publish stage: canonical numbers only, each row once, in order of number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirbook.functions.phone import CANONICAL, publish_number
from dirbook.functions.text import normalized

FIELDS = ("phone", "name", "prefecture", "municipality", "area", "lot")


def prepared(rows: DataFrame, fields: tuple[str, ...] = FIELDS, nfkc: bool = True) -> DataFrame:
    """rows(row_idx, fields) with normalised values; `valid` tells canonical numbers."""
    phone = publish_number(F.col(fields[0]), nfkc)
    values = [normalized(F.col(c), nfkc).alias(c) for c in fields[1:]]
    return rows.select("row_idx", phone.alias(fields[0]), *values).withColumn("valid", F.col(fields[0]).rlike(CANONICAL))


def distinct_rows(rows: DataFrame, fields: tuple[str, ...] = FIELDS, nfkc: bool = True) -> DataFrame:
    """Valid rows, each once, with the place of the first. Combined before the one shuffle there is."""
    return prepared(rows, fields, nfkc).where("valid").groupBy(*fields).agg(F.min("row_idx").alias("row_idx"))


def by_number(fields: tuple[str, ...] = FIELDS) -> list[Column]:
    part = lambda i: F.split(F.col(fields[0]), "-")[i].cast("int")
    return [part(1), part(2), F.col("row_idx")]


def publish(rows: DataFrame, fields: tuple[str, ...] = FIELDS, nfkc: bool = True) -> DataFrame:
    return distinct_rows(rows, fields, nfkc).orderBy(*by_number(fields))


def skip_counts(rows: DataFrame, fields: tuple[str, ...] = FIELDS, nfkc: bool = True) -> DataFrame:
    """(total, invalid, duplicates, published) of a publish run, without a second pass over the rows."""
    ready = prepared(rows, fields, nfkc).groupBy("valid", *fields).agg(F.count("*").alias("c"))
    valid = F.when(F.col("valid"), F.col("c")).otherwise(0)
    total = ready.agg(F.sum("c").alias("total"), F.sum(valid).alias("v"), F.count_if("valid").alias("published"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return total.select(zero(F.col("total")).alias("total"), zero(F.col("total") - F.col("v")).alias("invalid"), zero(F.col("v") - F.col("published")).alias("duplicates"), zero(F.col("published")).alias("published"))
