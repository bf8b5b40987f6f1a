"""Append-only logs: progress, decisions and manifests as JSON lines, reloaded to the latest record of each key.

A writer that ends within a line leaves a torn one at its file's end. It is passed over, and so is nothing else: a broken line that others
follow is an error. Lines are read as text and parsed by an explicit schema; a record must hold its key and its order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirbook.operators.scans import unused
from dirbook.sources.books import numbered_lines


def append(records: DataFrame, path: str) -> None:
    """Adds records to the log, in files of their own."""
    records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.mode("append").text(path)


def reload(spark: SparkSession, path: str, schema: str, key: str, order: str) -> DataFrame:
    """The latest record of each key by `order`; of records with one order, that in the last file and line."""
    lines = numbered_lines(spark, path)
    last = lines.groupBy("file").agg(F.max("line").alias("last"))
    read = lines.join(last, "file").where(F.trim("value") != "").withColumn("record", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    whole = F.try_parse_json("value").isNotNull() & F.col(f"record.{key}").isNotNull() & F.col(f"record.{order}").isNotNull()
    checked = read.withColumn("whole", F.when(whole, F.lit(True)).when(F.col("line") == F.col("last"), F.lit(False)).otherwise(F.raise_error(F.concat(F.lit("broken record in "), F.col("file"), F.lit(", line "), F.col("line").cast("string"))).cast("boolean")))
    place = Window.partitionBy(f"record.{key}").orderBy(F.desc(f"record.{order}"), F.desc("file"), F.desc("line"))
    return checked.where("whole").withColumn("newest", F.row_number().over(place)).where("newest = 1").select("record.*")


def compact(spark: SparkSession, path: str, out: str, schema: str, key: str, order: str) -> DataFrame:
    """Writes the latest records as a new log, which reloads to the same, and returns them."""
    found = reload(spark, path, schema, key, order)
    name = unused(found, "value")
    found.select(F.to_json(F.struct(*found.columns)).alias(name)).write.mode("overwrite").text(out)
    return reload(spark, out, schema, key, order)
