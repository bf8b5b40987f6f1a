"""The recognition stage around a batch service: requests out, results in, documents that aren't there yet appended.

Nothing here calls the service. What is asked is a manifest of column images and a file of requests; what comes back is a folder of result
lines. Both sides are tables, so a run can stop anywhere: images with a document are not asked about again, and results are matched with
the manifest, written once, quarantined or counted.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirbook.operators.harvest import missing_results
from dirbook.operators.jobs import counters, harvested, manifest_items
from dirbook.operators.segments import normalize_responses
from dirbook.sources import books, sinks
from dirbook.sources.shared import shared_folder


class Harvest(NamedTuple):
    saved: DataFrame
    quarantined: DataFrame
    missing: DataFrame
    counters: DataFrame


def _there(spark: SparkSession, path: str) -> bool:
    folder, files = books._hadoop(spark, path)
    return files.exists(folder)


def ask(spark: SparkSession, columns: str, out: str, prompt: str) -> DataFrame:
    """Writes requests for the column images of all split books under `columns` that have no document in `out` yet, and the manifest
    of all images; returns what is asked: (output_key, book, page, column, uri, mime)."""
    marked = books.books_marked(spark, columns)
    images = books.column_images(spark, columns).where(F.col("book").isin(marked))
    manifest_items(images).join(images.select("book", F.col("path").alias("uri")), "uri").select("output_key", "book", "page", "column", "uri", "mime").write.mode("overwrite").parquet(f"{out}/_manifest")
    asked = spark.read.parquet(f"{out}/_manifest")
    if _there(spark, f"{out}/documents"):
        asked = asked.join(spark.read.parquet(f"{out}/documents").select("book", "output_key"), ["book", "output_key"], "left_anti")
    sinks.write_requests(asked.select("output_key", "uri", "mime", F.lit(prompt).alias("prompt")), f"{out}/requests")
    return asked


def collect(spark: SparkSession, results: str, out: str) -> Harvest:
    """Appends the documents of a folder of results to `out`/documents; the rest is quarantined in `out`/quarantine with its problem.

    Outcomes are written once, before anything is appended: what they say of existing documents then stays true."""
    manifest = spark.read.parquet(f"{out}/_manifest")
    lines = books.result_lines(spark, results).withColumnRenamed("file", "job")
    existing = spark.read.parquet(f"{out}/documents") if _there(spark, f"{out}/documents") else None
    matched = harvested(lines, manifest, existing).join(manifest.select("output_key", "book", "page", "column"), "output_key", "left")
    folder = shared_folder(spark, "harvest")
    matched.write.parquet(f"{folder}/matched")
    told = spark.read.parquet(f"{folder}/matched")
    newest = told.where("status = 'saved'").dropDuplicates(["output_key"]).select("output_key", "book", "page", "column", F.col("payload").alias("text"))
    found = normalize_responses(newest, "output_key", "book")
    found.write.parquet(f"{folder}/documents")
    found = spark.read.parquet(f"{folder}/documents")
    saved = found.where("error IS NULL").drop("error")
    sinks.append_documents(saved, existing, f"{out}/documents")
    invalid = found.where("error IS NOT NULL").select("output_key", F.col("error").alias("problem"))
    bad = told.where("status IN ('failed', 'unmatched')").select("output_key", "problem").unionByName(invalid)
    bad.write.mode("append").parquet(f"{out}/quarantine")
    return Harvest(saved, bad, missing_results(manifest, told), counters(told, "job", "status", ("saved", "skipped", "unmatched", "failed")))
