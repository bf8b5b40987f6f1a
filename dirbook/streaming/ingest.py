"""Incremental harvest and counts: file streams, idempotent appends, windowed aggregates."""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dirbook.operators.segments import normalize_responses

RESPONSE = "output_key string, book string, page int, column int, text string"


def response_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(RESPONSE).option("maxFilesPerTrigger", files_per_batch).json(path)


def harvest_stream(responses: DataFrame, outputs: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Saves normalised documents whose key isn't there yet and quarantines the rest; runs until the input is used up.

    A batch is one transaction: its documents, its quarantine and its keys are folders of their own, named by checkpoint and batch, and count
    from the moment its counters are published. A batch that runs again after a failure replaces what it had written, whichever of these
    it had come to; one from another checkpoint finds the keys there and adds nothing.
    """
    begun = f"{zlib.crc32(checkpoint.encode()):08x}"

    def save(batch: DataFrame, batch_id: int) -> None:
        run = f"{begun}-{batch_id:09d}"
        spark = batch.sparkSession
        known = [r for r in published_runs(spark, outputs) if r != run]
        keys = batch.dropDuplicates(["output_key"])
        seen = keys.join(_keys(spark, outputs, known), "output_key", "left_anti")
        counted = Observation()
        found = normalize_responses(seen, "output_key", "book").persist()
        told = found.observe(counted, F.count_if(F.col("error").isNull()).alias("saved"), F.count_if(F.col("error").isNotNull()).alias("quarantined"))
        told.where("error IS NULL").drop("error").write.mode("overwrite").partitionBy("book").parquet(f"{outputs}/run={run}")
        bad = found.where("error IS NOT NULL").select(F.lit(batch_id).alias("batch"), "output_key", "error")
        bad.write.mode("overwrite").parquet(f"{quarantine}/run={run}")
        found.where("error IS NULL").select("output_key").write.mode("overwrite").parquet(f"{outputs}/_keys/run={run}")
        found.unpersist()
        publish(spark, outputs, run, counted.get)

    return responses.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def publish(spark: SparkSession, outputs: str, run: str, counters: dict[str, int]) -> None:
    """Makes a run count, by one move of a file that holds its counters."""
    final, files = _path(spark, f"{outputs}/_published/{run}.json")
    part, _ = _path(spark, f"{outputs}/_published/.{run}.{uuid.uuid4().hex}")
    out = files.create(part, True)
    out.write(bytearray(json.dumps(counters, sort_keys=True).encode()))
    out.close()
    files.delete(final, False)
    files.rename(part, final)


def published_runs(spark: SparkSession, outputs: str) -> list[str]:
    """Names of the runs that count; those of one stream in order."""
    folder, files = _path(spark, f"{outputs}/_published")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))


def published(spark: SparkSession, root: str, outputs: str, schema: str) -> DataFrame:
    """The rows under root (the outputs or the quarantine) of runs that count; what a failed run has left isn't read."""
    runs = published_runs(spark, outputs)
    paths = [p for p in (f"{root}/run={r}" for r in runs) if _path(spark, p)[1].exists(_path(spark, p)[0])]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths) if paths else spark.createDataFrame([], schema)


def counters(spark: SparkSession, outputs: str) -> DataFrame:
    """(run, saved, quarantined) of the runs that count."""
    kind = "run string, saved long, quarantined long"
    if not published_runs(spark, outputs):
        return spark.createDataFrame([], kind)
    read = spark.read.schema("saved long, quarantined long").json([f"{outputs}/_published/{r}.json" for r in published_runs(spark, outputs)])
    return read.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("run"), "saved", "quarantined")


def _keys(spark: SparkSession, outputs: str, runs: list[str]) -> DataFrame:
    """Keys of documents that are there: one narrow column, kept beside the documents."""
    kind = "output_key string"
    return spark.read.schema(kind).parquet(*[f"{outputs}/_keys/run={r}" for r in runs]) if runs else spark.createDataFrame([], kind)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def windowed_counts(events: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, by, events) per window of event time; works on a stream, with a watermark, and on a table."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count("*").alias("events")).select(F.col("window.start").alias("start"), by, "events")
