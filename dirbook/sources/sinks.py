"""Writing tables, documents and requests. Spark's committer makes every write all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.operators.harvest import write_if_absent
from dirbook.operators.jobs import report
from dirbook.schemas import HEADER, ROW_FIELDS


def _csv(df: DataFrame):
    return df.write.option("compression", "gzip").option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")


def write_exported(rows: DataFrame, path: str, single_file: bool = True) -> None:
    """Rows with the header, CRLF line ends, gzip."""
    named = rows.select(*[F.col(c).alias(h) for c, h in zip(ROW_FIELDS, HEADER)])
    _csv(named.coalesce(1) if single_file else named).option("header", "true").option("lineSep", "\r\n").mode("overwrite").csv(path)


def write_published(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Sorted rows without a header, LF line ends, gzip; part files follow the order of the rows."""
    plain = rows.select(*ROW_FIELDS)
    _csv(plain.coalesce(1) if single_file else plain).mode("overwrite").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A frame of a few rows as one JSON text."""
    report(df).coalesce(1).write.mode("overwrite").text(path)


def write_requests(requests: DataFrame, path: str) -> None:
    """requests(output_key, uri, mime, prompt) as JSONL for a batch service."""
    parts = F.array(F.struct(F.struct(F.col("uri").alias("fileUri"), F.col("mime").alias("mimeType")).alias("fileData")))
    request = F.struct(F.array(F.struct(F.lit("user").alias("role"), parts.alias("parts"))).alias("contents"), F.struct(F.array(F.struct(F.col("prompt").alias("text"))).alias("parts")).alias("systemInstruction"), F.struct(F.lit("application/json").alias("responseMimeType")).alias("generationConfig"))
    requests.select(F.to_json(F.struct(F.col("output_key").alias("key"), request.alias("request"))).alias("value")).write.mode("overwrite").text(path)


def append_documents(documents: DataFrame, existing: DataFrame | None, path: str) -> None:
    """Appends documents whose output_key isn't there yet; outputs are never overwritten."""
    new = documents if existing is None else write_if_absent(documents, existing, "output_key")
    new.write.mode("append").partitionBy("book").parquet(path)
