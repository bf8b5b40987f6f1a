"""Reading books: images, layouts, column documents, tables, batch results, configuration."""

from __future__ import annotations

import json
import re
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirbook.functions.jsons import output_key
from dirbook.operators.windows import in_order
from dirbook.schemas import DOCUMENT, HEADER, ROW_FIELDS

_COLUMN_IMAGE = r"(?i)([0-9]+)-([0-9]+)\.(png|webp)\z"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, is folder) of what a folder holds, sorted; empty if it doesn't exist. Any file system Spark reads."""
    path, fs = _hadoop(spark, folder)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(path)) if fs.exists(path) else []


def page_images(spark: SparkSession, root: str) -> DataFrame:
    """(book, page, path, content) of PNG pages; content is read only where it is used. `path` gives their order, for those
    that need one: sorting here would shuffle the images."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][nN][gG]").load(root)
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+\z", 1).alias("book"), output_key(F.col("path")).alias("page"), "path", "content")


def _holds(spark: SparkSession, folder: str, suffix: str) -> bool:
    """Whether a folder holds a file with this ending; listed up to the first one only."""
    path, fs = _hadoop(spark, folder)
    files = fs.listStatusIterator(path)
    while files.hasNext():
        status = files.next()
        if status.getPath().getName().lower().endswith(suffix) and not status.isDirectory():
            return True
    return False


def books_with(spark: SparkSession, root: str, suffix: str) -> list[str]:
    """Folders under root that hold a file with this ending: .png for scans, .ocr.json for recognised books."""
    folders = [name for name, is_dir in list_names(spark, root) if is_dir]
    return [b for b in folders if _holds(spark, f"{root}/{b}", suffix)]


def books_marked(spark: SparkSession, root: str, marker: str = "column_count.json") -> list[str]:
    """Folders under root that hold the marker file."""
    return [name for name, is_dir in list_names(spark, root) if is_dir and (marker, False) in list_names(spark, f"{root}/{name}")]


def resolve_books(spark: SparkSession, root: str, book: str | None = None, suffix: str = ".ocr.json") -> list[tuple[str, str]]:
    """(folder, book name). A root that itself holds the files is one book, under the name given or its own; otherwise the
    folder named, which may not exist and then fails on reading, or all that hold such files."""
    flat = any(not d and n.lower().endswith(suffix) for n, d in list_names(spark, root))
    if flat:
        return [(root, book or PurePosixPath(root.rstrip("/")).name)]
    return [(f"{root}/{b}", b) for b in ([book] if book else books_with(spark, root, suffix))]


def column_images(spark: SparkSession, root: str) -> DataFrame:
    """(book, page, column, path, mime): column images by their names; other files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    number = lambda i: F.regexp_extract("path", _COLUMN_IMAGE, i).cast("int")
    mime = F.when(F.lower(F.regexp_extract("path", _COLUMN_IMAGE, 3)) == "webp", F.lit("image/webp")).otherwise(F.lit("image/png"))
    return files.where(F.col("path").rlike(r"(?i)/[0-9]+-[0-9]+\.(png|webp)\z")).select(F.regexp_extract("path", r"([^/]+)/[^/]+\z", 1).alias("book"), number(1).alias("page"), number(2).alias("column"), "path", mime.alias("mime"))


def documents(spark: SparkSession, root: str) -> DataFrame:
    """Column documents with `file_key`, the file's name without its ending, which orders them within a book."""
    found = spark.read.schema(DOCUMENT).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.ocr.json").json(root)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\z", 1)
    return found.withColumn("file_key", F.regexp_replace(F.col("_metadata.file_name"), r"\.ocr\.json\z", "")).withColumn("book", F.coalesce("book", folder))


def segments(spark: SparkSession, root: str) -> DataFrame:
    """A row for each segment, by place in its file; a missing list is empty."""
    return documents(spark, root).select("book", "file_key", F.posexplode("segments").alias("pos", "s")).select("book", "file_key", "pos", "s.*")


def exported_rows(spark: SparkSession, path: str) -> DataFrame:
    """(row_idx, ROW_FIELDS) of csv or csv.gz files with a header that must have the six columns; others are dropped."""
    read = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path)
    missing = [c for c in HEADER if c not in read.columns]
    if missing:
        raise ValueError(f"CSV header lacks required columns: {', '.join(missing)}")
    texts = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(a) for c, a in zip(HEADER, ROW_FIELDS)]
    return read.select(F.monotonically_increasing_id().alias("row_idx"), *texts)


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    """(row_idx, ROW_FIELDS) of csv or csv.gz files with or without a header; short rows are padded, long ones cut.

    Only a file's first row can be its header; a later row that reads the same is a row."""
    read = spark.read.schema(", ".join(f"{c} string" for c in ROW_FIELDS)).option("escape", '"').option("multiLine", "true").csv(path)
    rows = read.select(F.monotonically_increasing_id().alias("row_idx"), F.col("_metadata.file_path").alias("file"), *[F.coalesce(c, F.lit("")).alias(c) for c in ROW_FIELDS])
    named = F.lit(True)
    for c, h in zip(ROW_FIELDS, HEADER):
        named = named & (F.col(c) == h)
    first = rows.groupBy("file").agg(F.min("row_idx").alias("first"))  # a row for each file
    headers = rows.where(named).join(first, "file").where("row_idx = first").select("row_idx")
    return rows.drop("file").join(headers, "row_idx", "left_anti")


def blank_rows(spark: SparkSession, path: str) -> DataFrame:
    """(blank) one row: how many lines of csv files hold nothing, which the reader of tables leaves out. Lines inside a
    quoted field count, too."""
    return spark.read.text(path).agg(F.count_if(F.col("value").isin("", "\r")).alias("blank"))


def numbered_lines(spark: SparkSession, root: str) -> DataFrame:
    """(file, line, value) of all lines of text files, numbered from 1 within each file, however files are split: a line's place in its
    split, after the lines of the splits before, of which only the counts are summed up. A split is all that a task orders."""
    scan = spark.read.option("recursiveFileLookup", "true").text(root).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    counts = scan.groupBy("file", "start").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("file", "start").orderBy("id"))
    placed = scan.withColumn("id", F.monotonically_increasing_id()).withColumn("place", place)
    return placed.join(counts.select("file", "start", before.alias("before")), ["file", "start"]).select("file", (F.col("before") + F.col("place")).alias("line"), "value")


def inline_responses(spark: SparkSession, path: str, requests: DataFrame, order: str) -> DataFrame:
    """requests(..., order) with the `response` line at their place: the lines of a file that a service answered in the order of what it was
    asked. Blank lines don't count. A count that differs is an error, as nothing else tells which answer belongs to which request."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "").select(F.lit(0).alias("all"), F.col("file"), F.col("line"), F.col("value").alias("response"))
    places = in_order(lines.select("file", "line", "response"), ["file", "line"], "place")
    asked = in_order(requests, [order], "place")
    joined = asked.join(places.drop("file", "line"), "place", "full")
    odd = F.when(F.col(order).isNull() | F.col("response").isNull(), F.raise_error(F.concat(F.lit("as many responses as requests are needed; unmatched at place "), F.col("place").cast("string"))))
    return joined.withColumn("response", F.coalesce(odd.cast("string"), F.col("response"))).drop("place")


def result_lines(spark: SparkSession, root: str) -> DataFrame:
    """(file, line, output_key, response, error) of JSONL batch results; blank lines are skipped, broken ones have an error."""
    lines = numbered_lines(spark, root)
    wanted = lines.where(F.col("file").rlike(r"(\.jsonl\z|/prediction\.results-[^/]*\z)") & (F.trim("value") != ""))
    ok = F.try_parse_json("value").isNotNull()
    uri = F.regexp_extract("value", r'"file_?[uU]ri"\s*:\s*"([^"]*)"', 1)
    body = F.coalesce(*[F.get_json_object("value", f"$.{k}") for k in ("response", "prediction", "predictions[0]")], F.col("value"))
    said = F.coalesce(F.get_json_object("value", "$.error.message"), F.get_json_object("value", "$.error"), F.when(F.get_json_object("value", "$.status") != "", F.get_json_object("value", "$.status")))
    return wanted.select("file", "line", output_key(uri).alias("output_key"), F.when(ok, body).alias("response"), F.when(~ok, F.lit("not JSON")).otherwise(said).alias("error"))


def content_hash(df: DataFrame, content: str = "content") -> DataFrame:
    return df.withColumn("sha256", F.sha2(F.col(content), 256))


def load_config(text: str | None) -> dict[str, Any]:
    """A book's settings; none for no text."""
    found = json.loads(text) if text else {}
    if not isinstance(found, dict):
        raise ValueError("configuration must be an object")
    return found


def config_section(config: dict[str, Any], name: str) -> dict[str, Any]:
    section = config.get(name)
    if section is None:
        return {}
    if not isinstance(section, dict):
        raise ValueError(f"{name} must be an object")
    return section


def split_options(config: dict[str, Any], **given: Any) -> dict[str, Any]:
    """Options of the split stage: those given, else the configuration's, else defaults; clamped and checked."""
    section = config_section(config, "split")
    pick = lambda name, key, default: given[name] if given.get(name) is not None else section.get(key, default)
    scale, quality, workers = float(pick("scale", "resizeScale", 0.75)), int(pick("quality", "webpQuality", 90)), int(pick("workers", "workers", 1))
    columns = pick("columns", "fixedColumnCount", None)
    if not 0 < scale <= 1:
        raise ValueError("resizeScale must be in (0, 1]")
    if columns is not None and int(columns) not in (2, 3, 4):
        raise ValueError("fixedColumnCount must be 2, 3 or 4")
    ranges = []
    for item in section.get("excludePageRanges", []):
        low, high = (item["start"], item["end"]) if isinstance(item, dict) else re.split(r"\s*-\s*", str(item), maxsplit=1)
        ranges.append((str(low).strip(), str(high).strip()))
    exact = [str(x).strip() for x in section.get("excludePages", [])]
    return {"columns": None if columns is None else int(columns), "scale": scale, "quality": max(1, min(100, quality)), "workers": max(1, workers), "exact": exact, "ranges": ranges}


def as_of_date(given: str | None, file_name: str | None) -> str:
    """A date given, or the one in a file's name, or the earliest dictionary's."""
    m = re.search(r"19[0-9]{2}-[0-9]{2}-[0-9]{2}", file_name or "")
    return given or (m[0] if m else "1963-02-01")
