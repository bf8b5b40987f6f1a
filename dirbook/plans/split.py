"""The split stage: page scans in, column images and a manifest out.

Pages are listed once, without their contents, joined with what the manifest and the folder of images hold already, and only those
that lack something are read, about PORTION of them a job. Tasks read and split pages and write their column images themselves: to a
name of their own attempt first, then moved onto the final one, so that a reader never sees half a file and a task that runs again
replaces what it wrote with the same. A page's row goes to the manifest through Spark's committer after its images are there;
a page is done when the manifest says so and its images are listed. Whatever goes wrong with a page is its row's reason.

Layout: <out>/<book>/<page>-<column>.png, <out>/_manifest (Parquet, rows are only ever added; the latest of a page counts), and for each
book column_count.json and split_quality.json.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirbook.functions.images import decoded
from dirbook.functions.jsons import output_key
from dirbook.operators.jobs import pending_pages
from dirbook.operators.layout import excluded_pages
from dirbook.operators.pixels import split_page
from dirbook.operators.scans import written
from dirbook.sources import books

CONFIG = "phonebook.config.json"
#: Pages a job, after which the manifest has them.
PORTION = 10_000
#: Pages a task.
PAGES_A_TASK = 32
MANIFEST = (
    "run long, book string, page string, input string, status string, reason string, columnCount int, files array<string>, cropRect struct<x1:int,y1:int,x2:int,y2:int>, "
    "columns array<struct<x1:int,y1:int,x2:int,y2:int>>, inference struct<mode:string,scores:map<int,double>>, quality struct<pageInkRatio:double,"
    "widthCoefficientOfVariation:double,medianColumnInkRatio:double,maxEdgeInkRatio:double,maxEdgeTextInkRatio:double,flags:array<string>>"
)
_NAMES = ("run", "book", "page", "input", "status", "reason", "columnCount", "files", "cropRect", "columns", "inference", "quality")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or a file and its path there. `file:/a`, as Hadoop writes it, is fine, and so is any character in a name."""
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").strip("/")
    files, root = fs.FileSystem.from_uri(quote(path, safe="/:@?&=%") if "://" in path else path)
    return files, root.rstrip("/")


class FileSink:
    """Files of a folder that any file system Arrow knows may hold, each whole or not there at all."""

    def __init__(self, folder: str, attempt: str):
        self.files, self.root = _opened(folder)
        self.attempt = attempt

    def put(self, name: str, data: bytes) -> None:
        """Writes under a name of this attempt and moves it onto the final one, replacing what is there."""
        part, whole = f"{self.root}/_attempts/{self.attempt}/{name}", f"{self.root}/{name}"
        for path in (part, whole):
            self.files.create_dir(path.rpartition("/")[0], recursive=True)
        with self.files.open_output_stream(part) as out:
            out.write(data)
        self.files.move(part, whole)

    @staticmethod
    def clear(folder: str) -> None:
        """Drops what attempts have left behind. Only while no task writes."""
        files, root = _opened(folder)
        if files.get_file_info(f"{root}/_attempts").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/_attempts")


def attempt_name() -> str:
    task = TaskContext.get()
    return f"{task.stageId()}-{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}" if task else uuid.uuid4().hex


def _content(path: str) -> bytes:
    files, at = _opened(path)
    with files.open_input_stream(at) as file:
        return file.read()


def _row(page: tuple[str, str, str] | tuple[str, str, str, bytes], sink: FileSink, options: dict[str, Any], run: int) -> dict[str, Any]:
    book, name, path = page[:3]
    row: dict[str, Any] = dict.fromkeys(_NAMES) | {"run": run, "book": book, "page": name, "input": path}
    try:
        found = split_page(decoded(page[3] if len(page) > 3 else _content(path)), options["columns"], options["scale"], options.get("tolerant", False))
        files = [f"{book}/{name}-{i:02d}.png" for i in range(1, found["columnCount"] + 1)]
        for file, image in zip(files, found["images"]):
            sink.put(file, image)
        x, y, width, height = (found["crop"][k] for k in ("x", "y", "width", "height"))
        row |= {k: found[k] for k in ("columnCount", "inference", "quality")} | {"status": "split", "files": files}
        row |= {"cropRect": {"x1": x, "y1": y, "x2": x + width, "y2": y + height}, "columns": [{"x1": s["x1"], "y1": 0, "x2": s["x2"], "y2": height} for s in found["spans"]]}
    except Exception as e:  # noqa: BLE001  a page's fault must not end the job
        row |= {"status": "skipped", "reason": str(e) or type(e).__name__}
    return row


def split_rows(pages: DataFrame, out: str, options: dict[str, dict[str, Any]], run: int) -> DataFrame:
    """MANIFEST rows of pages(book, page, path, content), whose column images are written to `out` on the way; options by book.
    Without `content`, tasks read the files at `path`."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sink = FileSink(out, attempt_name())
        for frame in frames:
            rows = [_row(page, sink, options[page[0]], run) for page in frame.itertuples(index=False, name=None)]
            yield pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=object) for c in _NAMES})

    return pages.select("book", "page", "path", *(c for c in pages.columns if c == "content")).mapInPandas(work, MANIFEST)


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The latest row of each page that the manifest has; empty if there is none yet."""
    path, files = books._hadoop(spark, f"{out}/_manifest")
    rows = spark.read.schema(MANIFEST).parquet(str(path)) if files.exists(path) else spark.createDataFrame([], MANIFEST)
    newest = F.row_number().over(Window.partitionBy("book", "page").orderBy(F.desc("run")))
    return rows.withColumn("newest", newest).where("newest = 1").drop("newest")


def book_options(spark: SparkSession, root: str, names: list[str], **given: Any) -> dict[str, dict[str, Any]]:
    """Options of each book: those given, else its configuration file's, else defaults."""
    found = {}
    for name in names:
        path, files = books._hadoop(spark, f"{root}/{name}/{CONFIG}")
        text = "\n".join(r["value"] for r in spark.read.text(_literal(str(path))).collect()) if files.exists(path) else None
        found[name] = books.split_options(books.load_config(text), **given) | ({"tolerant": True} if given.get("tolerant") else {})
    return found


def listed_images(spark: SparkSession, out: str) -> DataFrame:
    """(book, page) of every column image in the folder; none if there is no folder yet."""
    path, files = books._hadoop(spark, out)
    if not files.exists(path):
        return spark.createDataFrame([], "book string, page string")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*-*.png").load(out).select("path")
    return found.where("path NOT LIKE '%/_attempts/%'").select(F.regexp_extract("path", r"([^/]+)/[^/]+\z", 1).alias("book"), F.regexp_extract("path", r"([^/]+)-[0-9]+\.png\z", 1).alias("page"))


def pending(spark: SparkSession, pages: DataFrame, out: str) -> DataFrame:
    """Pages(book, page, path) that are to be split: those that the manifest doesn't call split, or with fewer images than columns."""
    done = manifest(spark, out).where("status = 'split'").select("book", "page", F.col("columnCount").alias("columns"))
    known = pages.join(done, ["book", "page"], "left").withColumn("columns", F.col("columns"))
    new = known.where("columns IS NULL").select("book", "page", "path")
    lacking = pending_pages(known.where("columns IS NOT NULL"), listed_images(spark, out))
    return new.unionByName(lacking.select("book", "page", "path"))


def empty_pages(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """(book, page, path) of page files without a byte, which Spark's readers pass over; a task lists a book."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for book in frame["book"]:
                files, at = _opened(f"{root}/{book}")
                empty = [f.base_name for f in files.get_file_info(fs.FileSelector(at)) if f.is_file and not f.size and f.base_name.lower().endswith(".png")]
                yield pd.DataFrame({"book": [book] * len(empty), "page": [n[:-4] for n in empty], "path": [f"{root}/{book}/{n}" for n in empty]}, dtype=object)

    return spark.createDataFrame([(n,) for n in names], "book string").repartition(len(names)).mapInPandas(work, "book string, page string, path string")


def _literal(path: str) -> str:
    """A path in which nothing is a pattern."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def split_books(spark: SparkSession, root: str, out: str, resume: bool = True, skip_failed: bool = True, **given: Any) -> DataFrame:
    """Splits the pages of all books under root that lack something, and returns the manifest.

    Without `resume` all pages are split again. Pages that can't be split are in the manifest as skipped and tried again the next time;
    without `skip_failed` they raise an error in the end."""
    names = books.books_with(spark, root, ".png")
    if not names:
        raise FileNotFoundError(f"no book with page scans under {root}")
    options = book_options(spark, root, names, **given)
    run = time.time_ns()
    pages = written(books.page_images(spark, root).drop("content").coalesce(spark.sparkContext.defaultParallelism))
    choosy = {name: o for name, o in options.items() if o["exact"] or o["ranges"]}
    todo, excluded = pages.where(~F.col("book").isin(list(choosy))), None
    for name, chosen in choosy.items():
        own = pages.where(F.col("book") == name)
        kept = excluded_pages(own, "page", chosen["exact"], chosen["ranges"])
        gone = own.join(kept.select("path"), "path", "left_anti").select("book", "page", "path")
        todo, excluded = todo.unionByName(kept), gone if excluded is None else excluded.unionByName(gone)
    wanted = written(pending(spark, todo, out) if resume else todo)
    count = wanted.count()
    jobs = -(-count // PORTION)
    for job in range(jobs):
        portion = wanted.where(F.pmod(F.xxhash64("path"), F.lit(jobs)) == job).repartition(-(-min(count, PORTION) // PAGES_A_TASK))
        split_rows(portion, out, options, run).write.mode("append").parquet(f"{out}/_manifest")
    if excluded is not None:
        left_out = excluded.select(F.lit(run).alias("run"), "book", "page", F.col("path").alias("input"), F.lit("excluded").alias("status"), F.lit("configured_exclude").alias("reason"))
        left_out.write.mode("append").parquet(f"{out}/_manifest")
    empty = empty_pages(spark, root, names).select(F.lit(run).alias("run"), "book", "page", F.col("path").alias("input"), F.lit("skipped").alias("status"), F.lit("empty file").alias("reason"))
    empty.write.mode("append").parquet(f"{out}/_manifest")
    FileSink.clear(out)
    rows = manifest(spark, out)
    write_summaries(spark, rows, out)
    failed = rows.where((F.col("run") == run) & (F.col("status") == "skipped")).select("book", "page", "reason").limit(20).collect() if not skip_failed else []
    if failed:
        raise ValueError("pages that can't be split: " + "; ".join(f"{r['book']}/{r['page']}: {r['reason']}" for r in failed))
    return rows


def summaries(rows: DataFrame) -> DataFrame:
    """(book, pageCount, skippedPageCount, suspiciousPageCount, columnCountHistogram, mostCommonColumnCount, flagCounts), a row for each book
    of a manifest; ties for the most common count go to the least."""
    split = rows.where("status = 'split'")
    counts = rows.groupBy("book").agg(
        F.count_if(F.col("status") == "split").alias("pageCount"),
        F.count_if(F.col("status") != "split").alias("skippedPageCount"),
        F.count_if((F.col("status") == "split") & (F.size("quality.flags") > 0)).alias("suspiciousPageCount"),
    )
    by_count = split.groupBy("book", "columnCount").agg(F.count("*").alias("n"))
    entry = F.struct(F.col("columnCount").cast("string"), F.col("n"))
    histogram = by_count.groupBy("book").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("columnCountHistogram"), F.max_by("columnCount", F.struct(F.col("n"), -F.col("columnCount"))).alias("mostCommonColumnCount"))
    flags = split.select("book", F.explode("quality.flags").alias("flag")).groupBy("book", "flag").agg(F.count("*").alias("n"))
    flags = flags.groupBy("book").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "n")))).alias("flagCounts"))
    return counts.join(histogram, "book", "left").join(flags, "book", "left")


def write_summaries(spark: SparkSession, rows: DataFrame, out: str) -> None:
    """column_count.json and split_quality.json of each book: a row of counts a book; pages are in the manifest."""
    for row in summaries(rows).toLocalIterator():
        found = row.asDict()
        counts = {"layoutScope": "page", "columnImageFormat": "png", "pageCount": found["pageCount"], "columnCountHistogram": found["columnCountHistogram"] or {}, "mostCommonColumnCount": found["mostCommonColumnCount"]}
        quality = {k: found[k] for k in ("pageCount", "skippedPageCount", "suspiciousPageCount")} | {"flagCounts": found["flagCounts"] or {}}
        for name, value in (("column_count.json", counts), ("split_quality.json", quality)):
            FileSink(out, uuid.uuid4().hex).put(f"{found['book']}/{name}", json.dumps(value, ensure_ascii=False, indent=2).encode())
    FileSink.clear(out)
