"""Requests, jobs and what came of them: manifests, resume, counters, reports and what a model is asked, as plans.

Nothing here calls a service. Requests and manifests are projections, results are tables, and what is left to do is an
anti-join; so a run can stop at any place and go on from what has been written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirbook.functions.jsons import extract_object, find_uri_column, output_key, response_text
from dirbook.operators.harvest import SUCCESS, TERMINAL, harvest
from dirbook.operators.scans import running_last, running_sum, unused


def slashes(path: Column) -> Column:
    """A path with forward separators, whichever system wrote it."""
    return F.translate(path, "\\", "/")


def utc_now() -> Column:
    """The time of the query as ISO text in UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def manifest_items(images: DataFrame) -> DataFrame:
    """(output_key, page, column, uri, mime, item) of images(page, column, path, mime); `item` is the JSON kept in a manifest."""
    uri = slashes(F.col("path"))
    found = images.select(output_key(uri).alias("output_key"), "page", "column", uri.alias("uri"), "mime")
    return found.withColumn("item", F.to_json(F.struct("output_key", "page", "column", "uri", "mime")))


def job_status(jobs: DataFrame) -> DataFrame:
    """jobs(name, state, ...) with whether each has ended and whether it went well."""
    return jobs.withColumn("terminal", F.col("state").isin(*TERMINAL)).withColumn("succeeded", F.col("state").isin(*SUCCESS))


def pending_pages(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Pages(book, page, columns) that are to be split yet: those with fewer images(book, page) than columns."""
    there = images.groupBy("book", "page").agg(F.count("*").alias("there"))
    return pages.join(there, ["book", "page"], "left").where(F.coalesce("there", F.lit(0)) < F.col("columns")).select(*pages.columns)


def harvested(results: DataFrame, requests: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """results(job, output_key, response, error) with the `payload` in the response's text, and with `status`: saved, skipped,
    unmatched, or failed (an error, or no JSON object in the text) together with a `problem`.

    A result without a key is known by the file that its response names."""
    key = F.when(F.col("output_key") != "", F.col("output_key")).otherwise(output_key(find_uri_column(F.col("response"))))
    matched = harvest(results.withColumn("output_key", key), requests, existing)
    payload = extract_object(response_text(F.col("response")))
    told = matched.withColumn("payload", F.when(F.col("status") == "saved", payload))
    problem = F.when(F.col("status") == "unmatched", F.lit("no request")).when(F.col("status") == "skipped", F.lit(None)).when(F.col("error").isNotNull(), F.col("error")).when(F.col("payload").isNull(), F.lit("no JSON object"))
    failed = (F.col("status") == "saved") & F.col("problem").isNotNull()
    return told.withColumn("problem", problem).withColumn("status", F.when(failed, F.lit("failed")).otherwise(F.col("status")))


def replay(requests: DataFrame, group: list[str], order: list[str], failed: Column, budget: int = 3) -> DataFrame:
    """requests with `outcome`: done, failed, or undone for all that come after the first `budget` failures in a row of their group.

    Runs of failures are islands over ordered ranges: the failures so far less those at the last success. So a group of any size is cut by
    distributed scans, and no request after the cut is looked at twice. Null in `failed` counts as success."""
    bad, sofar, base, cut = (unused(requests, n) for n in ("bad", "sofar", "base", "cut"))
    rows = running_sum(requests.withColumn(bad, F.coalesce(failed, F.lit(False))), F.col(bad).cast("long"), group, order, sofar)
    rows = running_last(rows, F.when(~F.col(bad), F.col(sofar)), group, order, base)
    place = F.struct(*[F.col(c) for c in order])
    full = rows.where(F.col(bad) & (F.col(sofar) - F.coalesce(base, F.lit(0)) == budget)).groupBy(*group).agg(F.min(place).alias(cut))
    named = full.select(*[F.col(c).alias(f"{cut}_{i}") for i, c in enumerate(group)], cut)
    same = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"{cut}_{i}"))
    outcome = F.when(F.col(cut).isNotNull() & (place > F.col(cut)), F.lit("undone")).when(F.col(bad), F.lit("failed")).otherwise(F.lit("done"))
    return rows.join(named, same, "left").withColumn("outcome", outcome).drop(bad, sofar, base, cut, *[f"{cut}_{i}" for i in range(len(group))])


def counters(rows: DataFrame, by: str, status: str, kinds: tuple[str, ...]) -> DataFrame:
    """(by, kinds..., total): how many rows of each status a group has; null in `by` is all groups together."""
    return rows.rollup(by).agg(*[F.count_if(F.col(status) == k).alias(k) for k in kinds], F.count("*").alias("total"))


def question(items: DataFrame, rules: list[str], as_of: str) -> DataFrame:
    """(chunk, payload): what a model is asked about items(chunk, place, id, count, reasons, samples, candidates), as JSON; the
    rules that hold at the date come first, items in order."""
    item = F.struct("place", "id", "count", "reasons", "samples", "candidates")
    grouped = items.groupBy("chunk").agg(F.array_sort(F.collect_list(item)).alias("items"))
    rule_list = F.array(*map(F.lit, rules)) if rules else F.array().cast("array<string>")
    return grouped.select("chunk", F.to_json(F.struct(F.lit(as_of).alias("asOf"), rule_list.alias("rules"), "items")).alias("payload"))


def report(df: DataFrame) -> DataFrame:
    """(value) of a frame of a few rows: one JSON array of its rows, in their order of all columns."""
    return df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*df.columns)))).alias("value"))
