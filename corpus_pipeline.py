"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Stages see their predecessor's rows only. Rows are told
apart by their place, so null and repeated doc_ids are fine; null texts are empty (and the quality rules reject those).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from dirbook.llm.common import Scratch
from dirbook.llm.exact import drop_copies
from dirbook.llm.ngram_join import one_of_each
from dirbook.llm.packing import pack
from dirbook.llm.quality import keep_good
from dirbook.llm.substring import cut_repeats

#: The scratch folder of the stage that each thread ran last.
_last = threading.local()


def _fresh(spark: SparkSession) -> Scratch:
    """A scratch folder for a stage. Stages of a run follow each other in one thread, each on what the one before has
    written; so that one's own folder goes. Runs in other threads have theirs."""
    if getattr(_last, "scratch", None) is not None:
        _last.scratch.release()
    _last.scratch = Scratch(spark)
    return _last.scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; null and empty texts have too few words. An empty table stays empty."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id (null is the smallest; of ties the last row); null counts as empty."""
    return drop_copies(docs, scratch=_fresh(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that are similar on five-word shingles, the one with the least doc_id (of ties the
    first row). Texts without words all stay."""
    return one_of_each(docs, scratch=_fresh(spark))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 35 words that occur elsewhere, too. All rows stay, those of null or short texts unchanged."""
    return cut_repeats(docs, scratch=_fresh(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece of a document, with its place. Null texts are one token, the separator."""
    return pack(docs, scratch=_fresh(spark))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: Packing has no SQL; run() is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    between = Scratch(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = between.table(docs, f"stage{i}")
            if i:
                between.drop(f"stage{i - 1}")
    return docs
