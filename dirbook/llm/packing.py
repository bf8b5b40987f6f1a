"""Packing of tokenised documents into sequences by shortest-pack-first over the length histogram.

Texts are encoded once; documents over the sequence length are cut into whole sequences and a rest. The plan sees only the
histogram of piece lengths (as many entries as the sequence length), and holds packing patterns with counts: packs that are
filled alike are one entry. Lengths are placed longest first, each length's pieces into the packs that are shortest so far,
as many as an entry has at a time; only when a piece fits into no pack are new ones opened. The number of entries does not
grow with the number of pieces. Patterns are numbered as sequences, and pieces find their place by their rank among the
pieces of their length: a place in their own partition's count plus the counts of the partitions before.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirbook.llm.bpe import VOCABULARY, encoder
from dirbook.llm.common import Scratch, batched, bytes_of, keyed

SEQUENCE, SEPARATOR = 4096, 2
#: Ranks that are joined to the plan under one key, so that a frequent length is many keys.
RANKS = 1024


class Slot(NamedTuple):
    """Pieces of one length whose ranks are from `first` to `last` - 1: number `first + i` goes to sequence `sequence + i` at
    `offset`."""

    length: int
    first: int
    last: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], most: int = SEQUENCE) -> list[Slot]:
    """Slots for histogram[length] pieces of each length up to `most`."""
    # patterns, shortest first: (tokens so far, first sequence, how many packs); those of a pattern follow each other
    patterns: list[tuple[int, int, int]] = []
    packs, slots = 0, []
    for length in sorted((x for x, n in histogram.items() if x and n), reverse=True):
        first, n = 0, histogram[length]
        while first < n:
            if not patterns or patterns[0][0] + length > most:
                new = -(-(n - first) // (most // length))
                heapq.heappush(patterns, (0, packs, new))
                packs += new
            used, sequence, count = heapq.heappop(patterns)
            placed = min(count, n - first)
            slots.append(Slot(length, first, first + placed, sequence, used))
            if used + length < most:
                heapq.heappush(patterns, (used + length, sequence, placed))
            if placed < count:
                heapq.heappush(patterns, (used, sequence + placed, count - placed))
            first += placed
    return slots


PIECES = "rid long, doc_id long, start long, length long, crc long, doc_tokens long, part long, place long"
_PIECES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])


def pieces_of(docs: DataFrame, vocabulary: str, most: int, separator: int) -> DataFrame:
    """Whole sequences and rests of all documents; `place`: number among this partition's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, seen = encoder(public_tokenizers.path(vocabulary), cuts=False), TaskContext.get().partitionId(), np.zeros(most + 1, np.int64)
        end = np.array([separator], "<u4").tobytes()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for rid, doc_id, text in zip(batch["rid"].to_pylist(), batch["doc_id"].to_pylist(), bytes_of(batch["text"])):
                    ids = bpe.encode(text) + end
                    n = len(ids) // 4
                    for start in range(0, n, most):
                        length = min(most, n - start)
                        yield rid, doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, part, int(seen[length])
                        seen[length] += 1

        yield from batched(rows(), _PIECES)

    return keyed(docs).mapInArrow(run, PIECES)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, most: int = SEQUENCE, separator: int = SEPARATOR, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of each row of docs(doc_id, text).

    Null and empty texts are documents of one token, the separator. Repeated rows and doc_ids are documents each. An
    empty table gives no pieces. Only doc_id and text are read. Sequences are numbered from 0 and pieces stand in them
    without gaps, each whole; a document of more than `most` tokens has a piece for each `most` and one for the rest.
    """
    spark: SparkSession = docs.sparkSession
    scratch = scratch or Scratch(spark)
    pieces = scratch.table(pieces_of(docs, vocabulary, most, separator), "pieces")
    counts = scratch.table(pieces.groupBy("length", "part").count(), "counts")
    # at most `most` rows reach the driver
    slots = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, most)
    rows = zip(*slots) if slots else ([] for _ in Slot._fields)
    planned = spark.createDataFrame(pa.Table.from_arrays([pa.array(c, pa.int64()) for c in rows], list(Slot._fields)))
    key = lambda rank: F.floor(rank / RANKS)
    planned = planned.withColumn("ranks", F.explode(F.sequence(key(F.col("first")), key(F.col("last") - 1))))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place")).withColumn("ranks", key(F.col("rank")))
    placed = ranked.join(planned, ["length", "ranks"]).where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return placed.select("doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
