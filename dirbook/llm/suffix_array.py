"""Suffix-array dedup by two-stage sorting.

Every byte is removed that lies in a string of `width` bytes which also starts elsewhere in the corpus. A suffix array
over all of it would be some ten times the text, so the suffixes are dealt out first: each by the anchor of its first
`width` bytes (see anchors.py), which equal strings share. An anchor that occurs once can't begin a repeat, and of equal
runs of suffixes one is sorted for all. What is left is sorted bucket by bucket, an anchor never being parted (those with very many contents are dealt by their strings' own
hashes instead, which leaves nothing to sort): in each, only the suffixes smaller than
their successors are sorted directly; the others are induced by one scan over the buckets of first bytes; neighbours in
the finished array are then compared for their common prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.anchors import RUNS, by_row, byte_words, candidates, grams, parts, portions, repeated_alone, runs, spans
from dirbook.llm.common import Scratch, batched, bytes_of, hash_pair, keyed

WIDTH, GRAM = 200, 64
#: Bytes sorted at once; an anchor's suffixes are never parted.
BUCKET = 1 << 20


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last one, before nothing, is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    step[-1] = -1
    # a run of equal bytes goes by what follows it
    at = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def suffix_order(data: bytes, depth: int) -> np.ndarray:
    """The suffixes of data in order of their first `depth` bytes at least (ties in any order)."""
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    small = np.flatnonzero(smaller_than_next(text))
    # stage one: sort the smaller suffixes directly
    keys = [data[i : i + depth] for i in small.tolist()]
    small = small[sorted(range(len(small)), key=keys.__getitem__)]
    # stage two: each suffix, in order, puts the larger suffix before it at the head of that one's bucket
    sorted_small = np.split(small, np.cumsum(np.bincount(text[small], minlength=256))[:-1]) if len(small) else [small] * 256
    heads: list[list[np.ndarray]] = [[] for _ in range(256)]
    heads[text[-1]].append(np.array([n - 1]))  # the empty suffix comes first and induces the last byte's
    out = []
    for c in range(256):
        front = np.concatenate(heads[c]) if heads[c] else np.zeros(0, np.int64)
        rounds = [front]
        while len(front):  # larger suffixes of this bucket induce those before them in a run of its byte
            front = front[front > 0] - 1
            front = front[text[front] == c]
            rounds.append(front)
        bucket = np.concatenate([*rounds, sorted_small[c]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = text[before]
        before, first = before[first > c], first[first > c]
        if len(before):
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                heads[text[part[0]]].append(part)
    return np.concatenate(out)


def common_at_least(data: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """For neighbours in the array, whether their common prefix has `depth` bytes. All suffixes must be that long."""
    a, b = order[:-1], order[1:]
    word = byte_words(data + bytes(8))
    alive = np.arange(len(a))
    for at in [*range(0, depth - 7, 8), depth - 8]:
        alive = alive[word[a[alive] + at] == word[b[alive] + at]]
    same = np.zeros(len(a), bool)
    same[alive] = True
    return same


def repeated_starts(pieces: list[bytes], copies: list[int], width: int) -> list[np.ndarray]:
    """For each piece, which of its strings of `width` bytes occur twice or more in all pieces together."""
    data = b"".join(x + b"\0" for x in pieces)
    lengths = np.array([len(x) for x in pieces])
    windows = np.maximum(lengths - width + 1, 0)
    begins = np.cumsum(lengths + 1) - lengths - 1
    owner = np.full(len(data), -1, np.int64)
    for i, (a, n) in enumerate(zip(begins.tolist(), windows.tolist())):
        owner[a : a + n] = i
    order = suffix_order(data, width)
    order = order[owner[order] >= 0]  # tails shorter than a string match nothing
    same = common_at_least(data, order, width)
    twice = np.zeros(len(data), bool)
    twice[order[:-1]] |= same
    twice[order[1:]] |= same
    twice[order] |= np.array(copies)[owner[order]] > 1
    return [np.flatnonzero(twice[a : a + n]) for a, n in zip(begins.tolist(), windows.tolist())]


def byte_runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """RUNS of the strings of `width` bytes of keyed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RUNS.split(", ")]
        for batch in batches:
            texts, rids = bytes_of(batch["text"]), batch["rid"].to_numpy(zero_copy_only=False)
            for some in portions(parts(texts, width), 1 << 20):
                data = b"".join(x[2] for x in some)
                if len(data) < width:
                    continue
                sequence, begin, lengths = (np.array(x) for x in ([x[0] for x in some], [x[1] for x in some], [len(x[2]) for x in some]))
                r = runs(grams(byte_words(data), 8, gram), lengths, width, gram)
                place = (np.cumsum(lengths) - lengths)[r.sequence] + r.start
                content = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(place.tolist(), (place + r.windows + width - 1).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rids[sequence[r.sequence]], begin[r.sequence] + r.start, r.windows, r.anchor.view(np.int64), np.array(content, np.uint64).view(np.int64), r.again)], names)

    return docs.select("rid", "text").mapInArrow(run, RUNS)


PIECES = pa.schema([("m", pa.int64()), ("rid", pa.int64()), ("start", pa.int64()), ("c", pa.int64()), ("piece", pa.binary())])


def _pieces(docs: DataFrame, width: int) -> DataFrame:
    """The bytes of the runs that documents (rid, text, runs) list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for rid, text, listed in zip(batch["rid"].to_pylist(), bytes_of(batch["text"]), batch["runs"].to_pylist()):
                    for x in listed:
                        yield x["m"], rid, x["start"], x["c"], text[x["start"] : x["start"] + x["n"] + width - 1]

        yield from batched(rows(), PIECES, 5000)

    return docs.select("rid", "text", "runs").mapInArrow(run, "m long, rid long, start long, c long, piece binary")


WINDOWS = pa.schema([(c, pa.int64()) for c in ("h1", "h2", "rid", "start", "c")])


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """Hashes of all strings of the runs that documents (rid, text, runs) list: those of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for rid, text, listed in zip(batch["rid"].to_pylist(), bytes_of(batch["text"]), batch["runs"].to_pylist()):
                    for x in listed:
                        for at in range(x["start"], x["start"] + x["n"]):
                            yield *hash_pair(text[at : at + width]), rid, at, x["c"]

        yield from batched(rows(), WINDOWS)

    return docs.select("rid", "text", "runs").mapInArrow(run, ", ".join(f"{f.name} long" for f in WINDOWS))


RANGES = pa.schema([("rid", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])


def buckets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """Rows in order of their anchor as lists of about `size` bytes that don't part an anchor."""
    held, n, last = [], 0, None
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("m", "rid", "start", "c", "piece"))):
            if n >= size and row[0] != last:
                yield held
                held, n = [], 0
            held.append(row)
            n += len(row[4])
            last = row[0]
    if held:
        yield held


def _repeats(pieces: DataFrame, width: int) -> DataFrame:
    """(rid, start, n) of runs of repeated strings in pieces that come sorted by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for held in buckets(batches, BUCKET):
                for (_, rid, start, _, _), hits in zip(held, repeated_starts([x[4] for x in held], [x[3] for x in held], width)):
                    if len(hits):
                        cuts = np.flatnonzero(np.diff(hits) > 1) + 1
                        for part in np.split(hits, cuts):
                            yield rid, start + int(part[0]), len(part)

        yield from batched(rows(), RANGES)

    return pieces.mapInArrow(run, "rid long, start long, n long")


def repeated_ranges(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, scratch: Scratch | None = None) -> DataFrame:
    """(rid, start, n): strings of `width` bytes at start .. start + n - 1 of keyed documents occur elsewhere too."""
    scratch = scratch or Scratch(docs.sparkSession)
    found = candidates(byte_runs(docs, width, gram), scratch)
    pieces = _pieces(docs.join(by_row(found.pieces, "start", "n", "m", "c"), "rid"), width)
    dealt = pieces.repartition(F.col("m")).sortWithinPartitions("m")
    whole = found.whole
    if found.hot.take(1):
        alone = scratch.table(_windows(docs.join(by_row(found.hot, "start", "n", "c"), "rid"), width), "windows")
        whole = whole.unionByName(repeated_alone(alone))
    return scratch.table(whole.unionByName(_repeats(dealt, width)), "ranges")


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of docs(doc_id, text).

    Bytes in a string of `width` bytes that also starts elsewhere, in another row or this one, are removed; strings are
    judged on the input and never cross rows. Null and empty texts, and those shorter than `width`, lose nothing. Repeated
    rows are repeats of each other, so both lose all. An empty table gives no rows. Only doc_id and text are read.
    """
    rows = keyed(docs)
    ranges = repeated_ranges(rows, width, gram, scratch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, count, kept = [], [], [], []
            for text, listed in zip(bytes_of(batch["text"]), batch["runs"].to_pylist()):
                cuts = spans([(x["start"], x["start"] + x["n"] + width - 1) for x in listed or ()])
                rest = b"".join(text[a:b] for a, b in zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(text)]))
                n.append(len(text))
                removed.append(len(text) - len(rest))
                count.append(len(cuts))
                kept.append(sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(x, pa.int64()) for x in (n, removed, count)), pa.array(kept, pa.string())], [c.split()[0] for c in REMOVED.split(", ")])

    return rows.join(by_row(ranges, "start", "n"), "rid", "left").select("doc_id", "text", "runs").mapInArrow(run, REMOVED)
