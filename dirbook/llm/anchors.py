"""Windows of sequences, dealt out by winnowed anchors.

Every window of `width` items is named by its anchor: the least hash among its grams of `gram` items. Equal windows have
equal anchors, so windows need only be compared where anchors are equal; and neighbouring windows mostly share theirs,
so they travel as one piece: a run of window starts. What a run holds is told by a second, independent hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.common import Scratch

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_SHIFT = np.uint64(29)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    out = a * _MIX[0]
    out += b
    out ^= out >> _SHIFT
    out *= _MIX[1]
    out ^= out >> _SHIFT
    return out


def grams(items: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Hashes of all stretches of `gram` items (a power of two times `span`), from hashes of stretches of `span`."""
    while span < gram:
        items = mix(items[:-span], items[span:])
        span *= 2
    return items


def byte_words(data: bytes) -> np.ndarray:
    """The eight bytes at each place, as one number."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data, 0, (1,)).astype(np.uint64)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours."""
    have = 1
    while 2 * have <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    return np.minimum(a[: len(a) - (width - have)], a[width - have :]) if have < width else a


def sliding_max(a: np.ndarray, width: int) -> np.ndarray:
    """Greatest of each `width` neighbours."""
    have = 1
    while 2 * have <= width:
        a = np.maximum(a[:-have], a[have:])
        have *= 2
    return np.maximum(a[: len(a) - (width - have)], a[width - have :]) if have < width else a


class Runs(NamedTuple):
    """Runs of windows with one anchor. `again`: the anchor's gram occurs more than once in the run."""

    sequence: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    again: np.ndarray


def runs(hashes: np.ndarray, lengths: np.ndarray, width: int, gram: int) -> Runs:
    """The runs of sequences of these lengths that stand one after the other.

    `hashes`: of the grams at each place of all sequences together; windows that reach over an end are not used.
    """
    reach = width - gram + 1
    ends = np.cumsum(lengths)
    begins = ends - lengths
    counts = np.maximum(lengths - width + 1, 0)
    used = np.flatnonzero(counts)
    if not len(used):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none.astype(bool))
    least = sliding_min(hashes, reach)
    total = int(counts[used].sum())
    first = np.cumsum(counts[used]) - counts[used]
    owner = np.repeat(np.arange(len(used)), counts[used])
    at = np.arange(total) - first[owner] + begins[used][owner]
    anchor = least[at]
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    windows = np.diff(starts, append=total)
    sequence, place, anchor = used[owner[starts]], at[starts], anchor[starts]
    again = _again(hashes, least, place, windows, anchor, reach)
    return Runs(sequence, place - begins[sequence], windows, anchor, again)


def _again(hashes: np.ndarray, least: np.ndarray, place: np.ndarray, windows: np.ndarray, anchor: np.ndarray, reach: int) -> np.ndarray:
    """Which runs hold their anchor's gram twice. Grams that are some window's least are few; runs over just one need no look."""
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(len(hashes) - len(least), np.uint64)])
    chosen = np.flatnonzero(sliding_max(padded, reach) == hashes)
    low, high = np.searchsorted(chosen, place), np.searchsorted(chosen, place + windows + reach - 1)
    value = hashes[chosen]
    again = np.zeros(len(place), bool)
    for i in np.flatnonzero(high - low > 1):
        again[i] = np.count_nonzero(value[low[i] : high[i]] == anchor[i]) > 1
    return again


def portions(items: list, size: int) -> Iterator[list]:
    """Lists of (sequence, begin, items) parts whose lengths add up to about `size`."""
    held, n = [], 0
    for x in items:
        held.append(x)
        n += len(x[2])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def spans(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges, as sorted ranges that don't touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


#: Longer sequences are taken in overlapping parts of this many items, to bound memory.
PART = 1 << 21


def parts(sequences: list, width: int) -> Iterator[tuple[int, int, object]]:
    """(sequence, begin, items) such that every window of `width` items lies in exactly one part."""
    for i, x in enumerate(sequences):
        for begin in range(0, max(1, len(x) - width + 1), PART):
            yield i, begin, x[begin : begin + PART + width - 1]


#: start, n: the run's first window and their number; sh: hash of all its items; again: see Runs.
RUNS = "rid long, start long, n long, m long, sh long, again boolean"


#: An anchor with more contents than this is hot: its windows are dealt out one by one.
HOT = 4096


class Candidates(NamedTuple):
    """What can hold repeated windows.

    whole(rid, start, n): runs of which the corpus has a second copy, item for item; all their windows are repeated.
    pieces(rid, start, n, m, c): one run for each content among those whose anchor has several contents; c copies.
    hot: the same, of hot anchors.
    """

    whole: DataFrame
    pieces: DataFrame
    hot: DataFrame


def candidates(every: DataFrame, scratch: Scratch, most: int | None = None) -> Candidates:
    """Candidates among RUNS, which are written first and dropped when candidates have been found. Counts are combined before they are shuffled, and runs find theirs by an equi-join that
    adaptive execution can split. Anchors have `most` contents at most, or are hot."""
    table = scratch.table(every, "runs")
    anchors = table.groupBy("m").agg(F.count("*").alias("c"), F.min("sh").alias("low"), F.max("sh").alias("high"), F.max("again").alias("twice")).where("c > 1 or twice")
    anchors = scratch.table(anchors.select("m", F.expr("low = high and not twice").alias("one")), "anchors")
    found = scratch.table(table.join(anchors, "m"), "candidates")
    scratch.drop("runs")
    scratch.drop("anchors")
    contents = found.where("not one").groupBy("m", "sh").agg(F.count("*").alias("c"), F.min(F.struct("rid", "start", "n")).alias("rep"))
    contents = scratch.table(contents, "contents")
    copied = found.where("not one").join(contents.where("c > 1").select("m", "sh"), ["m", "sh"])
    whole = found.where("one").select("rid", "start", "n").unionByName(copied.select("rid", "start", "n"))
    hot = scratch.table(contents.groupBy("m").count().where(F.col("count") > (HOT if most is None else most)).select("m"), "hot")
    rows = contents.select("rep.rid", "rep.start", "rep.n", "m", "c")
    return Candidates(whole, rows.join(hot, "m", "left_anti"), rows.join(hot, "m", "left_semi"))


def repeated_alone(windows: DataFrame) -> DataFrame:
    """(rid, start, n) of windows(h1, h2, rid, start, c), told apart by 128-bit hashes, that occur twice or more.

    Equal windows are combined before they are shuffled and found again by a join that can be split, so nothing about a
    hot anchor meets in one task.
    """
    twice = windows.groupBy("h1", "h2").agg(F.sum("c").alias("n")).where("n > 1").select("h1", "h2")
    return windows.where("c = 1").join(twice, ["h1", "h2"], "left_semi").select("rid", "start", F.lit(1).cast("long").alias("n"))


def by_row(ranges: DataFrame, *columns: str) -> DataFrame:
    """(rid, runs): the ranges of each row as a list, which is no longer than the row's own text."""
    return ranges.groupBy("rid").agg(F.collect_list(F.struct(*columns)).alias("runs"))
