"""Substring dedup by seed and extend, over words.

A window is `width` consecutive words of one document. Documents are joined on winnowed anchors: of each window, the
least hash among its grams of a few words (see anchors.py). Each place of an anchor is a seed. From it, all seeds of one
anchor are extended together, a word to the left or right at a time: seeds stay in one class while their words agree.
A window reaching o words to the left and the rest to the right is repeated exactly when another seed shares both its
left and its right class there, so no pairs are formed. What is removed, the union of repeated windows, is the union of
the maximal repeats of at least `width` words. Seeds of an anchor with very many contents would meet in one task; their
windows are compared by hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.anchors import RUNS, by_row, candidates, grams, parts, portions, repeated_alone, runs, spans
from dirbook.llm.common import Scratch, batched, bytes_of, fresh, hash_pair, keyed, row_number, slices, word_hashes
from dirbook.llm.suffix_array import PIECES, RANGES, WINDOWS, buckets

WIDTH, GRAM = 35, 8
#: Bytes of pieces extended at once; an anchor's pieces are never parted.
BUCKET = 4 << 20


def word_runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """RUNS of the windows of keyed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RUNS.split(", ")]
        for batch in slices(batches):
            rids = batch["rid"].to_numpy(zero_copy_only=False)
            hashes, counts = word_hashes(bytes_of(batch["text"]))
            words = np.split(hashes, np.cumsum(counts)[:-1])
            for some in portions(parts(words, width), 1 << 18):
                items = np.concatenate([x[2] for x in some])
                if len(items) < width:
                    continue
                sequence, begin, lengths = (np.array(x) for x in ([x[0] for x in some], [x[1] for x in some], [len(x[2]) for x in some]))
                r = runs(grams(items, 1, gram), lengths, width, gram)
                place, data = (np.cumsum(lengths) - lengths)[r.sequence] + r.start, items.tobytes()
                content = [xxhash.xxh3_64_intdigest(data[8 * a : 8 * b]) for a, b in zip(place.tolist(), (place + r.windows + width - 1).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rids[sequence[r.sequence]], begin[r.sequence] + r.start, r.windows, r.anchor.view(np.int64), np.array(content, np.uint64).view(np.int64), r.again)], names)

    return docs.select("rid", "text").mapInArrow(run, RUNS)


def _pieces(docs: DataFrame, width: int) -> DataFrame:
    """The words, a space between them, of the runs that documents (rid, text, runs) list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for rid, text, listed in zip(batch["rid"].to_pylist(), bytes_of(batch["text"]), batch["runs"].to_pylist()):
                    words = text.split()
                    for x in listed:
                        yield x["m"], rid, x["start"], x["c"], b" ".join(words[x["start"] : x["start"] + x["n"] + width - 1])

        yield from batched(rows(), PIECES, 5000)

    return docs.select("rid", "text", "runs").mapInArrow(run, "m long, rid long, start long, c long, piece binary")


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """Hashes of all windows of the runs that documents (rid, text, runs) list: those of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for rid, text, listed in zip(batch["rid"].to_pylist(), bytes_of(batch["text"]), batch["runs"].to_pylist()):
                    data = word_hashes([text])[0].tobytes()
                    for x in listed:
                        for at in range(x["start"], x["start"] + x["n"]):
                            yield *hash_pair(data[8 * at : 8 * (at + width)]), rid, at, x["c"]

        yield from batched(rows(), WINDOWS)

    return docs.select("rid", "text", "runs").mapInArrow(run, ", ".join(f"{f.name} long" for f in WINDOWS))


def _classes(previous: np.ndarray, words: np.ndarray, places: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Classes after one more word: seeds of one class with the same word at `places`; -1 where the piece ends."""
    out = np.full(len(previous), -1, np.int64)
    alive = np.flatnonzero(within & (previous >= 0))
    if len(alive):
        word = np.unique(words[places[alive]], return_inverse=True)[1]
        out[alive] = np.unique(previous[alive] * (int(word.max()) + 1) + word, return_inverse=True)[1]
    return out


def repeated_windows(anchors: list[int], pieces: list[bytes], copies: list[int], width: int, gram: int) -> list[np.ndarray]:
    """For each piece, which of its windows (by their first word) occur twice or more in the pieces of its anchor."""
    words, lengths = word_hashes(pieces)
    begins = np.cumsum(lengths) - lengths
    found = grams(words, 1, gram)
    # seeds: places in each piece where its anchor's gram stands
    owner = np.repeat(np.arange(len(pieces)), lengths)[: len(found)]
    anchor = np.array(anchors, np.int64).view(np.uint64)
    seeds = np.flatnonzero(found == anchor[owner])
    piece = owner[seeds]
    offset = seeds - begins[piece]
    seeds, piece, offset = (x[offset + gram <= lengths[piece]] for x in (seeds, piece, offset))
    # a window belongs to the first seed in it: one to the left, within its own reach, takes it over
    previous = np.full(len(seeds), -1)
    previous[1:] = np.where(piece[1:] == piece[:-1], offset[:-1], -1)
    reach = width - gram
    group = np.unique(anchor[piece], return_inverse=True)[1].astype(np.int64)
    # the anchor is a hash: begin from the gram's own words
    for k in range(gram):
        group = _classes(group, words, seeds + k, np.ones(len(seeds), bool))
    left, right = [group], [np.zeros(len(seeds), np.int64)]
    for k in range(1, reach + 1):
        left.append(_classes(left[-1], words, seeds - k, offset - k > previous))
        right.append(_classes(right[-1], words, np.minimum(seeds + gram + k - 1, len(words) - 1), offset + gram + k <= lengths[piece]))
    weight = np.array(copies)[piece]
    hits: list[list[np.ndarray]] = [[], []]
    for o in range(reach + 1):
        a, b = left[o], right[reach - o]
        alive = np.flatnonzero((a >= 0) & (b >= 0))
        if len(alive):
            same = np.unique(a[alive] * (int(b.max()) + 1) + b[alive], return_inverse=True)[1]
            twice = alive[np.bincount(same, weight[alive])[same] > 1]
            hits[0].append(piece[twice])
            hits[1].append(offset[twice] - o)
    which, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in hits)
    order = np.lexsort((at, which))
    which, at = which[order], at[order]
    return np.split(at, np.searchsorted(which, np.arange(1, len(pieces))))


def _repeats(pieces: DataFrame, width: int, gram: int) -> DataFrame:
    """(rid, start, n) of runs of repeated windows in pieces that come sorted by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for held in buckets(batches, BUCKET):
                found = repeated_windows([x[0] for x in held], [x[4] for x in held], [x[3] for x in held], width, gram)
                for (_, rid, start, _, _), hits in zip(held, found):
                    if len(hits):
                        cuts = np.flatnonzero(np.diff(hits) > 1) + 1
                        for part in np.split(hits, cuts):
                            yield rid, start + int(part[0]), len(part)

        yield from batched(rows(), RANGES)

    return pieces.mapInArrow(run, "rid long, start long, n long")


def repeated_ranges(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, scratch: Scratch | None = None) -> DataFrame:
    """(rid, start, n): the windows at words start .. start + n - 1 of keyed documents occur elsewhere too."""
    scratch = scratch or Scratch(docs.sparkSession)
    found = candidates(word_runs(docs, width, gram), scratch)
    pieces = _pieces(docs.join(by_row(found.pieces, "start", "n", "m", "c"), "rid"), width)
    dealt = pieces.repartition(F.col("m")).sortWithinPartitions("m")
    whole = found.whole
    if found.hot.take(1):
        alone = scratch.table(_windows(docs.join(by_row(found.hot, "start", "n", "c"), "rid"), width), "windows")
        whole = whole.unionByName(repeated_alone(alone))
    return scratch.table(whole.unionByName(_repeats(dealt, width, gram)), "ranges")


def _kept(words: list[bytes], listed: list[dict] | None, width: int) -> list[bytes]:
    cuts = spans([(x["start"], x["start"] + x["n"] + width - 1) for x in listed or ()])
    out: list[bytes] = []
    at = 0
    for a, b in cuts:
        out += words[at:a]
        at = b
    return out + words[at:]


REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row of docs(doc_id, text).

    Words in a window of `width` words that also starts elsewhere, in another row or this one, are removed; windows are
    judged on the input. Null texts have no words; texts of fewer than `width` words lose none. Repeated rows are repeats
    of each other, so both lose all. An empty table gives no rows. Only doc_id and text are read. Words are compared by
    64-bit hashes.
    """
    rows = keyed(docs)
    ranges = repeated_ranges(rows, width, gram, scratch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, kept = [], [], []
            for text, listed in zip(bytes_of(batch["text"]), batch["runs"].to_pylist()):
                words = text.split()
                rest = _kept(words, listed, width)
                n.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(sha256(b" ".join(rest)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(x, pa.int64()) for x in (n, removed)), pa.array(kept, pa.string())], [c.split()[0] for c in REMOVED.split(", ")])

    return rows.join(by_row(ranges, "start", "n"), "rid", "left").select("doc_id", "text", "runs").mapInArrow(run, REMOVED)


def cut_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, scratch: Scratch | None = None) -> DataFrame:
    """docs with repeated windows cut from their texts; n_chars, where there is one, follows. All columns and rows stay.

    Texts that lose nothing are left as they are; others become their remaining words, a space between them.
    """
    rid, cuts = fresh(docs), fresh(docs, "cuts")
    cut = by_row(repeated_ranges(keyed(docs), width, gram, scratch), "start", "n").select(F.col("rid").alias(rid), F.col("runs").alias(cuts))
    at, names = docs.columns.index("text"), docs.columns
    lengths = [i for i, c in enumerate(names) if c == "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, listed in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                texts.append(b" ".join(_kept(text.encode().split(), listed, width)).decode() if listed and text else text)
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            for i in lengths:
                columns[i] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    joined = docs.withColumn(rid, row_number(docs)).join(cut, rid, "left").drop(rid)
    return joined.mapInArrow(run, docs.schema)
