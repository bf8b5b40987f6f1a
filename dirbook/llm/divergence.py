r"""Source divergence audit by mergeable radix tries.

Terms are runs of `[^\x00-\x40\x5B-\x60\x7B-\x7F]`, letters A-Z lower-cased: in UTF-8, runs of the bytes a-z and of
those from 0x80 on. A byte trie is kept as its preorder, in arrays: leaves in UTF-8 order, each with the number of bytes
that it shares with the leaf before it, which is the depth of the node where it branches off. A leaf has a counter for
each source: occurrences, and documents. Tries are merged leaf by leaf; a leaf that shares all its bytes is the one before.

Each partition counts its texts into tries, one a language; when they hold HELD counters, they are written by traversal
and begun anew. Traversals are merged by range of (language, term), dealt out by Spark: each range takes what arrives, in
order, into a trie of its own and passes on the leaves with LEAST documents or more, in slices of bounded size.

A slice then meets its language's sources and their totals (a cogroup; nothing is broadcast) and yields partial sums of
the pairs of sources and, for each source, its TOP candidates, ties by term; sums and ranks over slices are Spark's. Where
a language has many sources, rows of pairs are dealt out by blocks of SOURCES. All arithmetic is on whole numbers.

Hot sources and languages: a term's counters are combined in each partition before they are shuffled, ranges are cut by
terms and not by languages. Nulls and odd tables: null texts, languages and sources are empty strings, and the same as
those. A language without kept terms has pairs of value 0 and no terms, one with a single source no pairs. Repeated rows
count as often as they stand there. An empty table gives no rows. Only the columns text, lang and source are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dirbook.llm.common import Scratch

#: Documents of its language that a kept term is in; ranks of terms that are returned.
LEAST, TOP = 10, 10
#: Counters that a partition's tries hold before they are written out.
HELD = 1_500_000
#: Leaves a range of the merge, terms and counters a slice, sources a block of pairs.
RANGE_LEAVES, SLICE_TERMS, SLICE_COUNTERS, SOURCES = 500_000, 4096, 500_000, 256
#: Terms of a slice that are expanded to all sources at once.
STEP = 512
UNIT = 10**9

#: Bytes of terms, lower-cased; all others become a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

LEAVES = "lang string, term binary, source string, n long, documents long"
KEPT = "lang string, slice long, term binary, sources array<string>, counts array<long>"
PARTIAL = "lang string, source string, part string, item string, value long"


def tokens(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The terms of UTF-8 texts, in order, and the number of the text that each is from."""
    data = np.frombuffer(b" ".join([*texts, b""]).translate(_TERM_BYTES), np.uint8)
    inside = data != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return found, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right").astype(np.int32)


def _bytes(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all values and the last one's end, their bytes)."""
    _, offsets, values = terms.buffers()
    at = np.frombuffer(offsets, np.int32)[terms.offset : terms.offset + len(terms) + 1].astype(np.int64)
    return at, np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)


def branch_depths(terms: pa.Array) -> np.ndarray:
    """For sorted terms, how many bytes each shares with the one before: where in the trie it branches off."""
    at, data = _bytes(terms)
    length = np.diff(at)
    depth = np.zeros(len(terms), np.int64)
    todo = np.arange(1, len(terms))
    k = 0
    while len(todo):
        todo = todo[(length[todo] > k) & (length[todo - 1] > k)]
        todo = todo[data[at[todo] + k] == data[at[todo - 1] + k]]
        k += 1
        depth[todo] = k
    return depth


class Trie:
    """A radix trie in preorder: counters (term, source, n, documents), ordered by the bytes of terms and sources."""

    def __init__(self, counters: pa.Table):
        self.counters = counters

    @staticmethod
    def merge(parts: Iterable[pa.Table | Trie]) -> Trie:
        """One trie of several, or of counters in any order; counters of a leaf and source are added up."""
        rows = pa.concat_tables([p.counters if isinstance(p, Trie) else p for p in parts]).select(["term", "source", "n", "documents"])
        rows = rows.group_by(["term", "source"], use_threads=False).aggregate([("n", "sum"), ("documents", "sum")]).rename_columns(["term", "source", "n", "documents"])
        return Trie(rows.sort_by([("term", "ascending"), ("source", "ascending")]).combine_chunks())

    def leaves(self) -> np.ndarray:
        """Where the counters of each leaf begin: a counter whose term shares all its bytes with the one before is of the same leaf."""
        if not self.counters.num_rows:
            return np.zeros(0, np.int64)
        terms = self.counters["term"].combine_chunks()
        length = np.diff(_bytes(terms)[0])
        same = branch_depths(terms) == length
        same[0], same[1:] = False, same[1:] & (length[1:] == length[:-1])
        return np.flatnonzero(~same)

    def walk(self) -> Iterator[tuple[bytes, int, dict[str, int]]]:
        """(term, documents, occurrences by source) of all leaves, in order."""
        rows = self.counters.to_pylist()
        bounds = [*self.leaves().tolist(), len(rows)]
        for a, b in zip(bounds, bounds[1:]):
            yield rows[a]["term"], sum(r["documents"] for r in rows[a:b]), {r["source"]: r["n"] for r in rows[a:b]}


def _counted(batch: pa.RecordBatch, groups: dict[tuple[str, str], int]) -> pa.Table:
    """(group, term, n, documents) of a batch's (lang, source, text); a group is a language with a source."""
    own = [groups.setdefault(g, len(groups)) for g in zip(batch["lang"].to_pylist(), batch["source"].to_pylist())]
    found, text = tokens(batch["text"].to_pylist())
    by_text = pa.table({"text": text, "term": found}).group_by(["text", "term"], use_threads=False).aggregate([([], "count_all")])
    group = pa.array(np.array(own, np.int32)[by_text["text"].to_numpy()] if own else np.zeros(0, np.int32))
    rows = pa.table({"group": group, "term": by_text["term"], "n": by_text["count_all"]})
    return rows.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")]).rename_columns(["group", "term", "n", "documents"])


def _added(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("documents", "sum")]).rename_columns(["group", "term", "n", "documents"])


def _written(rows: pa.Table, groups: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    """LEAVES of the tries, one a language, of counted rows."""
    source = pa.array([s for _, s in groups], pa.string()).take(rows["group"].combine_chunks())
    names = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in groups))}
    number = np.array([names[lang] for lang, _ in groups], np.int32)[rows["group"].to_numpy()]
    order = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[order], np.arange(len(names) + 1))
    rows = rows.set_column(0, "source", source)
    for lang, a, b in zip(names, bounds, bounds[1:]):
        if b > a:
            trie = Trie.merge([rows.take(pa.array(order[a:b]))]).counters
            yield from trie.add_column(0, "lang", pa.array([lang] * trie.num_rows, pa.string())).to_batches(max_chunksize=20_000)


def count_terms(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """LEAVES of the tries of a partition's (lang, source, text), which hold about `most` counters at a time."""
    groups: dict[tuple[str, str], int] = {}
    parts: list[pa.Table] = []
    for batch in batches:
        parts.append(_counted(batch, groups))
        if sum(p.num_rows for p in parts) > most:
            parts = [_added(parts)]
            if parts[0].num_rows > most // 2:
                yield from _written(parts[0], groups)
                groups, parts = {}, []
    if parts:
        yield from _written(_added(parts), groups)


def merge_leaves(batches: Iterator[pa.RecordBatch], most: int, most_counters: int) -> Iterator[pa.RecordBatch]:
    """KEPT terms of a range whose LEAVES come in order. Terms before the last one seen are complete."""
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    held: list[pa.Table] = []

    def passed(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        """The kept leaves of complete terms; what isn't complete stays held."""
        nonlocal number
        langs = rows["lang"].combine_chunks()
        code = pc.dictionary_encode(langs).indices.to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), rows.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            trie = Trie.merge([rows.slice(a, b - a)])
            starts = trie.leaves()
            if not last and b == rows.num_rows:
                if len(starts):
                    open_rows = trie.counters.slice(int(starts[-1]))
                    held.append(open_rows.add_column(0, "lang", pa.array([langs[a].as_py()] * open_rows.num_rows, pa.string())))
                    trie, starts = Trie(trie.counters.slice(0, int(starts[-1]))), starts[:-1]
            if not len(starts):
                continue
            documents = np.add.reduceat(trie.counters["documents"].to_numpy(), starts)
            ends = np.append(starts[1:], trie.counters.num_rows)
            chosen = np.flatnonzero(documents >= LEAST)
            sizes = (ends - starts)[chosen]
            if not len(chosen):
                continue
            full = np.maximum(np.arange(len(chosen)) // most, (np.cumsum(sizes) - sizes) // most_counters)  # both grow; so do their slices
            cut = np.insert(np.cumsum(np.diff(full) > 0), 0, 0)
            index = np.repeat(starts[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            kept = trie.counters.take(pa.array(index)).combine_chunks()
            offsets = pa.array(np.insert(np.cumsum(sizes), 0, 0).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, kept[c].combine_chunks()) for c in ("source", "n")]
            terms = trie.counters["term"].combine_chunks().take(pa.array(starts[chosen]))
            slices = pa.array(number + 1 + cut)
            number += int(cut[-1]) + 1
            table = pa.table([pa.array([langs[a].as_py()] * len(chosen), pa.string()), slices, terms, *lists], names=["lang", "slice", "term", "sources", "counts"])
            yield from table.to_batches(max_chunksize=2_000)

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(p.num_rows for p in held) > 4 * most:
            rows, held = pa.concat_tables(held), []
            yield from passed(rows, False)
    if held:
        rows, held = pa.concat_tables(held), []
        yield from passed(rows, True)


def probabilities(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / total), exactly, in two steps that fit into 64 bits up to 9 * 10^13 terms; beyond, by
    Python's whole numbers."""
    if int(totals.max(initial=0)) >= 9 * 10**13:
        return 1 + UNIT * (counts.astype(object) + 2) // totals.astype(object)
    whole, rest = np.divmod((counts + 2) * 100_000, totals)
    return 1 + whole * 10_000 + rest * 10_000 // totals


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def compare(key: tuple, kept: pa.Table, sources: pa.Table, size: int, step: int) -> pa.Table:
    """PARTIAL results of a slice of a language for a block of `size` of its sources; `sources` has all of them."""
    lang, block = key[0].as_py(), key[2].as_py()
    order = pc.sort_indices(sources["source"].combine_chunks().cast(pa.binary()))
    sources = sources.take(order)
    names = sources["source"].to_pylist()
    totals = sources["n"].to_numpy().astype(np.int64)
    terms_kept = int(sources["terms"][0].as_py())
    first, last = block * size, min(len(names), (block + 1) * size)
    sums = np.zeros((last - first, len(names)), np.int64)
    best: list[list[tuple]] = [[] for _ in range(first, last)]
    if kept.num_rows:
        kept = kept.take(pc.sort_indices(kept["term"].combine_chunks()))
        among = pa.array(names)
        whole = int(totals.sum()) + 2 * terms_kept
        for at in range(0, kept.num_rows, step):
            part = kept.slice(at, step).combine_chunks()
            lists = part["counts"].combine_chunks()
            column = pc.index_in(part["sources"].combine_chunks().flatten(), among).to_numpy(zero_copy_only=False)
            counts = np.zeros((part.num_rows, len(names)), np.int64)
            counts[np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False)), column] = lists.flatten().to_numpy()
            p = probabilities(counts, totals + 2 * terms_kept)
            q = probabilities(counts.sum(1), np.array([whole]))
            words = part["term"]
            for i in range(first, last):
                own = p[:, i]
                sums[i - first] += divergence(p, own[:, None]).sum(0).astype(np.int64)
                over = np.flatnonzero((counts[:, i] > 0) & (own > q))
                value = divergence(own[over], q[over]).astype(np.int64)
                top = np.argsort(-value, kind="stable")[:TOP]
                found = best[i - first] + [(-int(value[j]), words[int(over[j])].as_py()) for j in top]
                best[i - first] = sorted(found)[:TOP]
    rows = [(lang, names[first + a], "pair", names[b], int(x)) for a, line in enumerate(sums) for b, x in enumerate(line) if b != first + a]
    rows += [(lang, names[first + a], "term", term.decode(), -value) for a, found in enumerate(best) for value, term in found]
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "part", "item", "value"])


def kept_terms(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """KEPT terms of all documents, written to scratch."""
    read = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))
    held, most, most_counters = HELD, SLICE_TERMS, SLICE_COUNTERS
    leaves = scratch.table(read.mapInArrow(lambda batches: count_terms(batches, held), LEAVES), "leaves")
    ranges = max(1, -(-leaves.count() // RANGE_LEAVES))
    ranged = leaves.repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
    kept = scratch.table(ranged.mapInArrow(lambda batches: merge_leaves(batches, most, most_counters), KEPT), "kept")
    scratch.drop("leaves")
    return kept


def audit(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and its own terms."""
    scratch, size, step = scratch or Scratch(docs.sparkSession), SOURCES, STEP
    kept = kept_terms(docs, scratch)
    groups = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    slices = kept.groupBy("lang", "slice").agg(F.count("*").alias("terms"))
    vocabulary = slices.groupBy("lang").agg(F.sum("terms").alias("terms"))
    sources = groups.join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    sources = scratch.table(sources.select("lang", "source", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("terms", F.lit(0)).cast("long").alias("terms")), "sources")
    blocks = sources.groupBy("lang").agg(F.explode(F.sequence(F.lit(0), F.floor((F.count("*") - 1) / size).cast("int"))).alias("block"))
    tasks = blocks.join(slices.drop("terms"), "lang", "left").select("lang", F.coalesce("slice", F.lit(-1)).alias("slice"), "block")
    keys = ["lang", "slice", "block"]
    left = kept.join(blocks, "lang").select(*keys, "term", "sources", "counts")
    right = tasks.join(sources, "lang").select(*(F.col(k).alias(k) for k in keys), "source", "n", "terms")
    found = scratch.table(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda key, kept, sources: compare(key, kept, sources, size, step), PARTIAL), "partial")
    by = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(by))
    candidates = found.where("part = 'term'").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= TOP)
    return pairs.unionByName(candidates)
