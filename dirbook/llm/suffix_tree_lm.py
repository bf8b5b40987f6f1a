"""Scoring with a probabilistic suffix tree over words.

Symbols are a text's lower-cased words and one end; before the first word stand ends. A context is the symbols before a
symbol, up to two. The empty context and contexts of one symbol always are states of the tree. A context of two is kept as
a state when its next-symbol distribution diverges from that of its suffix: when telling them apart gains GAIN nats on the
training texts, each occurrence being predicted from the others. Distributions are smoothed into their suffix's:
P(w | c) = (n(c, w) + m P(w | suffix of c)) / (n(c) + m), with m growing with n(c); the empty context's is the base score's.
A symbol is scored in the longest suffix of the symbols before it that is a state. Words that training texts lack are one
symbol, as in the base score, so each distribution sums to one over the known symbols and the unknown one.

All counts are of the whole training corpus. A context of two is looked at from CONTEXT occurrences on, its strings are
stored from STORED on, whatever the size of the corpus, so the tree grows with what it is trained on. No task holds all of
it: texts are dealt into chunks of successive rows, and strings into blocks by ranges of their hash. A chunk sends each of
its distinct words and pairs of words once to their block, with the count in its training texts, and is answered with the
count of all. Then it sends its strings of three in the same way to the block of their context, which decides whether
that is a state and answers by how much the log10 probability changes. Rows that travel are one for each chunk and block, at
most one for each string. Symbols and strings are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirbook.llm.anchors import mix
from dirbook.llm.common import Scratch, bytes_of, keyed, places, slices, word_hashes

#: Occurrences in training texts from which on a context of two symbols is looked at, and from which on its strings are stored.
CONTEXT, STORED = 4, 2
#: Log-likelihood, in nats, that a state must gain.
GAIN = 3.0
#: What a distribution of n occurrences takes over from its suffix weighs STRENGTH * n ** POWER occurrences.
STRENGTH, POWER = 2.0, 0.8
#: Bytes of text in a chunk.
CHUNK = 4 << 20
END = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_ONE = np.uint64(1)
#: What stands before a text's first symbol is no context of its own.
_START = (mix(np.array([END]), np.array([END])) & ~_ONE)[0]


class Segment(NamedTuple):
    """A text, or a part of a very long one: the words before it (two at most), its own, and whether the text ends here."""

    rid: int
    doc_id: int | None
    held_out: bool
    lead: bytes
    text: bytes
    ends: bool


def _cut(text: bytes, size: int) -> Iterator[tuple[int, bytes, bytes, bool]]:
    """(place, words before, part, whether it is the last) of parts of about `size` bytes, cut at white space."""
    at, lead = 0, b""
    while len(text) - at > size and (found := _SPACE.search(text, at + size)):
        part = text[at : found.start()]
        yield at, lead, part, False
        lead = b" ".join((lead.split() + part.split()[-2:])[-2:])
        at = found.start()
    yield at, lead, text[at:] if at else text, True


def segments(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[tuple[int, int], list[Segment]]]:
    """Chunks: the number of the first row and its first part's place, and segments that have `size` bytes together. That
    goes by the rows of a partition alone, not by its batches."""
    name, held, n = None, [], 0
    for batch in slices(batches):
        for rid, doc_id, held_out, text in zip(*(batch[c].to_pylist() for c in ("rid", "doc_id", "held_out")), bytes_of(batch["text"])):
            for at, lead, part, ends in _cut(text, size):
                name = name or (rid, at)
                held.append(Segment(rid, doc_id, held_out, lead, part, ends))
                n += len(part) + 1
                if n >= size:
                    yield name, held
                    name, held, n = None, [], 0
    if held:
        yield name, held


class Strings(NamedTuple):
    """What a chunk asks for at each place of its segments but the first: `word` and `pair` (it and the symbol before).

    `own`: places of the segments' own symbols, others only lead up to them. `lengths`: of the segments, in own symbols."""

    symbol: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    own: np.ndarray
    trains: np.ndarray
    lengths: np.ndarray


def strings(found: list[Segment]) -> Strings:
    hashed, counts = word_hashes([s.text for s in found], lower=True)
    ends = np.array([s.ends for s in found], np.int64)
    lengths = counts + ends
    total = lengths + 2
    begins = np.cumsum(total) - total
    symbols = np.full(int(total.sum()), END, np.uint64)
    first = begins + 2
    symbols[np.arange(len(hashed)) + np.repeat(first - (np.cumsum(counts) - counts), counts)] = hashed
    for i, s in enumerate(found):
        if s.lead:
            lead = word_hashes([s.lead], lower=True)[0]
            symbols[first[i] - len(lead) : first[i]] = lead
    own = np.ones(len(symbols), bool)
    own[begins] = own[begins + 1] = False
    asked = np.ones(len(symbols), bool)
    asked[begins] = False
    pair = np.zeros(len(symbols), np.uint64)
    pair[1:] = mix(symbols[:-1], symbols[1:]) & ~_ONE
    trains = np.repeat(~np.array([s.held_out for s in found], bool), total)
    symbol, own = symbols[asked], own[asked]
    return Strings(symbol, symbol | _ONE, pair[asked], own, own & trains[asked], lengths)


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts, from several sorted parts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ _ONE))
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts[:0]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ _ONE))
    return keys[starts], np.diff(starts, append=len(keys))


def planes(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, first bytes first, so that bytes which are mostly zero compress well."""
    most = int(numbers.max()) if len(numbers) else 0
    size = next(k for k in (1, 2, 4, 8) if most < 1 << (8 * k))
    return bytes([size]) + np.ascontiguousarray(numbers.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T).tobytes()


def unplanes(data: bytes, kind=np.int64) -> np.ndarray:
    size = data[0]
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=1).reshape(size, -1).T).view(f"<u{size}").ravel().astype(kind)


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


def zipped(batch: pa.RecordBatch) -> bytes:
    """Many rows as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unzipped(data: bytes) -> list[dict]:
    return pa.ipc.open_stream(data).read_all().to_pylist()


def _bounds(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Where in sorted keys each block begins, and the end. Blocks are equal ranges of the hash."""
    edges = np.array([-(-(b << 64) // blocks) for b in range(1, blocks)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _strength(n: np.ndarray) -> np.ndarray:
    return STRENGTH * np.maximum(n, 1) ** POWER


_TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}


def _schema(names: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in names.split(", ")])


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


#: Kinds of rows that meet at a chunk: answers of blocks, segments. _TOTAL, _STATES: numbers of a block.
_ANSWER, _SEGMENT, _TOTAL, _REQUEST, _STATES = 0, 1, 2, 3, 4
REQUESTS = "chunk long, part long, block long, keys binary, counts binary"
_REQUESTS = _schema(REQUESTS)
ANSWERS = "kind int, chunk long, part long, at long, data binary, more binary"
_ANSWERS = _schema(ANSWERS)
#: What rows of segments hold, zipped: the segments, and then their scores and the numbers of their strings of three.
_SEGMENTS = _schema("rid long, doc_id long, held_out boolean, lead binary, text binary, ends boolean")
RESULT = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_RESULT = _schema(RESULT)
_WAITING = _schema(f"{RESULT}, strings binary")
#: Segments in a row.
_ROWS = 512


def _requests(rows: DataFrame, blocks: int) -> DataFrame:
    """REQUESTS rows: the distinct words and pairs of a chunk, and their counts in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk, part), found in segments(batches):
            s = strings(found)
            learned, n = distinct(np.concatenate([s.word[s.trains], s.pair[s.trains]]))
            rest = distinct(np.concatenate([s.word[~s.trains], s.pair[~s.trains]]))[0]
            keys, n = counted(np.concatenate([learned, rest]), np.concatenate([n, np.zeros(len(rest), np.int64)]))
            cuts = _bounds(keys, blocks)
            yield _rows(_REQUESTS, [{"chunk": chunk, "part": part, "block": b, "keys": packed(keys[x:y]), "counts": planes(n[x:y])} for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y])

    return rows.mapInArrow(run, REQUESTS)


def _by_block(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each block, from batches sorted by it."""
    last, held = None, []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("block", *columns))):
            if row[0] != last and held:
                yield last, held
                held = []
            last = row[0]
            held.append(row[1:])
    if held:
        yield last, held


def _answers(requests: DataFrame) -> DataFrame:
    """ANSWERS rows: the counts of what a chunk has asked for, in its order; and _TOTAL rows (at: training tokens, chunk:
    distinct ones, part: texts) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, cells in _by_block(batches, ["chunk", "part", "keys", "counts"]):
            asked = [unpacked(c[2]) for c in cells]
            keys, n = counted(np.concatenate(asked), np.concatenate([unplanes(c[3]) for c in cells]))
            for (chunk, part, *_), some in zip(cells, asked):
                yield _rows(_ANSWERS, [{"kind": _ANSWER, "chunk": chunk, "part": part, "at": block, "data": planes(n[np.searchsorted(keys, some)])}])
            words = n[(keys & _ONE) == _ONE]
            yield _rows(_ANSWERS, [{"kind": _TOTAL, "at": int(words.sum()), "chunk": int((words > 0).sum()), "part": int(n[keys == END | _ONE].sum())}])

    return requests.repartition(F.col("block")).sortWithinPartitions("block", "chunk", "part").mapInArrow(run, ANSWERS)


def _segment_rows(rows: DataFrame) -> DataFrame:
    """ANSWERS rows of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk, part), found in segments(batches):
            for at in range(0, len(found), _ROWS):
                data = zipped(_rows(_SEGMENTS, [s._asdict() for s in found[at : at + _ROWS]]))
                yield _rows(_ANSWERS, [{"kind": _SEGMENT, "chunk": chunk, "part": part, "at": at, "data": data}])

    return rows.mapInArrow(run, ANSWERS)


def _met(answers: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of each chunk together, answers first."""
    both = answers.where(F.col("kind") == _ANSWER).unionByName(others.select(*_ANSWERS.names))
    return both.repartition("chunk", "part").sortWithinPartitions("chunk", "part", "kind", "at")


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple[bytes, bytes]], list[dict]]]:
    """(chunk, its answers, its segments)."""
    last, answers, found = None, [], []
    for batch in batches:
        for kind, chunk, part, data, more in zip(*(batch[c].to_pylist() for c in ("kind", "chunk", "part", "data", "more"))):
            if (chunk, part) != last and last is not None:
                yield last, answers, found
                answers, found = [], []
            last = chunk, part
            if kind == _ANSWER:
                answers.append((data, more))
            else:
                found += unzipped(data)
    if last is not None:
        yield last, answers, found


#: Segments with their scores in contexts of one symbol, and requests for their strings of three.
SCORED = f"{ANSWERS}, lengths binary, totals binary, counts binary, suffix binary"
_SCORED = _schema(SCORED)


def _scored(met: DataFrame, blocks: int, tokens: int, known: int) -> DataFrame:
    below = tokens + 0.1 * (known + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk, part), answers, rows in _by_chunk(batches):
            found = [Segment(**r) for r in rows]
            s = strings(found)
            n = np.concatenate([unplanes(a[0]) for a in answers])
            keys = distinct(np.concatenate([s.word, s.pair]))[0]
            if len(keys) != len(n):
                raise ValueError("the rows of the input have changed between two scans")
            c, pairs = n[places(keys, s.word)], n[places(keys, s.pair)]
            before = np.flatnonzero(s.own) - 1  # the place of the symbol before
            own = before + 1
            base = (c[own] + 0.1) / below
            weight = _strength(c[before])
            p = (pairs[own] + weight * base) / (c[before] + weight)
            owner = np.repeat(np.arange(len(found)), s.lengths)
            total = lambda x: np.bincount(owner, x, len(found))
            # strings of three, by context and last symbol
            asks = (pairs[before] >= CONTEXT) & (s.pair[before] != _START)
            context, symbol, occurs, p3 = s.pair[before][asks], s.symbol[own][asks], pairs[before][asks], p[asks]
            sent = pairs[own][asks] >= STORED
            contexts, first, group = np.unique(context, return_index=True, return_inverse=True)
            order = np.lexsort((symbol[sent], group[sent]))
            g, w = group[sent][order], symbol[sent][order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
            number = np.empty(len(g), np.int64)
            number[order] = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            times = np.add.reduceat(s.trains[own][asks][sent][order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
            number_of = len(starts) + group
            number_of[sent] = number
            lengths = np.bincount(g[starts], minlength=len(contexts))
            suffix, totals, w = p3[sent][order][starts].astype(np.float32), occurs[first], w[starts]
            cuts, at = _bounds(contexts, blocks), np.concatenate([[0], np.cumsum(lengths)])
            for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if x < y:
                    i, j = at[x], at[y]
                    yield _rows(_SCORED, [{"kind": _REQUEST, "chunk": chunk, "part": part, "at": b, "data": packed(contexts[x:y]), "lengths": planes(lengths[x:y]), "totals": planes(totals[x:y]), "more": w[i:j].tobytes(), "counts": planes(times[i:j]), "suffix": suffix[i:j].tobytes()}])
            ask_of = np.concatenate([[0], np.cumsum(np.bincount(owner[asks], minlength=len(found)))])
            columns = zip(s.lengths.tolist(), total(c[own] > 0).astype(int).tolist(), total(np.log10(base)).tolist(), total(np.log10(p)).tolist())
            waiting = [(x.rid, x.doc_id, x.held_out, *some, planes(number_of[ask_of[i] : ask_of[i + 1]])) for i, (x, some) in enumerate(zip(found, columns))]
            for a in range(0, len(found), _ROWS):
                data = zipped(_rows(_WAITING, [dict(zip(_WAITING.names, x)) for x in waiting[a : a + _ROWS]]))
                yield _rows(_SCORED, [{"kind": _SEGMENT, "chunk": chunk, "part": part, "at": a, "data": data}])

    return met.mapInArrow(run, SCORED)


def divergence(group: np.ndarray, totals: np.ndarray, n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts with so many occurrences in `totals`, and strings of context `group` that occur n times, the last symbol
    having probability p after the context's suffix: which contexts are states, and by how much the log10 probability of
    strings, and of symbols without a stored string, changes."""
    stored = n >= STORED
    kept = np.bincount(group[stored], n[stored], len(totals))
    weight, less = _strength(kept), np.maximum(kept - 1, 0)
    other = np.log(weight / (kept + weight))
    one_less = _strength(less)
    alone = np.log((np.maximum(n - 1, 0) + one_less[group] * p) / ((less + one_less)[group] * p))
    gain = np.bincount(group[stored], (n * alone)[stored], len(totals)) + (totals - kept) * other
    states = (gain > GAIN) & (kept > 0)
    change = np.where(stored, np.log((np.where(stored, n, 0) + weight[group] * p) / ((kept + weight)[group] * p)), other[group])
    return states, np.where(states[group], change, 0.0) / np.log(10), np.where(states, other, 0.0) / np.log(10)


def _changes(requests: DataFrame) -> DataFrame:
    """ANSWERS rows: for each chunk the changes of its strings (data) and of its contexts' other symbols (more), in its order;
    and the number of a block's states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, cells in _by_block(batches, ["chunk", "part", "data", "lengths", "totals", "more", "counts", "suffix"]):
            contexts = [unpacked(c[2]) for c in cells]
            sizes = [unplanes(c[3]) for c in cells]
            names, first, group = np.unique(np.concatenate(contexts), return_index=True, return_inverse=True)
            totals = np.concatenate([unplanes(c[4]) for c in cells])[first]
            of = np.repeat(group, np.concatenate(sizes))
            symbol = np.frombuffer(b"".join([c[5] for c in cells]), np.uint64)
            n, p = np.concatenate([unplanes(c[6]) for c in cells]), np.frombuffer(b"".join([c[7] for c in cells]), np.float32)
            order = np.lexsort((symbol, of))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(of[order]) != 0) | (np.diff(symbol[order]) != 0)
            starts = np.flatnonzero(new)
            which = np.empty(len(order), np.int64)
            which[order] = np.cumsum(new) - 1
            n = np.add.reduceat(n[order], starts) if len(starts) else n[:0]
            states, change, other = divergence(of[order][starts], totals, n, p[order][starts].astype(float))
            change, other = change[which].astype(np.float32), other[group].astype(np.float32)
            i = j = 0
            for (chunk, part, *_), here, size in zip(cells, contexts, sizes):
                k, m = i + int(size.sum()), j + len(here)
                yield _rows(_ANSWERS, [{"kind": _ANSWER, "chunk": chunk, "part": part, "at": block, "data": change[i:k].tobytes(), "more": other[j:m].tobytes()}])
                i, j = k, m
            yield _rows(_ANSWERS, [{"kind": _STATES, "at": int(states.sum())}])

    asked = requests.withColumn("block", F.col("at")).repartition(F.col("block")).sortWithinPartitions("block", "chunk", "part")
    return asked.mapInArrow(run, ANSWERS)


def _changed(met: DataFrame) -> DataFrame:
    """RESULT rows of the segments: their scores with the changes that states of two symbols make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, answers, rows in _by_chunk(batches):
            change = np.concatenate([np.frombuffer(a[k], np.float32) for k in (0, 1) for a in answers] or [np.zeros(0, np.float32)])
            for r in rows:
                r["score"] += float(change[unplanes(r.pop("strings"))].sum(dtype=float))
            yield _rows(_RESULT, rows)

    return met.mapInArrow(run, RESULT)


def held_out_column() -> Column:
    """Whether a document is held out; a null doc_id counts as the empty text, whose remainder is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_states) of each row of docs(doc_id, text).

    Rows whose doc_id's crc32 is a multiple of ten are held out; all others train. Null texts are empty: one token, the
    end. Repeated rows train as often as they occur. With nothing to train on, known tokens are 0 and every symbol is the
    unknown one, whose probability is 1. An empty table gives no rows. Words are told apart by 64-bit hashes. A text beyond
    the size of a chunk is counted and scored in parts, each with the two words before it as context.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows = keyed(docs).withColumn("held_out", held_out_column()).select("rid", "doc_id", "held_out", "text")
    blocks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers = scratch.table(_answers(_requests(rows, blocks)), "answers")
    tokens, known, texts = (x or 0 for x in answers.where(F.col("kind") == _TOTAL).agg(F.sum("at"), F.sum("chunk"), F.sum("part")).first())
    scored = scratch.table(_scored(_met(answers, _segment_rows(rows)), blocks, tokens, known).withColumn("half", F.when(F.col("kind") == _REQUEST, 2 * F.col("at") >= blocks).cast("int")), "scored", by="half")
    scratch.drop("answers")
    changes = []
    for half in (0, 1):  # one after the other, so that only half of the requests are on the disks twice
        changes.append(scratch.table(_changes(scored.where(F.col("half") == half)), f"changes{half}"))
        scratch.drop(f"scored/half={half}")
    changes = changes[0].unionByName(changes[1])
    states = 1 + known + (changes.where(F.col("kind") == _STATES).agg(F.sum("at")).first()[0] or 0)
    result = _changed(_met(changes, scored.where(F.col("half").isNull())))
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    return result.groupBy("rid", "doc_id", "held_out").agg(*sums).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score", F.lit(states).cast("long").alias("n_states")
    )
