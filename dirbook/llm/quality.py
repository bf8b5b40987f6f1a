"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a bounded sample; the rules then run in order of rejections per second,
and a document stops at the first that rejects it. A rule reads features that are computed when first asked for, so a
document that a cheap rule rejects never pays for the dear ones. The verdict is a conjunction: the order changes how
long it takes, never what it is.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.common import SPACES, bytes_of, keyed, slices

#: Documents of the sample, about, drawn from all of the table; their whole texts are tried.
SAMPLE = 400
_SYMBOLS, _CONTINUED = b"#*$%&|<>", bytes(range(0x80, 0xC0))


class Features:
    """What the rules ask about one text, each computed once and only if asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that neither continue a code point nor are white space."""
        return len(self.text.translate(None, SPACES + _CONTINUED))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, _SYMBOLS))

    @cached_property
    def n_lines(self) -> int:
        return sum(1 for line in self.text.split(b"\n") if not line.isspace() and line)

    @cached_property
    def n_dup_lines(self) -> int:
        lines = self.text.split(b"\n")
        if len(lines) == 1:
            return 0
        lines = [line for line in lines if line and not line.isspace()]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by windows of three words that the text has twice or more."""
        n = self.n_words
        if n < 4:
            return 0
        # a word's number is the place where it first stands, below 2**21 here, so three pack into 63 bits
        if n >= 1 << 21:
            return self._repeat_words_long()
        number: dict[bytes, int] = {}
        ids = np.fromiter(map(number.setdefault, self.words, itertools.count()), np.int64, n)
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        ordered = np.sort(windows)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        at = np.searchsorted(twice, windows)
        hit = twice[np.minimum(at, len(twice) - 1)] == windows
        covered = np.zeros(n, bool)
        covered[:-2] |= hit
        covered[1:-1] |= hit
        covered[2:] |= hit
        return int(covered.sum())

    def _repeat_words_long(self) -> int:
        number: dict[bytes, int] = {}
        ids = np.fromiter(map(number.setdefault, self.words, itertools.count()), np.int64, self.n_words)
        order = np.lexsort((ids[2:], ids[1:-1], ids[:-2]))
        a = np.stack([ids[:-2][order], ids[1:-1][order], ids[2:][order]])
        same = (a[:, 1:] == a[:, :-1]).all(0)
        hit = np.zeros(len(order), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        covered = np.zeros(self.n_words, bool)
        covered[:-2] |= hit
        covered[1:-1] |= hit
        covered[2:] |= hit
        return int(covered.sum())

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Features], bool]


#: Bounds follow published filters for web text, with room on the side of keeping.
RULES = (
    Rule("few_words", lambda f: f.n_words < 50),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > 50 * f.n_words),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 15 * f.n_words),
    Rule("symbols", lambda f: 10 * f.n_symbols > 3 * f.n_words),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > f.n_lines),
)


class Estimate(NamedTuple):
    name: str
    cost: float
    rejected: float


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Estimate]:
    """Seconds and share of rejections of each rule alone, on about `sample` documents drawn from all of the table. They are
    tried where they lie; only sums reach the driver."""
    share = min(1.0, sample / max(docs.count(), 1))
    drawn = docs.select(F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")).sample(share, seed=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tried, cost, rejected = 0, [0.0] * len(rules), [0] * len(rules)
        for batch in slices(batches):
            texts = bytes_of(batch["text"])
            tried += len(texts)
            for i, rule in enumerate(rules):
                began = time.perf_counter()
                rejected[i] += sum(bool(rule.rejects(Features(text))) for text in texts)
                cost[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "cost": cost, "rejected": rejected, "tried": [tried] * len(rules)})

    sums = drawn.mapInArrow(run, "rule string, cost double, rejected long, tried long").groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("cost", "rejected", "tried")])
    by_rule = {r["rule"]: (r["cost"] / max(r["tried"], 1), r["rejected"] / max(r["tried"], 1)) for r in sums.collect()}  # a row for each rule
    return [Estimate(rule.name, *by_rule.get(rule.name, (0.0, 0.0))) for rule in rules]


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules, most rejections per second first."""
    by_name = {e.name: e for e in estimate(docs, rules)}
    return tuple(sorted(rules, key=lambda r: -by_name[r.name].rejected / max(by_name[r.name].cost, 1e-9)))


def verdict(features: Features, rules: tuple[Rule, ...]) -> bool:
    """Whether no rule rejects; those after the first that does aren't run."""
    return not any(rule.rejects(features) for rule in rules)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(rid, doc_id, kept) of each row of docs(doc_id, text).

    A null text counts as empty, and few_words rejects it. Repeated rows get a verdict each; an empty table gives no rows.
    Only doc_id and text are read.
    """
    names = [r.name for r in cascade(docs, rules)]
    ordered = tuple(sorted(rules, key=lambda r: names.index(r.name)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [verdict(Features(t), ordered) for t in bytes_of(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["rid"], batch["doc_id"], pa.array(kept, pa.bool_())], ["rid", "doc_id", "kept"])

    return keyed(docs).mapInArrow(run, "rid long, doc_id long, kept boolean")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs without the rows that a rule rejects; all columns. The verdict rides along in the scan, without a shuffle."""
    names = [r.name for r in cascade(docs, rules)]
    ordered = tuple(sorted(rules, key=lambda r: names.index(r.name)))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = pa.array([verdict(Features(t), ordered) for t in bytes_of(batch.column(at))], pa.bool_())
            yield batch.filter(kept)

    return docs.mapInArrow(run, docs.schema)


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """quality() with the features of every document, for those that want the figures of rejected ones too:
    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    names = [r.name for r in cascade(docs, rules)]
    ordered = tuple(sorted(rules, key=lambda r: names.index(r.name)))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in bytes_of(batch["text"]):
                f = Features(text)
                kept = verdict(f, ordered)
                rows.append((*(getattr(f, c) for c in columns), f.base_failed, kept and not f.base_failed))
            data = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, pa.int64()) for c in data[:5]), *(pa.array(c, pa.bool_()) for c in data[5:])], ["doc_id", *columns, "base_failed", "kept"])

    return keyed(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in columns) + ", base_failed boolean, kept boolean")
