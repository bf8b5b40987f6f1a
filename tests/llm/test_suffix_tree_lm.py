import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dirbook.llm import suffix_tree_lm
from dirbook.llm.suffix_tree_lm import CONTEXT, END, GAIN, POWER, STORED, STRENGTH, packed, planes, score, segments, strings, unpacked, unplanes


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def sequence(text):
    return (text or "").encode().lower().split() + [b"\n"]


def base(rows):
    train = Counter(w for d, t in rows if not held(d) for w in sequence(t))
    n, v = sum(train.values()), len(train)
    return Counter((d, held(d), len(sequence(t)), sum(train[w] > 0 for w in sequence(t)), n, round(sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in sequence(t)), 6)) for d, t in rows)


class Tree:
    """The model, by dictionaries."""

    def __init__(self, rows):
        self.one, self.two, self.three = Counter(), Counter(), defaultdict(Counter)
        for d, t in rows:
            if not held(d):
                s = [b"\n", b"\n", *sequence(t)]
                for a, b, c in zip(s, s[1:], s[2:]):
                    self.one[c] += 1
                    self.two[b, c] += 1
                    self.three[a, b][c] += 1
        self.total, self.below = sum(self.one.values()), sum(self.one.values()) + 0.1 * (len(self.one) + 1)
        self.states = {c for c in self.three if c != (b"\n", b"\n") and self.two[c] >= CONTEXT and self.gain(c) > GAIN}

    def weight(self, n):
        return STRENGTH * max(n, 1) ** POWER

    def p0(self, w):
        return (self.one[w] + 0.1) / self.below

    def p1(self, b, w):
        m = self.weight(self.one[b])
        return (self.two[b, w] + m * self.p0(w)) / (self.one[b] + m)

    def kept(self, c):
        return {w: n for w, n in self.three[c].items() if n >= STORED}

    def gain(self, c):
        kept, out = self.kept(c), 0.0
        n = sum(kept.values())
        if not n:
            return -math.inf
        for w, k in kept.items():
            m, p = self.weight(n - 1), self.p1(c[1], w)
            out += k * math.log((k - 1 + m * p) / (n - 1 + m) / p)
        return out + (self.two[c] - n) * math.log(self.weight(n) / (n + self.weight(n)))

    def p(self, a, b, w):
        """After the longest suffix of (a, b) that is a state."""
        if (a, b) not in self.states:
            return self.p1(b, w)
        kept = self.kept((a, b))
        n, m = sum(kept.values()), self.weight(sum(kept.values()))
        return (kept.get(w, 0) + m * self.p1(b, w)) / (n + m)

    def score(self, text):
        s = [b"\n", b"\n", *sequence(text)]
        return sum(math.log10(self.p(a, b, c)) for a, b, c in zip(s, s[1:], s[2:]))


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "then", "other", "of", "oft", "Éa", "x%d" % rng.randint(0, 40)])
    passages = [" ".join(word() for _ in range(12)) for _ in range(6)]
    return [(i, " \n".join(rng.choice(passages) if rng.random() < 0.4 else word() for _ in range(rng.randint(0, 40)))) for i in range(n)]


def check(spark, rows, got):
    tree = Tree(rows)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == base(rows)
    want = sorted((d is None, d or 0, tree.score(t)) for d, t in rows)
    for (_, d, x), r in zip(want, sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in got)):
        assert (d, x) == (r[1], pytest.approx(r[2], rel=1e-5, abs=1e-6))
    assert {r["n_states"] for r in got} <= {1 + len(tree.one) + len(tree.states)}
    return tree


def test_scores_equal_brute_force(spark, monkeypatch):
    rows = corpus(7)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, rid int").repartition(3).cache()
    tree = check(spark, rows, score(df).collect())
    assert 20 < len(tree.states) < len([c for c in tree.three if tree.two[c] >= CONTEXT])
    out = [(tree.score(t), sum(math.log10(tree.p0(w)) for w in sequence(t))) for d, t in rows if held(d)]
    assert out and sum(a for a, _ in out) > 0.8 * sum(b for _, b in out)  # log probabilities: nearer to zero is better
    monkeypatch.setattr(suffix_tree_lm, "CHUNK", 200)  # parts of texts, several chunks in a partition
    monkeypatch.setattr(suffix_tree_lm.segments, "__defaults__", (200,))
    check(spark, rows, score(df).collect())
    df.unpersist()


def test_distributions_sum_to_one():
    tree = Tree(corpus(3))
    for c in [*list(tree.states)[:5], (b"the", b"nowhere"), (b"\n", b"\n")]:
        assert sum(tree.p(*c, w) for w in [*tree.one, b"unknown"]) == pytest.approx(1)


def test_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(spark, rows, score(odd).collect())
    assert score(empty).count() == 0
    alone = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")  # all held out
    got = score(alone).collect()
    assert Counter((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == Counter([(3, 0, 0), (1, 0, 0)])
    check(spark, [(None, "a b"), (None, None)], got)


def test_states_do_not_depend_on_the_size_of_the_corpus(spark):
    """A context of twelve occurrences is a state among three million others."""
    rng = random.Random(3)
    common = ["w%d" % i for i in range(300)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(12000))) for i in range(260)]
    rare = [(1000 + i, "zq xj kv") for i in range(15)]
    got = {r["doc_id"]: r["score"] for r in score(spark.createDataFrame(rows + rare, "doc_id long, text string")).collect()}
    n = sum(not held(d) for d, _ in rare)
    less = {r["doc_id"]: r["score"] for r in score(spark.createDataFrame(rows[:20] + rare, "doc_id long, text string")).collect()}
    assert n > 9 and got[1000] > -12 and abs(got[1000] - less[1000]) < 4


def test_arrays_travel_whole():
    x = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (unpacked(packed(x)) == x).all() and (unplanes(planes(x), np.uint64) == x).all()
    assert len(unpacked(packed(x[:0]))) == 0
    for most in (0, 255, 256, 70_000, 1 << 40):
        assert unplanes(planes(np.array([most, 0, 3]))).tolist() == [most, 0, 3]


def test_parts_of_a_text_hold_each_symbol_once():
    text = " ".join("w%d" % i for i in range(500)) + "   "
    batch = pa.RecordBatch.from_pydict({"rid": [1], "doc_id": [1], "held_out": [False], "text": [text]})
    whole = strings(next(segments(iter([batch])))[1])
    parts = [strings(found) for _, found in segments(iter([batch]), 100)]
    assert len(parts) > 10
    for name in ("word", "pair"):
        assert (np.concatenate([getattr(p, name)[p.own] for p in parts]) == getattr(whole, name)[whole.own]).all()
    assert parts[-1].symbol[-1] == END


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_texts_held_out_are_more_probable_than_by_the_base(spark, sf):
    rows = score(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).where("held_out").select("score", "base_score").collect()
    model, plain = sum(r["score"] for r in rows), sum(r["base_score"] for r in rows)
    assert plain < model < 0 and model > 0.85 * plain
    assert sum(r["score"] >= r["base_score"] for r in rows) > 0.9 * len(rows)
