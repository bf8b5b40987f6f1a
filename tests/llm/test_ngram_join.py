import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dirbook.llm import ngram_join
from dirbook.llm.ngram_join import components, connect, one_of_each, signatures, similar, tokens
from dirbook.llm.common import Scratch


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), d if not s else least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near(rng, words, share):
    return [rng.choice("abcdefgh") * rng.randint(1, 3) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4)))
    texts = ["", None, "a b", "A b", "a b c d e", "x " * 300, "x " * 9]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([6, 20, 60, 200, 400]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            texts.append("\n".join(near(rng, base, rng.choice([0, 0.005, 0.02, 0.04]))))
    base = [word() for _ in range(150)]
    texts += [" ".join(near(rng, base, rng.choice([0.01, 0.02, 0.03]))) for _ in range(70)]
    common = [word() for _ in range(40)]
    texts += [" ".join(common + [word() for _ in range(rng.randint(2, 30))]) for _ in range(40)]
    rng.shuffle(texts)
    return [(i if i != 9 else None, t) for i, t in enumerate(texts)]


def test_components_equal_brute_force(spark, monkeypatch):
    for seed, frequent in ((1, 16), (2, 3)):
        monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
        monkeypatch.setattr(ngram_join, "CENTERS", 2)
        rows = corpus(seed)
        df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, node int")
        got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in components(df).collect())
        assert got == brute(rows)
        left = one_of_each(df)
        assert left.columns == df.columns
        assert left.count() == len([1 for c in brute(rows).elements() if not c[1]]) + len({c[2] for c in brute(rows) if c[1]})


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in components(odd).collect()) == brute(rows)
    assert components(empty).count() == 0 and one_of_each(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 120), st.integers(0, 40), st.integers(0, 40), st.integers(0, 3), st.integers(0, 2**32))
def test_similar_sets_share_a_combination(n, less, more, often, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    b = np.unique(np.concatenate([rng.permutation(a)[less:], rng.integers(0, 2**63, more).astype(np.uint64)]))
    every = np.unique(np.concatenate([a, b]))
    frequent = np.sort(rng.permutation(every)[: len(every) * often // 3])
    if similar(a, b):
        assert len(np.intersect1d(signatures(a, frequent), signatures(b, frequent)))


def test_tokens_are_the_shingles():
    for t in ("A b c d e f a B c d e", "x y", "", "q"):
        assert len(tokens(t.encode())) == len(shingles(t))
    assert (tokens(b"A B c") == tokens(b"a b C")).all()


def test_connect_long_chain(spark):
    scratch = Scratch(spark)
    rng = random.Random(2)
    nodes = list(range(120))
    rng.shuffle(nodes)
    links = [(nodes[i], nodes[i + 1]) for i in range(99)] + [(500, 400), (400, 450)]
    got = {r["node"]: r["comp"] for r in connect(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
    assert got == {**{n: min(nodes[:100]) for n in nodes[:100]}, 500: 400, 400: 400, 450: 400}


def test_near_copies_go_by_component_not_by_id(spark):
    """Unrelated texts that share an id all stay; near copies without ids are reduced."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(6, a, 0), (6, b, 1), (7, c, 2), (8, c + " more", 3), (7, b + " more", 4), (None, "x " + " ".join(f"n{i}" for i in range(60)), 5), (None, " ".join(f"n{i}" for i in range(60)), 6), (None, "", 7), (None, None, 8), (6, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int")
    assert sorted(r["place"] for r in one_of_each(docs.coalesce(1)).collect()) == [0, 1, 2, 5, 7, 8, 9]
