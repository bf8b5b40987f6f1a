import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dirbook.llm import divergence
from dirbook.llm.divergence import Trie, audit, branch_depths, probabilities, tokens
from dirbook.llm.entry import ORACLES, op12_source_tries


def counters(rows):
    return pa.table({"term": pa.array([t.encode() for t, _, _ in rows], pa.binary()), "source": pa.array([s for _, s, _ in rows], pa.string()), "n": pa.array([n for _, _, n in rows], pa.int64()), "documents": pa.array([1] * len(rows), pa.int64())})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abé日", max_size=5), st.sampled_from("xyz"), st.integers(1, 9)), max_size=40), st.integers(0, 40))
def test_tries_hold_what_was_added(rows, cut):
    """Leaves come in the order of their bytes; two tries merged hold what one would."""
    want: dict = defaultdict(Counter)
    documents = Counter()
    for term, source, n in rows:
        want[term.encode()][source] += n
        documents[term.encode()] += 1
    one = Trie.merge([counters(rows)])
    for trie in (one, Trie.merge([Trie.merge([counters(rows[:cut])]), Trie.merge([counters(rows[cut:])])])):
        assert [(t, d, dict(c)) for t, d, c in trie.walk()] == [(t, documents[t], dict(want[t])) for t in sorted(want)]
    terms = one.counters["term"].combine_chunks()
    shared = [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(terms.to_pylist(), terms.to_pylist()[1:])] if len(terms) else []
    assert branch_depths(terms).tolist() == shared


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBz @[`{\x7f\x00\x80éßΣ日\n1'"), max_size=30), max_size=4))
def test_terms(texts):
    want = [("".join(c.lower() if "A" <= c <= "Z" else c for c in w), i) for i, t in enumerate(texts) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
    found, text = tokens([t.encode() for t in texts])
    assert list(zip([t.decode() for t in found.to_pylist()], text.tolist())) == want


@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=5), st.integers(0, 10**12))
def test_probabilities_are_exact(counts, more):
    total = sum(counts) + more + 2 * len(counts)
    want = [1 + 10**9 * (c + 2) // total for c in counts]
    assert probabilities(np.array(counts), np.array([total])).tolist() == want
    assert probabilities(np.array(counts), np.array([total * 10**3])).tolist() == [1 + 10**9 * (c + 2) // (total * 10**3) for c in counts]


def brute(rows):
    rows = [(lang or "", source or "", [t.decode() for t in tokens([(text or "").encode()])[0].to_pylist()]) for lang, source, text in rows]
    seen, count, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in rows:
        seen[lang].update(set(words))
        count[lang, source].update(words)
        sources[lang].add(source)
    for lang in sources:
        kept = sorted(t for t, n in seen[lang].items() if n >= 10)
        counts = {s: {t: count[lang, s][t] for t in kept} for s in sources[lang]}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources[lang]:
            pairs = [(o, sum(f(p(counts[s], t), p(counts[o], t)) for t in kept)) for o in sources[lang] if o != s]
            own = [(t, f(p(counts[s], t), p(whole, t))) for t in kept if counts[s][t] > 0 and p(counts[s], t) > p(whole, t)]
            for part, found, most in (("pair", pairs, None), ("term", own, 10)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                yield from ((lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked))


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("HELD", 20), ("RANGE_LEAVES", 15), ("SLICE_TERMS", 4), ("SLICE_COUNTERS", 9), ("SOURCES", 2), ("STEP", 3)):
            monkeypatch.setattr(divergence, name, value)
    rows = [("en", "ab"[i % 2], f"The the {'cat' if i % 3 else 'Dog'} {'élan ' * (i % 5)} w{i} tie{i % 2}x") for i in range(40)]
    rows += [("fr", f"s{i % 5}", "un deux trois " * (i % 4) + "été") for i in range(30)] + [("fr", None, None), (None, None, "x " * 50), (None, "a", "x y"), ("de", "lonely", "nur selten")]
    rows += [("", None, "x Y")] * 12
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "lang string, source string, text string, slice int, term string").repartition(3)
    assert Counter(map(tuple, audit(docs).collect())) == Counter(brute(rows))


def test_empty_and_odd_tables(spark, odd, empty):
    assert audit(empty.selectExpr("*", "text as lang", "text as source")).collect() == []
    docs = odd.selectExpr("*", "cast(null as string) as source")
    assert audit(docs).collect() == []
    assert Counter(map(tuple, audit(docs.unionByName(docs.selectExpr("doc_id", "text", "lang", "rid", "length", "'b' as source"))).collect())) == Counter(
        brute([("en", s, r["text"]) for r in odd.collect() for s in (None, "b")])
    )


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = op12_source_tries(spark, sf)
    want = con.execute(ORACLES["op12_source_tries"])
    assert got.columns == [c[0] for c in want.description]
    rows = want.fetchall()
    assert len(rows) > 2000 and Counter(map(tuple, got.collect())) == Counter(rows)
