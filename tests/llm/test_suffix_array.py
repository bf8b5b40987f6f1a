import random
from collections import Counter
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dirbook.llm import anchors
from dirbook.llm.suffix_array import remove_repeats, repeated_starts, suffix_order


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60) | st.text("ab\0", max_size=80).map(str.encode), st.integers(8, 70))
def test_suffix_order(data, depth):
    order = suffix_order(data, depth)
    assert sorted(order.tolist()) == list(range(len(data)))
    cut = [data[i : i + depth] for i in order.tolist()]
    assert cut == sorted(cut)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab\0", max_size=60).map(str.encode), max_size=6))
def test_repeated_starts(pieces):
    seen = Counter(x[i : i + 9] for x in pieces for i in range(len(x) - 8))
    got = repeated_starts(pieces, [1] * len(pieces), 9) if pieces else []
    assert [g.tolist() for g in got] == [[i for i in range(len(x) - 8) if seen[x[i : i + 9]] > 1] for x in pieces]


def brute(texts, width):
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), len(t) - len(kept), bytes(gone).replace(b"\0", b" ").decode("latin-1").split().__len__(), sha256(kept).hexdigest()))
    return out


def check(spark, texts, width, gram):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, rid string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(df, width, gram).collect()}
    want = dict(enumerate(brute([(t or "").encode() for t in texts], width)))
    assert got == want


@pytest.mark.parametrize("hot", [4096, 1])
def test_remove_repeats_equals_brute_force(spark, odd, empty, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefgé \n") for _ in range(n))
    passages = [text(90), text(60), text(41), "z" * 80]
    texts = [None, "", "short", text(300), "ab" * 150, "q" * 200, "ab" * 40]
    for _ in range(40):
        t = text(rng.randint(0, 300))
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(t))
            t = t[:at] + p[rng.randint(0, 10) :] + t[at:]
        texts.append(t)
    texts += texts[10:13]
    check(spark, texts, 40, 16)
    check(spark, [r["text"] for r in odd.collect()], 200, 64)
    assert remove_repeats(empty).count() == 0
