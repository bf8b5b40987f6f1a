import random
from collections import Counter
from hashlib import sha256

import pytest

from dirbook.llm import anchors
from dirbook.llm.substring import cut_repeats, remove_repeats


def brute(texts, width):
    docs = [t.encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in docs for i in range(len(w) - width + 1))
    out = []
    for w in docs:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode()))
    return out


def check(spark, texts, width, gram):
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, rid string, n_chars long")
    want = brute([t or "" for t in texts], width)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(df, width, gram).collect()}
    assert got == {i: w[:3] for i, w in enumerate(want)}
    cut = {r["doc_id"]: r for r in cut_repeats(df, width, gram).collect()}
    for i, (t, w) in enumerate(zip(texts, want)):
        assert cut[i]["text"] == (w[3] if w[1] else t)
        assert cut[i]["n_chars"] == (None if t is None else len(cut[i]["text"]))


@pytest.mark.parametrize("hot", [4096, 1])
def test_equals_brute_force(spark, odd, empty, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "é", "d", "e", "f", "gg"]) for _ in range(n))
    passages = [text(40), text(25), text(14), "z " * 30]
    texts = [None, "", "one two", text(100), "x y " * 40, "q " * 60, "x y " * 9, "m n o " * 12]
    for _ in range(50):
        words = text(rng.randint(0, 80)).split()
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = p.split()[rng.randint(0, 5) :]
        texts.append("\n".join(words))
    texts += texts[10:13]
    check(spark, texts, 12, 4)
    check(spark, texts, 9, 8)
    check(spark, [r["text"] for r in odd.collect()], 35, 8)
    assert remove_repeats(empty).count() == 0 and cut_repeats(empty.withColumn("n_chars", empty["rid"])).count() == 0
