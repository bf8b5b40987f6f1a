"""The pipeline against a version of plain Python, on the smallest table."""

from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from dirbook.llm.bpe import VOCABULARY

SF = "/root/testdata/sf0.001"


def good(t):
    b = t.encode()
    words = b.split()
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in b.split(b"\n") if x.split()]
    n, chars, symbols = len(words), sum(len(w.decode()) for w in words), sum(c in b"#*$%&|<>" for c in b)
    return not (n < 50 or 100 * len(covered) > 50 * n or not 2 * n <= chars <= 15 * n or 10 * symbols > 3 * n or 2 * (len(lines) - len(set(lines))) > len(lines))


def near(docs):
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in docs.items() for w in [t.encode().lower().split()]}
    comp = {d: d for d in docs}
    ids = sorted(docs)
    changed = True
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            if comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    return {d: docs[d] for d in docs if comp[d] == d}


def cut(docs):
    words = {d: t.encode().split() for d, t in docs.items()}
    seen = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    out = {}
    for d, w in words.items():
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        out[d] = b" ".join(x for i, x in enumerate(w) if i not in gone).decode() if gone else docs[d]
    return out


def test_pipeline(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    docs = {d: t for d, t in docs.items() if good(t)}
    last = {t: max(x for x in docs if docs[x] == t) for t in docs.values()}
    docs = cut(near({d: t for t, d in last.items()}))
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in docs.items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    got = defaultdict(int)
    for r in rows:
        assert r["doc_tokens"] == want[r["doc_id"]]
        got[r["doc_id"]] += r["length"]
    assert got == want


def test_stages_keep_columns_and_stand_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b", 1, 2, 3), (2, "a b", 4, 5, 6), (3, None, 7, 8, 9), (3, "w " * 80, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __rid int, rid int, cuts int").coalesce(1)
    for (name, stage), kept in zip(corpus_pipeline.STAGES[1:4], (3, 3, 4)):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {tuple(r)[2:] for r in out.collect()} <= {r[2:] for r in rows} and out.count() == kept, name


def test_packing_stage_takes_odd_rows(spark, odd, empty):
    out = corpus_pipeline.STAGES[-1][1](spark, odd, SF)
    whole = {}
    for r in out.collect():
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r["length"])
    assert sum(sum(x) for x in whole.values()) == sum(k[1] * sum(1 for r in odd.collect() if (r["doc_id"], tokens(r["text"])) == k) for k in whole)
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def tokens(text):
    return len(Tokenizer.from_file(public_tokenizers.path(VOCABULARY)).encode(text or "", add_special_tokens=False).ids) + 1
