import re
import struct
from collections import Counter
from hashlib import sha256

import pytest
import xxhash
from pyspark.sql import functions as F

from dirbook.llm import winnowing
from dirbook.llm.entry import op13_winnowed_fingerprints
from dirbook.llm.winnowing import GRAM, PIECE, WINDOW, fingerprints, hash_of, place_of, print_of


def plain_print(text):
    """(hash, place) of each selected gram, from the definition."""
    words = []
    for at in range(0, len(text), winnowing.CHUNK):
        for word in re.findall(r"[^\x20\x09-\x0D]+", text[at : at + winnowing.CHUNK]):
            words += [word[i : i + PIECE] for i in range(0, len(word), PIECE)]
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    grams = []
    for i in range(max(1, len(hashes) - GRAM + 1) if hashes else 0):
        h = 42
        for x in hashes[i : i + GRAM]:
            h = xxhash.xxh64_intdigest(struct.pack("<Q", x), h)
        grams.append(h >> 31 & 0xFFFFFFFF)
    chosen = []
    for s in range(max(1, len(grams) - WINDOW + 1) if grams else 0):
        window = grams[s : s + WINDOW]
        at = s + max(i for i, x in enumerate(window) if x == min(window))
        if at not in chosen:
            chosen.append(at)
    return [(grams[i], i) for i in chosen]


def plain_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows):
    """The whole result from (doc_id, text) rows with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    shown = lambda p: " ".join(f"{h:X}:{i}" for h, i in p)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = plain_print(text), plain_print(edited), plain_print(after)
        yield i, len(text), sha256(edited.encode()).hexdigest(), shown(a), shown(b), plain_likeness(a, b), plain_likeness(a, c)


TEXTS = ["", None, "a", "ab", "one two three", " \t\n ", "word " * 700, "ünï çödé 日本語 😀 x\x0by\x1cz fin", "same text here", "same text here", "x" * 5000, "日本語の文章" * 40]
TEXTS += [" ".join(f"w{(i * i * k) % 97}" for i in range(20 * k)) for k in range(1, 12)]


@pytest.mark.parametrize("size, chunk", [(16 << 20, 1 << 16), (300, 64)])
def test_fingerprints_equal_brute_force(spark, monkeypatch, size, chunk):
    monkeypatch.setattr(winnowing, "RANGE_BYTES", size)
    monkeypatch.setattr(winnowing, "CHUNK", chunk)
    rows = [(None if i == 3 else 7 * i % 23, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(i, t, "z", 1, "q") for i, t in rows], "doc_id long, text string, print string, copy int, h string").repartition(5)
    assert Counter(map(tuple, fingerprints(docs).collect())) == Counter(plain(rows))
    names = spark.createDataFrame([(None if i is None else f"n{i:03}", t) for i, t in rows], "doc_id string, text string")
    assert Counter(tuple(r)[1:] for r in fingerprints(names).collect()) == Counter(x[1:] for x in plain(rows))


def test_tables_of_one_row_and_none(spark, empty):
    assert fingerprints(empty).collect() == []
    one = fingerprints(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in one] == list(plain([(1, "a b c d e f")]))


def test_repeated_rows_and_ids(spark, odd, monkeypatch):
    monkeypatch.setattr(winnowing, "RANGE_BYTES", 100)
    got = fingerprints(odd).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r["doc_id"], len(r["text"] or "")) for r in odd.collect())
    again = fingerprints(odd.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    copies = spark.createDataFrame([(i // 40, "the same words again and again and again") for i in range(120)] + [(None, "other")] * 50, "doc_id long, text string")
    rows = fingerprints(copies).collect()
    assert len(rows) == 170 and sum(r["near_next"] == 1.0 for r in rows) == 168


def test_windows_share_an_entry(spark):
    """Any GRAM + WINDOW - 1 common words give a common entry, and its place is where it stands."""
    common = " ".join(f"c{i}" for i in range(GRAM + WINDOW - 1))
    texts = [" ".join(f"p{k}x{i}" for i in range(k)) + " " + common + " " + " ".join(f"s{k}x{i}" for i in range(3 * k)) for k in range(20)]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select(print_of(F.col("text")).alias("p")).select(F.transform("p", lambda x: F.struct(hash_of(x).alias("h"), place_of(x).alias("i"))).alias("p"))
    prints = [[(x["h"], x["i"]) for x in r["p"]] for r in found.collect()]
    first = {h: i for h, i in prints[0]}
    assert all({h: i - k for h, i in p}.items() & first.items() for k, p in enumerate(prints))


def test_no_python_in_the_plan(spark):
    plan = fingerprints(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_winnowed_fingerprints(spark, sf).collect()
    assert Counter(map(tuple, got)) == Counter(plain(docs))
    full = [r for r in got if r["n_chars"] > 200]
    assert sum(r["near_edited"] > 0.25 for r in full) > 0.95 * len(full)
