"""The bounded similarity join against every pair matched in plain Python."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from dirbook.operators import repair, similar


def tables(spark, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("堺本町東西丁目あ𠮷") for _ in range(r.randint(0, 7)))
    pool = [word() for _ in range(60)]
    rows, n = [], 0
    for _ in range(500):
        area = r.choice(pool) + r.choice(["", "", "、町", "x"])
        if area:
            rows.append((n, f"P{r.randint(0, 1)}", f"M{r.randint(0, 3)}市", area, "1"))
            n += 1
    rows += [(n + i, "P2", "M9市", f"離{i}町", "1") for i in range(3)] + [(n + 10 + i, "P2", "M8市", "遠町", "1") for i in range(9)]
    counts = repair.location_counts(spark.createDataFrame(rows, "row_idx long, prefecture string, municipality string, area string, lot string"))
    return counts, repair.suspicious(counts, 2)


def brute(odd, counts, common_min, least, top):
    frequent = [c for c in counts if c["count"] >= common_min and c["comparable"]]
    for o in odd:
        near = [(0 if c["municipality"] == o["municipality"] else 1, c) for c in frequent if c["prefecture"] == o["prefecture"] and (c["municipality"] == o["municipality"] or o["comparable"] and c["comparable"][0] == o["comparable"][0])]
        if not near:
            near = [(2, c) for c in counts if c["count"] >= common_min and c["area"] and c["prefecture"] == o["prefecture"]]
        scored = []
        for block, c in near:
            ratio = SequenceMatcher(None, o["comparable"], c["comparable"]).ratio() if o["comparable"] and c["comparable"] else 0.0
            score = ratio * (1.0 if c["municipality"] == o["municipality"] else 0.82)
            if c["id"] != o["id"] and score >= least:
                scored.append((-score, -c["count"], block, c["first_seen"], c["id"], round(score, 4)))
        for rank, x in enumerate(sorted(scored)[:top], 1):
            yield o["id"], x[4], rank, x[5], -x[1]


@pytest.mark.parametrize("seed, least, common_min", [(1, 0.5, 4), (2, 0.72, 8), (3, 0.9, 2), (4, 0.0, 4), (5, 0.3, 3)])
def test_candidates_equal_brute_force(spark, seed, least, common_min):
    counts, odd = tables(spark, seed)
    want = sorted(brute(odd.collect(), counts.collect(), common_min, least, 5))
    got = repair.similar_candidates(odd, counts, common_min, least, 5).collect()
    assert sorted(map(tuple, got)) == want and (want or least == 0.9)


def test_fewer_pairs_are_matched(spark):
    counts, odd = tables(spark, 6)
    found = {r["stage"]: r["pairs"] for r in similar.pair_counts(odd, counts, 4, 0.72).collect()}
    pairs = repair.block_pairs(odd, repair.common(counts, 4))
    assert found["blocked"] == pairs.count() and 0 < found["matched"] < found["blocked"] / 3
    bounded = {(r["id"], r["candidate"]) for r in similar.bounded_pairs(odd, counts, 4, 0.72).collect()}
    matched = {(r["id"], r["candidate"]) for r in repair.similar_candidates(odd, counts, 4, 0.72, 10**6).collect()}
    assert matched <= bounded


def test_letters_count_repeats(spark):
    row = spark.createDataFrame([("aab𠮷𠮷", "ab𠮷c")], "a string, b string").select(similar.letters(F.col("a")).alias("x"), similar.bound(similar.letters(F.col("a")), similar.letters(F.col("b")), F.lit(1.0)).alias("y")).first()
    assert row["x"] == ["a1", "a2", "b1", "𠮷1", "𠮷2"] and row["y"] == 2.0 * 3 / 9
