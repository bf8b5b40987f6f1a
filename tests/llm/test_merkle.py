import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import pytest

from dirbook.llm import merkle
from dirbook.llm.entry import ORACLES, op11_merkle_manifest
from dirbook.llm.merkle import manifest


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, the sides of each node, level by level)."""
    sides, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k - k % 8 : k - k % 8 + 8]
            sides[i].append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        nodes, at = [H(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)], [k // 8 for k in at]
    return nodes[0], sides


def brute(rows):
    def leaf(row):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    langs = defaultdict(list)
    for row in rows:
        langs[row[2]].append(row)
    trees = {}
    for lang, found in langs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0], leaf(r)))
        trees[lang] = tree([leaf(r) for r in found])
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    root, outer = tree([trees[x][0] for x in names])
    for lang in langs:
        subroot, sides = trees[lang]
        for row, inner in zip(langs[lang], sides):
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                now = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            x, all_sides = leaf(now), inner + outer[names.index(lang)]
            for b, a in all_sides:
                x = H(b, x, a)
            yield row[0], leaf(row), subroot, root, H(*(b + a for b, a in all_sides)), x, x == root


ROWS = [(i, f"s{i % 3}" if i % 7 else None, ("en" if i % 10 < 8 else "de"), i if i % 5 else None, f"Text {i} É" if i % 11 else None) for i in range(700)]
ROWS += [(5000 + i, "s", f"l{i:02}", 1, "One") for i in range(70)] + [(9000, "", "", 0, ""), (9001, "x", None, 2, "ab"), (9002, "x", "tür", 2, "AB"), (9003, "x", "tz", 2, "AB")]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = spark.createDataFrame([(*r, 1, "d", "p") for r in ROWS], SCHEMA + ", block int, digest string, place string").repartition(5)
    assert Counter(map(tuple, manifest(docs).collect())) == Counter(brute(ROWS))


def test_nulls_and_repeated_rows(spark, empty):
    rows = [(None, "s", "en", 1, "A")] * 30 + [(3, "s", "en", 1, t) for t in ("A", "B", None, "", "A")] + [(None, None, None, None, None)] * 3
    got = manifest(spark.createDataFrame(rows, SCHEMA))
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows))
    for one in ([(1, "s", "en", 1, "A")], [(None, None, None, None, None)]):
        assert [tuple(r) for r in manifest(spark.createDataFrame(one, SCHEMA)).collect()] == list(brute(one))
    nothing = empty.selectExpr("doc_id", "text", "text as source", "text as lang", "rid as n_chars")
    assert manifest(nothing).collect() == [] and manifest(nothing).columns == got.columns


def test_ids_of_any_type(spark):
    rows = [(f"k{i}", "s", "en", 1, "Some Text") for i in range(40)]
    assert Counter(map(tuple, manifest(spark.createDataFrame(rows, SCHEMA.replace("doc_id long", "doc_id string"))).collect())) == Counter(brute(rows))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = op11_merkle_manifest(spark, sf)
    want = con.execute(ORACLES["op11_merkle_manifest"])
    assert got.columns == [c[0] for c in want.description]
    rows = Counter(map(tuple, want.fetchall()))
    assert Counter(map(tuple, got.collect())) == rows
    assert rows == Counter(brute([tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]))
