"""Segments on the JVM against the parser, over whatever values a response may hold."""

import json
import random

from pyspark.sql import functions as F

from dirbook.operators import segments as S

VALUES = [None, True, False, 0, 1, 2, 3, -4, 2**31, -(2**31) - 1, 1.5, 1.0, 1e3, "", "x", " d ", "directory_entry", "　a ", [], ["a", " a", "b ", ""], ["x", 1], [None], {}, {"phone": "9"}, {"sameEntry": True}, {"sameEntry": True, "confidence": 2, "reason": " r "}, {"confidence": "x"}, [{}]]


def responses(seed):
    r = random.Random(seed)
    good = {"t": ["d", " a", "h"], "x": ["t ", ""], "i": [0, 2, -1], "p": [[], ["1", "2"]], "n": [["n"]], "a": [["q", "q"]], "f": [["old"]], "s": [True, 1, "x"], "e": [True, False]}
    full = {
        "segmentId": ["s1", 5, 0, ""], "sequence": [4], "entryType": ["directory_entry", " ad_block "], "rawText": [" r "], "cleanText": [" c "], "indentLevel": [-2, 3], "startsMidEntry": [True, False], "endsMidEntry": [True], "entryHints": [{}, {"phone": " 7 "}, {"name": "n", "address": ""}],
        "phones": [["1", "7"]], "names": [["m"]], "addresses": [["a1", "a2"]], "reviewFlags": [["old", "multi_phone"]], "continuityFromPrevious": [None, {"sameEntry": True, "mergedCleanText": " m ", "confidence": 0.25}, {}], "confidence": [0.5, 7, -1],
    }
    for _ in range(700):
        kind, fields = r.choice([("r", good), ("segments", full)])
        rows = []
        for _ in range(r.randint(0, 3)):
            row = {k: r.choice(v) for k, v in fields.items() if r.random() < 0.8 or k in ("t", "entryType")}
            if r.random() < 0.35:
                row[r.choice(list(fields))] = r.choice(VALUES)
            rows.append(row if r.random() < 0.97 else r.choice(VALUES))
        payload = {kind: rows if r.random() < 0.95 else r.choice(VALUES)}
        if r.random() < 0.05:
            payload["segments"] = r.choice(VALUES)
        yield json.dumps(payload, ensure_ascii=r.random() < 0.5)
    yield from ("", "no", "{}", "[]", "```json\n{\"r\": []}\n```", 'so: {"r": [{"t": "d"}]} end', '{"r": [], "r": 3}', '{"r": [{"t": "d", "x": "\\ud83d"}]}', '{"r": [{"t": "d", "i": 99999999999999999999}]}', '{"segments": [{"entryType": "ad_block", "segmentId": [1]}]}', '{"r": [{"t": "d"}]} {"r": 1}', '{"r": null}', '{"segments": null, "r": []}')


def test_jvm_and_parser_agree(spark):
    rows = [(i, i % 50, i % 3, t) for i, t in enumerate(responses(11))] + [(10**6, 1, 1, None)]
    df = spark.createDataFrame(rows, "k int, page int, column int, text string").repartition(4)
    got = {r["k"]: r for r in S.strict_responses(df, "k").collect()}
    want = {r["k"]: r for r in S.normalize_responses(df, "k").collect()}
    assert len(got) == len(want) == len(rows)
    for k, r in want.items():
        assert got[k] == r, (rows[k] if k < len(rows) else None, got[k], r)
    assert sum(r["error"] is None for r in want.values()) > 150 and len({r["error"] for r in want.values()}) > 60


def test_plain_responses_need_no_python(spark):
    plain = spark.range(10).selectExpr("1 AS page", "cast(id AS int) AS column", "concat('{\"r\":[{\"t\":\"d\",\"i\":', id, '}]}') AS text")
    told = S.strict_responses(plain)
    assert [r["segments"][0]["indentLevel"] for r in told.orderBy("column").collect()] == list(range(10))
    sides = told._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert sides.count("mapInArrow") + sides.count("MapInArrow") <= 1 and plain.where(F.lit(False)).count() == 0
