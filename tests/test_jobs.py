"""Manifests, questions, reports and readers that the queries don't reach."""

import json

from pyspark.sql import functions as F

from dirbook.functions.jsons import find_uri_column
from dirbook.functions.similarity import rounded, similarity
from dirbook.operators import jobs as J
from dirbook.operators import repair as Q
from dirbook.operators import segments as S
from dirbook.operators import windows as W
from dirbook.sources import books, sinks


def test_rounding_goes_by_the_binary_value(spark):
    values = [2.675, 0.12345, 0.5, 1.5, -2.675, None, 0.00005]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"), 2)).collect()] == [None if x is None else round(x, 2) for x in values]


def test_similarity_equals_matching_blocks(spark):
    from difflib import SequenceMatcher

    pairs = [("abcd", "abxd"), ("", "a"), ("北町", "北町一"), ("aab", "baa"), ("abc", "abc")]
    df = spark.createDataFrame([(*p, i % 2 == 0) for i, p in enumerate(pairs)], "a string, b string, same boolean")
    got = [r[0] for r in df.select(similarity(F.col("a"), F.col("b"), F.col("same"))).collect()]
    want = [(SequenceMatcher(None, a, b).ratio() if a and b else 0.0) * (1.0 if i % 2 == 0 else 0.82) for i, (a, b) in enumerate(pairs)]
    assert got == want


def test_question_holds_items_in_order(spark):
    items = spark.createDataFrame([(1, 0, "b", 2, ["rare_location"], ["x"], ["c"]), (1, 1, "a", 3, [], [], []), (2, 2, "c", 3, [], [], [])], "chunk int, place int, id string, count int, reasons array<string>, samples array<string>, candidates array<string>")
    got = {r["chunk"]: json.loads(r["payload"]) for r in J.question(items, ["rule"], "1963-02-01").collect()}
    assert got[1]["asOf"] == "1963-02-01" and got[1]["rules"] == ["rule"] and [x["id"] for x in got[1]["items"]] == ["b", "a"]
    assert [x["id"] for x in got[2]["items"]] == ["c"]


def test_reports_and_time(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    sinks.write_report(df, f"{tmp_path}/r")
    assert json.loads("".join(r[0] for r in spark.read.text(f"{tmp_path}/r").collect())) == [{"n": 1, "s": "a"}, {"n": 2, "s": "b"}]
    assert spark.range(1).select(J.utc_now().rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z$")).first()[0]


def test_only_the_first_row_can_be_a_header(spark, tmp_path):
    header = "電話番号,名前,都道府県,市区町村,町域,番地"
    (tmp_path / "a.csv").write_text(f"{header}\n06-1,n,p,m,a,1\n\n{header}\n06-2,n\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("06-3,n,p,m,a,1\n", encoding="utf-8")
    rows = books.table_rows(spark, str(tmp_path)).collect()
    assert sorted(r["phone"] for r in rows) == ["06-1", "06-2", "06-3", "電話番号"]
    assert {r["phone"]: r["area"] for r in rows}["06-2"] == ""
    assert books.blank_rows(spark, str(tmp_path)).first()["blank"] == 1


def test_columns_of_any_name_stay(spark):
    left = spark.createDataFrame([(1, 5, "x", "y"), (1, 9, "x", "y")], "k int, at int, side string, v string")
    right = spark.createDataFrame([(1, 4, "a"), (1, 7, "b")], "k int, at int, value string")
    got = W.asof_backward(left, right, "k", "at", "value", "out").orderBy("at").collect()
    assert [(r["side"], r["v"], r["out"]) for r in got] == [("x", "y", "a"), ("x", "y", "b")]


def test_broken_json_names_no_file(spark):
    df = spark.createDataFrame([("{",), (None,), ('{"a":[{"file_uri":"u"}]}',)], "x string")
    assert [r[0] for r in df.select(find_uri_column(F.col("x"))).collect()] == ["", "", "u"]


def test_repair_report_and_gate(spark):
    rows = spark.createDataFrame([(i, " p", "m", "a" if i else "ａ", "1") for i in range(9)] + [(9, "p", "m", ",a", "1")], "row_idx long, prefecture string, municipality string, area string, lot string")
    counts = Q.location_counts(rows)
    assert {(r["area"], r["count"]) for r in counts.collect()} == {("a", 9), (",a", 1)}
    odd = Q.suspicious(counts)
    found = Q.candidates(odd, counts)
    own = Q.deterministic_decisions(odd, found, counts).selectExpr("0 AS decision_idx", "*")
    corrections = Q.valid_corrections(own, odd, found, counts)
    repaired = Q.apply_corrections(rows, corrections)
    assert {r["area"] for r in repaired.where("changed").collect()} == {"a"} and repaired.where("prefecture = ' p'").count() == 9
    assert Q.report(rows, odd, corrections, repaired).first().asDict() == {"rows": 10, "suspicious": 1, "corrections": 1, "changed": 1}
    gate = spark.createDataFrame([(100, 10), (100, 11), (5, 3), (5, 4)], "asked int, missing int")
    assert [r[0] for r in gate.select(Q.too_many_missing(F.col("asked"), F.col("missing"))).collect()] == [False, True, False, True]


def test_responses_with_numbers_and_text_that_no_row_can_hold_are_rejected(spark):
    good = {"segments": [{"entryType": "directory_entry", "segmentId": 5, "sequence": 2**31 - 1}]}
    rows = [(1, 1, json.dumps(good)), (1, 2, json.dumps({"r": [{"t": "d", "i": 2**31}]})), (1, 3, '{"r":[{"t":"d","x":"\\ud800"}]}'), (1, 4, '{"r":[{"t":"d","x":"\\ud83d\\ude00"}]}'), (1, 5, None)]
    got = {r["column"]: r for r in S.normalize_responses(spark.createDataFrame(rows, "page int, column int, text string")).collect()}
    assert got[1]["segments"][0]["segmentId"] == "5" and got[1]["segments"][0]["sequence"] == 2**31 - 1 and got[4]["segments"][0]["rawText"] == "\U0001f600"
    assert [bool(got[c]["error"]) for c in (1, 2, 3, 4, 5)] == [False, True, True, False, True]
