import json
import random

import pytest
from pyspark.sql import functions as F

from dirbook import dictionary as D
from dirbook.functions import address as A
from dirbook.functions import arrays as R
from dirbook.functions import phone as P
from dirbook.functions import text as T
from dirbook.functions.jsons import first_object
from dirbook.operators import export as X
from dirbook.operators import publish as B
from dirbook.operators import repair as Q
from dirbook.operators import segments as S


def one(spark, column):
    return spark.range(1).select(column).first()[0]


ADDRESSES = [
    ("豊,中庄内西2", None, "大阪府", "豊中市", "中庄内西", "2"),
    ("北堂島船大工、堂栄ビル", None, "大阪府", "大阪市北区", "堂島船大工,堂栄ビル", ""),
    ("北堂島中1-23", None, "大阪府", "大阪市北区", "堂島中", "1-23"),
    ("布,中小阪483", "1968-03-01", "大阪府", "東大阪市", "中小阪", "483"),
    ("門真二番", "1968-03-01", "大阪府", "門真市", "二番", ""),
    ("東,内淡路1-28", None, "大阪府", "大阪市東区", "内淡路", "1-28"),
    ("布,中小阪483", "1963-02-01", "大阪府", "布施市", "中小阪", "483"),
    ("三島,三島正音寺", None, "大阪府", "三島郡三島町", "正音寺", ""),
    ("北河,門真二番", None, "大阪府", "北河内郡門真町", "二番", ""),
    ("尼,森160", None, "兵庫県", "尼崎市", "森", "160"),
    ("尼若王寺中ノ坪", None, "兵庫県", "尼崎市", "若王寺中ノ坪", ""),
    ("東淀川", None, "大阪府", "大阪市東淀川区", "川", ""),
    ("大阪市北区梅田", None, "大阪府", "大阪市", "北区梅田", ""),
    ("大阪府", None, "大阪府", "大阪市大正区", "阪府", ""),
    ("ああ平野区西脇", "unknown-date", "大阪府", "大阪市ああ平野区", "西脇", ""),
    ("", None, "大阪府", "大阪市", "", ""),
    ("なにわ5", None, "大阪府", "大阪市", "なにわ", "5"),
    ("東,", None, "大阪府", "大阪市東区", "", ""),
]


def test_addresses(spark):
    df = spark.createDataFrame([(i, a, d) for i, (a, d, *_) in enumerate(ADDRESSES)], "i int, address string, as_of string")
    got = {r["i"]: tuple(r[1:]) for r in A.split_address(df, "address", "as_of").select("i", "prefecture", "municipality", "area", "lot").collect()}
    assert got == {i: x[2:] for i, x in enumerate(ADDRESSES)}
    for a, d, prefecture, municipality, area, lot in ADDRESSES:
        version = D.LATE if d and d >= D.LATE else D.EARLY
        assert A.split_text(a, version) == (prefecture, municipality, area + lot)


def test_dictionary_sizes(spark):
    early, late = D.profile(D.EARLY), D.profile(D.LATE)
    assert (len(early.wards), len(early.cities), len(late.cities), len(early.towns), len(late.towns), len(early.city_names), len(late.city_names)) == (22, 26, 28, 42, 34, 29, 37)
    assert len(D.district_names()) == 13 and len({e.prefix for e in D.entries(D.EARLY) if e.kind == "ward_name"}) == 35
    assert D.table(spark).where("valid_from = '1968-03-01' AND prefix = '布'").first()["municipality"] == "東大阪市"


@pytest.mark.parametrize("phone, want", [("761-8512代", "06-761-8512"), ("761-8512代表", "06-761-8512"), ("※", "06-"), ("※072(11)2222", "072-11-2222"), ("761--8512-代", "06-761-8512-"), ("", ""), ("０６ー１", "06ー1")])
def test_export_numbers(spark, phone, want):
    assert one(spark, P.export_number(F.lit(phone))) == want


def test_number_candidates(spark):
    values = F.array(F.lit("{761-8512、762-1111代}"), F.lit("761-8512"))
    assert one(spark, P.number_candidates(values, F.lit(""))) == ["06-761-8512", "06-762-1111"]
    assert one(spark, P.number_candidates(F.array(F.lit("")), F.lit("町200"))) == ["06-200"]


def test_lists(spark):
    strings = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    rows = one(spark, R.expand_candidates(strings("1", "2", "3"), strings("n", ""), strings("a", "b")))
    assert [tuple(r) for r in rows] == [("1", "n", "a"), ("2", "n", "b"), ("3", "n", "b")] == X.expand(["1", "2", "3"], ["n", ""], ["a", "b"])
    assert [tuple(r) for r in one(spark, R.expand_candidates(strings(), strings(), strings("a", "b")))] == [("", "", "a"), ("", "", "b")] == X.expand([], [], ["a", "b"])
    for given, want in ((["北,堂島", "堂島", ""], ["北,堂島"]), (["a", "b"], ["a", "b"]), (["", "x"], ["x"]), (["ab", "a・b", "b"], ["ab"])):
        assert one(spark, R.collapse_fragments(strings(*given))) == want == X.collapse(given)
    assert one(spark, R.merge_continuation(strings("a", " "), strings(" b ", "c"))) == ["abc"]
    assert one(spark, R.review_flags(strings("x"), F.lit(True), F.lit(False), F.lit(False), strings("1", "2"), strings("a"))) == ["x", "starts_mid_entry", "multi_phone"]


def test_books(spark):
    for book, want in (("昭和38年2月1日大阪市50音別電話番号簿", "1963-02-01-大阪市-50音別電話番号簿.csv.gz"), ("misc", "unknown-date-misc-電話番号簿.csv.gz"), ("昭和43年3月1日a/b", "1968-03-01-a・b-電話番号簿.csv.gz"), ("平成2年13月40日電話番号簿", "1990-13-40-unknown-region-電話番号簿.csv.gz")):
        assert one(spark, T.book_filename(F.lit(book))) == want


def segment(text="", phones=(), names=(), addresses=(), kind="directory_entry", indent=0):
    return {"entryType": kind, "rawText": text, "cleanText": text, "indentLevel": indent, "phones": list(phones), "names": list(names), "addresses": list(addresses), "entryHints": {"phone": "", "name": "", "address": ""}}


SEGMENTS = "book string, file_key string, pos int, entryType string, rawText string, cleanText string, indentLevel int, phones array<string>, names array<string>, addresses array<string>, entryHints struct<phone:string,name:string,address:string>"


def exported(spark, *files, book="昭和38年2月1日大阪市電話番号簿"):
    rows = [(book, f"{i + 1:04d}-01", j, *(s[k] for k in ("entryType", "rawText", "cleanText", "indentLevel", "phones", "names", "addresses", "entryHints"))) for i, f in enumerate(files) for j, s in enumerate(f)]
    out = X.export(spark.createDataFrame(rows, SEGMENTS)).orderBy("section", "row_no").collect()
    return [(r["phone"], r["name"], r["municipality"], r["area"], r["lot"]) for r in out]


def test_addresses_carry_down_and_indent(spark):
    got = exported(spark, [segment("x", ["931-1", "931-2222", "931-3333"], ["関目自動車学校"], ["城,別所201", "城,別所200"]), segment("y", ["932-1111"], ["連絡所"], ["城,別所1"], indent=1)])
    assert [(r[1], r[2], r[3], r[4]) for r in got] == [("関目自動車学校", "大阪市城東区", "別所", x) for x in ("201", "200", "200")] + [("関目自動車学校連絡所", "大阪市城東区", "別所", "1")]


def test_no_phone_no_row_and_state_over_files(spark):
    assert exported(spark, [segment("町", [], ["n"], ["北町"])]) == []
    got = exported(spark, [segment("", [], ["朝日自動車株式"], [])], [segment("x", ["371-1111"], ["本社"], ["北町1"], indent=1)])
    assert got == [("06-371-1111", "朝日自動車株式本社", "大阪市北区", "町", "1")]


def test_continuation_rewrites_and_headings_reset(spark):
    entry, more = segment("a", ["371-1111"], ["n"], ["北,梅"]), segment("田の", [], [], ["田"])
    assert exported(spark, [entry, more, segment("371-2222", ["371-2222"])]) == [("06-371-1111", "n", "大阪市北区", "梅田", ""), ("06-371-2222", "n", "大阪市北区", "梅田", "")]
    assert exported(spark, [entry, segment(kind="category_heading"), more]) == [("06-371-1111", "n", "大阪市北区", "梅", "")]


def test_positions_pair_numbers_names_and_addresses(spark):
    text = "丸山商店本店 371-1111 北町1 支店 371-2222 南町2"
    got = exported(spark, [segment(text, ["371-1111", "371-2222"], ["丸山商店", "丸山商店本店", "丸山商店支店"], ["北町1", "南町2"])])
    assert got == [("06-371-1111", "丸山商店 本店", "大阪市北区", "町", "1"), ("06-371-2222", "丸山商店 支店", "大阪市南区", "町", "2")]


def test_missing_type_is_an_error(spark):
    with pytest.raises(Exception, match="entryType"):
        exported(spark, [segment("x", kind=None)])


def test_publish(spark):
    rows = [(0, "06ー761ー8512", "b"), (1, "06-231-0001", "a"), (2, "06-231-0001", " a"), (3, "761-8512", "c"), (4, "06-761-8512代表", "b"), (5, None, None)]
    df = spark.createDataFrame(rows, "row_idx int, phone string, name string")
    assert [tuple(r) for r in B.publish(df, ("phone", "name")).collect()] == [("06-231-0001", "a", 1), ("06-761-8512", "b", 0)]
    assert tuple(B.skip_counts(df, ("phone", "name")).first()) == (6, 2, 2, 2)
    assert tuple(B.skip_counts(df.limit(0), ("phone", "name")).first()) == (0, 0, 0, 0)


def locations(spark, *groups):
    rows = [("大阪府", m, a, str(i)) for m, a, n in groups for i in range(n)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_idx int, prefecture string, municipality string, area string, lot string")


def test_repair(spark):
    rows = locations(spark, ("大阪市北区", "堂島船大工", 10), ("大阪市北区", "北,堂島船大工", 1), ("豊中市", "豊中岡町", 9))
    counts = Q.location_counts(rows)
    odd = {r["area"]: r["reasons"] for r in Q.suspicious(counts).collect()}
    assert odd == {"北,堂島船大工": ["area_contains_separator", "area_starts_with_municipality_hint", "area_starts_with_own_municipality_name", "rare_location"][:2] + ["rare_location"], "豊中岡町": ["area_starts_with_municipality_hint", "area_starts_with_own_municipality_name"]}
    found = Q.candidates(Q.suspicious(counts), counts, 8, 0.5, 5).collect()
    assert [(r["candidate"].split("\t")[2], r["similarity"]) for r in found] == [("堂島船大工", 0.9091)]
    decisions = spark.createDataFrame([(0, found[0]["id"], "replace", found[0]["candidate"], 0.9), (1, found[0]["id"], "keep", "", 1.0)], "decision_idx int, id string, action string, corrected_id string, confidence double")
    offered = Q.candidates(Q.suspicious(counts), counts, 8, 0.5, 5)
    fixed = Q.apply_corrections(rows, Q.valid_corrections(decisions, Q.suspicious(counts), offered, counts))
    assert fixed.where("changed").count() == 1 and fixed.where("area = '堂島船大工'").count() == 11


def test_empty_blocks_try_the_prefecture(spark):
    rows = locations(spark, ("A市", "xyz町", 10), ("B市", "yxyz町", 1))
    counts = Q.location_counts(rows)
    found = Q.similar_candidates(Q.suspicious(counts).where("municipality = 'B市'"), counts, 8, 0.5, 5).collect()
    assert [r["candidate"] for r in found] == ["大阪府\tA市\txyz町"]


def test_first_objects():
    assert first_object('x {bad} ```json\n{"a": {"b": 1}} tail```') == {"a": {"b": 1}}
    assert first_object("[1, 2]") is None and first_object(None) is None


def test_compact_and_full_responses(spark):
    compact = {"r": [{"t": "d", "x": "a 1 ", "i": -1, "p": ["1", "2", "1", ""], "n": ["n"], "a": [], "f": [], "s": 1}]}
    seg = S.normalize_response(compact, 37, 1)[0]
    assert (seg["segmentId"], seg["rawText"], seg["indentLevel"], seg["phones"], seg["reviewFlags"], seg["entryHints"]["phone"], seg["confidence"], seg["startsMidEntry"]) == ("0037-01-0001", "a 1", 0, ["1", "2"], ["multi_phone"], "1", 1.0, False)
    full = {"segments": [{"entryType": "directory_entry", "cleanText": " t ", "indentLevel": 0, "phones": [], "names": ["n"], "addresses": [], "reviewFlags": [], "entryHints": {"phone": "9"}, "continuityFromPrevious": {"sameEntry": True}, "confidence": 7}]}
    seg = S.normalize_response(full, 37, 2)[0]
    assert (seg["phones"], seg["entryHints"], seg["confidence"], seg["startsMidEntry"], seg["reviewFlags"]) == (["9"], {"phone": "9", "name": "n", "address": ""}, 1.0, True, ["starts_mid_entry", "continued_from_previous"])
    for bad in ({"r": [{"t": "z"}]}, {"r": [{"t": "d", "i": 1.5}]}, {"r": [3]}, {"segments": [{"entryType": "directory_entry", "phones": [1]}]}, {"segments": 1}, {"r": [{"t": "d", "i": True}]}):
        with pytest.raises(S.Invalid):
            S.normalize_response(bad, 1, 1)
    rows = [(1, 1, json.dumps(compact)), (1, 2, "nothing"), (1, 3, None)]
    got = S.normalize_responses(spark.createDataFrame(rows, "page int, column int, text string")).collect()
    assert [(r["column"], r["segments"] is None, r["error"]) for r in got] == [(1, False, None), (2, True, "no JSON object"), (3, True, "no JSON object")]


def test_lists_of_the_fold_follow_the_column_rules(spark):
    rng = random.Random(3)
    some = lambda values, n: [rng.choice(values) for _ in range(rng.randint(0, n))]
    rows = [(i, some(["1", "2", "3"], 3), some(["n", "", "m"], 3), some(["北町1", "北、町1", "町1", "", "豊,中２", "（北町）1-2"], 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, phones array<string>, names array<string>, addresses array<string>")
    got = df.select("i", R.collapse_fragments(F.col("addresses")).alias("whole"), R.expand_candidates(F.col("phones"), F.col("names"), F.col("addresses")).alias("rows")).collect()
    for r in got:
        _, phones, names, addresses = rows[r["i"]]
        assert r["whole"] == X.collapse(addresses), addresses
        assert [tuple(x) for x in r["rows"]] == X.expand(phones, names, addresses), rows[r["i"]]


def test_a_segment_alone_is_prepared_by_columns(spark):
    """Numbers from a list, a hint or the text; names and addresses from lists, hints or what the text has beside its number."""
    rows = [[segment("x", ["{931-1111、(06)932-2222}", "931-1111"], [" ｎ "], ["北町1", "北,町1"])], [segment("丸山 商店 371-1111 北町 1")], [segment("371-1111 …")]]
    fields = ("entryType", "rawText", "cleanText", "indentLevel", "phones", "names", "addresses", "entryHints")
    flat = spark.createDataFrame([("昭和38年2月1日", f"{i}", j, *(x[k] for k in fields)) for i, f in enumerate(rows) for j, x in enumerate(f)], SEGMENTS)
    got = {r["file_key"]: r for r in X.prepared(flat).collect()}
    assert (got["0"]["phones"], got["0"]["names"], got["0"]["addresses"], got["0"]["bare"]) == (["06-931-1111", "06-932-2222"], ["n"], ["北町1"], False)
    assert (got["1"]["phones"], got["1"]["name"], got["1"]["address"], got["1"]["bare"]) == (["06-371-1111"], "丸山", "商店 北町 1", False)
    assert (got["2"]["phones"], got["2"]["bare"]) == (["06-371-1111"], True)


def test_indented_names_of_one_long_section_are_not_gathered(spark):
    r = random.Random(8)
    lines = [(1, 5, i, r.choice([0, 1, 2, 3]), r.choice(["a", "b", "ab", ""])) for i in range(11000)]
    got = X.indented_names(spark.createDataFrame(lines, "b long, section long, p long, l int, n string").repartition(5), "b", "p", "l", "n")
    assert got.columns == ["b", "section", "pos", "name"] and "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()
    want, above = [], []
    for _, _, i, level, name in lines:
        above = [x for x in above if x[0] < level]
        head = above[-1][1] if above and level else ""
        full = name if not name or name.startswith(head) else head + name
        above += [(level, full)] if full else []
        want.append((1, 5, i, full))
    assert [tuple(x) for x in got.orderBy("pos").collect()] == want


def test_expansion_computes_each_list_once(spark):
    lists = spark.range(1).select(*[F.split(F.concat(F.lit("1 2 3"), F.col("id").cast("string")), " ").alias(c) for c in "pna"])
    plan = lists.select(R.expand_candidates(F.reverse("p"), F.col("n"), F.col("a")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert (plan.count("filter("), plan.count("reverse(")) == (2, 1)
