"""The export over books that are cut into many parts, and helpers of the fold against the columns they stand for."""

import random

from pyspark.sql import functions as F

from dirbook import dictionary as D
from dirbook.functions import address as A
from dirbook.functions import arrays as R
from dirbook.functions import phone as P
from dirbook.functions import text as T
from dirbook.operators import export as X

LINES = "book string, file_key string, pos int, entryType string, rawText string, cleanText string, indentLevel int, phones array<string>, names array<string>, addresses array<string>, entryHints struct<phone:string,name:string,address:string>"


def lines_of_books(seed):
    r = random.Random(seed)
    books = ["昭和38年2月1日大阪市電話番号簿", "昭和44年2月1日大阪市電話番号簿", "misc", "昭和38年2月1日x", None]
    rows = []
    for i in range(3000):
        book = books[min(int(r.expovariate(1)), 4)]
        kind = "directory_entry" if book == "misc" or r.random() > 0.06 else r.choice([*X.RESETS, "page_number"])
        phones = [f"{r.randrange(100, 999)}-{r.randrange(9999):04d}" for _ in range(r.choice([0, 1, 1, 1, 2]))]
        names = [f"ｎ{r.randrange(9)}"] if r.random() < 0.7 else []
        addresses = [r.choice(["北町", "豊,中", "布,町", "町"]) + str(r.randrange(40)) for _ in range(r.choice([0, 1, 1, 2]))]
        rows.append((book, f"{i // 700:04d}-01", i % 700, kind, "", r.choice(["町の", "丸山 371-1111 北町 1", "371-1111"]), r.randrange(4), phones, names, addresses, ("", "", "")))
    r.shuffle(rows)
    return rows


def test_cut_books_fold_as_whole_ones(spark):
    """No job runs and nothing is written when the plan is made, and sections are what one pass over each book makes of them."""
    segments = spark.createDataFrame(lines_of_books(3), LINES).repartition(7)
    spark.sparkContext.setJobGroup("export-plan", "")
    found = X.export(segments)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("export-plan")) == []
    spark.sparkContext.setJobGroup("export-run", "")
    cuts = X._cuts(segments.select("book", "file_key", "pos", F.col("entryType").isin(*X.RESETS).alias("reset")), 16).select(F.sum(F.size("cuts"))).first()[0]
    assert 4 < cuts <= 16
    want, key, state, section = [], None, None, 0

    def close():
        for i, (phone, name, address) in enumerate(r for e in state.entries for r in e) if state else ():
            want.append((key, section, i, phone, name, *A.split_text(address, state.version)))

    rows = [r.asDict() for r in X.prepared(segments, "entryType").collect()]
    for r in sorted(rows, key=lambda r: (r["book"] or "", r["file_key"], r["pos"])):
        if r["book"] != key or state is None or r["entryType"] in X.RESETS:
            close()
            section = (section if r["book"] == key else 0) + (r["entryType"] in X.RESETS)
            key, state = r["book"], X.Section(X._dictionary(r["book"]))
        if r["entryType"] == "directory_entry":
            state.take(X.Segment(*(r[c] for c in X.PREPARED)))
    close()
    got = sorted((r["book"] or "", r["section"], r["row_no"], r["phone"], r["name"], r["prefecture"], r["municipality"], r["area"] + r["lot"]) for r in found.collect())
    assert len(got) > 1500 and got == sorted((b or "", *rest) for b, *rest in want)


def test_dates_of_names_as_columns_give_them(spark):
    names = ["昭和38年2月1日大阪市電話番号簿", "昭和43年12月1日x", "平成1年1月1日", "大正10年1月1日y\n", "昭和5年1月1日\nz", "昭和5年1月1日a\nz", "昭和99999年13月40日b", "x昭和38年2月1日c", "昭和38年9999999999月1日d", "令和1年1月1日e ", "", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", T.book_date(F.col("n")).alias("d"))
    assert [(r["n"], r["d"]) for r in df.collect()] == [(n, T.dated(n)) for n in names]


def test_addresses_with_odd_white_space(spark):
    texts = [" 北\x1c町 1", "\x1e", "豊,　中\x851", "あ\x1dい区西1-2", " 堺,町 3", "尼，尼崎、1", "北町\x1f"]
    df = spark.createDataFrame([(x, d) for x in texts for d in (D.EARLY, D.LATE)], "a string, d string")
    for r in A.split_address(df, "a", "d").collect():
        assert A.split_text(r["a"], r["d"]) == (r["prefecture"], r["municipality"], r["area"] + r["lot"]), r


def test_texts_are_stripped_and_composed_by_columns_as_in_python(spark):
    white = [chr(i) for i in range(1, 0x3001) if chr(i).isspace()]
    texts = [f"{w}ａ {w}ｶﾞ{w}" for w in white] + ["", "a", "\x1c"]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in texts], "x string").select(T.normalized(F.col("x"))).collect()] == [T.unicodedata.normalize("NFKC", x).strip() for x in texts]
    lists = [[" ａ", None, "a", ""], None, [], ["ｶﾞ", "b", "ガ"], ["x"]]
    got = spark.createDataFrame([(x,) for x in lists], "x array<string>").coalesce(1).select(R.composed_candidates(F.col("x"))).collect()
    assert [r[0] for r in got] == [["a"], [], [], ["ガ", "b"], ["x"]]


def test_plain_numbers_are_what_tidying_leaves(spark):
    """A list that is plain, and the same list with one that isn't, give the same numbers."""
    r = random.Random(5)
    digits = lambda a, b: "".join(r.choice("0123456789") for _ in range(r.randint(a, b)))
    lists = [["-".join(digits(1, 5) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 3))] for _ in range(400)]
    df = spark.createDataFrame([(x, [*x, "(06)371-1111代表"]) for x in lists], "x array<string>, y array<string>")
    none = F.lit("")
    for row in df.select("x", P.number_candidates(F.col("x"), none).alias("a"), P.number_candidates(F.col("y"), none).alias("b")).collect():
        assert [*row["a"], "06-371-1111"] == row["b"], row
    odd = ["{931-1111、(06)932-2222}", "931-1111代", "　931--1111-", "a 931-1111 b", "//", "{}", "※931-1111"]
    got = spark.createDataFrame([([T.unicodedata.normalize("NFKC", x).strip()],) for x in odd], "x array<string>").select(P.number_candidates(F.col("x"), F.lit("町 371-1111"))).collect()
    assert [x[0] for x in got] == [["06-931-1111", "06-932-2222"], ["06-931-1111"], ["06-931"], ["06-931-1111"], ["06-371-1111"], ["06-371-1111"], ["06-931-1111"]]
