"""Distributed scans against plain windows, and how a single key's rows spread."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dirbook.operators import scans, windows


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    data = [(r.choice(["hot"] * 6 + ["a", "b", None]), i, r.choice([None, None, r.randint(0, 99)]), "x") for i in r.sample(range(5000), 1500)]
    return spark.createDataFrame(data, "key string, place long, value long, part string").repartition(7)


def bag(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_running_values_equal_windows(spark, rows):
    w = Window.partitionBy("key").orderBy("place")
    upto, before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    want = rows.select("key", "place", "part", F.sum("value").over(upto).alias("s"), F.last("value", True).over(upto).alias("l"), F.last("value", True).over(before).alias("b"), F.first("value", True).over(after).alias("n"))
    for column, got in (
        ("s", scans.running_sum(rows, F.col("value"), ["key"], ["place"], "s")),
        ("l", scans.running_last(rows, F.col("value"), ["key"], ["place"], "l")),
        ("b", scans.running_last(rows, F.col("value"), ["key"], ["place"], "b", inclusive=False)),
        ("n", scans.running_last(rows, F.col("value"), ["key"], ["place"], "n", backward=True, inclusive=False)),
    ):
        assert got.columns == [*rows.columns, column]
        assert bag(got, "key", "place", "part", column) == bag(want, "key", "place", "part", column)
    replaced = windows.carry_forward(rows, F.col("value"), ["key"], ["place"], "value")
    assert replaced.columns == rows.columns and bag(replaced, "key", "place", "value") == bag(want, "key", "place", "l")


def test_one_key_spreads_over_tasks(spark):
    """A book that holds all rows is cut into ranges, and its sections still count on over their borders."""
    book = spark.range(20000).select(F.lit("b").alias("book"), F.col("id").alias("pos"), (F.col("id") % 100 == 0).alias("heading")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        part = scans.dealt(book, ["book"], ["pos"], "part").groupBy("part").count().collect()
        assert len(part) == 4 and max(r["count"] for r in part) < 8000
        got = windows.sections(book, F.col("heading"), "book", ["pos"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(r["section"] == r["pos"] // 100 + 1 for r in got) and len(got) == 20000


def test_places_and_descending_order(spark, rows):
    named = rows.select("place", F.lit(1).alias("part"), F.lit(2).alias("own"))
    got = windows.in_order(named, ["place"], "n")
    assert got.columns == ["place", "part", "own", "n"]
    assert [r["n"] for r in got.orderBy("place").collect()] == list(range(1500))
    assert [r["n"] for r in windows.in_order(named, ["-place"], "n").orderBy(F.desc("place")).collect()] == list(range(1500))


def test_asof_and_range_lookups_on_one_key(spark):
    r = random.Random(9)
    left = sorted(r.sample(range(2000), 300))
    right = [(x, r.choice([None, x])) for x in sorted(r.sample(range(2000), 500))]
    a = spark.createDataFrame([("u", x) for x in left], "key string, at long").repartition(4)
    b = spark.createDataFrame([("u", x, v) for x, v in right], "key string, at long, value long").repartition(4)
    asof = {x: next((v for y, v in reversed(right) if y <= x and v is not None), None) for x in left}
    assert {r["at"]: r["label"] for r in windows.asof_backward(a, b, "key", "at", "value", "label").collect()} == asof
    ends = dict(zip(left, left[1:] + [10**9]))
    first = {x: next((v for y, v in right if x <= y < ends[x] and v is not None), None) for x in left}
    assert {r["at"]: r["first"] for r in windows.range_first(a, b, "key", "at", "value", "first").collect()} == first


def test_empty_tables(spark, rows):
    none = rows.limit(0)
    assert windows.sections(none, F.lit(True), "key", ["place"]).count() == 0 and windows.in_order(none, ["place"]).count() == 0
    assert windows.asof_backward(none.select("key", "place"), none.select("key", "place", "value"), "key", "place", "value", "v").count() == 0


def test_row_numbers_equal_windows_and_spread_one_key(spark, rows):
    want = rows.select("key", "place", "part", F.row_number().over(Window.partitionBy("key").orderBy("place")).alias("n"))
    got = scans.row_numbers(rows, ["key"], ["place"], "n")
    assert bag(got, "key", "place", "part", "n") == bag(want, "key", "place", "part", "n")
    down = rows.select("place", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("place"))).alias("n"))
    assert bag(scans.row_numbers(rows, ["key"], ["-place"], "n"), "place", "n") == bag(down, "place", "n")


def test_segments_are_numbered_without_a_window_over_a_book(spark):
    """All lines of a book in one task was what bounded every query on segments."""
    from dirbook.views import VIEWS, load

    found = load(spark, "/root/testdata/sf0.001", "v_segment")
    assert "row_number" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = spark.sql(VIEWS["v_segment"].replace("FROM lineitem", "FROM {lineitem}"), lineitem=load(spark, "/root/testdata/sf0.001", "lineitem"))
    assert found.dtypes == want.dtypes and bag(found, *want.columns) == bag(want, *want.columns)
