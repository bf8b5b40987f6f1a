"""Line numbers of files in many splits, and answers joined with requests by place."""

import pytest

from dirbook.sources import books


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_split_files_number_as_one(spark, tmp_path, small_splits):
    texts = {"a.jsonl": [f"line {i} " + "x" * (i % 40) for i in range(300)], "b.jsonl": ["", "one", "", "two"], "c.jsonl": ["z" * 900] * 3}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = books.numbered_lines(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = {(r["file"].rsplit("/", 1)[1], r["line"]): r["value"] for r in rows.collect()}
    assert got == {(name, i): x for name, lines in texts.items() for i, x in enumerate(lines, 1)}


def test_answers_join_requests_by_place(spark, tmp_path, small_splits):
    (tmp_path / "r.jsonl").write_text("".join(f'{{"text": "{i}"}}\n\n' for i in range(60)))
    requests = spark.createDataFrame([(f"k{i:03}",) for i in range(60)], "output_key string").repartition(3)
    got = {r["output_key"]: r["response"] for r in books.inline_responses(spark, str(tmp_path), requests, "output_key").collect()}
    assert got == {f"k{i:03}": f'{{"text": "{i}"}}' for i in range(60)}
    for some in (requests.where("output_key <> 'k007'"), requests.union(spark.createDataFrame([("k999",)], "output_key string"))):
        with pytest.raises(Exception, match="as many responses as requests"):
            books.inline_responses(spark, str(tmp_path), some, "output_key").collect()
