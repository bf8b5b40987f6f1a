"""Harvest as one transaction a batch, and replay within an error budget."""

import random

import pytest
from pyspark.sql import functions as F

from dirbook.operators import jobs
from dirbook.streaming import ingest

GOOD, BAD = '{"r": [{"t": "d", "x": "a"}]}', '{"r": [{"t": "z"}]}'


def test_a_failed_batch_is_replaced_by_its_retry(spark, tmp_path, monkeypatch):
    source, outputs, quarantine, checkpoint = (str(tmp_path / x) for x in ("in", "out", "bad", "check"))
    rows = [("k1", GOOD), ("k2", BAD), ("k3", GOOD), ("k1", GOOD)]
    df = spark.createDataFrame([(k, "b", 1, i, t) for i, (k, t) in enumerate(rows)], ingest.RESPONSE)
    df.coalesce(1).write.json(source)

    def run(to=checkpoint):
        ingest.harvest_stream(ingest.response_stream(spark, source), outputs, quarantine, to).awaitTermination()

    real, kind = ingest.publish, "output_key string"
    monkeypatch.setattr(ingest, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        run()
    assert ingest.published(spark, outputs, outputs, kind).count() == 0 and ingest.counters(spark, outputs).count() == 0
    monkeypatch.setattr(ingest, "publish", real)
    run()
    documents = lambda: sorted(r[0] for r in ingest.published(spark, outputs, outputs, kind).collect())
    assert documents() == ["k1", "k3"]
    assert [r[0] for r in ingest.published(spark, quarantine, outputs, kind).collect()] == ["k2"]
    assert [tuple(r)[1:] for r in ingest.counters(spark, outputs).collect()] == [(2, 1)]
    assert sorted(r[0] for r in spark.read.parquet(outputs).select("output_key").collect()) == ["k1", "k3"]  # nothing is left of the failed one
    run(str(tmp_path / "other"))
    assert documents() == ["k1", "k3"]
    spark.createDataFrame([("k4", "b", 1, 1, GOOD)], ingest.RESPONSE).coalesce(1).write.mode("append").json(source)
    run()
    assert documents() == ["k1", "k3", "k4"]


def test_replay_stops_at_the_budget(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), i, r.choice([True, False, None, True])) for i in r.sample(range(3000), 900)] + [("c", i, i % 3 != 0) for i in range(50)]
    df = spark.createDataFrame(rows, "job string, place long, bad boolean").repartition(5)
    got = {(x["job"], x["place"]): x["outcome"] for x in jobs.replay(df, ["job"], ["place"], F.col("bad"), 5).collect()}
    assert len(got) == len(rows)
    for job in ("a", "b", None, "c"):
        streak = 0
        for _, place, bad in sorted((x for x in rows if x[0] == job), key=lambda x: x[1]):
            assert got[job, place] == ("undone" if streak >= 5 else "failed" if bad else "done")
            if streak < 5:
                streak = streak + 1 if bad else 0
