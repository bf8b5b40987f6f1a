"""From split books to documents, with a service played by a folder of results."""

import json

from dirbook.operators import pixels
from dirbook.plans import recognise, split
from tests.test_io_layout_streaming import page
from tests.test_split import scans


def test_requests_results_and_documents(spark, tmp_path):
    columns, out = str(tmp_path / "columns"), str(tmp_path / "out")
    scans(tmp_path / "scans", {"a/0001": split_png(2), "a/0002": split_png(2)})
    (tmp_path / "scans" / "a" / split.CONFIG).write_text(json.dumps({"split": {"fixedColumnCount": 2}}))
    split.split_books(spark, str(tmp_path / "scans"), columns)
    asked = sorted(r["output_key"] for r in recognise.ask(spark, columns, out, "read this").collect())
    assert asked == ["0001-01", "0001-02", "0002-01", "0002-02"]
    requests = [json.loads(r["value"]) for r in spark.read.text(f"{out}/requests").collect()]
    assert sorted(r["key"] for r in requests) == asked and "read this" in json.dumps(requests)

    def result(key, text):
        uri = {"contents": [{"parts": [{"fileData": {"fileUri": f"gs://a/{key}.png"}}]}]}
        return json.dumps({"request": uri, "response": {"text": text}})

    good = json.dumps({"r": [{"t": "d", "x": "町"}]})
    (tmp_path / "results").mkdir()
    (tmp_path / "results" / "r.jsonl").write_text("\n".join([result("0001-01", good), result("0001-02", '{"r": [{"t": "z"}]}'), result("0002-01", "nothing"), result("0009-09", good), ""]))
    told = recognise.collect(spark, str(tmp_path / "results"), out)
    assert [(r["output_key"], r["segments"][0]["segmentId"]) for r in told.saved.collect()] == [("0001-01", "0001-01-0001")]
    assert {r["output_key"]: r["problem"] for r in told.quarantined.collect()} == {"0001-02": "r[1].t is unknown", "0002-01": "no JSON object", "0009-09": "no request"}
    assert [r["output_key"] for r in told.missing.collect()] == ["0002-02"]
    assert {r["total"] for r in told.counters.collect()} == {4}
    again = recognise.collect(spark, str(tmp_path / "results"), out)
    assert again.saved.count() == 0 and spark.read.parquet(f"{out}/documents").count() == 1
    assert sorted(r["output_key"] for r in recognise.ask(spark, columns, out, "p").collect()) == asked[1:]


def split_png(n):
    return pixels.png(page(n))
