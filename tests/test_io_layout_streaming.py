import gzip
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from dirbook import sql
from dirbook.functions import phone
from dirbook.operators import layout, pixels, windows
from dirbook.plans import stages
from dirbook.sources import books, sinks
from dirbook.streaming import ingest


def page(columns, h=1000, w=900):
    """A page of short strokes with rules between columns."""
    rng = np.random.default_rng(1)
    gray = np.full((h, w), 255, np.uint8)
    for y in range(60, h - 60, 14):
        for x in range(60, w - 60, 9):
            if rng.random() < 0.8:
                gray[y : y + 8, x : x + 5] = 0
    for i in range(1, columns):
        x = 60 + (w - 120) * i // columns
        gray[:, x - 8 : x + 8] = 255
        gray[40 : h - 40, x : x + 2] = 0
    return gray


def test_layouts_of_synthetic_pages():
    for n in (2, 3, 4):
        found, _ = pixels.infer(pixels.binarized(page(n)), tolerant=True)
        assert len(found.spans) == n
    with pytest.raises(pixels.NoLayout):
        pixels.infer(pixels.binarized(page(2)))
    assert pixels.crop(np.pad(page(2), 40)) == (35, 35, 910, 1010)
    ink = np.zeros((50, 4), bool)
    ink[5:25, 0] = ink[5:9, 1] = True
    assert pixels.opened(ink, 10).sum(0).tolist() == [20, 0, 0, 0]
    assert pixels.shrunk(np.full((8, 8), 7, np.uint8), 0.75).tolist() == [[7] * 6] * 6


def test_split_pages_from_png(spark, tmp_path):
    book = tmp_path / "book"
    book.mkdir()
    (book / "0001.png").write_bytes(pixels.png(page(3)))
    (book / "0002.png").write_bytes(pixels.png(np.full((400, 300), 255, np.uint8)))
    rows = {Path(r["origin"]).stem: r for r in pixels.split_pages(spark.read.format("image").load(str(book)), tolerant=True).collect()}
    assert rows["0001"]["columnCount"] == 3 and rows["0001"]["images"][0][:4] == b"\x89PNG" and rows["0001"]["error"] is None
    assert rows["0002"]["error"] and rows["0002"]["columnCount"] is None
    assert books.books_with(spark, str(tmp_path), ".png") == ["book"]
    assert books.page_images(spark, str(tmp_path)).select("book", "page").orderBy("page").collect()[0] == ("book", "0001")


def test_quality_gate_and_exclusions(spark):
    flags = lambda *x: spark.range(1).select(layout.fatal(F.array(*map(F.lit, x)).cast("array<string>"))).first()[0]
    assert flags("uneven_column_widths") and not flags("possible_text_cut_at_column_edge") and not flags()
    pages = spark.createDataFrame([(f"{i:04d}",) for i in range(1, 9)], "page string")
    assert [r[0] for r in layout.excluded_pages(pages, "page", ["0002"], [("0006", "0004")]).collect()] == ["0001", "0003", "0007", "0008"]


def test_options():
    config = {"split": {"fixedColumnCount": 4, "webpQuality": 300, "resizeScale": 0.5, "workers": 3, "excludePages": ["0001"], "excludePageRanges": ["0003-0005", {"start": "9", "end": "7"}]}}
    got = books.split_options(config, quality=None, columns=3)
    assert got == {"columns": 3, "scale": 0.5, "quality": 100, "workers": 3, "exact": ["0001"], "ranges": [("0003", "0005"), ("9", "7")]}
    assert books.split_options({})["quality"] == 90
    for bad in ({"split": {"resizeScale": 2}}, {"split": 3}, {"split": {"fixedColumnCount": 7}}):
        with pytest.raises(ValueError):
            books.split_options(bad)
    assert books.as_of_date(None, "1968-03-01-x.csv.gz") == "1968-03-01" and books.as_of_date("", None) == "1963-02-01"


def test_documents_and_books(spark, tmp_path):
    for name, texts in (("0002-01", ["c"]), ("0001-01", ["a", "b"]), ("0001-02", None)):
        document = {"page": 1, "column": 1} | ({} if texts is None else {"segments": [{"entryType": "directory_entry", "cleanText": t} for t in texts]})
        (tmp_path / "b1").mkdir(exist_ok=True)
        (tmp_path / "b1" / f"{name}.ocr.json").write_text(json.dumps(document), "utf-8")
    got = [(r["book"], r["file_key"], r["pos"], r["cleanText"]) for r in books.segments(spark, str(tmp_path)).orderBy("file_key", "pos").collect()]
    assert got == [("b1", "0001-01", 0, "a"), ("b1", "0001-01", 1, "b"), ("b1", "0002-01", 0, "c")]
    assert books.resolve_books(spark, str(tmp_path)) == [(f"{tmp_path}/b1", "b1")]
    assert books.resolve_books(spark, f"{tmp_path}/b1", "other") == [(f"{tmp_path}/b1", "other")]
    assert books.resolve_books(spark, f"{tmp_path}/none") == []


ROWS = "row_idx long, phone string, name string, prefecture string, municipality string, area string, lot string"


def test_tables_round_trip(spark, tmp_path):
    rows = [(0, "06-111-2222", 'a "b", c', "大阪府", "大阪市", " x ", "1"), (1, "06-111-0001", "", "大阪府", "堺市", "y", "")]
    df = spark.createDataFrame(rows, ROWS)
    sinks.write_exported(df, f"{tmp_path}/e")
    part = next(Path(f"{tmp_path}/e").glob("part-*.csv.gz"))
    assert gzip.open(part).read().decode() == '電話番号,名前,都道府県,市区町村,町域,番地\r\n06-111-2222,"a ""b"", c",大阪府,大阪市, x ,1\r\n06-111-0001,,大阪府,堺市,y,\r\n'
    back = books.exported_rows(spark, f"{tmp_path}/e").collect()
    assert [tuple(r)[1:] for r in back] == [r[1:] for r in rows]
    assert books.table_rows(spark, f"{tmp_path}/e").count() == 2
    out, counts = stages.published(df)
    sinks.write_published(out, f"{tmp_path}/p", single_file=True)
    text = gzip.open(next(Path(f"{tmp_path}/p").glob("part-*.csv.gz"))).read().decode()
    assert text.splitlines()[0].startswith("06-111-0001,,") and tuple(counts.first()) == (2, 0, 0, 2)
    with pytest.raises(ValueError, match="lacks"):
        books.exported_rows(spark, f"{tmp_path}/p")


def test_result_lines(spark, tmp_path):
    lines = ['{"instance": {"x": [{"fileData": {"fileUri": "gs://b/0001-02.webp"}}]}, "response": {"text": "t"}}', "", "not json", '{"error": {"message": "m"}}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "skip.txt").write_text("{}")
    got = sorted((r["output_key"], r["response"] or "", r["error"] or "") for r in books.result_lines(spark, str(tmp_path)).collect())
    assert got == [("", "", "not JSON"), ("", '{"error": {"message": "m"}}', "m"), ("0001-02", '{"text":"t"}', "")]


def test_chunks_and_bad_size(spark):
    df = windows.chunked(spark.range(25).withColumnRenamed("id", "k"), ["k"], 10)
    assert {r["k"]: r["chunk"] for r in df.collect()} == {i: i // 10 for i in range(25)}
    with pytest.raises(ValueError):
        windows.chunked(df, ["k"], 0)


def test_repair_stage(spark):
    rows = [(i, "大阪府", "大阪市北区", "堂島船大工", str(i)) for i in range(10)] + [(10, "大阪府", "大阪市北区", "堂島,船大工", "1-2")]
    got = stages.repaired(spark.createDataFrame(rows, "row_idx long, prefecture string, municipality string, area string, lot string"), min_similarity=0.5)
    last = got.repaired.where("row_idx = 10").first()
    assert (last["area"], last["lot"], last["changed"]) == ("堂島船大工", "1-2", True)


def test_streaming_equals_batch_and_is_idempotent(spark, tmp_path):
    line = lambda k, text: json.dumps({"output_key": k, "book": "b", "page": int(k[:4]), "column": 1, "text": text})
    good = json.dumps({"r": [{"t": "d", "x": "a"}]})
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text("\n".join([line("0001-01", good), line("0002-01", "broken")]))
    paths = [f"{tmp_path}/{x}" for x in ("out", "bad", "checkpoint")]
    run = lambda checkpoint: ingest.harvest_stream(ingest.response_stream(spark, f"{tmp_path}/in", 1), paths[0], paths[1], checkpoint).awaitTermination()
    run(paths[2])
    (tmp_path / "in/2.json").write_text("\n".join([line("0001-01", good), line("0003-01", good)]))
    run(paths[2])
    run(f"{tmp_path}/other")  # from the start again: nothing is saved twice
    assert sorted(r["output_key"] for r in spark.read.parquet(paths[0]).collect()) == ["0001-01", "0003-01"]
    assert {r["output_key"] for r in spark.read.parquet(paths[1]).collect()} == {"0002-01"}


def test_windowed_counts_batch(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:00:00", "a")], "ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted(r["events"] for r in ingest.windowed_counts(df, "ts", "kind").collect()) == [1, 2]


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql("SELECT nfkc('ＡＢ') a, seq_ratio('abcd', 'bcde') b, normalize_phone('761-8512代') c, split_address('豊,岡町2', null).municipality d, first_json('x {\"a\": 1}') e").first()
    assert tuple(row) == ("AB", 0.75, "06-761-8512", "豊中市", '{"a":1}')
    printed = ["761-8512代", "761-8512代表", "※", "※072(11)2222", "761--8512-代", "", "０６ー１", None, " 371 1111 ", "※3-4"]
    df = spark.createDataFrame([(x,) for x in printed], "p string")
    assert [tuple(r)[0] == tuple(r)[1] for r in df.select(F.expr("normalize_phone(p)"), phone.export_number(F.col("p"))).collect()] == [True] * len(printed)
    assert spark.sql("SELECT * FROM expand_candidates(array('1', '2'), array('n'), array('a'))").count() == 2
