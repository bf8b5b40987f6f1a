"""Logs cut at any byte reload to their last whole record."""

import json

import pytest

from dirbook.sources import logs

SCHEMA = "id string, seq long, said string"


def latest(records):
    found = {}
    for r in records:
        if r["id"] not in found or r["seq"] >= found[r["id"]]["seq"]:
            found[r["id"]] = r
    return sorted((r["id"], r["seq"], r["said"]) for r in found.values())


def test_a_log_cut_at_any_byte(spark, tmp_path):
    records = [{"id": f"k{i % 3}", "seq": i, "said": f"町 {i}"} for i in range(6)]
    data = "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records).encode()
    ends = [i + 1 for i, b in enumerate(data) if b == 10]
    for cut in sorted({0, 1, len(data), *(e + d for e in ends for d in (-2, -1, 0, 3)), len(data) // 2}):
        folder = tmp_path / f"log{cut}"
        folder.mkdir()
        (folder / "a.jsonl").write_bytes(data[:cut])
        whole = sum(e - 1 <= cut for e in ends)
        assert sorted(map(tuple, logs.reload(spark, str(folder), SCHEMA, "id", "seq").collect())) == latest(records[:whole]), cut


def test_appended_and_compacted(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "compact")
    rows = [("a", 1, "x"), ("b", 1, None), ("a", 3, "z"), ("a", 2, "y")]
    for row in rows:
        logs.append(spark.createDataFrame([row], SCHEMA), path)
    assert sorted(map(tuple, logs.reload(spark, path, SCHEMA, "id", "seq").collect())) == [("a", 3, "z"), ("b", 1, None)]
    assert sorted(map(tuple, logs.compact(spark, path, out, SCHEMA, "id", "seq").collect())) == [("a", 3, "z"), ("b", 1, None)]


def test_damage_before_the_end_is_an_error(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "a", "seq": 1}\n{"id": "b", "se\n{"id": "c", "seq": 2}\n')
    with pytest.raises(Exception, match="broken record"):
        logs.reload(spark, str(tmp_path), SCHEMA, "id", "seq").collect()
