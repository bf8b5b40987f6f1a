"""The codec against a plain encoder, equalisation against a plain version, and the split stage from folder to manifest."""

import json
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dirbook.functions.images import decoded, gray_of, png, shrunk
from dirbook.operators import pixels
from dirbook.plans import split
from tests.test_io_layout_streaming import page


def encoded(samples, kind, depth, filters, palette=b""):
    """A PNG file, filtered byte by byte as the format's text has it. samples: rows of packed bytes."""
    unit = max(1, {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind] * depth // 8)
    width = {0: 8, 2: 8, 3: 8, 4: 8, 6: 8}[kind]
    before, out = bytes(len(samples[0])), b""
    for row, f in zip(samples, filters):
        line = []
        for i, x in enumerate(row):
            a, b, c = (row[i - unit] if i >= unit else 0), before[i], (before[i - unit] if i >= unit else 0)
            p = a + b - c
            nearest = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((x - (0, a, b, (a + b) // 2, nearest)[f]) % 256)
        out, before = out + bytes([f, *line]), row
    chunk = lambda k, d: len(d).to_bytes(4, "big") + k + d + zlib.crc32(k + d).to_bytes(4, "big")
    head = width.to_bytes(4, "big") + len(samples).to_bytes(4, "big") + bytes([depth, kind, 0, 0, 0])
    body = zlib.compress(out)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", body[:7]) + chunk(b"IDAT", body[7:]) + chunk(b"IEND", b"")


@settings(max_examples=150, deadline=None)
@given(st.data(), st.sampled_from([(0, 8), (2, 8), (4, 8), (6, 8), (0, 16), (2, 16), (0, 1), (0, 2), (0, 4), (3, 8), (3, 4)]), st.integers(1, 6))
def test_png_files_of_all_kinds(data, form, height):
    kind, depth = form
    length = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind] * depth
    rows = [data.draw(st.binary(min_size=length, max_size=length)) for _ in range(height)]
    if kind == 3:
        rows = [bytes(x & 0x77 if depth == 4 else x % 8 for x in r) for r in rows]
    palette = bytes(range(24)) if kind == 3 else b""
    got = decoded(encoded(rows, kind, depth, data.draw(st.lists(st.integers(0, 4), min_size=height, max_size=height)), palette))
    for y, row in enumerate(rows):
        values = [int(f"{int.from_bytes(row, 'big'):0{8 * len(row)}b}"[i * depth : (i + 1) * depth], 2) for i in range(8 * len(row) // depth)]
        values = [v >> 8 if depth == 16 else v * (255 // (2**depth - 1)) if kind == 0 else v for v in values]
        n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
        for x in range(8):
            sample = values[x * n : (x + 1) * n]
            want = list(palette[3 * sample[0] : 3 * sample[0] + 3]) if kind == 3 else sample[: 1 if n < 3 else 3]
            assert got[y, x].tolist() == want


def test_png_round_trip_and_faults():
    rng = np.random.default_rng(5)
    for shape in ((7, 5, 1), (3, 9, 3)):
        image = rng.integers(0, 256, shape).astype(np.uint8)
        assert (decoded(png(image)) == image).all()
    assert shrunk(np.full((8, 8, 3), 7, np.uint8), 0.5).tolist() == [[[7] * 3] * 4] * 4
    assert gray_of(np.array([[[255, 255, 255], [10, 10, 10]]], np.uint8)).tolist() == [[255, 10]]
    good = png(np.zeros((4, 4), np.uint8))
    for bad in (b"", b"GIF89a", good[:30], good[:40] + b"x" + good[41:], good.replace(b"\x08\x00\x00\x00\x00", b"\x08\x00\x00\x00\x01", 1)):
        with pytest.raises(ValueError):
            decoded(bad)


def plain_equalized(gray, clip=2.0, tiles=8):
    """The usual equalisation, one pixel and one level at a time, in single precision."""
    f = np.float32
    h, w = gray.shape
    ph, pw = (h, w) if h % tiles == 0 and w % tiles == 0 else (h + tiles - h % tiles, w + tiles - w % tiles)
    mirrored = lambda i, n: i if i < n else 2 * (n - 1) - i
    th, tw = ph // tiles, pw // tiles
    tables = {}
    for ty in range(tiles):
        for tx in range(tiles):
            counts = [0] * 256
            for y in range(ty * th, (ty + 1) * th):
                for x in range(tx * tw, (tx + 1) * tw):
                    counts[gray[mirrored(y, h), mirrored(x, w)]] += 1
            limit = max(int(clip * th * tw / 256), 1)
            clipped = sum(max(0, c - limit) for c in counts)
            counts = [min(c, limit) + clipped // 256 for c in counts]
            rest = clipped % 256
            if rest:
                i, step = 0, max(256 // rest, 1)
                while i < 256 and rest:
                    counts[i] += 1
                    i, rest = i + step, rest - 1
            total, table = 0, []
            for c in counts:
                total += c
                table.append(min(255, round(float(f(total) * (f(255) / f(th * tw))))))
            tables[ty, tx] = table
    out = np.zeros_like(gray)
    for y in range(h):
        for x in range(w):
            v = int(gray[y, x])
            fy, fx = f(y) * (f(1) / f(th)) - f(0.5), f(x) * (f(1) / f(tw)) - f(0.5)
            y0, x0 = int(np.floor(fy)), int(np.floor(fx))
            ya, xa = fy - f(y0), fx - f(x0)
            y1, x1, y0, x0 = min(y0 + 1, tiles - 1), min(x0 + 1, tiles - 1), max(y0, 0), max(x0, 0)
            a = f(tables[y0, x0][v]) * (f(1) - xa) + f(tables[y0, x1][v]) * xa
            b = f(tables[y1, x0][v]) * (f(1) - xa) + f(tables[y1, x1][v]) * xa
            out[y, x] = min(255, max(0, round(float(a * (f(1) - ya) + b * ya))))
    return out


@pytest.mark.parametrize("h, w", [(64, 64), (61, 83), (64, 50), (96, 40)])
def test_equalisation_to_the_byte(h, w):
    rng = np.random.default_rng(h * w)
    for gray in (rng.integers(0, 256, (h, w)), rng.integers(100, 110, (h, w)), np.where(rng.random((h, w)) < 0.9, 250, rng.integers(0, 60, (h, w)))):
        gray = gray.astype(np.uint8)
        assert (pixels.equalized(gray) == plain_equalized(gray)).all()


def scans(root, pages):
    for name, content in pages.items():
        path = root / f"{name}.png"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def test_split_stage_writes_only_what_lacks(spark, tmp_path):
    root, out = tmp_path / "scans", tmp_path / "columns"
    colour = np.stack([page(3)] * 3, -1)
    scans(root, {"a/0001": png(page(2)), "a/0002": png(page(2)), "a/0003": png(page(2)), "b/0001": png(colour), "b/0002": b"not an image", "b/0003 [x].y": png(page(3))})
    (root / "a" / split.CONFIG).write_text(json.dumps({"split": {"fixedColumnCount": 2, "resizeScale": 0.5, "excludePages": ["0003"]}}))
    (root / "b" / split.CONFIG).write_text(json.dumps({"split": {"fixedColumnCount": 3}}))
    rows = {(r["book"], r["page"]): r for r in split.split_books(spark, str(root), str(out)).collect()}
    assert {k: r["status"] for k, r in rows.items()} == {("a", "0001"): "split", ("a", "0002"): "split", ("a", "0003"): "excluded", ("b", "0001"): "split", ("b", "0002"): "skipped", ("b", "0003 [x].y"): "split"}
    assert rows["b", "0002"]["reason"] == "not a PNG file" and rows["a", "0003"]["reason"] == "configured_exclude"
    files = sorted(str(p.relative_to(out)) for p in out.rglob("*.png"))
    assert files == sorted(f for r in rows.values() for f in r["files"] or []) and len(files) == 10
    image = decoded((out / "b" / "0001-02.png").read_bytes())
    box = rows["b", "0001"]["columns"][1]
    assert image.shape == (round(1000 * 0.75), round((box["x2"] - box["x1"]) * 0.75), 3)
    assert not (out / "_attempts").exists()
    assert json.loads((out / "a" / "column_count.json").read_text()) == {"layoutScope": "page", "columnImageFormat": "png", "pageCount": 2, "columnCountHistogram": {"2": 2}, "mostCommonColumnCount": 2}
    quality = json.loads((out / "b" / "split_quality.json").read_text())
    assert (quality["pageCount"], quality["skippedPageCount"]) == (2, 1)

    def stamps():
        return {str(p.relative_to(out)): p.stat().st_mtime_ns for p in out.rglob("*.png")}

    before = stamps()
    (out / "a" / "0002-01.png").unlink()
    (root / "b" / "0002.png").write_bytes(png(page(3)))
    again = {(r["book"], r["page"]): r for r in split.split_books(spark, str(root), str(out)).collect()}
    assert again["b", "0002"]["status"] == "split" and again["a", "0001"]["run"] == rows["a", "0001"]["run"] != again["a", "0002"]["run"]
    after = stamps()
    assert {f for f in after if after[f] != before.get(f)} == {"a/0002-01.png", "a/0002-02.png", "b/0002-01.png", "b/0002-02.png", "b/0002-03.png"}
    assert split.pending(spark, split.books.page_images(spark, str(root)).where("page <> '0003'"), str(out)).count() == 0


def test_images_without_a_manifest_are_written_again(spark, tmp_path):
    """A run that ended between its images and its manifest leaves nothing that counts."""
    root, out = tmp_path / "scans", tmp_path / "columns"
    scans(root, {"a/0001": png(page(2))})
    (root / "a" / split.CONFIG).write_text(json.dumps({"split": {"fixedColumnCount": 2}}))
    options = split.book_options(spark, str(root), ["a"])
    pages = split.books.page_images(spark, str(root))
    split.split_rows(pages, str(out), options, 1).write.format("noop").mode("overwrite").save()
    assert len(list(out.rglob("*.png"))) == 2 and split.manifest(spark, str(out)).count() == 0
    first = {p.name: p.read_bytes() for p in out.rglob("*.png")}
    rows = split.split_books(spark, str(root), str(out)).collect()
    assert [r["status"] for r in rows] == ["split"] and {p.name: p.read_bytes() for p in out.rglob("*.png")} == first


def test_failures_can_be_errors(spark, tmp_path):
    scans(tmp_path / "s", {"a/0001": b"", "a/0002": png(np.full((400, 300), 255, np.uint8))})
    with pytest.raises(ValueError, match="a/0001: empty file"):
        split.split_books(spark, str(tmp_path / "s"), str(tmp_path / "o"), skip_failed=False)
    assert split.split_books(spark, str(tmp_path / "s"), str(tmp_path / "o")).count() == 2
    with pytest.raises(FileNotFoundError):
        split.split_books(spark, str(tmp_path / "none"), str(tmp_path / "o2"))


def plain_filtered(mask, size, axis, all_of):
    """A window at a time: what lies beyond the edge is true for erosion and false for dilation."""
    before, out = size // 2, np.zeros_like(mask)
    lines, into = (mask, out) if axis else (mask.T, out.T)
    for line, found in zip(lines, into):
        for i in range(len(line)):
            window = [line[j] if 0 <= j < len(line) else all_of for j in range(i - before, i - before + size)]
            found[i] = all(window) if all_of else any(window)
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 20, 45])
def test_windows_of_any_size(size):
    rng = np.random.default_rng(size)
    for share in (0.1, 0.5, 0.9):
        mask = rng.random((23, 31)) < share
        for axis in (0, 1):
            for all_of in (False, True):
                assert (pixels._filtered(mask, size, axis, all_of) == plain_filtered(mask, size, axis, all_of)).all()


def test_pages_are_dealt_in_portions_without_lists_on_the_driver(spark, tmp_path, monkeypatch):
    """Each portion is one job of many tasks; neither names nor files are gathered one by one."""
    root, out = tmp_path / "scans", tmp_path / "columns"
    scans(root, {f"a/{i:04d}": png(page(2)) for i in range(9)} | {"a/0009": b""})
    monkeypatch.setattr(split, "PORTION", 4)
    monkeypatch.setattr(split, "PAGES_A_TASK", 2)

    def local(*_, **__):
        raise AssertionError("pages came to the driver one by one")

    with monkeypatch.context() as m:
        m.setattr(split, "write_summaries", lambda *_: None)
        m.setattr("pyspark.sql.classic.dataframe.DataFrame.toLocalIterator", local)
        rows = split.split_books(spark, str(root), str(out), columns=2)
    assert sorted((r["page"], r["status"]) for r in rows.collect()) == [(f"{i:04d}", "split") for i in range(9)] + [("0009", "skipped")]
    assert len(list(out.rglob("*.png"))) == 18
