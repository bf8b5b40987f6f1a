"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Writer: a gzip member for each record, in files of bounded size under a folder that driver and executors share. A file is
written under a name of its own attempt and then moved, so a task that runs again leaves the same files.

Reader: at each place it takes a gzip member or a plain record and checks it: member checksum, version line, headers,
block length, block digest, record end. After a failed check it searches for the next valid member or version line,
goes on there, and logs the bytes between as a quarantined gap. A member may hold many records; a damaged one among them
is a gap inside the member. Files are read in windows; only one plain record, or one member, is held.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirbook.llm.common import Scratch, bytes_of, row_number, whole_number

VERSION = b"WARC/1.1\r\n"
FILE_BYTES = 64 << 20
WINDOW = 1 << 20
#: A block longer than this, which no row could hold, is taken for damage.
MOST_BLOCK = 1 << 31


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    """A whole record, uncompressed."""
    lines = [f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", "sha1:" + sha1_base32(block)), ("Content-Length", str(len(block)))]]
    return VERSION + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def header_value(text: str) -> str:
    """Text fit for one header line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


class Found(NamedTuple):
    """A record, or a gap (headers None) with the reason why its bytes were quarantined. `inside`: where it begins in the
    content of the member from `start` to `end`; 0 for a member's first record and for plain ones."""

    start: int
    end: int
    headers: dict[str, str] | None
    block: bytes
    reason: str = ""
    inside: int = 0


class Damaged(Exception):
    pass


_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_HEADER = re.compile(rb"[!-9;-~]+[ \t]*:|[ \t]")


class Archive:
    """Random access to a file of `size` bytes through read(start, n)."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        self._at, self._held = 0, b""

    def window(self, start: int, n: int = WINDOW, least: int | None = None) -> bytes:
        """Up to n bytes from `start`, fewer than `least` (or n) only at the end; the last window read is kept."""
        held = self._at + len(self._held)
        if not self._at <= start or start + (least or n) > held and held < self.size:
            self._at, self._held = start, self.read(start, max(n, WINDOW))
        return self._held[start - self._at : start - self._at + n]

    def member_at(self, start: int) -> tuple[bytes, int, int]:
        """(content, end, skipped) of the gzip member at `start`; the first `skipped` bytes, in which no record can begin, are left out of
        the content, so that what only looks like a member, or a long damaged record, isn't held."""
        unpacker, at, parts, total, skipped, begun = zlib.decompressobj(31), start, [], 0, 0, False
        while not unpacker.eof:
            data = self.window(at, 1 << 14, 1)
            if not data:
                raise Damaged("member cut short")
            try:
                part = unpacker.decompress(data)
            except zlib.error as e:
                raise Damaged(f"member: {e}") from None
            at += len(data)
            parts.append(part)
            total += len(part)
            if not begun:  # the end of what is held may be a version line's beginning
                whole = b"".join(parts)
                begun = b"WARC/" in whole
                parts = [whole if begun else whole[-4:]]
                skipped = 0 if begun and total == len(whole) else total - len(parts[0])
            if total - skipped > MOST_BLOCK + (1 << 16):
                raise Damaged("member too long")
        return b"".join(parts), at - len(unpacker.unused_data), skipped

    def plain_at(self, start: int) -> tuple[bytes, int]:
        """(content, end) of the uncompressed record at `start`."""
        n, stop = 1 << 12, -1
        while stop < 0:
            head = self.window(start, n, n)
            stop = head.find(b"\r\n\r\n")
            if stop < 0 and (len(head) < n or not all(_HEADER.match(x) for x in head.split(b"\r\n")[1:-1])):
                raise Damaged("headers without an end")
            n *= 2  # as long as all lines so far are headers
        m = re.search(rb"\r\ncontent-length[ \t]*:[ \t]*(\d{1,18})[ \t]*\r\n", head[: stop + 2], re.I)
        if not m:
            raise Damaged("no Content-Length")
        end = start + stop + 4 + int(m[1]) + 4
        if int(m[1]) > MOST_BLOCK or end > self.size:
            raise Damaged("block cut short")
        return self.window(start, end - start) if end - start <= WINDOW else self.read(start, end - start), end

    def found_at(self, start: int) -> list[Found]:
        """The plain record at `start`, or all records of the member there with the gaps between them."""
        head = self.window(start, 5)
        if head[:2] == b"\x1f\x8b":
            content, end, skipped = self.member_at(start)
            return records_in(content, end, start, skipped)
        if head == b"WARC/":
            data, end = self.plain_at(start)
            headers, block, _ = parse(data)
            return [Found(start, end, headers, block)]
        raise Damaged("neither a member nor a version line")

    def next_start(self, after: int) -> int:
        """The next place from `after` on where a member or version line can begin, or the end."""
        at = after
        while at < self.size:
            data = self.window(at, WINDOW)
            m = re.search(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n", data)
            if m:
                return at + m.start()
            if at + len(data) >= self.size:
                break
            at += len(data) - 10
        return self.size

    def salvage(self) -> Iterator[Found]:
        """All records that pass their checks, and the gaps between."""
        at, gap, reason = 0, None, ""
        while at < self.size:
            try:
                found = self.found_at(at)
            except Damaged as e:
                if gap is None:
                    gap, reason = at, str(e)
                at = self.next_start(at + 1)
                continue
            if gap is not None:
                yield Found(gap, at, None, b"", reason)
                gap = None
            yield from found
            at = found[-1].end
        if gap is not None:
            yield Found(gap, self.size, None, b"", reason)


def records_in(content: bytes, end: int, start: int, skipped: int = 0) -> list[Found]:
    """The records in a member's content, one after the other, and the gaps between; a member without any is damaged. Places inside count
    from the member's own beginning, `skipped` bytes before the content."""
    found, at, gap, reason = [], 0, -skipped if skipped else None, "member holds no record"
    while at < len(content):
        try:
            headers, block, after = parse(content, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            m = _VERSION.search(content, at + 1)
            at = m.start() if m else len(content)
            continue
        if gap is not None:
            found.append(Found(start, end, None, b"", reason, gap + skipped))
            gap = None
        found.append(Found(start, end, headers, block, inside=at + skipped))
        at = after
    if not any(x.headers for x in found):
        raise Damaged(reason)
    return found if gap is None else [*found, Found(start, end, None, b"", reason, gap + skipped)]


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case) and block of the record from `at` on, which must be whole, and where it ends."""
    if not _VERSION.match(data, at):
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("headers without an end")
    headers: dict[str, str] = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not {"warc-type", "warc-record-id", "content-length"} <= headers.keys() or not headers["content-length"].isdecimal():
        raise Damaged("a required header is missing")
    end = stop + 4 + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("block length and record end disagree")
    block = data[stop + 4 : end]
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and digest != sha1_base32(block):
        raise Damaged("block digest differs")
    return headers, block, end + 4


def payload(block: bytes, headers: dict[str, str]) -> bytes:
    """The block without the HTTP head that response records have."""
    if not headers.get("content-type", "").startswith("application/http"):
        return block
    head, split, body = block.partition(b"\r\n\r\n")
    return body if split else b""


def store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri)


def record_id(rid: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=rid & ((1 << 64) - 1), version=5)}>"


def write_archives(pages: DataFrame, folder: str, least_revisit: int = 0, scratch: Scratch | None = None) -> DataFrame:
    """Writes a record for each row of pages(page_id, url, html); gives (path, records, bytes) of each file, once written.

    Of rows with equal payloads of at least `least_revisit` bytes the one with the largest page_id (null is the smallest;
    of equals the last in the scan) is a response, the others revisit it. A null html is an empty payload; a null url
    leaves out the target, a null page_id its header. An empty table gives no files.
    """
    spark: SparkSession = pages.sparkSession
    scratch = scratch or Scratch(spark)
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(row_number(pages).alias("rid"), whole_number(pages["page_id"]).alias("page_id"), pages["url"].cast("string").alias("url"), html.alias("html"))
    digests = rows.select("rid", "page_id", F.unhex(F.sha2("html", 256)).alias("digest"), F.octet_length("html").alias("n")).where(F.col("n") >= least_revisit)
    groups = digests.groupBy("digest", "n").agg(F.max(F.struct("page_id", "rid")).alias("last"), F.count("*").alias("size")).where("size > 1")
    revisits = digests.join(groups, ["digest", "n"]).where("rid != last.rid").select("rid", F.col("last.rid").alias("original"), F.col("last.page_id").alias("refers_to"))
    todo = rows.join(revisits, "rid", "left").select("rid", "page_id", "url", "html", "original", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        k, out, size, n, made = 0, None, 0, 0, []
        temporary = ""
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("rid", "page_id", "url", "original", "refers_to")]
            for rid, page_id, url, original, refers_to, body in zip(*columns, bytes_of(batch["html"])):
                if out is None:
                    final, temporary = f"{base}/part-{task.partitionId():06d}-{k:04d}.warc.gz", f"{base}/.attempt-{task.taskAttemptId()}-{k}"
                    out = files.open_output_stream(temporary, compression=None)
                size += out.write(member(page_record(rid, page_id, url, body, original, refers_to)))
                n += 1
                if size >= FILE_BYTES:
                    made.append(_finish(files, out, temporary, final, n, size))
                    k, out, size, n = k + 1, None, 0, 0
        if out is not None:
            made.append(_finish(files, out, temporary, final, n, size))
        yield pa.RecordBatch.from_pydict({"path": [m[0] for m in made], "records": [m[1] for m in made], "bytes": [m[2] for m in made]}, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return scratch.table(todo.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def _finish(files: arrow_fs.FileSystem, out, temporary: str, final: str, n: int, size: int) -> tuple[str, int, int]:
    out.close()
    files.move(temporary, final)
    return final.rsplit("/", 1)[1], n, size


def page_record(rid: int, page_id: int | None, url: str | None, body: bytes, original: int | None, refers_to: int | None) -> bytes:
    headers = [("WARC-Type", "response" if original is None else "revisit"), ("WARC-Record-ID", record_id(rid)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        headers.append(("WARC-Target-URI", header_value(url)))
    headers.append(("WARC-Payload-Digest", "sha1:" + sha1_base32(body)))
    if page_id is not None:
        headers.append(("Page-Id", str(page_id)))
    if original is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(original))]
        if refers_to is not None:
            headers.append(("Refers-To-Page-Id", str(refers_to)))
        return record(headers, b"")
    headers.append(("Content-Type", "application/http;msgtype=response"))
    return record(headers, b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body)


READ = "path string, start long, end long, inside long, reason string, record_id string, record_type string, page_id long, url string, refers_to_id string, refers_to long, payload_digest string, payload_bytes long"


def read_archives(paths: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records and gaps of the files paths(path) in `folder`: READ's columns, and the payload itself if asked for.

    Gaps have a reason and nulls for the rest. A response's digest and length are those of the payload that was read; a
    revisit's digest is the one that its header states.
    """
    schema = READ + (", payload binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(folder)
        rows, held = [], 0
        for batch in batches:
            for path in batch["path"].to_pylist():
                with files.open_input_file(f"{base}/{path}") as f:
                    for x in Archive(lambda start, n, f=f: f.read_at(min(n, f.size() - start), start), f.size()).salvage():
                        rows.append(_row(path, x, payloads))
                        held += len(x.block) * payloads + 500
                        if held > 16 << 20:
                            yield _batch(rows, arrow, names)
                            rows, held = [], 0
        if rows:
            yield _batch(rows, arrow, names)

    return paths.select("path").mapInArrow(run, schema)


def _batch(rows: list[dict], arrow: pa.Schema, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], arrow.field(c).type) for c in names], schema=arrow)


def _number(text: str | None) -> int | None:
    """A whole number of 64 bits; any other text is none."""
    found = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return found if found is not None and -(1 << 63) <= found < 1 << 63 else None


def _row(path: str, x: Found, payloads: bool) -> dict:
    if x.headers is None:
        return {"path": path, "start": x.start, "end": x.end, "inside": x.inside, "reason": x.reason}
    h = x.headers
    row = {"path": path, "start": x.start, "end": x.end, "inside": x.inside, "record_id": h["warc-record-id"], "record_type": h["warc-type"], "page_id": _number(h.get("page-id")), "url": h.get("warc-target-uri"), "refers_to_id": h.get("warc-refers-to"), "refers_to": _number(h.get("refers-to-page-id"))}
    if row["record_type"] == "revisit":
        row["payload_digest"] = h.get("warc-payload-digest", "").removeprefix("sha1:")
    else:
        body = payload(x.block, h)
        row |= {"payload_digest": sha1_base32(body), "payload_bytes": len(body)}
        if payloads:
            row["payload"] = body
    return row


def round_trip(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page, written to archives and read back.

    A revisit's length is that of the response it refers to. Rows, nulls and ties: see write_archives().
    """
    scratch = scratch or Scratch(pages.sparkSession)
    folder = f"{scratch.path}/archives"
    manifest = write_archives(pages, folder, scratch=scratch)
    n = max(1, manifest.count())
    read = scratch.table(read_archives(manifest.repartition(n, "path"), folder), "read").where("reason is null")
    responses = read.where("record_type = 'response'")
    lengths = responses.select(F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("length"))
    revisits = read.where("record_type = 'revisit'").join(lengths, "refers_to_id").withColumn("payload_bytes", F.col("length"))
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*out).unionByName(revisits.select(*out))
