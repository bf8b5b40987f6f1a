import gzip
import io
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dirbook.llm.exact import drop_copies, exact_groups
from dirbook.llm.quality import RULES, Features, estimate, keep_good, quality, quality_report
from dirbook.llm.warc import Archive, _number, member, page_record, read_archives, record, round_trip, sha1_base32, write_archives


def test_exact_groups_equal_brute_force(spark, odd, empty):
    rows = odd.collect()
    for block in (3, 4096):
        got = exact_groups(odd, block=block).collect()
        assert len(got) == len(rows)
        groups = defaultdict(list)
        for r in rows:
            groups[r["text"] or ""].append(r["doc_id"])
        want = Counter((i, max((x for x in ids if x is not None), default=None), len(ids), sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
        assert sum(r["kept"] for r in got) == len(groups)
        assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert exact_groups(empty).count() == 0
    left = drop_copies(odd)
    assert left.columns == odd.columns and sorted(r["text"] or "" for r in left.collect()) == sorted(groups)


def brute(text):
    words = text.split()
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split(b"\n") if x.split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in b"#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é\n|\x1c #"), max_size=120))
def test_features_equal_brute_force(text):
    f = Features(text.encode())
    assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == brute(text.encode())
    assert f._repeat_words_long() == f.n_repeat_words if f.n_words > 2 else True


def test_quality_is_the_conjunction_in_any_order(odd, empty):
    want = Counter((r["doc_id"], not any(x.rejects(Features((r["text"] or "").encode())) for x in RULES)) for r in odd.collect())
    assert Counter((r["doc_id"], r["kept"]) for r in quality(odd).collect()) == want
    assert Counter((r["doc_id"], r["kept"]) for r in quality(odd, RULES[::-1]).collect()) == want
    assert Counter((r["doc_id"], r["kept"]) for r in quality_report(odd).collect()) == want
    assert keep_good(odd).columns == odd.columns and keep_good(odd).count() == sum(n for (_, kept), n in want.items() if kept)
    assert quality_report(empty).count() == 0 and keep_good(empty).count() == 0
    assert {e.name for e in estimate(odd)} == {r.name for r in RULES}


PAGES = "page_id long, url string, html string, record_type string"


def test_round_trip(spark):
    rows = [(1, "http://a/ x\r\n", "<p>é</p>", ""), (2, None, "<p>é</p>", ""), (3, "u", None, ""), (4, "u", "", ""), (None, "u", "<p>é</p>", ""), (2, None, "<p>é</p>", ""), (7, "u", "WARC/1.1\r\n\x1f\x8b\x08" * 9999, "")]
    got = round_trip(spark.createDataFrame(rows, PAGES)).collect()
    groups = defaultdict(list)
    for page_id, _, html, _ in rows:
        groups[html or ""].append(page_id)
    best = {h: max(x for x in ids if x is not None) for h, ids in groups.items()}
    assert sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"]) for r in got) == sorted((p or 0, len((h or "").encode()), sha1_base32((h or "").encode())) for p, _, h, _ in rows)
    assert Counter(r["record_type"] for r in got) == {"response": len(groups), "revisit": len(rows) - len(groups)}
    for r in got:
        html = next(h or "" for p, _, h, _ in rows if p == r["page_id"] and sha1_base32((h or "").encode()) == r["payload_digest"])
        assert r["refers_to"] == (None if r["record_type"] == "response" else best[html])
        assert r["record_type"] == "revisit" or r["page_id"] == best[html]
    assert round_trip(spark.createDataFrame([], PAGES)).count() == 0


def records():
    return [page_record(i, i, "http://h/%d" % i, b"<p>text %d</p>" % i * 50, None, None) for i in range(6)]


def read(data):
    return list(Archive(lambda a, n: data[a : a + n], len(data)).salvage())


@pytest.mark.parametrize("pack", [member, lambda x: x])
def test_salvage_skips_damage_and_logs_gaps(pack):
    parts = [pack(r) for r in records()]
    assert gzip.open(io.BytesIO(member(records()[0]))).read() == records()[0]
    assert [x.headers["page-id"] for x in read(b"".join(parts))] == list("012345")
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 0xFF
    data = b"junk" + parts[0] + parts[1] + bytes(broken) + parts[3] + b"\x1f\x8b\x08 noise WARC/1.0\r\n" + parts[4] + parts[5][:-9]
    found = read(data)
    assert [x.headers["page-id"] for x in found if x.headers] == ["0", "1", "3", "4"]
    gaps = [(x.start, x.end) for x in found if x.headers is None]
    assert len(gaps) == 4 and all(x.reason for x in found if x.headers is None)
    at = 0
    for x in found:  # records and gaps cover the file
        assert x.start == at
        at = x.end
    assert at == len(data)
    assert read(b"") == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.integers(1, 400), st.booleans())
def test_salvage_recovers_all_untouched_records(at, n, gz):
    parts = [member(r) if gz else r for r in records()]
    whole = b"".join(parts)
    at %= len(whole)
    found = read(whole[:at] + bytes(n) + whole[at + n :])
    ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
    intact = {str(i) for i, e in enumerate(ends) if e <= at or e - len(parts[i]) >= at + n}
    assert intact <= {x.headers.get("page-id") for x in found if x.headers}


def salvaged(data):
    return [(x.headers and x.headers["warc-record-id"], x.inside, x.reason) for x in Archive(lambda start, n: data[start : start + n], len(data)).salvage()]


def plain(i, headers=()):
    return record([("WARC-Type", "response"), ("WARC-Record-ID", str(i)), *headers], b"body %d" % i)


def test_members_may_hold_many_records():
    one, two, three = map(plain, (1, 2, 3))
    assert salvaged(member(one + two + three)) == [("1", 0, ""), ("2", len(one), ""), ("3", len(one + two), "")]
    got = salvaged(member(one + two.replace(b"body", b"b0dy") + three) + member(one))
    assert got == [("1", 0, ""), (None, len(one), "block digest differs"), ("3", len(one + two), ""), ("1", 0, "")]
    assert [x[0] for x in salvaged(member(b"") + member(two) + member(one)[:-1])] == [None, "2", None]


def test_headers_of_any_length():
    assert [x[0] for x in salvaged(plain(1, [("X-Long", "y" * 70_000)]) + plain(2))] == ["1", "2"]
    assert [x[0] for x in salvaged(b"WARC/1.0\r\nno header\r\n" + b"z" * 100_000 + plain(1, [("X-Long", "y" * 3_000_000)]) + plain(2))] == [None, "1", "2"]


def test_records_after_a_long_damaged_one_in_a_member():
    """However much of a member holds no version line, the records after it are found, at their own places."""
    broken = b"WXRC/1.1\r\n" + record([("WARC-Type", "response"), ("WARC-Record-ID", "0")], bytes(range(256)) * 800)[10:]
    for n in (0, 3, 70_000, 500_000):
        lead = b"\xff" * n + broken
        got = salvaged(member(lead + plain(1) + plain(2)) + member(plain(3)))
        assert got == [(None, 0, got[0][2]), ("1", len(lead), ""), ("2", len(lead + plain(1)), ""), ("3", 0, "")]


def test_numbers_beyond_a_long_are_none():
    assert [_number(x) for x in ("9223372036854775807", "9223372036854775808", "9999999999999999999", "-9223372036854775808", "12", "x", None)] == [2**63 - 1, None, None, -(2**63), 12, None, None]
