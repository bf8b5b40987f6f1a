import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from dirbook.llm.bpe import VOCABULARY, ForcedBoundaryBPE, encode_documents, encoder, token_digests
from dirbook.llm.packing import pack, plan

BPE = encoder(public_tokenizers.path(VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abcdeth 'sSE1<|endoftext|>É.,\n\x1c\x7f")), max_size=80))
def test_ids_and_text_equal_the_library(text):
    want = BPE.library.encode(text, add_special_tokens=False)
    ids, decoded = BPE.encode_decode(text.encode())
    assert list(np.frombuffer(ids, "<u4")) == want.ids
    assert decoded.decode() == BPE.library.decode(want.ids, skip_special_tokens=False)
    assert BPE.encode(text.encode()) == ids


def test_special_tokens_are_matched_as_written():
    for text in ("<|endoftext|>", "<|ENDOFTEXT|>", "A<|endoftext|>B,", "x.<|startoftext|>.", "T\u0308. E\u0301, É. ß,", "don't, o'ER."):
        assert list(np.frombuffer(BPE.encode(text.encode()), "<u4")) == BPE.library.encode(text, add_special_tokens=False).ids


def test_both_merge_orders_agree():
    rng = random.Random(1)
    for _ in range(300):
        parts = [rng.choice("abcdefghthenin") for _ in range(rng.randint(1, 60))]
        parts[-1] += "</w>"
        assert BPE.merge_short(parts) == BPE.merge_long(parts)


def test_cuts_are_never_merged_over():
    for token in list(BPE.ids)[::50]:
        assert len(BPE.cut(token.removesuffix("</w>"))) == 1


def test_digests(odd, empty):
    rows = token_digests(odd).collect()
    assert len(rows) == odd.count()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, BPE.library.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd.collect())
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, list(r["ids"])) for r in encode_documents(odd).collect())
    assert got == want
    assert {(r["doc_id"] or 0, r["ids_sha256"]) for r in rows} == {(i, sha256(np.array(x, "<u4").tobytes()).hexdigest()) for _, i, x in want}
    assert token_digests(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 40), max_size=12))
def test_plan_places_every_piece_once(histogram):
    placed: Counter = Counter()
    packs: dict[int, list[tuple[int, int]]] = {}
    for s in plan(histogram, 32):
        for i in range(s.last - s.first):
            placed[s.length, s.first + i] += 1
            packs.setdefault(s.sequence + i, []).append((s.offset, s.length))
    assert placed == Counter((n, r) for n, c in histogram.items() for r in range(c))
    assert sorted(packs) == list(range(len(packs)))
    for held in packs.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 32
    total = sum(n * c for n, c in histogram.items())
    if len(packs) > 1:  # a piece opens a pack only when it fits into none, so any two packs hold more than one together
        used = sorted(sum(n for _, n in held) for held in packs.values())
        assert used[0] + used[1] > 32 and total <= 32 * len(packs)


def test_plan_leaves_little_padding_and_does_not_grow_with_the_corpus():
    rng = np.random.default_rng(1)
    lengths = Counter(np.clip(rng.lognormal(6, 1, 200_000), 1, 4096).astype(int).tolist())
    small, large = plan(dict(lengths)), plan({n: 10_000 * c for n, c in lengths.items()})
    packs = max(s.sequence + s.last - s.first for s in small)
    assert sum(n * c for n, c in lengths.items()) > 0.999 * 4096 * packs
    assert len(large) < 2 * len(small) < 100_000


def test_each_id_lies_in_one_piece(spark, odd, empty):
    """Ids of a document, put together from its pieces, by the checksum of each."""
    want = Counter()
    for r in odd.collect():
        ids = np.array(BPE.library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        for start in range(0, len(ids) // 4, 64):
            piece = ids[4 * start : 4 * start + 256]
            want[r["doc_id"], start, len(piece) // 4, zlib.crc32(piece), len(ids) // 4] += 1
    rows = pack(odd, most=64).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(places) == list(range(len(places)))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert pack(empty).count() == 0


def test_ids_are_the_same_without_cuts():
    plain = ForcedBoundaryBPE(public_tokenizers.path(VOCABULARY), cuts=False)
    for text in ("", "word " * 300, "\u00fcn\u00ef \u65e5\u672c\u8a9e <|endoftext|> x\x0by\x1cz", "x" * 5000, "it's 1234 TIMES, don't!\n\nit's"):
        assert plain.encode(text.encode()) == BPE.encode(text.encode())
