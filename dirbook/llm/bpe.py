"""BPE encoding and decoding by forced boundaries.

A merge can only join two symbols into a token of the vocabulary. A pair of neighbouring bytes that occurs inside no
token is therefore never merged over: text may be cut there, the fragments encoded independently and the ids
concatenated, with the same result. White space occurs in no token, so texts fall into words first; inside a
pre-token, the pair table gives further cuts. Words and fragments repeat, so each worker keeps those it has encoded, in
caches of bounded size. Time is linear in the text and a very long word costs n log n.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dirbook.llm.common import bytes_of, held, keyed

VOCABULARY = "word_bpe_49k.json"
END = "</w>"


#: Words of printable ASCII and the letters of Latin-1: composed already, lower-cased letter by letter.
SIMPLE = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Pre-tokens of such words once lower-cased, as the file's pattern finds them.
SIMPLE_PRETOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")


class _Kept(dict):
    """A cache that computes what it lacks; when full it starts anew, so its size is bounded. Long keys aren't kept."""

    def __init__(self, make, most: int = 400_000, longest: int = 48):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        found = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = found
        return found


class ForcedBoundaryBPE:
    """Encoder and decoder for a byte-level BPE file with word ends. Without `cuts`, pre-tokens go to the library's merges
    whole: the same ids, for operators that are not about how they are found."""

    def __init__(self, path: str, cuts: bool = True):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["model"]["merges"])}
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.specials.items()}
        self.inside = self._pairs()
        self.merges = self.library.model.tokenize
        letters = "abcdefghijklmnopqrstuvwxyz"
        #: Finds a forced boundary between plain letters, the common case, faster than the table does.
        self.forced = re.compile("|".join(a + b for a in letters for b in letters if a + b not in self.inside) or r"(?!)").search
        #: Letters of Latin-1 in the byte-level alphabet.
        self.shown = {c: self.library.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in (*range(0xDF, 0xF7), *range(0xF8, 0x100))}
        #: Each word that isn't kept costs a search of the merges; a pre-token is shared by words that differ in case or marks.
        self.pretokens = _Kept(self._encode_pretoken if cuts else self._merge_pretoken, 700_000)
        self.words = _Kept(self.encode_word, 1_200_000)
        self.words_both = _Kept(self._word_both, 500_000)

    def _pairs(self) -> set[str]:
        """Neighbouring symbols (bytes, as the byte-level alphabet shows them) found inside some token."""
        found: set[str] = set()
        for token in self.ids:
            body = token.removesuffix(END)
            found.update(body[i : i + 2] for i in range(len(body) - 1))
        return found

    def cut(self, pretoken: str) -> list[str]:
        """The pre-token, cut at every forced boundary."""
        inside = self.inside
        if pretoken.isascii() and pretoken.isalpha():
            if not self.forced(pretoken):
                return [pretoken]
        elif all(map(inside.__contains__, map(str.__add__, pretoken, pretoken[1:]))):
            return [pretoken]
        cuts = [i for i in range(1, len(pretoken)) if pretoken[i - 1 : i + 1] not in inside]
        return [pretoken[a:b] for a, b in zip([0, *cuts], [*cuts, len(pretoken)])]

    def _encode_pretoken(self, pretoken: str) -> bytes:
        """Fragments encoded one by one. The library's merges put a word end on what they get, so only the last is theirs."""
        parts = self.cut(pretoken)
        out: list[int] = []
        for part in parts[:-1]:
            symbols = self.merge_short(list(part)) if len(part) <= 32 else self.merge_long(list(part))
            out += [self.ids[s] for s in symbols if s in self.ids]
        if len(parts[-1]) > 256:
            out += [self.ids[s] for s in self.merge_long([*parts[-1][:-1], parts[-1][-1] + END]) if s in self.ids]
        else:
            out += [t.id for t in self.merges(parts[-1])]
        return array("I", out).tobytes()

    def _merge_pretoken(self, pretoken: str) -> bytes:
        return array("I", [t.id for t in self.merges(pretoken)]).tobytes() if len(pretoken) <= 256 else self._encode_pretoken(pretoken)

    def merge_short(self, symbols: list[str]) -> list[str]:
        """Merges in order of rank: the pair of least rank, everywhere it stands, until none is left."""
        ranks, none = self.ranks, len(self.ranks)
        while len(symbols) > 1:
            found = [ranks.get(pair, none) for pair in zip(symbols, symbols[1:])]
            best = min(found)
            if best == none:
                break
            i, out, last = 0, [], len(found)
            while i <= last:
                if i < last and found[i] == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def merge_long(self, parts: list[str]) -> list[str]:
        """The same in n log n, by a linked list and a heap; for fragments without a space that run on and on."""
        symbols: list[str | None] = list(parts)
        n, rank = len(symbols), self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = left + right, None, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := rank((symbols[i], symbols[after[j]]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[after[j]]))
            if before[i] >= 0 and (r := rank((symbols[before[i]], symbols[i]))) is not None:
                heapq.heappush(heap, (r, before[i], symbols[before[i]], symbols[i]))
        return [s for s in symbols if s is not None]

    def encode_plain(self, text: str) -> bytes:
        """Ids of text without special tokens."""
        if SIMPLE.fullmatch(text):
            pretokens = SIMPLE_PRETOKENS.findall(text.lower())
            if not text.isascii():
                pretokens = [p if p.isascii() else p.translate(self.shown) for p in pretokens]
        else:
            pretokens = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text)) if p]
        return b"".join(map(self.pretokens.__getitem__, pretokens))

    def encode_word(self, word: bytes) -> bytes:
        """Ids of text between two white spaces, special tokens included.

        Words that differ in case only are one, and a stop or comma after a letter is a pre-token of its own."""
        if word.isascii() and b"<|" not in word:
            small = word.lower()
            if small != word:
                return self.words[small]
            if word.isalpha():  # one pre-token
                return self.pretokens[word.decode()]
        if len(word) > 1 and word[-1] in b".," and 97 <= word[-2] <= 122:
            return self.words[word[:-1]] + self.words[word[-1:]]
        text = word.decode()
        if "<|" not in text or not self.special.search(text):
            return self.encode_plain(text)
        out, at = b"", 0
        for m in self.special.finditer(text):
            out += self.encode_plain(text[at : m.start()]) + array("I", [self.specials[m[0]]]).tobytes()
            at = m.end()
        return out + self.encode_plain(text[at:])

    def _word_both(self, word: bytes) -> tuple[bytes, bytes]:
        ids = self.words[word]
        return ids, self.decode(array("I", ids)).encode()

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole UTF-8 text, as little-endian uint32."""
        return b"".join(map(self.words.__getitem__, text.split()))

    def encode_decode(self, text: bytes) -> tuple[bytes, bytes]:
        """The ids, and the text that decode() makes of them."""
        pairs = list(map(self.words_both.__getitem__, text.split()))
        return b"".join([p[0] for p in pairs]), b" ".join([p[1] for p in pairs if p[0]])

    def decode(self, ids) -> str:
        """The file names no decoder, so tokens are shown as they stand in the vocabulary, a space between them."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def encoder(path: str, cuts: bool = True) -> ForcedBoundaryBPE:
    """One encoder for each Python worker, so that its caches outlive a task."""
    return held(f"bpe {cuts} {path}", lambda: ForcedBoundaryBPE(path, cuts))


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of each row of docs(doc_id, text); a null text counts as empty, with no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(public_tokenizers.path(vocabulary))
        for batch in batches:
            pairs = [bpe.encode_decode(text) for text in bytes_of(batch["text"])]
            ids = pa.array([np.frombuffer(a, "<u4").astype(np.int32) for a, _ in pairs], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids, pa.array([b.decode() for _, b in pairs], pa.string())], ["doc_id", "ids", "decoded"])

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what encode_documents() gives, as digests.

    Every row of docs gives one row; null and empty texts have no tokens and the digests of nothing; repeated rows are
    encoded each; an empty table gives an empty one. Only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(public_tokenizers.path(vocabulary))
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in bytes_of(batch["text"]):
                a, b = bpe.encode_decode(text)
                n.append(len(a) // 4)
                ids.append(sha256(a).hexdigest())
                decoded.append(sha256(b).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
