"""Main text of web pages by removing site templates.

Each page is parsed once. Elements that hold no article text by their kind (scripts, menus, forms) or by a word in their
class, id or role (adverts, comments) are left out at once; names never hide the page's body or article. Every other container's subtree is hashed; Spark counts each
hash per host, and subtrees that recur on many pages of their host are deleted as the site's template. Where a page marks
one article or its main element, blocks outside it are left out; paragraphs and headings are
templates only outside marked articles, on more pages and at the same place, as articles of a site do quote the same
passages.

Pages are not shuffled: what a parse yields is written once, and only pages with a template subtree are joined to the
verdicts. Counts are combined before the shuffle, so a host with a third of all pages is no burden.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.anchors import mix
from dirbook.llm.common import Scratch, row_number, slices, whole_number

#: A subtree is template if it recurs on this many pages of its host, whatever its size; a block of text outside marked
#: articles if it does at the same place from the page's start or end.
MANY_PAGES, MANY_TEXTS = 5, 50

# fixed values: element names of the HTML standard
_RAW = frozenset("script style xmp iframe noembed noframes noscript plaintext".split())
_RAW_DECODED = frozenset("title textarea".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_NO_TEXT = frozenset("applet audio button canvas datalist dialog footer head header iframe input label link map math menu meta nav noscript object option script select style svg template textarea title video aside search".split())
_TEXT_BLOCKS = frozenset("a abbr address b bdi bdo blockquote br cite code dd del dfn dl dt em figcaption font h1 h2 h3 h4 h5 h6 i ins kbd li mark ol p pre q s samp small span strong sub sup td th time tr tt u ul var".split())
#: Start tags that end an open element of these names.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table article main section div body html td th".split())
_WALLS = frozenset("article main body td".split())
_END_OF = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in _RAW | _RAW_DECODED}
_ENDS_P = _BLOCK - {"br", "body", "html", "head", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "summary", "legend", "figcaption"}
# fixed values: words of class, id and role that name what isn't the article
_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored banner cookie cookies consent gdpr notice notices alert popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead footer colophon copyright sidebar aside widget widgets related recommended recommendations share sharing social newsletter subscribe subscription signup login search comment comments commentlist disqus respond reply replies promo promotion toolbar contentinfo complementary".split()
)

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+|[\"'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]{2,}")
#: First words of names that tell a state of the page, and words that may follow one of _NAMED in the name of its parts.
_STATES = frozenset("has have with without no not is are show hide".split())
_PARTS = frozenset(
    "area bar block body bottom box button buttons center col column container content element form group heading holder icon icons inner inside item items left link links list main module outer panel placeholder posts primary right row secondary section slot text title top unit wrap wrapper zone".split()
)
#: What a name never hides, nor an element around the page's only ones of the latter two.
_NEVER_NAMED = frozenset("html body main article".split())


def _names_boilerplate(name: str) -> bool:
    """Whether one name is a word of _NAMED, ends with one (`site-footer`) or is one's part (`comment-list`); names of
    states (`with-sidebar`, `comments-open`) are not."""
    words = _WORDS.findall(name)
    if not words or words[0] in _STATES:
        return False
    return words[-1] in _NAMED or words[0] in _NAMED and all(w in _NAMED or w in _PARTS for w in words)


def _marked(attributes: str) -> tuple[bool, bool]:
    """Whether class, id or role names boilerplate, and whether the role is main."""
    named = main = False
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        main |= m[1].lower() == "role" and value.strip() == "main"
        named |= any(map(_names_boilerplate, value.split()))
    return named and not main, main


class Open(NamedTuple):
    """An open element. `node`: the innermost candidate up to it; `wrapper`: the innermost named element up to it; -1: none."""

    name: str
    start: int
    node: int
    own: bool
    hidden: bool
    main: bool
    wrapper: int


class Page(NamedTuple):
    """A page's blocks and the tree of subtrees that may take them along.

    texts: of the blocks, in order; inside: the innermost subtree of each (-1: none); parents, hashes: of the subtrees, a
    parent before its children (hash 0: in a named element, counts nowhere); placed: of each block outside marked articles two hashes of its text at its place."""

    texts: list[str]
    inside: list[int]
    parents: list[int]
    hashes: list[int]
    placed: list[list[int]]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _placed(text: str, place: int) -> int:
    """The hash of a block of text at a place from the start, or a negative one from the end: even, those of elements are odd."""
    return _hash(f"{place} {text}") & ~1


#: Fixed primes under 2^31 and bases, modulo which substrings are hashed.
_FIELDS = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_812_433_253))


def _field_powers(n: int, base: int, prime: int) -> np.ndarray:
    """The first n powers of a base modulo a prime, twice as many in each step."""
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
        have += more
    return out


def _substring_hashes(source: str, starts: list[int], ends: list[int]) -> list[int]:
    """Odd hashes of substrings, however they overlap, in time that is linear in the source: differences of prefix sums of polynomials over
    two prime fields, where, unlike modulo a power of two, no family of texts has the same hash whatever the base."""
    if not starts:
        return []
    codes = np.frombuffer(source.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    spread, a, b = mix(codes, codes), np.array(starts), np.array(ends)
    found = (b - a).astype(np.uint64)
    for prime, base in _FIELDS:
        p = np.uint64(prime)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread % p * _field_powers(len(codes), base, prime) % p, dtype=np.uint64)])
        inverse = _field_powers(len(codes) + 1, pow(base, -1, prime), prime)
        found = mix(found, (sums[b] - sums[a]) % p * inverse[a] % p)
    return (found.view(np.int64) | 1).tolist()


class _Elements:
    """The open elements, with the places of each name, so that end tags find theirs without a search."""

    def __init__(self) -> None:
        self.stack: list[Open] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []
        self.walls: list[int] = []

    def push(self, x: Open) -> None:
        i = len(self.stack)
        self.stack.append(x)
        self.at[x.name].append(i)
        if x.name in _SCOPES:
            self.scopes.append(i)
        if x.name in _WALLS:
            self.walls.append(i)

    def pop(self) -> Open:
        x = self.stack.pop()
        self.at[x.name].pop()
        if x.name in _SCOPES:
            self.scopes.pop()
        if x.name in _WALLS:
            self.walls.pop()
        return x

    def last(self, *names: str) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def ended_by(self, name: str) -> int:
        """Where the element stands that an end tag ends, or -1: a stray one doesn't end what holds it."""
        i = self.last(name)
        return i if name in _SCOPES or not self.walls or i >= self.walls[-1] else -1

    def closed_by(self, name: str) -> int:
        """Where the element stands that a start tag ends, or -1."""
        if name not in _ENDS_P and name not in _CLOSES:
            return -1
        i = self.last(*(("p",) if name in _ENDS_P or name in ("li", "dt", "dd") else ()), *_CLOSES.get(name, ()))
        return i if not self.scopes or i >= self.scopes[-1] else -1


def parse(source: str) -> Page:
    """Blocks of a page in order, without what its kind or name gives away."""
    source = " ".join(source.split())
    # each block: text, whether it lies in a marked article, the innermost subtree and named element around it
    blocks: list[tuple[str, bool, int, int]] = []
    elements = _Elements()
    stack = elements.stack
    pieces: list[str] = []
    # of subtrees: parent, start, end and the innermost named element around; of named elements: the one around
    parents: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    under: list[int] = []
    wrappers: list[int] = []
    forms: list[int] = []
    # of outermost article and main elements, whether it is an article and the innermost named element around it
    opened: list[tuple[bool, int]] = []
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        pieces.clear()
        if text:
            top = stack[-1] if stack else None
            blocks.append((text, bool(top and top.main), top.node if top else -1, top.wrapper if top else -1))

    def close(until: int, end: int) -> None:
        while len(stack) > until:
            if stack[-1].name in _BLOCK:
                flush()
            x = elements.pop()
            if x.own:
                ends[x.node] = end

    size = len(source)
    while at < size:
        m = _MARKUP.search(source, at)
        stop = m.start() if m else size
        if stop > at and not (stack and stack[-1].hidden):
            pieces.append(source[at:stop])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if (i := elements.ended_by(name)) >= 0:
                close(i, m.end())
            continue
        if name in _BLOCK:
            if (i := elements.closed_by(name)) >= 0:
                close(i, m.start())
            flush()
        if name in _VOID or m[3].endswith("/") and name not in _BLOCK:
            continue
        if name in _RAW or name in _RAW_DECODED:
            e = _END_OF[name].search(source, at)
            at = e.end() if e else size
            continue
        named, role = _marked(m[3]) if m[3] else (False, False)
        top = stack[-1] if stack else None
        hidden = bool(top and top.hidden) or name in _NO_TEXT
        inside = bool(top and top.main)
        main = not hidden and (name in ("article", "main") or role)
        wrapper, node = (top.wrapper, top.node) if top else (-1, -1)
        if main and not inside:
            opened.append((name == "article" and not role, wrapper))
        if (named or name == "form") and not hidden and name not in _NEVER_NAMED:
            wrappers.append(wrapper)
            wrapper = len(wrappers) - 1
            if not named:
                forms.append(wrapper)
        own = not hidden and not main and name not in _TEXT_BLOCKS and name not in ("html", "body")
        if own:
            parents.append(node)
            starts.append(m.start())
            ends.append(size)
            under.append(wrapper)
            node = len(parents) - 1
        elements.push(Open(name, m.start(), node, own, hidden, inside or main, wrapper))
    close(0, size)
    flush()
    # where all articles are in named elements, these are the page's wrappers
    shown = [False] * len(wrappers)
    if all(w >= 0 for _, w in opened):
        for _, w in opened:
            while w >= 0 and not shown[w]:
                shown[w], w = True, wrappers[w]
    if not opened and forms:  # nor is a form that holds most of the text of a page without a marked article
        held = [0] * len(wrappers)
        for text, _, _, w in blocks:
            if w >= 0:
                held[w] += len(text)
        for w in range(len(wrappers) - 1, -1, -1):
            if wrappers[w] >= 0:
                held[wrappers[w]] += held[w]
        whole = sum(len(x[0]) for x in blocks)
        for w in forms:
            shown[w] = 2 * held[w] > whole
    clear = []
    for w, around in enumerate(wrappers):
        clear.append(shown[w] and (around < 0 or clear[around]))
    is_clear = lambda w: w < 0 or clear[w]
    blocks = [x for x in blocks if is_clear(x[3])]
    # several articles and no main element can be cards beside the page's text, which then only counts of subtrees cut
    tops = [is_article for is_article, w in opened if is_clear(w)]
    cut = len(tops) == 1 or not all(tops)
    kept = [x for x in blocks if x[1] or not cut]
    placed = [[] if in_main else [_placed(text, i), _placed(text, i - len(kept))] for i, (text, in_main, _, _) in enumerate(kept)]
    hashes = [h if is_clear(w) else 0 for h, w in zip(_substring_hashes(source, starts, ends), under)]
    return Page([x[0] for x in kept], [x[2] for x in kept], parents, hashes, placed)


def without(page: Page, gone: set[int]) -> list[str]:
    """Texts of the blocks that are in no subtree, and at no place, of those hashes."""
    cut: list[bool] = []
    for parent, h in zip(page.parents, page.hashes):
        cut.append(h in gone or parent >= 0 and cut[parent])
    return [text for text, node, placed in zip(page.texts, page.inside, page.placed) if not (node >= 0 and cut[node]) and gone.isdisjoint(placed)]


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


PARSED = "rid long, page_id long, url string, host string, page long, texts array<string>, inside array<int>, parents array<int>, hashes array<long>, placed array<array<long>>"


def _parsed(pages: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in PARSED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sources = [x or "" for x in batch["html"].to_pylist()]
            found = [[host_of(u) for u in batch["url"].to_pylist()], [_hash(x) for x in sources], *map(list, zip(*map(parse, sources)))]
            yield pa.RecordBatch.from_arrays([batch["rid"], batch["page_id"], batch["url"], *(pa.array(c, k) for c, k in zip(found, kinds))], names)

    rows = pages.select(row_number(pages).alias("rid"), whole_number(pages["page_id"]).alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    return rows.mapInArrow(run, PARSED)


TEXTS = "page_id long, url string, text string"


def _cut(pages: DataFrame) -> DataFrame:
    """TEXTS of PARSED rows with the hashes `gone` of their templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch[c].to_pylist() for c in Page._fields]
            texts = ["\n".join(without(Page(*row), set(gone))) for *row, gone in zip(*columns, batch["gone"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.select("page_id", "url", *Page._fields, "gone").mapInArrow(run, TEXTS)


def main_text(pages: DataFrame, many: int = MANY_PAGES, many_texts: int = MANY_TEXTS, scratch: Scratch | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages(page_id, url, html).

    Blocks are texts between boundaries of block elements or line breaks, with character references decoded and each
    stretch of white space one space; empty ones are dropped, the others joined by line feeds. A null html is empty and
    gives the empty text. Pages with a null or broken url share the empty host. Repeated rows give a row each; equal
    pages of a host count once, so that they are no templates of each other. An empty table gives no rows. Other columns are not read.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    parsed = scratch.table(_parsed(pages), "parsed")
    least = F.when(F.col("h") % 2 == 0, many_texts).otherwise(many)
    once = parsed.groupBy("host", "page").agg(F.min("rid").alias("rid"), F.count("*").alias("n"))
    copies = parsed.select("rid", "host", "page").join(once.where("n > 1").select("host", "page", F.col("rid").alias("first")), ["host", "page"]).where("rid <> first").select("rid")
    every = F.array_remove(F.array_distinct(F.concat("hashes", F.flatten("placed"))), F.lit(0).cast("long"))
    seen = parsed.select("rid", "host", F.explode(every).alias("h"))
    counts = seen.join(copies, "rid", "left_anti").groupBy("host", "h").agg(F.count("*").alias("n"))
    templates = scratch.table(counts.where(F.col("n") >= least).select("host", "h"), "templates")
    verdicts = scratch.table(seen.join(templates, ["host", "h"]).groupBy("rid").agg(F.collect_list("h").alias("gone")), "verdicts")
    judged = parsed.join(verdicts, "rid", "left")
    whole = judged.where(F.col("gone").isNull()).select("page_id", "url", F.array_join("texts", "\n").alias("text"))
    return whole.unionByName(_cut(judged.where(F.col("gone").isNotNull()))).withColumn("n_chars", F.char_length("text").cast("long"))
