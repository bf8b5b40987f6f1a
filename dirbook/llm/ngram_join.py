"""Jaccard self-join of documents on word shingles, by token-combination prefixes.

Tokens are hashes of shingles. Documents with one set of tokens are one node. First, nodes that can't be similar to any
are set aside: of n tokens a similar set lacks d = n - ceil(0.8 n) at most, so a node with more than d tokens that no
other has is alone. That is counted on the tokens below a bound of the hash, and for the nodes left on all of theirs.

Tokens of the rest fall into classes by how many nodes have them: rare tokens are indexed one by one; frequent ones
only as pairs, drawn within small subclasses. A node orders its tokens by class, subclass and hash, and indexes a prefix,
extended until it holds a credit of d + 1, where a rare token counts one and a subclass with s tokens of the prefix
counts s - 1. Two similar nodes then share a rare token of both prefixes or a pair: were fewer than k tokens shared in
each class of k-combinations, more than d tokens would be missing. Subclasses depend on the set's size, so a node indexes
pairs for each size class that a similar one may be in.

Candidates are verified on whole texts. Nodes that share a combination are compared with a few centers of their group,
not all with all; rounds go on until each group lies in one component or all nodes outside its largest component have
been compared with every other member of another component. So no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.anchors import grams, mix
from dirbook.llm.common import Scratch, bytes_of, fresh, keyed, row_number, slices, word_hashes

WORDS, SIMILAR = 5, 80
#: A token is frequent if FREQUENT nodes have it at least; at most MOST_FREQUENT tokens are, by raising that bound.
FREQUENT, MOST_FREQUENT = 16, 2_000_000
#: Parts of the hash range in which sets are compared.
_BITS = 1024
#: Share of the hash range whose tokens are counted first, of all nodes.
SHARE = 0.3
#: Documents in groups up to this size are compared with each other, larger groups by centers.
SMALL_GROUP = 8
#: Centers of a group in the first round; four times as many in each that follows.
CENTERS = 16


def token_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    ids, counts = word_hashes(texts, lower=True)
    span = 1 << (words.bit_length() - 1)
    found = grams(ids, 1, span)
    for k in range(span, words):
        found = mix(found[: max(0, len(ids) - k)], ids[k:])
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(_unique(found[at : at + n - words + 1]))
        else:  # fewer words are one shingle
            whole = np.array([n], np.uint64)
            for k in range(at, at + n):
                whole = mix(whole, ids[k : k + 1])
            out.append(whole if n else ids[:0])
        at += n
    return out


def _unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def tokens(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return token_sets([text], words)[0]


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILAR) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def missing(n: int, percent: int = SIMILAR) -> int:
    """Of n tokens, how many a similar set can lack at most."""
    return n - -(-percent * n // 100)


def subclasses(size_class: int) -> int:
    """Into how many subclasses sets of 2**size_class tokens and more, up to twice as many, deal frequent tokens.

    Four tokens or more for each, so that a prefix always reaches its credit: a set of n tokens indexes for size classes up
    to 1.25 n, so it has 0.3125 n subclasses at most, each of which costs one token of n, and 0.6875 n is d + 1 at least
    from three tokens on. Sets of fewer than four have none."""
    return (1 << size_class) // 4


def signatures(found: np.ndarray, frequent: np.ndarray, percent: int = SIMILAR) -> np.ndarray:
    """Hashes of the combinations that a set of sorted tokens indexes. `frequent`: the sorted frequent tokens."""
    n = len(found)
    need = missing(n, percent) + 1
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
        rare = found[~often]
    else:
        often, rare = None, found
    out = [rare[:need]]
    need -= len(out[0])
    if need > 0:
        for size_class in range(max(0, (percent * n // 100).bit_length() - 1), (-(-100 * n // percent)).bit_length()):
            out.append(_pairs(found[often], subclasses(size_class), size_class, need))
    return np.unique(np.concatenate(out)) if len(out) > 1 else out[0]


def _pairs(often: np.ndarray, kinds: int, size_class: int, need: int) -> np.ndarray:
    if not kinds:  # small sets index frequent tokens one by one, too
        return often[:need]
    kind = (mix(often, np.full(len(often), size_class, np.uint64)) % np.uint64(kinds)).astype(np.int64)
    order = np.lexsort((often, kind))
    often, kind = often[order], kind[order]
    out = []
    for part in np.split(often, np.flatnonzero(np.diff(kind)) + 1):
        if need <= 0:
            break
        part = part[: need + 1]
        need -= len(part) - 1
        i, j = np.triu_indices(len(part), 1)
        out.append(mix(mix(part[i], part[j]), np.full(len(i), size_class, np.uint64)))
    return np.concatenate(out) if out else often[:0]


def node_of(found: np.ndarray) -> int:
    """The name of a set."""
    return xxhash.xxh3_64_intdigest(found.tobytes())


COUNTED = "block long, kind int, rid long, doc_id long, n long, used long, node long, tokens binary, nodes binary"
_COUNTED = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in COUNTED.split(", ")])
#: Kinds of rows: tokens of nodes, sets of documents, how many tokens of a node others have, frequent tokens.
_TOKENS, _SET, _COMMON, _OFTEN = 0, 1, 2, 3


def _rows(kind: int, count: int, /, **columns) -> pa.RecordBatch:
    """`count` rows of COUNTED; columns that aren't given are null."""
    columns["kind"] = np.full(count, kind, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in _COUNTED], schema=_COUNTED)


def _split(block: np.ndarray, *arrays: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Arrays that are sorted by block, cut at blocks."""
    cuts = np.flatnonzero(np.diff(block)) + 1
    return block[np.append(0, cuts)], [[x.tobytes() for x in np.split(a, cuts)] for a in arrays]


def _dealt(names: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Which block each name goes to, and the order by block."""
    block = ((names ^ (names >> np.uint64(32))) % np.uint64(blocks)).astype(np.int32)
    return block, np.argsort(block, kind="stable")


def _counted_tokens(docs: DataFrame, words: int, share: float, blocks: int, frequent_from: int | None) -> DataFrame:
    """COUNTED rows of the kinds _SET, _COMMON and, from so many nodes on, _OFTEN, of docs(rid, doc_id, text)."""
    bound = np.uint64(min(int(share * 2**64), 2**64 - 1))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = token_sets(bytes_of(batch["text"]), words)
            names = np.array([node_of(x) for x in found], np.uint64)
            used = [x[: np.searchsorted(x, bound, "right")] for x in found]
            yield _rows(_SET, len(found), block=(names % np.uint64(blocks)).astype(np.int64), rid=batch["rid"], doc_id=batch["doc_id"], n=[len(x) for x in found], used=[len(x) for x in used], node=names.view(np.int64))
            once = [x for name, x in dict(zip(names.tolist(), used)).items() if len(x)]
            if once:
                token = np.concatenate(once)
                node = np.repeat(np.array([name for name, x in dict(zip(names.tolist(), used)).items() if len(x)], np.uint64), [len(x) for x in once])
                block, order = _dealt(token, blocks)
                where, (some, whose) = _split(block[order], token[order], node[order])
                yield _rows(_TOKENS, len(where), block=where.astype(np.int64), tokens=some, nodes=whose)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            is_set = batch.filter(pa.array(batch["kind"].to_numpy() == _SET))
            if is_set.num_rows:
                yield is_set
            rest = batch.filter(pa.array(batch["kind"].to_numpy() == _TOKENS))
            for block, some, whose in zip(*(rest[c].to_pylist() for c in ("block", "tokens", "nodes"))):
                if block != last and held:
                    yield from flush(held)
                    held = []
                last = block
                held.append((some, whose))
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        token, node = (np.frombuffer(b"".join([h[k] for h in held]), np.uint64) for k in (0, 1))
        token, node = _distinct(token, node)
        starts = np.flatnonzero(np.diff(token, prepend=token[:1] ^ np.uint64(1)))
        sizes = np.diff(starts, append=len(token))
        names, common = np.unique(node[np.repeat(sizes, sizes) > 1], return_counts=True)
        if len(names):
            block, order = _dealt(names, blocks)
            where, (some, times) = _split(block[order], names[order], common[order].astype(np.uint32))
            yield _rows(_COMMON, len(where), block=where.astype(np.int64), nodes=some, tokens=times)
        if frequent_from is not None:
            often = sizes >= frequent_from
            if often.any():
                yield _rows(_OFTEN, int(often.sum()), node=token[starts[often]].view(np.int64), n=sizes[often])

    dealt = docs.select("rid", "doc_id", "text").mapInArrow(deal, COUNTED).repartition(F.col("block")).sortWithinPartitions("block")
    return dealt.mapInArrow(count, COUNTED)


def _distinct(first: np.ndarray, second: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct pairs, and what goes with them."""
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    one = np.ones(len(first), bool)
    one[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return first[one], second[one], *(x[order][one] for x in more)


def _common(counted: DataFrame) -> DataFrame:
    """(node, common): how many of a node's tokens others have, too, from the parts that blocks of tokens have counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for block, some, times in zip(*(batch[c].to_pylist() for c in ("block", "nodes", "tokens"))):
                if block != last and held:
                    yield flush(held)
                    held = []
                last = block
                held.append((some, times))
        if held:
            yield flush(held)

    def flush(held: list) -> pa.RecordBatch:
        node, which = np.unique(np.frombuffer(b"".join([h[0] for h in held]), np.int64), return_inverse=True)
        common = np.bincount(which, np.frombuffer(b"".join([h[1] for h in held]), np.uint32), len(node)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(common)], ["node", "common"])

    parts = counted.where(F.col("kind") == _COMMON).select("block", "nodes", "tokens")
    return parts.repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(run, "node long, common long")


def _possible(counted: DataFrame, percent: int) -> DataFrame:
    """(node, rep, n, shared) of nodes that don't have more tokens of their own than a similar set can lack; `shared`: how
    many tokens others may have, too."""
    nodes = counted.where((F.col("kind") == _SET) & (F.col("n") > 0)).groupBy("node").agg(F.min("rid").alias("rep"), F.max("n").alias("n"), F.max("used").alias("used"))
    common = _common(counted)
    lacking = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100)
    shared = F.coalesce("common", F.lit(0))
    return nodes.join(common, "node", "left").where(F.col("used") - shared <= lacking).select("node", "rep", "n", (F.col("n") - F.col("used") + shared).alias("shared"))


def _index(texts: DataFrame, frequent: np.ndarray, words: int, percent: int, blocks: int) -> DataFrame:
    """(block, sigs, nodes, sizes, shared): combinations and whose they are, dealt into blocks by combination, many in a row."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in slices(batches):
            found = token_sets(bytes_of(batch["text"]), words)
            sigs = [signatures(x, often, percent) for x in found]
            if not found:
                continue
            sig, lengths = np.concatenate(sigs), [len(x) for x in sigs]
            node = np.repeat(batch["node"].to_numpy(zero_copy_only=False), lengths)
            size = np.repeat(np.array([len(x) for x in found], np.int64), lengths)
            common = np.repeat(batch["shared"].to_numpy(zero_copy_only=False), lengths)
            block = ((sig >> np.uint64(16)) % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            where, parts = _split(block[order], sig[order], node[order], size[order], common[order])
            yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int64)), *(pa.array(x, pa.binary()) for x in parts)], ["block", "sigs", "nodes", "sizes", "shared"])

    return texts.select("node", "shared", "text").mapInArrow(run, "block long, sigs binary, nodes binary, sizes binary, shared binary")


GROUPED = "gid long, a long, b long, n long, shared long"


def _near(n, m, shared_n, shared_m, percent: int, least):
    """Whether sets of n and m tokens can be similar: what they have in common is no more than either shares with any."""
    # both / (n + m - both) >= percent / 100
    return (100 + percent) * least(shared_n, shared_m) >= percent * (n + m)


def _groups(index: DataFrame, percent: int) -> DataFrame:
    """Rows of two kinds: candidate pairs (a, b), and members of large groups (gid, a, n)."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in GROUPED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for block, *parts in zip(*(batch[c].to_pylist() for c in ("block", "sigs", "nodes", "sizes", "shared"))):
                if block != last and held:
                    yield from flush(held)
                    held = []
                last = block
                held.append(parts)
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        sig, node, size, common = (np.frombuffer(b"".join([h[k] for h in held]), kind) for k, kind in enumerate((np.uint64, np.int64, np.int64, np.int64)))
        sig, node, size, common = _distinct(sig, node, size, common)
        starts = np.flatnonzero(np.diff(sig, prepend=sig[:1] ^ np.uint64(1)))
        sizes = np.diff(starts, append=len(sig))
        left, right = [], []
        for n in range(2, SMALL_GROUP + 1):
            at = starts[sizes == n]
            for i in range(n):
                for j in range(i + 1, n):
                    left.append(at + i)
                    right.append(at + j)
        large = np.flatnonzero(sizes > SMALL_GROUP)
        own = size - common
        for g in large:  # a star around the member with fewest tokens of its own: of copies with changes, what they copy
            here = np.arange(starts[g], starts[g] + sizes[g])
            center = here[own[here].argmin()]
            left.append(np.full(len(here) - 1, center))
            right.append(here[here != center])
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            near = _near(size[a], size[b], common[a], common[b], percent, np.minimum)
            both = np.unique(np.sort(np.stack([node[a[near]], node[b[near]]], 1), 1), axis=0)
            none = pa.nulls(len(both), pa.int64())
            yield pa.RecordBatch.from_arrays([none, *(pa.array(np.ascontiguousarray(both[:, k])) for k in (0, 1)), none, none], schema=schema)
        seen: set[bytes] = set()
        for g in large:  # groups of the same members are one
            members = node[starts[g] : starts[g] + sizes[g]]
            if (name := xxhash.xxh3_64_digest(members.tobytes())) not in seen:
                seen.add(name)
                gid = np.full(len(members), int.from_bytes(name, "little", signed=True))
                yield pa.RecordBatch.from_arrays([pa.array(gid), pa.array(members), pa.nulls(len(members), pa.int64()), *(pa.array(x[starts[g] : starts[g] + sizes[g]]) for x in (size, common))], schema=schema)

    return index.mapInArrow(run, GROUPED)


def _maps(texts: DataFrame, words: int) -> DataFrame:
    """(node, map): which of _BITS equal parts of the hash range a node's tokens fall into, a bit each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.zeros((batch.num_rows, _BITS), bool)
            for row, found in zip(rows, token_sets(bytes_of(batch["text"]), words)):
                row[((found >> np.uint64(32)).astype(np.int64) * _BITS) >> 32] = True
            packed = np.packbits(rows, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array([x.tobytes() for x in packed], pa.binary())], ["node", "map"])

    return texts.select("node", "text").mapInArrow(run, "node long, map binary")


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first = None, None
        for batch in batches:
            kept = []
            for a, x, y in zip(batch["a"].to_pylist(), batch["x"].to_pylist(), bytes_of(batch["y"])):
                if a != name:
                    name, first = a, tokens(x.encode(), words)
                kept.append(similar(first, tokens(y, words), percent))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def connect(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, comp) of every node of links(a, b): comp is the least node that links reach.

    Components hook onto their least neighbour and names are then shortened by jumps, so the number of rounds grows with
    the logarithm of the longest chain. Each round writes its new names and the edges left, contracted and distinct.
    """
    comps = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("comp", F.col("node"))
    edges, k = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), 0
    while True:
        k += 1
        edges = scratch.table(edges, f"{name}_edges{k}")
        if not edges.take(1):
            return comps
        hooks = edges.groupBy(F.col("b").alias("old")).agg(F.min("a").alias("new"))
        for _ in range(2):  # on to the least neighbour's least neighbour, and so on
            on = hooks.select(F.col("old").alias("new"), F.col("new").alias("further"))
            hooks = hooks.join(on, "new", "left").select("old", F.coalesce("further", "new").alias("new"))
        hooks = scratch.table(hooks, f"{name}_hooks{k}")
        to = lambda c, out: hooks.select(F.col("old").alias(c), F.col("new").alias(out))
        comps = comps.join(to("comp", "new"), "comp", "left").select("node", F.coalesce("new", "comp").alias("comp"))
        moved = edges.join(to("a", "x"), "a", "left").join(to("b", "y"), "b", "left").select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
        edges = moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(docs: DataFrame, words: int = WORDS, percent: int = SIMILAR, scratch: Scratch | None = None) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, comp) of each row of docs(doc_id, text).

    A set is the distinct shingles of `words` words, lower-cased A-Z; with fewer words, their sequence is the one
    shingle. Texts that are null or without words have no shingles, link with nothing and are their own component, under
    their own doc_id. Others link when they share `percent` of their union at least; component_id is the least doc_id
    that links reach (null only if all of them are), and may be that of two components where ids repeat; comp is the
    component's own name, null where there are no shingles. Repeated rows link with each other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows = keyed(docs)
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = scratch.table(_counted_tokens(rows, words, SHARE, blocks, None), "counted")
    sets = counted.where(F.col("kind") == _SET).select("rid", "doc_id", "n", "node")
    possible = _possible(counted, percent)
    texts = scratch.table(rows.join(possible.select("node", "rep", "n"), rows["rid"] == F.col("rep")).select(F.col("node").alias("rid"), F.col("n").alias("doc_id"), "text"), "possible")
    counted = scratch.table(_counted_tokens(texts, words, 1.0, blocks, FREQUENT), "counted2")
    texts = scratch.table(texts.join(_possible(counted, percent).select("node", "n", "shared"), texts["rid"] == F.col("node")).select("node", "n", "shared", "text"), "texts")
    total = texts.agg(F.sum("n")).first()[0] or 0
    often = counted.where((F.col("kind") == _OFTEN) & (F.col("n") >= -(-total // MOST_FREQUENT))).select("node").toArrow()["node"]
    frequent = np.sort(often.to_numpy().view(np.uint64)) if len(often) else np.zeros(0, np.uint64)
    dealt = _index(texts, frequent, words, percent, 4 * blocks).repartition(F.col("block")).sortWithinPartitions("block")
    grouped = scratch.table(_groups(dealt, percent), "grouped")
    tried = scratch.table(grouped.where("gid is null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tried0")
    members = grouped.where("gid is not null").select("gid", F.col("a").alias("node"), "n", "shared").distinct()
    maps = scratch.table(_maps(texts, words), "maps")
    links = scratch.table(_verify(tried, texts, words, percent), "links0")
    comps = scratch.table(connect(links, scratch), "comps0")
    k, centers, done = 0, CENTERS, members.select("gid", "node").limit(0)
    while True:
        k += 1
        chosen, pairs = _more_pairs(members, comps, maps, done, centers, percent, scratch, k)
        if not chosen.take(1):
            break
        pairs = scratch.table(pairs, f"pairs{k}")  # distinct before the join, not after
        more = scratch.table(pairs.join(tried, ["a", "b"], "left_anti"), f"more{k}")
        found = scratch.table(_verify(more, texts, words, percent), f"links{k}")
        done, tried = done.unionByName(chosen), tried.unionByName(more)
        if found.take(1):
            links = links.unionByName(found)
            comps = scratch.table(connect(links, scratch, f"cc{k}"), f"comps{k}")
        centers *= 4
    placed = scratch.table(sets.join(comps, "node", "left").select("rid", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("comp", "node")).alias("comp")), "placed")
    least = scratch.table(placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    inside = placed.where("comp is not null").join(least, "comp").select("rid", "doc_id", "n_shingles", "component_id", "comp")
    return inside.unionByName(placed.where("comp is null").select("rid", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "comp"))


OPEN = "gid long, node long, n long, shared long, comp long, top long, was boolean, map binary"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(gid, columns of its members) of OPEN rows sorted by gid."""
    names = [c.split()[0] for c in OPEN.split(", ")][1:]
    last, held = None, []

    def columns() -> dict[str, np.ndarray]:
        found = {c: np.concatenate([h[c].to_numpy(zero_copy_only=False) for h in held]) for c in names if c != "map"}
        return found | {"map": np.frombuffer(b"".join([x for h in held for x in h["map"].to_pylist()]), np.uint64).reshape(-1, _BITS // 64)}

    for batch in batches:
        gid = batch["gid"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(gid)) + 1).tolist(), len(gid)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                if gid[a] != last and held:
                    yield last, columns()
                    held = []
                last = int(gid[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield last, columns()


def _centers(group: dict[str, np.ndarray], centers: int) -> np.ndarray:
    """Places of members outside the group's largest component that weren't centers yet: those with fewest tokens of their own."""
    outside = np.flatnonzero((group["comp"] != group["top"]) & ~group["was"])
    own = group["n"][outside] - group["shared"][outside]
    return outside[np.lexsort((group["node"][outside], own))][:centers]


def _possible_partners(group: dict[str, np.ndarray], center: int, percent: int) -> np.ndarray:
    """Places of members of other components that may be similar to the center, by what sizes and maps tell."""
    n, shared, comp = group["n"], group["shared"], group["comp"]
    others = np.flatnonzero((comp != comp[center]) & _near(n[center], n, shared[center], shared, percent, np.minimum))
    mine, theirs = group["map"][center], group["map"][others]
    # each part of the hash range that only one of two has tokens in is a token that the other lacks
    most = np.minimum(n[center] - np.bitwise_count(mine & ~theirs).sum(1), n[others] - np.bitwise_count(theirs & ~mine).sum(1))
    return others[(100 + percent) * most >= percent * (n[center] + n[others])]


#: Memberships of groups with one largest component that a task takes, about.
_TASK = 20_000


def _more_pairs(members: DataFrame, comps: DataFrame, maps: DataFrame, done: DataFrame, centers: int, percent: int, scratch: Scratch, k: int) -> tuple[DataFrame, DataFrame]:
    """(gid, node) of new centers, in groups that aren't settled, and their pairs (a, b) with members of other components.

    Groups overlap, as similar nodes share many combinations. Those with the same largest component go to the same tasks,
    which form a pair once, however many of their groups have it; how many tasks grows with their members."""
    at = members.join(comps, "node", "left").select("gid", "node", "n", "shared", F.coalesce("comp", "node").alias("comp"))
    sizes = at.groupBy("gid", "comp").agg(F.count("*").alias("c"))
    tops = sizes.groupBy("gid").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.count("*").alias("comps"), F.sum("c").alias("c")).where("comps > 1")
    tops = scratch.table(tops.select("gid", "top", "c"), f"tops{k}")
    tasks = tops.groupBy("top").agg(F.ceil(F.sum("c") / _TASK).alias("tasks"))
    tops = tops.join(tasks, "top").select("gid", "top", F.pmod(F.xxhash64("gid"), "tasks").alias("task"))
    before = done.withColumn("was", F.lit(True))
    opened = at.join(tops, "gid").join(before, ["gid", "node"], "left").join(maps, "node").withColumn("was", F.coalesce("was", F.lit(False)))
    names = [c.split()[0] for c in OPEN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, held = [], [], 0
        for gid, group in _members(batches):
            chosen = _centers(group, centers)
            yield rows(np.full(len(chosen), gid), group["node"][chosen], True)
            for c in chosen:
                others = group["node"][_possible_partners(group, c, percent)]
                left.append(np.minimum(others, group["node"][c]))
                right.append(np.maximum(others, group["node"][c]))
                held += len(others)
            if held > 1_000_000:
                left, right = ([x] for x in _distinct(np.concatenate(left), np.concatenate(right)))
                if len(left[0]) > 500_000:
                    yield rows(left[0], right[0], False)
                    left, right = [], []
                held = sum(map(len, left))
        if left:
            yield rows(*_distinct(np.concatenate(left), np.concatenate(right)), False)

    def rows(a: np.ndarray, b: np.ndarray, is_center: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), is_center))], ["a", "b", "is_center"])

    found = opened.repartition("top", "task").sortWithinPartitions("gid").select(*names).mapInArrow(run, "a long, b long, is_center boolean")
    found = scratch.table(found, f"found{k}")
    return found.where("is_center").select(F.col("a").alias("gid"), F.col("b").alias("node")), found.where("not is_center").select("a", "b").distinct()


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = SIMILAR, scratch: Scratch | None = None) -> DataFrame:
    """docs with one row of each component: of those with the least doc_id (null is the smallest), the first in the scan. All columns."""
    scratch = scratch or Scratch(docs.sparkSession)
    found = scratch.table(components(docs, words, percent, scratch), "components")
    first = found.where("comp is not null").groupBy("comp").agg(F.min(F.struct("doc_id", "rid")).getField("rid").alias("first"), F.count("*").alias("c"))
    first = scratch.table(first.where("c > 1"), "first")
    rid = fresh(docs)
    dropped = found.join(first, "comp").where("rid <> first").select(F.col("rid").alias(rid))
    return docs.withColumn(rid, row_number(docs)).join(dropped, rid, "left_anti").drop(rid)
