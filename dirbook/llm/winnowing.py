r"""Document fingerprints by winnowing, in column functions only.

A text is read as words of `[^\x20\x09-\x0D]`, of which those longer than PIECE code points are cut into pieces from
their start, so that scripts without spaces have pieces, too. Every GRAM consecutive words are hashed; of every WINDOW
consecutive hashes the least is selected, of equal ones the rightmost, and its place is kept. So any stretch of
GRAM + WINDOW - 1 words that two texts share gives both a common entry, wherever it stands. A text with fewer words is
one gram, one with fewer grams one window.

A print is an array of whole numbers, one for each selected gram: 32 bits of its hash, times 2^31, less its place. Their
least is the least hash with the rightmost place, so that a window's choice is one least(). Windows of a power of two
grow by halves. All this happens within a row, one lambda a word and step; memory goes with the row's own text. A text's
words are sought in stretches of CHUNK code points, which also end words.

Neighbours by id need an order over the whole table, but no task that sees all of it. Ranges of ids are found on keys
alone (ids and hashes of texts); then each row goes to its range, once, together with a copy of the next range's first
row. Within a range, lead() finds the next document.

Nulls and odd tables: null texts are empty and have an empty print. Null ids come last. Rows with one id are ordered by
their texts' hashes, then by their texts; of equal rows, which one comes first makes no difference. A table of one row
is its own neighbour, an empty one gives no rows. Only the columns doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirbook.llm.common import Scratch

GRAM, WINDOW, PIECE = 5, 8, 12
CHUNK = 1 << 16
#: Bytes of text a range, and the most ranges, whose first keys the driver holds.
RANGE_BYTES, MOST_RANGES = 16 << 20, 16_384
_PLACES = (1 << 31) - 1
_HASH = (_PLACES << 32 | 0xFFFFFFFF) & ~_PLACES


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often it is used, within lambdas as well."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}")
    stretches = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / CHUNK).cast("int"), F.lit(1))
    of = lambda i: F.transform(F.regexp_extract_all(F.substring(text, i * CHUNK + 1, F.lit(CHUNK)), words, F.lit(0)), lambda w: F.xxhash64(w))
    return F.when(F.length(text) == 0, F.array().cast("array<bigint>")).otherwise(F.flatten(F.transform(stretches, of)))


def grams(words: Column) -> Column:
    """Hash and place of each gram as one number; those that would reach over the end are left out, but for the first."""
    last = F.greatest(F.size(words) - (GRAM - 1), F.lit(1))
    gram = lambda x, i: F.xxhash64(x, *[F.get(words, i + j) for j in range(1, GRAM)]).bitwiseAND(F.lit(_HASH)) - i
    return F.slice(F.transform(words, gram), F.lit(1), last)


def winnow(hashed: Column, width: int = WINDOW) -> Column:
    """The numbers that some window of `width` (a power of two) selects, in order; of fewer numbers, their least."""

    def widen(least: Column, have: int) -> Column:
        if have == width:
            return F.array_distinct(F.slice(least, F.lit(1), F.greatest(F.size(least) - (width - 1), F.lit(1))))
        return let(F.transform(least, lambda x, i: F.least(x, F.get(least, i + have))), lambda wider: widen(wider, 2 * have))

    return widen(hashed, 1)


def print_of(text: Column) -> Column:
    """The print of a text without nulls."""
    return let(word_hashes(text), lambda words: let(grams(words), lambda hashed: winnow(hashed)))


def hash_of(entry: Column) -> Column:
    return F.shiftright(entry + F.lit(_PLACES), 31)


def place_of(entry: Column) -> Column:
    return (entry + F.lit(_PLACES)).bitwiseAND(F.lit(_HASH)) - entry


def written(entries: Column) -> Column:
    """A print as text: hash in hex, a colon and the place in words, for each entry."""
    return F.array_join(F.transform(entries, lambda x: F.concat_ws(":", F.hex(hash_of(x)), place_of(x).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Common hashes of two prints by all their hashes; 1 where both are empty."""
    hashes = lambda entries: F.transform(entries, hash_of)
    return let(
        F.struct(hashes(a).alias("a"), hashes(b).alias("b")),
        lambda x: let(F.size(F.array_union(x["a"], x["b"])), lambda n: F.when(n == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x["a"], x["b"])) / n)),
    )


def _ranges(keys: DataFrame, scratch: Scratch) -> list:
    """The first key (doc_id, h) of each range of keys(doc_id, h, bytes), in descending order."""
    table = scratch.table(keys, "keys")
    total = table.agg(F.sum("bytes")).first()[0] or 0
    n = min(MOST_RANGES, max(1, -(-total // RANGE_BYTES)))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    ranged = table.repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("range")).agg(F.max(F.struct("doc_id", "h")).alias("first"))
    return [row["first"] for row in ranged.orderBy("range").collect()]


def _range_of(key: Column, firsts: list, kind: str) -> Column:
    """The number of the range that a key belongs to, sought among every STEP-th first key and then among STEP of them."""
    step = max(1, int(len(firsts) ** 0.5))
    bound = lambda some: F.array(*[F.struct(F.lit(x["doc_id"]).cast(kind).alias("doc_id"), F.lit(x["h"]).cast("long").alias("h")) for x in some])
    upto = lambda some: F.size(F.filter(some, lambda b: b >= key))
    coarse = F.greatest(upto(bound(firsts[::step])) - 1, F.lit(0)) * step
    return let(coarse, lambda c: F.greatest(c + upto(F.slice(bound(firsts), c + 1, F.lit(step))) - 1, F.lit(0)))


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text, print, next_text, next_print) of every row: its own and those of the next document by descending id;
    after the last comes the first."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    firsts = _ranges(rows.select("doc_id", "h", F.octet_length("text").cast("long").alias("bytes")), scratch)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if not firsts:
        return rows.select("doc_id", "text", print_of(F.col("text")).alias("print"), F.col("text").alias("next_text"), F.array().cast("array<bigint>").alias("next_print"))
    n = len(firsts)
    bounds = rows.sparkSession.createDataFrame([(i, x["h"], x["doc_id"]) for i, x in enumerate(firsts)], f"first_of int, first_h long, first_id {kind}")
    found = rows.join(F.broadcast(bounds), (F.col("h") == F.col("first_h")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    copies = found.groupBy("first_of").agg(F.max("text").alias("text"), F.first("doc_id").alias("doc_id"), F.first("h").alias("h"))
    copies = copies.select("doc_id", "text", "h", F.expr(f"pmod(first_of - 1, {n})").cast("int").alias("range"), F.lit(True).alias("copy"))
    dealt = rows.select("doc_id", "text", "h", _range_of(F.struct("doc_id", "h"), firsts, kind).cast("int").alias("range"), F.lit(False).alias("copy"))
    printed = dealt.unionByName(copies).repartitionById(n, "range").withColumn("print", print_of(F.col("text")))
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.col("h").desc(), F.col("text").desc())
    return printed.withColumns({"next_text": F.lead("text").over(order), "next_print": F.lead("print").over(order)}).where("not copy").drop("h", "range", "copy")


def fingerprints(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Prints of documents and of their edited texts, whose last third is taken from the next document by descending id."""
    rows = with_next(docs, scratch or Scratch(docs.sparkSession))
    n, third = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)))
    printed = edited.withColumn("edited_print", print_of(F.col("edited")))
    return printed.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("print")).alias("fingerprint"),
        written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
