"""Exact dedup by deterministic block naming.

Texts are cut into fixed-size blocks of UTF-8 bytes. The distinct blocks are sorted and numbered: equal blocks, and only
those, share an integer name. Then neighbouring names are paired, the distinct pairs sorted and numbered, and so on until
each document has one name. Two documents are equal exactly when byte length and last name are equal. A 64-bit hash only
deals the blocks out; blocks that share a hash are told apart by their bytes, so no collision can join two texts.

All of it is DataFrame operations. Distinct blocks are combined before they are shuffled, and occurrences look names up
by an equi-join that adaptive execution can split, so a block that a third of the documents share lands in no single task.
Each level of names is written to the shared folder, where a lost executor finds it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirbook.llm.common import Scratch, fresh, keyed, row_number

BLOCK = 4096


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """(rid, i, h, block) of each fixed-size block; an empty text is one empty block."""
    data = F.encode("text", "UTF-8")
    parts = docs.select("rid", data.alias("data")).select(
        "rid", F.posexplode(F.expr(f"transform(sequence(0, greatest(length(data) - 1, 0) div {block}), k -> substring(data, cast(k as int) * {block} + 1, {block}))")).alias("i", "block")
    )
    return parts.select("rid", "i", F.xxhash64("block").alias("h"), "block")


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Integer names in sort order within each partition of a table that is already dealt out by `keys`."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """(rid, n_bytes, name) of keyed documents (rid, ..., text): equal (n_bytes, name) means equal texts."""
    scratch = scratch or Scratch(docs.sparkSession)
    blocks = _blocks(docs, block)
    # sets of the blocks with one hash: combined on each side of the shuffle, and of one block each but for collisions
    sets = blocks.groupBy("h").agg(F.collect_set("block").alias("blocks"))
    each = sets.select("h", (F.size("blocks") > 1).alias("shared"), F.explode("blocks").alias("block"))
    names = scratch.table(_numbered(each, "h", "block").select("h", "name", F.when(F.col("shared"), F.col("block")).alias("block")), "names0")
    shared = names.where("block is not null")
    level = blocks.select("rid", "i", "h").join(names.where("block is null").select("h", "name"), "h").select("rid", "i", "name")
    if shared.take(1):
        level = level.unionByName(blocks.join(shared, ["h", "block"]).select("rid", "i", "name"))
    level = scratch.table(level, "level0")
    sizes = scratch.table(level.groupBy("rid").agg(F.count("*").alias("n")), "sizes0")
    most = sizes.agg(F.max("n")).first()[0] or 1
    done, k = [level.where("i = 0").join(sizes.where("n = 1").select("rid"), "rid", "left_semi").select("rid", "name")], 0
    level = level.join(sizes.where("n > 1").select("rid", "n"), "rid")
    while most > 1:
        k += 1
        side = lambda odd: F.max(F.when(F.col("i") % 2 == odd, F.col("name")))
        pairs = scratch.table(level.groupBy("rid", "n", F.floor(F.col("i") / 2).alias("j")).agg(side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b")), f"pairs{k}")
        names = scratch.table(_numbered(pairs.select("a", "b").distinct(), "a", "b"), f"names{k}")
        level = scratch.table(pairs.join(names, ["a", "b"]).select("rid", F.ceil(F.col("n") / 2).alias("n"), F.col("j").alias("i"), "name"), f"level{k}")
        done.append(level.where("n = 1").select("rid", "name"))
        level, most = level.where("n > 1"), -(-most // 2)
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return docs.select("rid", F.octet_length("text").alias("n_bytes")).join(named, "rid")


def exact_groups(docs: DataFrame, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """(rid, doc_id, keep_id, group_size, kept, text_sha256) of each row of docs(doc_id, text).

    Texts are equal when identical byte by byte; null counts as the empty text. Of equal texts the row with the largest
    doc_id stays (null is the smallest); of rows that share that too, the last in the scan, so one row is kept of each
    group. keep_id is its doc_id. An empty table gives no rows. Only doc_id and text are read.
    """
    rows, scratch = keyed(docs), scratch or Scratch(docs.sparkSession)
    named = identities(rows, block, scratch)
    ids = rows.select("rid", "doc_id", F.sha2("text", 256).alias("text_sha256")).join(named, "rid")
    groups = ids.groupBy("n_bytes", "name").agg(F.max(F.struct("doc_id", "rid")).alias("last"), F.count("*").alias("group_size"))
    groups = scratch.table(groups, "groups")  # so that the join can be split where a group is large
    return ids.join(groups, ["n_bytes", "name"]).select("rid", "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("last.rid")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """docs without the rows whose text another row keeps, with all columns, whatever their names.

    Null counts as the empty text, so of all null and empty texts one row stays; ties of doc_id are told apart as in
    exact_groups(). An empty table stays empty.
    """
    rid = fresh(docs)
    dropped = exact_groups(docs, scratch=scratch).where("not kept").select(F.col("rid").alias(rid))
    return docs.withColumn(rid, row_number(docs)).join(dropped, rid, "left_anti").drop(rid)
