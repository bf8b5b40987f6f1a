"""Merkle dataset manifest: digests of rows, a tree for each language, one root, and a proof for each row.

A leaf's digest is computed where the row is read, so that texts don't travel. Leaves are put in order by a range sort and
numbered from counts of its ranges. BLOCK of them, LEVELS levels of RUN children, form a block: consecutive, aligned, and
of bounded size, whichever language it is from. A block arrives at an executor as an Arrow table, on which DuckDB runs
its levels: string_agg in order, then sha256. The roots of blocks are nodes of the next round, LEVELS levels higher, until a language
has one; the languages' roots go through the same rounds to the dataset's root.

Proofs go the other way. A node's path is what stands before and after it in its run, level by level; that of a block's
root, found a round higher, continues the paths of all its nodes, and meets them in a cogroup. The last such step has the
leaves and folds them, changed ones in their changed form, up to the root.

Nulls and odd tables: a null value is `-`, and the null language comes first. Null ids come before others and are never
tampered with; rows with one id and language are ordered by their digests, and so equal rows have equal proofs up to
their place. Ids keep their type and order. A table of one row has its leaf for a root and the digest of nothing for a
proof; an empty one gives no rows. Only the five columns named in COLUMNS are read.
"""

from __future__ import annotations

from collections.abc import Callable

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirbook.llm.common import Scratch, held

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The manifest's runs, and levels a block: blocks have RUN ** LEVELS nodes at most.
RUN, LEVELS = 8, 4
#: One row in this many, by crc32 of its id, is tampered with.
TAMPERED = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_KEY = "lang string, block long"
_PATH = "befores array<string>, afters array<string>, subroot string, root string"


def digest(*values: Column) -> Column:
    """H of values, each `-` if null, or else its length in bytes, a colon and itself."""
    marked = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, digest, changed): the digest of each row and of what it is after tampering."""
    row = {c: docs[c] for c in COLUMNS}
    picked = F.crc32(row["doc_id"].cast("string").cast("binary")) % TAMPERED == 0
    other = row | {"text": F.translate(row["text"].cast("string"), _UPPER, _LOWER)}
    own = digest(*row.values())
    return docs.select(row["doc_id"], row["lang"].cast("string").alias("lang"), own.alias("digest"), F.when(picked, digest(*other.values())).alias("changed"))


def placed(nodes: DataFrame, order: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """nodes(lang, ...), written in order, with their places from 0 and number n within their language. The null language is one, too.

    The rows are written once, as places come from counts of their ranges: read again, they have the same numbers."""
    by = [F.col("lang").asc_nulls_first(), *order]
    rows = scratch.table(nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("id", F.monotonically_increasing_id()), name)
    part = F.shiftright("id", 33)
    counts = rows.groupBy("lang", part.alias("of_part")).agg(F.count("*").alias("c"), F.min("id").alias("first"))
    before = Window.partitionBy("lang").orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("lang").alias("of_lang"), "of_part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("base"), F.sum("c").over(Window.partitionBy("lang")).alias("n"))
    joined = rows.join(counts, (part == F.col("of_part")) & F.col("lang").eqNullSafe(F.col("of_lang")))
    return joined.withColumn("place", F.col("id") + F.col("base")).drop("id", "base", "of_lang", "of_part")


def _engine() -> duckdb.DuckDBPyConnection:
    return held("duckdb", lambda: duckdb.connect(config={"threads": 1, "memory_limit": "256MB"}))


def _levels(con: duckdb.DuckDBPyConnection, nodes: pa.Table, size: int) -> int:
    """Tables level0 (slot, digest), level1, ... of a block, as many as its language needs; the number of levels above 0."""
    con.register("nodes", nodes.select(["place", "digest"]))
    con.execute(f"CREATE OR REPLACE TEMP TABLE level0 AS SELECT place % {size} AS slot, digest FROM nodes")
    con.unregister("nodes")
    up, width = 0, min(size, nodes["n"][0].as_py())
    while width > 1:
        con.execute(f"CREATE OR REPLACE TEMP TABLE level{up + 1} AS SELECT slot // {RUN} AS slot, sha256(string_agg(digest, '' ORDER BY slot)) AS digest FROM level{up} GROUP BY slot // {RUN}")
        up, width = up + 1, -(-width // RUN)
    return up


def block_root(nodes: pa.Table, size: int) -> pa.Table:
    """(lang, place, n, digest): a block's root as a node of the next round."""
    lang, place, n = nodes["lang"][0].as_py(), nodes["place"][0].as_py() // size, nodes["n"][0].as_py()
    con = _engine()
    up = _levels(con, nodes, size)
    root = con.execute(f"SELECT digest FROM level{up}").fetchall()
    return pa.table({"lang": pa.array([lang], pa.string()), "place": pa.array([place], pa.int64()), "n": pa.array([-(-n // size)], pa.int64()), "digest": pa.array([root[0][0]], pa.string())})


def _sides(con: duckdb.DuckDBPyConnection, up: int) -> str:
    """Tables with what stands before and after each node in its run; the joins from a block's lowest nodes upwards."""
    for k in range(up):
        run = f"PARTITION BY slot // {RUN} ORDER BY slot ROWS BETWEEN"
        con.execute(
            f"CREATE OR REPLACE TEMP TABLE side{k} AS SELECT slot, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
            f"coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM level{k}"
        )
    return "level0 " + " ".join(f"JOIN side{k} ON side{k}.slot = level0.slot // {RUN**k}" for k in range(up))


def _outer(upper: pa.Table) -> tuple[list[str], list[str], str, str]:
    row = upper.slice(0, 1).to_pylist()[0]
    return row["befores"], row["afters"], row["subroot"], row["root"]


def paths(nodes: pa.Table, upper: pa.Table, size: int) -> pa.Table:
    """(lang, block, path) of a block's nodes, which are blocks of the round below; `upper`: the path of the block's root."""
    befores, afters, subroot, root = _outer(upper)
    con = _engine()
    up = _levels(con, nodes, size)
    joined = _sides(con, up)
    own = [f"[{', '.join(f'side{k}.{x}' for k in range(up))}]::VARCHAR[]" for x in "ba"]
    found = con.execute(f"SELECT list_concat({own[0]}, ?::VARCHAR[]), list_concat({own[1]}, ?::VARCHAR[]) FROM {joined} ORDER BY level0.slot", [befores, afters]).fetchall()
    nodes = nodes.sort_by("place")
    n, listed = nodes.num_rows, pa.list_(pa.string())
    columns = [nodes["lang"].cast(pa.string()), nodes["place"].cast(pa.int64()), pa.array([r[0] for r in found], listed), pa.array([r[1] for r in found], listed), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string())]
    return pa.table(columns, names=["lang", "block", "befores", "afters", "subroot", "root"])


def proofs(nodes: pa.Table, upper: pa.Table, size: int) -> pa.Table:
    """What is told about each leaf of a block: its proof's digest and the root that its present form folds up to."""
    befores, afters, subroot, root = _outer(upper)
    con = _engine()
    up = _levels(con, nodes, size)
    joined = _sides(con, up)
    con.register("present", nodes.select(["place", "changed"]))
    sides = [(f"side{k}.b", f"side{k}.a") for k in range(up)] + [(f"'{b}'", f"'{a}'") for b, a in zip(befores, afters)]
    folded = "coalesce(changed, digest)"
    for b, a in sides:
        folded = f"sha256({b} || {folded} || {a})"
    proof = " || ".join(f"{b} || {a}" for b, a in sides) or "''"
    found = con.execute(f"SELECT sha256({proof}), {folded} FROM {joined} JOIN present ON place % {size} = level0.slot ORDER BY level0.slot").fetchall()
    con.unregister("present")
    nodes = nodes.sort_by("place")
    n, text = nodes.num_rows, pa.string()
    columns = [nodes["doc_id"], nodes["digest"].cast(text), pa.array([subroot] * n, text), pa.array([root] * n, text), *(pa.array([r[i] for r in found], text) for i in (0, 1)), pa.array([r[1] == root for r in found], pa.bool_())]
    return pa.table(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def climb(nodes: DataFrame, size: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """nodes(lang, place, n, digest) and the tables above it, the last with one node a language."""
    tables, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        by_block = tables[-1].select("lang", "place", "n", "digest").groupBy("lang", F.expr(f"place div {size}").alias("block"))
        roots = by_block.applyInArrow(lambda table: block_root(table, size), "lang string, place long, n long, digest string")
        tables.append(scratch.table(roots, f"{name}{len(tables)}"))
        most = -(-most // size)
        if most <= 1:
            return tables


def _meet(nodes: DataFrame, upper: DataFrame, size: int, use: Callable, schema: str) -> DataFrame:
    lower = nodes.groupBy("lang", F.expr(f"place div {size}").alias("block"))
    return lower.cogroup(upper.groupBy("lang", "block")).applyInArrow(lambda a, b: use(a, b, size), schema)


def manifest(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    scratch, size = scratch or Scratch(docs.sparkSession), RUN**LEVELS
    compact = scratch.table(leaves(docs), "leaves")
    rows = placed(compact, [F.col("doc_id").asc_nulls_first(), F.col("digest")], scratch, "ordered")
    scratch.drop("leaves")
    rounds = climb(rows, size, scratch, "round")
    langs = placed(rounds[-1].select(F.lit("").alias("lang"), F.col("lang").alias("of"), "digest"), [F.col("of").asc_nulls_first()], scratch, "langs")
    top = climb(langs, size, scratch, "top")
    whole = top[-1].first()
    root = whole["digest"] if whole else ""
    none = F.array().cast("array<string>")
    path = top[-1].select("lang", F.col("place").alias("block"), none.alias("befores"), none.alias("afters"), F.lit("").alias("subroot"), F.lit(root).alias("root"))
    for k in range(len(top) - 2, -1, -1):
        path = scratch.table(_meet(top[k].select("lang", "place", "n", "digest"), path, size, paths, f"{_KEY}, {_PATH}"), f"top_path{k}")
    of_lang = path.join(langs.select("place", "of", "digest"), path["block"] == F.col("place"))
    path = of_lang.select(F.col("of").alias("lang"), F.lit(0).cast("long").alias("block"), "befores", "afters", F.col("digest").alias("subroot"), "root")
    for k in range(len(rounds) - 2, 0, -1):
        path = scratch.table(_meet(rounds[k], path, size, paths, f"{_KEY}, {_PATH}"), f"path{k}")
    kind = compact.schema["doc_id"].dataType.simpleString()
    return _meet(rows, path, size, proofs, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
