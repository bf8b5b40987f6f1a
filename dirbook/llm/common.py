"""What the corpus operators share: row keys, shared scratch folders, word splitting and hashing.

Row keys. A document is one row of the input, whatever its doc_id: doc_id may be null or occur twice. Each
operator therefore numbers rows by their place in the scan (`rid`). So that this number is the same in every reading of
files, tables and checkpoints, the first operator fixes the session's spark.sql.files.minPartitionNum: otherwise Spark
splits files by the cores registered at that moment, and rows would change numbers when an executor is lost or added.
The input must be one of these and not, say, the unsorted result of a shuffle.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, where words of `[^\x20\x09-\x0D]+` end. bytes.split() uses the same six.
SPACES = b" \t\n\x0b\x0c\r"


def row_number(rows: DataFrame) -> Column:
    """The number of each row of a scan, whatever cores there are in later scans."""
    spark = rows.sparkSession
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))
    spark.conf.set(*_BATCH)
    return F.monotonically_increasing_id()


def fresh(docs: DataFrame, name: str = "rid") -> str:
    """A column name that docs doesn't have, whatever case counts."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def whole_number(key: Column) -> Column:
    """An id of any type as a long; null where it is no whole number, such as a name."""
    return key.try_cast("long")


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, key, text) of every row; null texts become empty. Other columns, whatever their names, are left out."""
    return docs.select(
        row_number(docs).alias("rid"),
        whole_number(docs[key]).alias(key),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias(text),
    )


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where all run in one process may the session name none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="dirbook-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Settings while a scratch table is written.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.columnarReaderBatchSize": "256", "spark.sql.maxConcurrentOutputFileWriters": "4"}
#: Rows go to Python in batches of this many bytes, so that long texts or binaries don't add up to large ones.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


class Scratch:
    """A folder under the shared one for an operator's intermediate tables.

    Tables are written once and reread, which cuts lineage: a lost executor costs only the stage it ran. The folder
    goes with the JVM, or earlier by release(), once the results that read it have been written.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_base(spark)}/dirbook-{uuid.uuid4().hex}"
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._path = hadoop
        self._fs.mkdirs(hadoop)
        self._fs.deleteOnExit(hadoop)

    def table(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """The rows, written and reread; with `by`, a folder for each value of that column. What the write has shuffled goes
        from the executors' disks as soon as it is done; scans are read a few rows at a time, as rows may be large."""
        path, conf = f"{self.path}/{name}", self.spark.conf
        before = {k: conf.get(k) for k in _WRITING}
        for k, v in _WRITING.items():
            conf.set(k, v)
        try:
            (df.write.partitionBy(by) if by else df.write).mode("overwrite").parquet(path)
        finally:
            for k, v in before.items():
                conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def release(self) -> None:
        self._fs.delete(self._path, True)


def bytes_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in parts of a few rows, for work whose Python objects would otherwise be as many as a batch has."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_held: dict[str, object] = {}


def held(name: str, make):
    """What this Python worker holds from task to task under a name; only one such thing, to bound its memory."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


_IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[ord("A") : ord("Z") + 1] += 32
#: Longer words are hashed one by one.
_LONG = 64
_STEPS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _stirred(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One round: for a given state no two blocks give the same, and what comes out depends on all bits in no linear way."""
    x = state ^ block
    for shift, by in zip((32, 29, 32), _STEPS):
        x = (x ^ (x >> np.uint64(shift))) * by
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit content hashes of the words of all texts, number of words of each text).

    All words' first eight bytes are stirred in at once, then the next eight of those that have more. Words of eight bytes and fewer
    never have the same hash as others of their length; longer ones do with the chance of a random hash. What the worker holds for other
    operators goes.
    """
    _held.clear()
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _IS_SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    length = ends - starts
    if lower:
        data = _TO_LOWER[data]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded.tobytes(), 0, (1,))
    out = _stirred(np.full(len(starts), 0x2545F4914F6CDD1D, np.uint64), length.astype(np.uint64))
    todo, at = np.flatnonzero(length <= _LONG), 0
    while len(todo):
        block = blocks[starts[todo] + at].astype(np.uint64)
        rest = length[todo] - at
        cut = rest < 8
        block[cut] &= (np.uint64(1) << (np.uint64(8) * rest[cut].astype(np.uint64))) - np.uint64(1)
        out[todo] = _stirred(out[todo], block)
        at += 8
        todo = todo[rest > 8]
    for i in np.flatnonzero(length > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), 0x9E3779B97F4A7C15)
    bounds = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
    return out, counts


def places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where in sorted, evenly spread keys each of the wanted ones stands; all must be there."""
    if not len(wanted):
        return np.zeros(0, np.int64)
    low, span = keys[0], int(keys[-1] - keys[0])
    shift = max(0, span.bit_length() - len(keys).bit_length() - 1)
    first = np.searchsorted(keys, low + (np.arange((span >> shift) + 1, dtype=np.uint64) << np.uint64(shift)))
    at = first[((wanted - low) >> np.uint64(shift)).astype(np.int64)]
    todo = np.flatnonzero(keys[at] != wanted)
    while len(todo):
        at[todo] += 1
        todo = todo[keys[at[todo]] != wanted[todo]]
    return at


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def hash_pair(data: bytes) -> tuple[int, int]:
    """A 128-bit hash as two signed numbers."""
    h = xxhash.xxh3_128_intdigest(data)
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)
