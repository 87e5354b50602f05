"""Pieces the corpus operators share: shared storage, byte-level tokenising and hashing in numpy."""

from __future__ import annotations

import ctypes
import math
import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space bytes that separate words, space and \t \n \v \f \r.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_GOLDEN, _LONG_WORD = np.uint64(0x9E3779B97F4A7C15), 256
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def fold_of(doc_id: str | Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % n


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else (tests) one that is set here."""
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not place:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
        place = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(place)
    return place.rstrip("/")


class _Scopes(threading.local):
    """What a thread has put in shared storage, by scope, the innermost last: paths, and tables' names."""

    def __init__(self):
        self.all: list[list[str]] = [[]]


_SCOPES = _Scopes()
_TABLE = "table:"


def placed(spark: SparkSession, kind: str = "table") -> str:
    """A new path in the shared folder."""
    _SCOPES.all[-1].append(f"{shared_dir(spark)}/fl-{kind}-{uuid.uuid4().hex}")
    return _SCOPES.all[-1][-1]


def named_table() -> str:
    """A new name for a table of the catalog."""
    _SCOPES.all[-1].append(f"{_TABLE}fl_run_{uuid.uuid4().hex}")
    return _SCOPES.all[-1][-1].removeprefix(_TABLE)


def discard(spark: SparkSession, name: str) -> None:
    """Deletes a path or table that was placed in the present scope."""
    _SCOPES.all[-1].remove(name)
    if name.startswith(_TABLE):
        spark.sql(f"DROP TABLE IF EXISTS {name.removeprefix(_TABLE)}")
    else:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_shared(spark: SparkSession) -> None:
    """Deletes what operators of this scope and thread have put in shared storage; call it when their results have been read."""
    while _SCOPES.all[-1]:
        discard(spark, _SCOPES.all[-1][-1])


@contextmanager
def scoped(spark: SparkSession) -> Iterator[None]:
    """A scope of its own: what operators put in shared storage inside is deleted at its end, other scopes' isn't."""
    _SCOPES.all.append([])
    try:
        yield
    finally:
        clear_shared(spark)
        _SCOPES.all.pop()


def written(df: DataFrame, compression: str = "zstd", few: bool = False) -> DataFrame:
    """df as a table in the shared folder, read back: cuts lineage and survives lost executors.

    few: for small results of a shuffle; at most two files for each core of the cluster, not one for each partition.
    """
    spark = df.sparkSession
    path = placed(spark)
    out = df.coalesce(2 * max(2, spark.sparkContext.defaultParallelism)) if few else df
    out.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of many texts in flat arrays. start, end: byte offsets in buf; first: each text's first word, and one more."""

    def __init__(self, texts: list[bytes], fold: bool = False):
        joined = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(joined, np.uint8)
        self.buf = _FOLD[buf] if fold else buf
        edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[buf], [True])).view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.first = np.searchsorted(self.start, np.concatenate(([0], np.cumsum(sizes))))

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int) -> np.ndarray:
        """64-bit hash of each word: its blocks of 8 bytes go one after another through a finaliser that starts with seed and length.

        Each step mixes all bits, so repeating patterns in long words cancel nothing out. Very long words take XXH64.
        """
        n = self.end - self.start
        out = mix(np.full(len(n), seed, np.uint64) + n.astype(np.uint64) * _GOLDEN)
        blocks = np.ndarray((len(self.buf),), "<u8", np.concatenate((self.buf, np.zeros(8, np.uint8))), 0, (1,))
        at = np.flatnonzero(n <= _LONG_WORD)
        start, left = self.start[at], n[at]
        while len(at):
            keep = ~np.uint64(0) >> (np.uint64(64) - 8 * np.minimum(left, 8).astype(np.uint64))
            out[at] = mix(out[at] ^ (blocks[start] & keep))
            more = left > 8
            at, start, left = at[more], start[more] + 8, left[more] - 8
        for k in np.flatnonzero(n > _LONG_WORD).tolist():
            out[k] = xxhash.xxh64_intdigest(self.buf[self.start[k] : self.end[k]].tobytes(), seed)
        return out


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def stretches(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of at most `most` bytes, or of one row. Python objects are made for one at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + most, "right")))
        yield at, upto
        at = upto


_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")


def pieces_of(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in pieces of some size, cut after white space, so that few words of a very long text are objects at a time."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end


def is_scan(df: DataFrame) -> bool:
    """Whether df only reads files, projects and filters."""
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes = {m[1] for line in plan.toString().splitlines() if (m := re.match(r"[\s:+|-]*(\w+)", line))}
    return plan.deterministic() and nodes <= {"Project", "Filter", "Relation"}


def text_bytes(df: DataFrame, text_col: str) -> int:
    """About how many bytes a table's texts have; decides how finely work is cut, never a result.

    Over a plain scan twice the size of its files, without reading them; else counted.
    """
    if is_scan(df):
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size < 1 << 55:  # Spark's stand-in for an unknown size is larger
            return 2 * size
    return int(df.agg(F.sum(F.octet_length(F.col(text_col))).alias("b")).first().b or 0)


def trim() -> None:
    """Gives back what the C library keeps of freed arrays; workers live long and would hold their largest pack's memory."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library
    pa.default_memory_pool().release_unused()


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in Arrow batches of some MB from now on, unless the session has a size of its own. For the queries and the pipeline; operators leave a session as it is.

    Spark's default of 64 MB is held several times by every task: in the executor's Java and Python processes, in and out.
    """
    if spark.conf.get(_BATCH) in ("64m", "67108864", "67108864b"):
        spark.conf.set(_BATCH, "4m")


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives memory back when a task's batches are through."""

    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return tidied


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def power_of_two(n: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1.0, n))))
