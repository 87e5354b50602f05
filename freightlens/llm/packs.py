"""Packs and tallies: a corpus-wide count of 64- or 128-bit keys without a row per key.

Texts are packed, some MB a row. Each pack sends its keys, dealt by hash into
blocks, as one binary row per (pack, block); a block adds up what all packs sent and answers each of them with one
row. Keys are spread by hash, so a frequent word or a large group of copies is one key with a sum, never a group
of rows. The number of blocks grows with the corpus, so that a block's keys fit in a task. So does the number of packs,
and a key that all packs have would bring as many rows to its block; beyond LOT packs their rows are added up by lots
first, a lot's sums go to the block as one row, and the block's answer comes back through the lot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_scan, power_of_two, texts_of, trim, written

PACK_BYTES = 6 << 20
#: Packs of a lot, about.
LOT = 2048


def pack(df: DataFrame, text_col: str, keep: list[str], pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(pack long, data binary): rows of (keep..., text) as compressed Arrow.

    Cut by bytes of text, so one long text makes a pack of its own. Empty input makes no pack. Packs are used more
    than once and must be the same each time: over a plain scan of files they are made anew, as a scan's partitions
    and their rows are the same each time; anything else is written to the shared folder first. A pack's number is a
    digest of its place and content, so if a pack came out different the next time, answers to it would reach no pack,
    which is an error.
    """

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            data = shrunk(pa.Table.from_batches(held).combine_chunks())
            number = xxhash.xxh64_intdigest(data, (task << 32) + n) - (1 << 63)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([data], pa.binary())], ["pack", "data"])

        for batch in batches:
            ends = np.cumsum([len(x) for x in texts_of(batch.column("text"))])
            at = 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, before + pack_bytes - size, "right")))
                held.append(batch.slice(at, upto - at))
                size += int(ends[upto - 1]) - before
                at = upto
                if size >= pack_bytes or at < batch.num_rows:
                    yield row()
                    n, held, size = n + 1, [], 0
        if held:
            yield row()

    cols = [F.col(c) for c in keep] + [F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    found = df.select(*cols).mapInArrow(packs, "pack long, data binary")
    return found if is_scan(df) else written(found, "none")


def shrunk(table: pa.Table) -> bytes:
    """A table as compressed Arrow; packs are written and shuffled, so some effort pays."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return zstandard.ZstdCompressor(level=5).compress(sink.getvalue())


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


def squeeze(a: np.ndarray, level: int = 1) -> bytes:
    """Integers as compressed byte planes: the high bytes of small numbers cost next to nothing."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    """Rising keys by their steps, whose high bytes are mostly zero."""
    return squeeze(np.diff(keys, prepend=keys.dtype.type(0)))


def keys_of(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(expand(data, dtype), dtype=dtype)


REQUEST = "block int, pack long, keys binary, extra binary"
_REQUEST = pa.schema([("block", pa.int32()), ("pack", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())])


def deal(number: int, lead: np.ndarray, keys: np.ndarray, extra: np.ndarray, blocks: int, first: int = 0) -> pa.RecordBatch:
    """Request rows of a pack: keys (rising, or pairs) and extra, in the order of the rising 64-bit hashes lead, whose top bits name one of `blocks` blocks from `first` on."""
    block = ((lead >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    edge = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)])) if len(block) else np.zeros(1, np.int64)
    spans = list(zip(edge[:-1], edge[1:], strict=True))
    columns = [
        pa.array([first + int(block[s]) for s, _ in spans], pa.int32()),
        pa.array([number] * len(spans), pa.int64()),
        pa.array([pack_keys(keys[s:e]) if keys.ndim == 1 else np.ascontiguousarray(keys[s:e]).tobytes() for s, e in spans], pa.binary()),
        pa.array([squeeze(extra[s:e]) for s, e in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_REQUEST)


def ask(packs: DataFrame, requests: Callable[[int, pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Request rows of every pack, by a narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from requests(number, unpack(data.as_py()))
                trim()

    return packs.mapInArrow(run, REQUEST)


@dataclass(frozen=True)
class Sums:
    """How rows (keys, extra) of a block add up. kind: of the extra's integers, 32 bits of a pack's, 64 of a lot's.

    merge: an answer for each row. gather: all rows as one. hand: an answer for each row from their lot's keys and answer.
    """

    merge: Callable[[list[bytes], list[bytes], type], list[bytes]]
    gather: Callable[[list[bytes], list[bytes]], tuple[bytes, bytes]]
    hand: Callable[[bytes, bytes, list[bytes]], list[bytes]]


def lots_of(total: int, pack_bytes: int, lot: int = LOT) -> int:
    """How many lots the packs of so many bytes of text go in."""
    return power_of_two(total / pack_bytes / lot)


def added(dtype: type) -> Callable[[list[bytes], list[bytes]], tuple[bytes, bytes]]:
    """Rows of rising keys and counts as one row."""

    def gather(keys: list[bytes], extra: list[bytes]) -> tuple[bytes, bytes]:
        every, inverse = np.unique(np.concatenate([keys_of(k, dtype) for k in keys]), return_inverse=True)
        sums = np.bincount(inverse, np.concatenate([expand(x, np.uint32) for x in extra]))
        return pack_keys(every), squeeze(sums.astype(np.uint64))

    return gather


def _in_order(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column("pack").to_numpy(), kind="stable")))


def _answered(requests: DataFrame, merge: Callable[[list[bytes], list[bytes], type], list[bytes]], kind: type) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        got = merge(table.column("keys").to_pylist(), table.column("extra").to_pylist(), kind)
        return pa.table({"pack": table.column("pack"), "block": table.column("block"), "answer": pa.array(got, pa.binary())})

    return requests.groupBy("block").applyInArrow(run, "pack long, block int, answer binary")


def answer(requests: DataFrame, sums: Sums, lots: int = 1) -> DataFrame:
    """(pack, block, answer) of each request, by the sums of all that reached its block. lots: by how many lots on the way."""
    if lots <= 1:
        return _answered(requests, sums.merge, np.uint32)
    rows = written(requests, "none").withColumn("lot", F.pmod(F.xxhash64("pack"), F.lit(lots)))

    def gathered(table: pa.Table) -> pa.Table:
        keys, extra = sums.gather(table.column("keys").to_pylist(), table.column("extra").to_pylist())
        return pa.table({"block": table.column("block")[:1], "pack": table.column("lot")[:1], "keys": pa.array([keys], pa.binary()), "extra": pa.array([extra], pa.binary())})

    def handed(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _in_order(left)
        got = sums.hand(right.column("keys")[0].as_py(), right.column("answer")[0].as_py(), left.column("keys").to_pylist())
        return pa.table({"pack": left.column("pack"), "block": left.column("block"), "answer": pa.array(got, pa.binary())})

    whole = written(rows.groupBy("block", "lot").applyInArrow(gathered, REQUEST), "none")
    told = _answered(whole, sums.merge, np.uint64).join(whole.select("block", "pack", "keys"), ["block", "pack"]).withColumnRenamed("pack", "lot")
    return rows.groupBy("block", "lot").cogroup(told.groupBy("block", "lot")).applyInArrow(handed, "pack long, block int, answer binary")


def meet(packs: DataFrame, answers: DataFrame, use: Callable[[int, pa.Table, dict[int, bytes]], pa.Table], schema: str) -> DataFrame:
    """Each pack with its answers by block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        by = dict(zip(right.column("block").to_pylist(), right.column("answer").to_pylist(), strict=True))
        number = left.column("pack")[0].as_py() if left.num_rows else -1
        if not left.num_rows:
            raise RuntimeError("an answer reached no pack")
        out = use(number, unpack(left.column("data")[0].as_py()), by)
        del by
        trim()
        return out

    return packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(run, schema)
