"""Media columns: archives of images behind a Spark data source.

Writing ("fl_media" as a sink): each task streams its rows into archives of its own in a folder of shared storage. An
archive holds members one after another (a small header, the name, the media bytes) and ends with a directory of
their offsets; it rolls at `roll_bytes`. A task's archives have names of its own attempt, and only a commit lists them,
so what a lost or repeated attempt leaves behind is never read. Every write leaves a list of its own, so appending adds
to what is there.

Reading: the driver lists the committed archives and cuts each in byte ranges of `range_bytes`; it doesn't open them.
A task reads its archive's directory, takes the members whose offsets lie in its range, reads neighbouring ones in
requests of `batch_bytes`, and streams them through Arrow in batches of as many bytes. Each member is checked (length
and CRC-32) by itself; one that fails, or whose request fails, is retried at its own offset after the file is opened
anew, `retries` times, and after that fails the task: rows are never skipped. Every member is in one range only.

The medium here is a grey PNG 192 samples wide: a payload's bytes are its samples, so the payload comes back whole.
Payloads are the text's UTF-8 bytes (null: none) with bytes 32 up to a positive multiple of 192. Ids are kept as text, of
any type; a null id is kept as null. Repeated rows are members of their own, of equal bytes. A very long text is one
member, read in one piece. Extra columns are left out. An empty table makes no archive.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .common import placed, tidy

SIDE = 192
#: A PNG file's signature, and the filter byte of an unfiltered row.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_MEMBER = struct.Struct("<4sIiI")  # mark, CRC-32 of name and media, the name's bytes (-1: a null id), media bytes
_TAIL = struct.Struct("<qI4s")  # the directory's offset, its CRC-32, mark
_MARK = b"FLM2"
_COMMITTED = "_committed-"


def store(url: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors reach, by its URL."""
    return pafs.FileSystem.from_uri(url.replace("s3a://", "s3://", 1) if "://" in url or url.startswith("file:") else f"file://{url}")


def payload_of(text: bytes) -> bytes:
    return text.ljust(max(1, -(-len(text) // SIDE)) * SIDE, b" ")


def png_of(text: bytes, level: int = 1) -> bytes:
    """A grey image of 8 bits a sample, SIDE samples wide, of the text's payload; a text chunk holds the bytes before padding."""
    payload = payload_of(text)
    rows = np.frombuffer(payload, np.uint8).reshape(-1, SIDE)
    plain = np.zeros((len(rows), SIDE + 1), np.uint8)
    plain[:, 1:] = rows
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", SIDE, len(rows), 8, 0, 0, 0, 0)) + chunk(b"tEXt", b"Bytes\0%d" % len(text)) + chunk(b"IDAT", zlib.compress(plain.tobytes(), level)) + chunk(b"IEND", b"")


def samples_of(png: bytes) -> tuple[np.ndarray, int]:
    """The samples of an image that png_of made, and the bytes before padding; every chunk's checksum is tested."""
    if not png.startswith(PNG_SIGNATURE):
        raise ValueError("not a PNG file")
    at, data, height, length = len(PNG_SIGNATURE), b"", 0, -1
    while at < len(png):
        n, kind = struct.unpack(">I", png[at : at + 4])[0], png[at + 4 : at + 8]
        body = png[at + 8 : at + 8 + n]
        if struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError("a damaged chunk")
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", body)
            if (width, *form) != (SIDE, 8, 0, 0, 0, 0):
                raise ValueError("another form of PNG")
        elif kind == b"tEXt" and body.startswith(b"Bytes\0"):
            length = int(body[6:])
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, SIDE + 1)
    if rows[:, 0].any():
        raise ValueError("a filtered row")
    return rows[:, 1:], length


def feature_of(samples: np.ndarray) -> str:
    """Rows, mean, deviation, mean step along rows and entropy of the samples, as text."""
    x = samples.astype(np.int64)
    n = x.size
    share = np.bincount(samples.ravel(), minlength=256)
    share = share[share > 0] / n
    mean = x.sum() / n
    deviation = max(0.0, (x * x).sum() / n - mean * mean) ** 0.5
    step = np.abs(np.diff(x, axis=1)).sum() / max(1, samples.shape[0] * (SIDE - 1))
    return f"rows={samples.shape[0]};mean={mean:.4f};dev={deviation:.4f};step={step:.4f};entropy={-(share * np.log2(share)).sum():.4f}"


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Archive:
    """One archive while it is written."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.out, self.at, self.offsets = fs.open_output_stream(path), 0, []

    def add(self, name: bytes | None, media: bytes) -> None:
        body = (name or b"") + media
        head = _MEMBER.pack(_MARK, zlib.crc32(body), -1 if name is None else len(name), len(media))
        self.offsets.append(self.at)
        self.out.write(head + body)
        self.at += len(head) + len(body)

    def close(self) -> None:
        directory = np.array(self.offsets, "<i8").tobytes()
        self.out.write(directory + _TAIL.pack(self.at, zlib.crc32(directory), _MARK))
        self.out.close()


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.url, self.roll = options["path"], int(options.get("roll_bytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, folder = store(self.url)
        fs.create_dir(folder, recursive=True)
        names, archive = [], None
        for batch in iterator:
            for name, text in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                if archive is None:
                    names.append(f"{uuid.uuid4().hex}.flm")
                    archive = _Archive(fs, f"{folder}/{names[-1]}")
                archive.add(name, png_of(text.as_py() or b""))
                if archive.at >= self.roll:
                    archive.close()
                    archive = None
        if archive is not None:
            archive.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        fs, folder = store(self.url)
        fs.create_dir(folder, recursive=True)
        # Readers see the list under its last name only, whole.
        name = uuid.uuid4().hex
        with fs.open_output_stream(f"{folder}/_new-{name}") as out:
            out.write(json.dumps(sorted(x for m in messages if m for x in m.names)).encode())
        fs.move(f"{folder}/_new-{name}", f"{folder}/{_COMMITTED}{name}.json")

    def abort(self, messages: list) -> None:
        fs, folder = store(self.url)
        for name in (x for m in messages if m for x in m.names):
            fs.delete_file(f"{folder}/{name}")


@dataclass
class _Range(InputPartition):
    name: str
    start: int
    end: int


class MemberReader:
    """Members of one archive by offset, each retried by itself."""

    def __init__(self, fs: pafs.FileSystem, path: str, retries: int):
        self.fs, self.path, self.retries, self.file = fs, path, retries, None

    def _again(self, read):
        for left in range(self.retries, -1, -1):
            try:
                if self.file is None:
                    self.file = self.fs.open_input_file(self.path)
                return read(self.file)
            except (OSError, ValueError):
                self.file = None  # opened anew, and only this member is read again
                if not left:
                    raise

    def offsets(self) -> tuple[np.ndarray, int]:
        """The members' offsets and where the last one ends."""

        def read(f):
            size = f.size()
            at, crc, mark = _TAIL.unpack(f.read_at(_TAIL.size, size - _TAIL.size))
            directory = f.read_at(size - _TAIL.size - at, at)
            if mark != _MARK or zlib.crc32(directory) != crc:
                raise ValueError("a damaged directory")
            return np.frombuffer(directory, "<i8"), at

        return self._again(read)

    def member(self, at: int) -> tuple[bytes | None, bytes]:
        def read(f):
            return parsed(f.read_at(_MEMBER.size + sum(sizes_of(f.read_at(_MEMBER.size, at))), at))

        return self._again(read)

    def members(self, at: int, end: int, offsets: list[int]) -> Iterator[tuple[bytes | None, bytes]]:
        """The members at these offsets, from one request for the bytes up to end; those that come out damaged are read by themselves."""
        try:
            if self.file is None:
                self.file = self.fs.open_input_file(self.path)
            data = self.file.read_at(end - at, at)
        except OSError:
            self.file, data = None, b""
        for start, stop in zip(offsets, [*offsets[1:], end], strict=True):
            try:
                yield parsed(data[start - at : stop - at])
            except (ValueError, struct.error):
                yield self.member(start)


def sizes_of(head: bytes) -> tuple[int, int]:
    mark, _, name, media = _MEMBER.unpack(head[: _MEMBER.size])
    if mark != _MARK:
        raise ValueError("not a member")
    return max(0, name), media


def parsed(data: bytes) -> tuple[bytes | None, bytes]:
    """A member's name and media, tested against its header."""
    _, crc, named, _ = _MEMBER.unpack(data[: _MEMBER.size])
    name, media = sizes_of(data)
    body = data[_MEMBER.size :]
    if len(body) != name + media or zlib.crc32(body) != crc:
        raise ValueError("a damaged member")
    return None if named < 0 else body[:name], body[name:]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.cut = options["path"], int(options.get("range_bytes", 16 << 20))
        self.batch, self.retries = int(options.get("batch_bytes", 4 << 20)), int(options.get("retries", 3))

    def partitions(self) -> list[_Range]:
        fs, folder = store(self.url)
        names = []
        for x in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if x.base_name.startswith(_COMMITTED):
                with fs.open_input_stream(x.path) as f:
                    names += json.loads(f.read())
        names.sort()
        sizes = [x.size for x in fs.get_file_info([f"{folder}/{n}" for n in names])]
        return [_Range(n, a, a + self.cut) for n, size in zip(names, sizes, strict=True) for a in range(0, size, self.cut)] or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, folder = store(self.url)
        reader = MemberReader(fs, f"{folder}/{partition.name}", self.retries)
        offsets, last = reader.offsets()
        edges = np.append(offsets, last)
        at, upto = np.searchsorted(offsets, partition.start), np.searchsorted(offsets, partition.end)
        while at < upto:
            end = min(upto, max(at + 1, int(np.searchsorted(edges, edges[at] + self.batch, "right")) - 1), at + 1000)
            found = list(reader.members(int(edges[at]), int(edges[end]), edges[at:end].tolist()))
            ids, media = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()).cast(pa.string()), pa.array(media, pa.binary())], ["id", "media"])
            at = end


class MediaSource(DataSource):
    """Reads (id string, media binary); writes (id string, text string)."""

    @classmethod
    def name(cls) -> str:
        return "fl_media"

    def schema(self) -> str:
        return "id string, media binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def archive(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> None:
    """Writes each text as an image into archives in the folder `path`."""
    spark = docs.sparkSession
    spark.dataSource.register(MediaSource)
    docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).write.format("fl_media").options(path=path, **{k: str(v) for k, v in options.items()}).mode("append").save()


def members(spark: SparkSession, path: str, **options) -> DataFrame:
    """(id string, media binary) of all members."""
    spark.dataSource.register(MediaSource)
    return spark.read.format("fl_media").options(path=path, **{k: str(v) for k, v in options.items()}).load()


DECODED = "id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def decoded(found: DataFrame) -> DataFrame:
    """What the stored bytes of each member say (DECODED)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, media in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                png = media.as_py()
                samples, length = samples_of(png)
                payload = samples.tobytes()
                rows.append((number, length, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(png), sha256(png).hexdigest(), feature_of(samples)))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in DECODED.split(", ")])

    return found.mapInArrow(tidy(run), DECODED)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text stored as an image in archives, read back and measured."""
    path = placed(spark, "media")
    archive(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    found = decoded(members(spark, path))
    return found.select(F.col("id").cast("long").alias("doc_id"), *found.columns[1:])
