"""The media source: exact round trips, ranges, retries of single members, and what isn't committed."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.fs as pafs
import pytest

from freightlens.llm import media_source as m
from freightlens.llm.common import shared_dir

from .cases import clashing, documents, empty


def test_png_round_trip():
    for text in (b"", b" ", b"x" * 191, b"x" * 192, b"x" * 193, bytes(range(256)) * 5):
        samples, length = m.samples_of(m.png_of(text))
        assert samples.tobytes() == text.ljust(max(192, -(-len(text) // 192) * 192)) and length == len(text)
    broken = bytearray(m.png_of(b"hello"))
    broken[60] ^= 1
    with pytest.raises(ValueError):
        m.samples_of(bytes(broken))
    assert m.feature_of(np.full((2, 192), 32, np.uint8)) == "rows=2;mean=32.0000;dev=0.0000;step=0.0000;entropy=-0.0000"


@pytest.mark.parametrize("options", [{}, {"roll_bytes": 3000, "range_bytes": 500, "batch_bytes": 100}])
def test_round_trip_of_a_table(spark, options):
    docs = documents(spark)
    path = f"{shared_dir(spark)}/media-{len(options)}"
    m.archive(clashing(docs, "id", "media"), path, **options)
    got = Counter(tuple(r) for r in m.decoded(m.members(spark, path, **options)).collect())
    want = Counter()
    for r in docs.collect():
        text = (r.text or "").encode()
        payload, png = m.payload_of(text), m.png_of(text)
        want[None if r.doc_id is None else str(r.doc_id), len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(png), hashlib.sha256(png).hexdigest(), slow_feature(payload)] += 1
    assert got == want


def slow_feature(payload):
    rows = [payload[k : k + 192] for k in range(0, len(payload), 192)]
    n, mean = len(payload), sum(payload) / len(payload)
    deviation = max(0.0, sum(x * x for x in payload) / n - mean * mean) ** 0.5
    step = sum(abs(x - y) for r in rows for x, y in zip(r, r[1:], strict=False)) / (len(rows) * 191)
    entropy = -sum(payload.count(x) / n * math.log2(payload.count(x) / n) for x in set(payload))
    return f"rows={len(rows)};mean={mean:.4f};dev={deviation:.4f};step={step:.4f};entropy={entropy:.4f}"


def test_appending_adds_and_ids_are_of_any_type(spark):
    path = f"{shared_dir(spark)}/media-twice"
    for name, text in (("a/1", "first"), ("-9223372036854775808", "second"), (None, "third"), ("", "fourth")):
        m.archive(spark.createDataFrame([(name, text)], "doc_id string, text string"), path)
    got = {r.id: bytes(r.media) for r in m.members(spark, path).collect()}
    assert got == {n: m.png_of(t) for n, t in (("a/1", b"first"), ("-9223372036854775808", b"second"), (None, b"third"), ("", b"fourth"))}


def test_a_very_long_text_is_one_member(spark):
    path, text = f"{shared_dir(spark)}/media-long", "words of a long text \n" * 400_000
    m.archive(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string"), path)
    got = {r.id: r.n_bytes for r in m.decoded(m.members(spark, path)).collect()}
    assert got == {"1": len(text), "2": 1}


def test_empty_table(spark):
    path = f"{shared_dir(spark)}/media-empty"
    m.archive(empty(spark), path)
    assert m.members(spark, path).count() == 0


def test_uncommitted_archives_are_not_read(spark):
    path = f"{shared_dir(spark)}/media-stray"
    m.archive(documents(spark), path)
    n = m.members(spark, path).count()
    fs, folder = m.store(path)
    with fs.open_output_stream(f"{folder}/stray.flm") as out:
        out.write(b"half an archive")
    assert m.members(spark, path).count() == n


class Flaky:
    """A file system whose files fail at some offsets for the first times."""

    def __init__(self, inner, failures):
        self.inner, self.failures, self.opened = inner, failures, 0

    def open_input_file(self, path):
        self.opened += 1
        return FlakyFile(self.inner.open_input_file(path), self.failures)


class FlakyFile:
    def __init__(self, inner, failures):
        self.inner, self.failures = inner, failures

    def size(self):
        return self.inner.size()

    def read_at(self, n, at):
        if self.failures.get(at, 0) > 0:
            self.failures[at] -= 1
            raise OSError("lost")
        return self.inner.read_at(n, at)


def test_members_are_retried_by_offset(tmp_path):
    fs, path = pafs.LocalFileSystem(), str(tmp_path / "a.flm")
    archive = m._Archive(fs, path)
    for k in range(4):
        archive.add(b"%d" % k if k else None, m.png_of(b"text %d" % k))
    archive.close()
    offsets, end = m.MemberReader(fs, path, 0).offsets()
    offsets = offsets.tolist()
    flaky = Flaky(fs, {offsets[2]: 2})
    reader = m.MemberReader(flaky, path, 3)
    assert [reader.member(at)[0] for at in offsets] == [None, b"1", b"2", b"3"]
    assert flaky.opened == 3
    with pytest.raises(OSError):
        m.MemberReader(Flaky(fs, {offsets[1]: 9}), path, 2).member(offsets[1])
    # A request for all of them that fails is made up for by requests for each; so is one that brings damaged bytes.
    lost = m.MemberReader(Flaky(fs, {offsets[0]: 1}), path, 1)
    assert [x[0] for x in lost.members(offsets[0], end, offsets)] == [None, b"1", b"2", b"3"]
    data = bytearray((tmp_path / "a.flm").read_bytes())
    data[offsets[3] + 30] ^= 1
    (tmp_path / "a.flm").write_bytes(data)
    with pytest.raises(ValueError):
        m.MemberReader(fs, path, 1).member(offsets[3])
    damaged = m.MemberReader(fs, path, 1).members(offsets[0], end, offsets)
    assert [next(damaged)[0] for _ in range(3)] == [None, b"1", b"2"]
    with pytest.raises(ValueError):
        next(damaged)
