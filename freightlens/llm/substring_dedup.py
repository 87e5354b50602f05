"""Substring dedup: a count-min prefilter over partition sketches, then exact grouping of what may repeat.

First pass. Every pack of documents counts its windows in a count-min sketch of two rows, kept sparse; the sketches are
merged by adding counter to counter in the blocks of the counter space. A counter is at least the number of windows that
hash to it, so a window that repeats has counters of 2 or more in both rows. The space has a constant number of counters
for each word of the corpus, so false alarms don't grow.

Second pass. Windows whose counters say so are grouped exactly, by 128 bits of two hashes over their words with seeds of
their own; the rest cannot repeat. Each pack sends a different window once, with its count, and hears which of them occur
twice or more in all. Nothing is lost, capped or gathered in one place: copies of a passage are one sum.

Windows are judged on the input. Null texts have no words; a text shorter than a window loses nothing; repeated rows
are copies like any others and so lose their windows, both. A very long text is a pack of its own. An empty table has no
rows. Extra columns are left out; a null id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, ceil_div, mix, power_of_two, text_bytes, texts_of
from .packs import _REQUEST, LOT, PACK_BYTES, REQUEST, Sums, added, answer, ask, deal, expand, keys_of, lots_of, meet, pack, squeeze

#: Keys that a task has in hand at a time.
BLOCK_KEYS = 500_000
_SALTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0x3C6EF372FE94F82A))
_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))


def rolled(h: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """A hash of each run of `size` values, put together from runs whose lengths are powers of two.

    Each time two runs are joined high bits are folded into low ones, so that patterns of repeating words don't cancel out.
    """

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * base + b
        x ^= x >> np.uint64(32)
        x *= _SALTS[0]
        return x

    n, got, done, run, length = max(0, len(h) - size + 1), None, 0, h, 1
    while length <= size:
        if size & length:  # the parts of a run in the order of their lengths, the shortest first
            part = run[done : done + n]
            got = part.copy() if got is None else join(got, part)
            done += length
        run = join(run[:-length], run[length:]) if len(run) > length else run[:0]
        length *= 2
    return mix(got[:n])


class _Windows:
    """A pack's windows: ok tells those whole inside one text."""

    def __init__(self, table: pa.Table, size: int):
        self.words = w = Words(texts_of(table.column("text")))
        self.size, n = size, max(0, len(w) - size + 1)
        change = np.zeros(n + 1, np.int64)
        low, high = w.first[:-1], w.first[1:] - size + 1
        some = high > low
        np.add.at(change, low[some], 1)
        np.add.at(change, high[some], -1)
        self.ok = np.flatnonzero(np.cumsum(change[:-1]) > 0)

    def lane(self, k: int) -> np.ndarray:
        """64 bits of each window's key."""
        return rolled(self.words.hashes(k + 1), self.size, _BASES[k])[self.ok]


def repeated_windows(texts: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), size: int = 35, counters_per_word: float = 8.0, pack_bytes: int = PACK_BYTES, lot: int = LOT) -> DataFrame:
    """Each text with the words that repeated windows cover: (keep..., n_words long, n_removed long, kept_text string).

    pack_bytes: text that a worker has in hand at a time; larger packs send fewer and longer rows. lot: packs
    whose rows are added up on the way to their blocks, where there are more.
    """
    total = text_bytes(texts, text_col)
    lots = lots_of(total, pack_bytes, lot)
    words = total // 6 + 1
    bits = min(60, max(16, power_of_two(counters_per_word * words).bit_length() - 1))
    blocks = ceil_div(words, BLOCK_KEYS)
    kind = np.uint32 if bits <= 32 else np.uint64
    packs = pack(texts, text_col, list(keep), pack_bytes)

    def counters(window: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sketch's counters that a pack touches, the one of each window, and what each counts."""
        return np.unique(mix(window + _SALTS[row]) >> np.uint64(64 - bits), return_inverse=True, return_counts=True)

    def sketches(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        window = _Windows(table, size).lane(0)
        for row in (0, 1):
            at, _, n = counters(window, row)
            if len(at):
                yield deal(number, at << np.uint64(64 - bits), at.astype(kind), n.astype(np.uint32), blocks, row * blocks)

    def merge_sketches(keys: list[bytes], extra: list[bytes], of: type) -> list[bytes]:
        at = [keys_of(k, kind) for k in keys]
        _, inverse = np.unique(np.concatenate(at), return_inverse=True)
        often = np.bincount(inverse, np.concatenate([expand(x, of) for x in extra])) >= 2
        return [np.packbits(x).tobytes() for x in np.split(often[inverse], np.cumsum([len(a) for a in at])[:-1])]

    def hand_sketches(whole: bytes, told: bytes, keys: list[bytes]) -> list[bytes]:
        every = keys_of(whole, kind)
        often = np.unpackbits(np.frombuffer(told, np.uint8), count=len(every))
        return [np.packbits(often[np.searchsorted(every, keys_of(k, kind))]).tobytes() for k in keys]

    def candidates(number: int, table: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        w = _Windows(table, size)
        one = w.lane(0)
        maybe = np.ones(len(one), bool)
        for row in (0, 1):
            at, of, _ = counters(one, row)
            lead = at << np.uint64(64 - bits)
            sizes = np.bincount(((lead >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), minlength=blocks)
            told = [np.unpackbits(np.frombuffer(answers[row * blocks + int(b)], np.uint8), count=int(sizes[b])) for b in np.flatnonzero(sizes)]
            if told:
                maybe &= np.concatenate(told).astype(bool)[of]
        if not maybe.any():
            return pa.Table.from_batches([], _REQUEST)
        keys, n = different(np.stack((one[maybe], w.lane(1)[maybe]), 1), None)
        return pa.Table.from_batches([deal(number, keys[:, 0], keys, n.astype(np.uint32), blocks)])

    def different(keys: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Different keys in order, and how often each occurs (n: how often each given one does)."""
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))) if len(keys) else np.zeros(0, np.int64)
        n = np.ones(len(keys), np.int64) if n is None else n[order]
        return keys[first], np.add.reduceat(n, first, dtype=np.int64) if len(first) else n

    def sent_of(keys: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(k, np.uint64).reshape(-1, 2) for k in keys]

    def gather_windows(keys: list[bytes], extra: list[bytes]) -> tuple[bytes, bytes]:
        every, n = different(np.concatenate(sent_of(keys)), np.concatenate([expand(x, np.uint32) for x in extra]).astype(np.int64))
        return np.ascontiguousarray(every).tobytes(), squeeze(n.astype(np.uint64))

    def hand_windows(whole: bytes, told: bytes, keys: list[bytes]) -> list[bytes]:
        often = np.frombuffer(told, np.uint64).reshape(-1, 2)
        return [np.ascontiguousarray(s[among(s, often)]).tobytes() for s in sent_of(keys)]

    def merge_windows(keys: list[bytes], extra: list[bytes], of: type) -> list[bytes]:
        sent = sent_of(keys)
        every, n = different(np.concatenate(sent), np.concatenate([expand(x, of) for x in extra]))
        often = np.ascontiguousarray(every[n >= 2])
        return [np.ascontiguousarray(s[among(s, often)]).tobytes() for s in sent]

    def among(keys: np.ndarray, often: np.ndarray) -> np.ndarray:
        """Which keys are in often, whose rows rise."""
        hit = np.zeros(len(keys), bool)
        at = np.searchsorted(often[:, 0], keys[:, 0])
        todo = np.arange(len(keys))
        while len(todo := todo[at[todo] < len(often)]) and len(todo := todo[often[at[todo], 0] == keys[todo, 0]]):
            hit[todo] |= often[at[todo], 1] == keys[todo, 1]
            at[todo] += 1  # keys that share their first half
        return hit

    def cut(number: int, table: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        texts = texts_of(table.column("text"))
        w = _Windows(table, size)
        first = w.words.first
        cover = np.zeros(first[-1] + 1, np.int32)
        if any(answers.values()):
            often = different(np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in answers.values()]), None)[0]
            one = w.lane(0)
            near = np.flatnonzero(np.isin(one, often[:, 0]))
            at = w.ok[near[among(np.stack((one[near], w.lane(1)[near]), 1), often)]]
            cover[at] += 1
            np.add.at(cover, at + size, -1)
        gone = np.cumsum(cover[:-1]) > 0
        before = np.concatenate(([0], np.cumsum(gone)))
        removed = before[first[1:]] - before[first[:-1]]
        stays = (~gone).tolist() if removed.any() else []
        kept = [b" ".join(compress(t.split(), stays[s:e]) if r else t.split()) for t, r, s, e in zip(texts, removed.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True)]
        return pa.table({**{c: table.column(c) for c in keep}, "n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    kept = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep)
    first = answer(ask(packs, sketches), Sums(merge_sketches, added(kind), hand_sketches), lots)
    second = answer(meet(packs, first, candidates, REQUEST), Sums(merge_windows, gather_windows, hand_windows), lots)
    return meet(packs, second, cut, f"{kept}{', ' * bool(keep)}n_words long, n_removed long, kept_text string")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that windows of 35 words found elsewhere cover."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = repeated_windows(docs, keep=("doc_id",), size=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: The same in DuckDB's SQL, with a row for each window.
OP5_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 34), ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, n - 33)) AS i FROM n WHERE n >= 35)),
often AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win JOIN often USING (t)),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM hit) GROUP BY doc_id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_words, CAST(coalesce(len(gone.ps), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone.ps IS NULL THEN n.w ELSE list_filter(list_transform(range(1, n.n + 1), lambda p: CASE WHEN list_contains(gone.ps, p) THEN NULL ELSE n.w[p] END), lambda x: x IS NOT NULL) END, ' '), '')) AS kept_sha256
FROM n LEFT JOIN gone USING (doc_id)
"""
