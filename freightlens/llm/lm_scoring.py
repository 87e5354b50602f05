"""LM scoring by deleted interpolation.

The probability of a token w after h is l2 * c(hw)/c(h) + l1 * c(w)/N + l0 / (V+1), where the weights l depend on how
often the context h was seen (buckets by powers of two). The weights are learned by expectation-maximisation on
held-out counts: each training token is taken out of the counts in turn (every count less one) and predicted by the
rest. All token and pair counts of the whole training part are used; none is pruned.

Counts come through packs and tallies (see packs.py): each pack of documents sends its different tokens and pairs by
64-bit hash with their training counts, blocks add up, and each pack hears the totals of what it asked for. Frequent
words are one key with a sum. Of the packs that have a token in training texts one is told that it counts it for V. What
each token was told is written once, as two numbers a token; the weights and all scores come from that table by narrow
passes.

Expectation-maximisation starts on the driver, from a histogram of rounded held-out ratios by bucket, whose size is
bounded by its grid (about 45 buckets of 200 x 200 cells at most). From there on each round is a pass over the held-out
counts of all training tokens as they are, which gives three sums a bucket, until no weight moves by `tolerance`.

Null and empty texts have one token, the end. A table without training rows scores with the uniform part alone.
Repeated rows count and are scored like any others; a null id counts as the empty text in the choice of the fold. A very
long text is a pack of its own. An empty table gives no rows and a model without counts. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, ceil_div, fold_of, mix, text_bytes, texts_of, trim, written
from .packs import LOT, PACK_BYTES, Sums, added, answer, ask, deal, expand, keys_of, lots_of, meet, pack, shrunk, squeeze, unpack

BLOCK_KEYS = 500_000
_END, _START, _STEP = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x9E3779B97F4A7C15)
#: Steps of the histogram in an octave.
FINE = 4
#: Marks the total of a token that a pack counts for V.
_OWN = np.uint64(1 << 63)


def bucket_of(n: np.ndarray) -> np.ndarray:
    """0 for contexts not seen, else 1 and the whole part of the binary logarithm."""
    return np.where(n > 0, 1 + np.floor(np.log2(np.maximum(n, 1))), 0).astype(np.int64)


class _Tokens:
    """A pack's tokens and pairs; train: whether each token's text is learned from."""

    def __init__(self, table: pa.Table):
        w = Words(texts_of(table.column("text")), fold=True)
        self.n = w.counts() + 1
        self.start = np.cumsum(self.n) - self.n
        self.end = self.start + self.n - 1
        self.token = np.empty(int(self.n.sum()), np.uint64)
        inner = np.ones(len(self.token), bool)
        inner[self.end] = False
        self.token[inner], self.token[self.end] = w.hashes(6), _END
        before = np.concatenate(([_START], self.token[:-1]))
        before[self.start] = _START
        self.pair = mix(mix(before + _STEP) + self.token)
        self.train = np.repeat(table.column("train").to_numpy(zero_copy_only=False), self.n)

    def asked(self, which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different keys in order, the key of each token, and the keys' counts in training texts."""
        keys, inverse = np.unique(getattr(self, which), return_inverse=True)
        return keys, inverse, np.bincount(inverse, self.train, len(keys)).astype(np.uint32)


@dataclass
class Model:
    """What scoring needs besides the counts. weights: by bucket, (l0, l1, l2)."""

    tokens: int
    types: int
    weights: np.ndarray = field(default_factory=lambda: np.array([[1.0, 0.0, 0.0]]))

    def of(self, bucket: np.ndarray) -> np.ndarray:
        return self.weights[np.minimum(bucket, len(self.weights) - 1)]


START = np.array([0.05, 0.35, 0.6])


def renewed(sums: np.ndarray) -> np.ndarray:
    """Weights by bucket from the expected tokens of each part; buckets with few tokens stay near the start."""
    got = sums + 1e-3 * START
    got[0, 2] = 0  # a context that wasn't seen has no pairs
    return got / got.sum(1, keepdims=True)


def started(cells: np.ndarray, n: np.ndarray, tokens: int, types: int, rounds: int = 50) -> Model:
    """Expectation-maximisation over rounded held-out cells (bucket, word step, pair step) with n tokens each."""
    if not len(cells) or tokens < 2:
        return Model(tokens, types)
    bucket, word, pair = cells.T
    p = np.stack((np.full(len(n), 1 / (types + 1)), np.where(word > 0, 2.0 ** ((word - 1) / FINE), 0) / (tokens - 1), np.where(pair > 0, 2.0 ** (-(pair - 1) / FINE), 0)), 1)
    size = int(bucket.max()) + 1
    weights = renewed(np.zeros((size, 3)))
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(1))[:, None]
        weights = renewed(np.stack([np.bincount(bucket, share[:, k], size) for k in range(3)], 1))
    return Model(tokens, types, weights)


def expected(model: Model, c: np.ndarray, h: np.ndarray, hc: np.ndarray) -> np.ndarray:
    """Expected tokens by bucket and part, of tokens with the held-out counts c (word), h (context), hc (pair)."""
    bucket = bucket_of(h)
    share = model.of(bucket) * np.stack((np.full(len(c), 1 / (model.types + 1)), c / max(model.tokens - 1, 1), hc / np.maximum(h, 1)), 1)
    share /= share.sum(1, keepdims=True)
    return np.stack([np.bincount(bucket, share[:, k], len(model.weights)) for k in range(3)], 1)


class Counts:
    """A corpus with what each of its tokens was told. table: (docs, word, pair binary; trained, types long; cell, seen binary)."""

    def __init__(self, table: DataFrame, keep: dict[str, str]):
        self.table, self.keep = table, keep

    @staticmethod
    def gather(docs: DataFrame, train: Column, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), pack_bytes: int = PACK_BYTES, lot: int = LOT) -> Counts:
        """pack_bytes: text that a worker has in hand at a time; larger packs send fewer and longer rows. lot: packs whose rows are added up on the way to their blocks, where there are more."""
        total = text_bytes(docs, text_col)
        words, pairs = ceil_div(total // 40 + 1, BLOCK_KEYS), ceil_div(total // 6 + 1, BLOCK_KEYS)
        packs = pack(docs.select(*keep, text_col, F.coalesce(train, F.lit(False)).alias("train")), text_col, [*keep, "train"], pack_bytes)
        parts = (("token", 0, words), ("pair", words, pairs))

        def requests(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
            t = _Tokens(table)
            for which, first, blocks in parts:
                keys, _, n = t.asked(which)
                yield deal(number, keys, keys, n, blocks, first)

        def owned(at: list[np.ndarray], sums: np.ndarray, first: np.ndarray, inverse: np.ndarray, whose: np.ndarray) -> list[bytes]:
            """The sums of each row's keys; of keys that count here the first row is told that it owns them."""
            total = sums[inverse]
            total[first[whose]] |= _OWN
            return [squeeze(x) for x in np.split(total, np.cumsum([len(a) for a in at])[:-1])]

        def merge(keys: list[bytes], extra: list[bytes], kind: type) -> list[bytes]:
            at = [keys_of(k, np.uint64) for k in keys]
            _, first, inverse = np.unique(np.concatenate(at), return_index=True, return_inverse=True)
            sums = np.bincount(inverse, np.concatenate([expand(x, kind) for x in extra])).astype(np.uint64)
            return owned(at, sums, first, inverse, sums > 0)

        def hand(whole: bytes, answered: bytes, keys: list[bytes]) -> list[bytes]:
            at, back = [keys_of(k, np.uint64) for k in keys], expand(answered, np.uint64)
            every, first, inverse = np.unique(np.concatenate(at), return_index=True, return_inverse=True)
            if len(every) != len(back):
                raise RuntimeError("a lot's answer doesn't fit its keys")
            return owned(at, back & ~_OWN, first, inverse, back >= _OWN)

        def told(number: int, table: pa.Table, answers: dict[int, bytes]) -> pa.Table:
            t = _Tokens(table)
            got, types = [], []
            for which, first, blocks in parts:
                keys, inverse, _ = t.asked(which)
                back = np.concatenate([expand(answers[b], np.uint64) for b in range(first, first + blocks) if b in answers])
                if len(back) != len(keys):
                    raise RuntimeError("a pack's answers don't fit its keys")
                types.append(int((back >= _OWN).sum()))
                got.append((back & ~_OWN)[inverse])
            word, pair = got
            before = np.concatenate(([0], word[:-1])).astype(np.int64)
            before[t.start] = word[t.end]  # as many starts as ends
            c, h, hc = word[t.train].astype(np.int64) - 1, before[t.train] - 1, pair[t.train].astype(np.int64) - 1
            steps = [bucket_of(h), np.where(c > 0, 1 + np.rint(FINE * np.log2(np.maximum(c, 1))), 0).astype(np.int64), np.where(hc > 0, 1 + np.rint(FINE * np.log2(np.maximum(h, 1) / np.maximum(hc, 1))), 0).astype(np.int64)]
            cell, seen = np.unique((steps[0] << 24) + (steps[1] << 12) + steps[2], return_counts=True)
            own = table.select(list(keep)).append_column("n", pa.array(t.n)).append_column("held_out", pa.array(~table.column("train").to_numpy(zero_copy_only=False)))
            row = {"docs": shrunk(own), "word": squeeze(word, 5), "pair": squeeze(pair, 5), "trained": int(t.train.sum()), "types": types[0], "cell": cell.astype(np.int64).tobytes(), "seen": seen.astype(np.int64).tobytes()}
            return pa.Table.from_pylist([row])

        table = meet(packs, answer(ask(packs, requests), Sums(merge, added(np.uint64), hand), lots_of(total, pack_bytes, lot)), told, "docs binary, word binary, pair binary, trained long, types long, cell binary, seen binary")
        return Counts(written(table, "none"), {c: docs.schema[c].dataType.simpleString() for c in keep})

    @staticmethod
    def told(docs: pa.Scalar, word: pa.Scalar, pair: pa.Scalar) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A pack's documents, each one's first token, and each token's counts: its own, its context's, its pair's."""
        own = unpack(docs.as_py())
        n, word, pair = own.column("n").to_numpy(), expand(word.as_py(), np.uint64), expand(pair.as_py(), np.uint64)
        start = np.cumsum(n) - n
        before = np.concatenate(([0], word[:-1])).astype(word.dtype)
        before[start] = word[start + n - 1]  # as many starts as ends
        return own, start, word.astype(float), before.astype(float), pair.astype(float)

    def learn(self, tolerance: float = 1e-3, rounds: int = 30) -> Model:
        """A model whose weights a further round of expectation-maximisation would move by less than tolerance."""

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for cell, seen in zip(batch.column(0), batch.column(1), strict=True):
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64)) for x in (cell, seen)], ["cell", "seen"])

        total = self.table.agg(F.sum("trained").alias("n"), F.sum("types").alias("v")).first()
        rows = self.table.select("cell", "seen").mapInArrow(cells, "cell long, seen long").groupBy("cell").agg(F.sum("seen").alias("n")).orderBy("cell").toArrow()
        cell = rows.column("cell").to_numpy()
        model = started(np.stack((cell >> 24, cell >> 12 & 4095, cell & 4095), 1), rows.column("n").to_numpy().astype(float), int(total.n or 0), int(total.v or 0))
        for _ in range(rounds if model.tokens > 1 else 0):
            weights = renewed(self._expected(model))
            moved = float(np.abs(weights - model.weights).max())
            model = Model(model.tokens, model.types, weights)
            if moved < tolerance:
                break
        return model

    def _expected(self, model: Model) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = np.zeros_like(model.weights)
            for batch in batches:
                for row in zip(*(batch.column(k) for k in range(3)), strict=True):
                    own, _, word, before, pair = Counts.told(*row)
                    train = np.repeat(~own.column("held_out").to_numpy(zero_copy_only=False), own.column("n").to_numpy())
                    got += expected(model, word[train] - 1, before[train] - 1, pair[train] - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(got))), *(pa.array(np.ascontiguousarray(x)) for x in got.T)], ["bucket", "a", "b", "c"])
            trim()

        table = self.table.select("docs", "word", "pair").mapInArrow(sums, "bucket long, a double, b double, c double")
        rows = table.groupBy("bucket").agg(*(F.sum(k).alias(k) for k in "abc")).collect()  # about 45 at most
        out = np.zeros_like(model.weights)
        for r in rows:
            out[r.bucket] = r.a, r.b, r.c
        return out

    def score(self, model: Model) -> DataFrame:
        """(keep..., held_out boolean, n_tokens, n_known, train_tokens long, base_score, score double)."""
        keep = self.keep

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in zip(*(batch.column(k) for k in range(3)), strict=True):
                    own, start, word, before, pair = Counts.told(*row)
                    n = own.column("n").to_numpy()
                    share = model.of(bucket_of(before))
                    p = share[:, 0] / (model.types + 1) + share[:, 1] * word / max(model.tokens, 1) + share[:, 2] * pair / np.maximum(before, 1)
                    base = np.log10((word + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
                    add = lambda x: np.add.reduceat(x, start)  # noqa: B023, E731
                    out = {**{c: own.column(c).combine_chunks() for c in keep}, "held_out": own.column("held_out").combine_chunks(), "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(add((word > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(len(n), model.tokens), pa.int64()), "base_score": pa.array(add(base)), "score": pa.array(add(np.log10(p)))}
                    yield pa.RecordBatch.from_pydict(out)
                    trim()

        kept = "".join(f"`{c}` {kind}, " for c, kind in keep.items())
        return self.table.select("docs", "word", "pair").mapInArrow(run, f"{kept}held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, with the fold that crc32(doc_id) mod 5 = 1 names held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = Counts.gather(docs, fold_of("doc_id") != 1)
    return counts.score(counts.learn())
