"""Quality classifier: a byte-level convolutional network in numpy.

Every text is cut in overlapping chunks of bytes, the last one padded with zeros, so the chunks cover the whole text,
however long. Each byte has a learned embedding, each filter is a learned weight vector over a chunk, its rectified
responses are max-pooled over the text, and a logistic layer combines the pooled responses into one probability.

Training (Adam on the log loss, numpy alone, seeded) sees a bounded sample of the labelled rows: at most `sample` of each
class, those with the smallest hash of their ids, whole texts of at most `most_bytes` each and `sample_bytes` together,
on the driver. With the default of 1500 a class, texts of 3.4 kB make 10 MB. A bound for each class changes the share of
good texts in the sample; the last layer's shift is set right by the classes' numbers among all labelled documents, so a
score means the same whatever the size. Batches go through in pieces of bounded size, so memory grows with a batch's bytes only. The
model's few thousand weights travel to the scoring tasks in the closure.

Null and empty texts are scored like any other text (one chunk of zeros); so are texts of any length, in pieces. Rows
repeated in the labels count once, with the smallest label; labels without a document are ignored. Of equal responses
(ties) the first chunk's counts in training; of equal hashes the smaller id is sampled. Without labels of both
classes every score is the share of ones (or 0.5). Repeated documents are scored alike, a null id counts as the empty
text in the choice of the fold. An empty table has no scores. Extra columns pass through `scored`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import fold_of, stretches, texts_of, tidy

CHUNK, STRIDE, WIDTH, FILTERS = 16, 8, 4, 24
#: From this score on a text counts as good.
THRESHOLD = 0.3
_PIECE = 1 << 22


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes with each text padded to whole chunks, the chunks' starts, and the first chunk of each text."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    count = 1 + np.maximum(0, -(-(n - CHUNK) // STRIDE))
    padded = (count - 1) * STRIDE + CHUNK
    data = np.frombuffer(b"".join(t.ljust(p, b"\0") for t, p in zip(texts, padded.tolist(), strict=True)), np.uint8)
    first = np.cumsum(count) - count
    start = np.arange(int(count.sum())) * STRIDE + np.repeat((np.cumsum(padded) - padded) - first * STRIDE, count)
    return data, start, first


@dataclass
class Network:
    embedding: np.ndarray  # 256 x WIDTH
    filters: np.ndarray  # CHUNK * WIDTH x FILTERS
    bias: np.ndarray
    top: np.ndarray  # FILTERS
    shift: float

    def responses(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        x = self.embedding[data[start[:, None] + np.arange(CHUNK)]].reshape(len(start), -1)
        return np.maximum(x @ self.filters + self.bias, 0)

    def pieces(self, data: np.ndarray, start: np.ndarray, first: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
        """Of some chunks at a time: which chunks, which texts, each text's first chunk among them, and the responses."""
        ends, step = np.append(first[1:], len(start)), _PIECE // (CHUNK * WIDTH)
        for at in range(0, len(start), step):
            upto = min(at + step, len(start))
            a, b = int(np.searchsorted(ends, at, "right")), int(np.searchsorted(first, upto))
            yield slice(at, upto), slice(a, b), np.maximum(first[a:b] - at, 0), self.responses(data, start[at:upto])

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Each text's largest responses; chunks go through in pieces of bounded size."""
        data, start, first = chunks_of(texts)
        out = np.zeros((len(first), FILTERS), np.float32)
        for _, of, local, r in self.pieces(data, start, first):
            np.maximum(out[of], np.maximum.reduceat(r, local), out=out[of])
        return out

    def for_share(self, seen: np.ndarray, all_of: dict[int, int]) -> Network:
        """The network for the classes' true numbers, if it learned from both classes in another proportion."""
        ones, zeros = int((seen == 1).sum()), int((seen == 0).sum())
        if not (ones and zeros and all_of.get(0) and all_of.get(1)):
            return self
        return replace(self, shift=self.shift + float(np.log(all_of[1] / all_of[0]) - np.log(ones / zeros)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.pooled(texts) @ self.top + self.shift, -40, 40).astype(float)))


def winners(net: Network, data: np.ndarray, start: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's largest responses, and the first chunk that attains each."""
    z, at = np.full((len(first), FILTERS), -1, np.float32), np.zeros((len(first), FILTERS), np.int64)
    for chunks, of, local, r in net.pieces(data, start, first):
        best = np.maximum.reduceat(r, local)
        own = np.repeat(np.arange(len(local)), np.diff(np.append(local, len(r))))
        place = np.where(r == best[own], np.arange(chunks.start, chunks.stop)[:, None], len(start))
        place = np.minimum.reduceat(place, local)
        better = best > z[of]
        at[of] = np.where(better, place, at[of])
        z[of] = np.where(better, best, z[of])
    return z, at


def gradients(net: Network, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray | float]:
    """Of the mean log loss. A maximum's gradient goes to the chunk that attains it, so only those chunks are seen again."""
    data, start, first = chunks_of(texts)
    z, at = winners(net, data, start, first)
    e = (1 / (1 + np.exp(-np.clip(z @ net.top + net.shift, -30, 30))) - y) / len(y)
    dz = np.where(z > 0, e[:, None] * net.top, 0).astype(np.float32)
    seen, own = np.unique(at, return_inverse=True)
    dr = np.zeros((len(seen), FILTERS), np.float32)
    np.add.at(dr, (own.reshape(at.shape), np.arange(FILTERS)[None, :]), dz)
    codes = data[start[seen][:, None] + np.arange(CHUNK)]
    x = net.embedding[codes].reshape(len(codes), -1)
    dx, flat = (dr @ net.filters.T).reshape(-1, WIDTH), codes.reshape(-1)
    embedding = np.stack([np.bincount(flat, dx[:, k], 256) for k in range(WIDTH)], 1).astype(np.float32)
    return {"embedding": embedding, "filters": x.T @ dr, "bias": dr.sum(0), "top": z.T @ e, "shift": float(e.sum())}


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7, epochs: int = 12, steps: int = 240, batch_bytes: int = 1 << 18, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Fits a network; each class weighs as in the sample given. A small sample is gone through more often, up to `steps` steps."""
    rng = np.random.default_rng(seed)
    share = float(np.mean(labels)) if len(labels) else 0.5
    net = Network(rng.normal(0, 0.5, (256, WIDTH)).astype(np.float32), (rng.normal(0, 1, (CHUNK * WIDTH, FILTERS)) / np.sqrt(CHUNK * WIDTH) * 2).astype(np.float32), np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float32), 0.0)
    if not len(labels) or share in (0, 1):
        net.shift = float(np.log(max(share, 0.01) / max(1 - share, 0.01)))
        return net
    net.top = rng.normal(0, 0.1, FILTERS).astype(np.float32)
    names = ["embedding", "filters", "bias", "top", "shift"]
    m, v, t = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for _ in range(max(epochs, -(-steps * batch_bytes // max(batch_bytes, sum(map(len, texts)))))):
        order, held, size = rng.permutation(len(texts)), [], 0
        for i in order.tolist():
            held.append(i)
            size += len(texts[i])
            if size < batch_bytes and i != order[-1]:
                continue
            grads = gradients(net, [texts[k] for k in held], labels[held].astype(np.float32))
            grads["filters"] += decay * net.filters
            grads["top"] += decay * net.top
            t += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                v[k] = 0.99 * v[k] + 0.01 * np.square(grads[k])
                setattr(net, k, getattr(net, k) - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8))
            held, size = [], 0
    net.shift = float(net.shift)
    return net


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(id, label) outside the held-out fold, one row an id."""
    return labels.where((fold_of(id_col) != 0) & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).cast("int").alias("label"))


def sample_of(docs: DataFrame, labels: DataFrame, sample: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_bytes: int = 4 << 20, sample_bytes: int = 64 << 20) -> DataFrame:
    """(text, label) of at most `sample` labelled rows of each class outside the held-out fold, and of bounded bytes."""
    one = labelled(labels, id_col, label_col)
    pick = lambda y: one.where(F.col("label") == y).orderBy(F.xxhash64(id_col), id_col).limit(sample)
    chosen = pick(0).union(pick(1)).select(F.col(id_col).alias("__id"), "label")
    # At most 2 * sample rows of two numbers, so the texts need no shuffle.
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.where(size <= most_bytes).join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).groupBy("__id", "label").agg(F.min(text_col).alias("text"))
    order = [F.xxhash64("__id"), F.col("__id")]
    so_far = F.sum(F.octet_length(F.coalesce("text", F.lit("")))).over(Window.orderBy(*order))  # over 2 * sample rows at most
    return rows.withColumn("__bytes", so_far).where(F.col("__bytes") <= sample_bytes).orderBy(*order).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, **columns) -> Network:
    rows = sample_of(docs, labels, sample, **columns).toArrow()
    seen = rows.column("label").to_numpy()
    net = train(texts_of(rows.column("text")), seen)
    every = labelled(labels, **{k: v for k, v in columns.items() if k in ("id_col", "label_col")})
    id_col = columns.get("id_col", "doc_id")
    every = every.join(docs.select(id_col), id_col, "left_semi")  # labels of other documents don't count
    all_of = {r.label: r.n for r in every.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a class
    return net.for_share(seen, all_of)


def scored(docs: DataFrame, net: Network, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the score as one more column; a column of that name is replaced."""
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            got = [net.score(texts_of(texts.slice(a, b - a))) for a, b in stretches(texts, 2 << 20)]
            yield batch.append_column(name, pa.array(np.concatenate(got) if got else np.zeros(0)))

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of good quality, learned from the labelled rows outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = scored(docs.select("doc_id", "text"), net)
    return found.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
