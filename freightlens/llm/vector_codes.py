"""Compression of vectors to codes of their parts, by weighted Lloyd over distinct integer values.

Components become integers, floor(scale * x). A vector is cut into `parts` consecutive parts. Equal parts of a position are
one distinct row with a weight, added up before any row moves; Lloyd's rounds run over these. A round is a narrow pass
that adds up, for each entry of each position's codebook, the weights and weighted sums of the values nearest to it: a row
an entry and task, so only codebooks (parts * entries rows, a bound by the parameters) come to the driver, and sums are of
whole numbers, so they don't depend on the order. At last each distinct value gets its code and error, which are joined
back to the vectors: values with a thousandth of all rows or more by broadcast (at most a thousand a position), all others
by a shuffle of their hashes and values, so no task gets all rows of a common value. Errors of common labels likewise.

Vectors that are null, hold null or non-finite components, or have another length than the table's longest go, empty ones
too; if nothing is left there are no rows. Parts are as equal as can be if the length isn't a multiple. Components of
32,768 or more would not fit the sums and are an error. Ties: of equal distances the lower entry; of repeated ids the
smaller vector comes first where the codebooks begin, null ids last; repeated rows are vectors of their own, each with its
code. With fewer vectors than entries a codebook has as many. Null labels are one label. Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: A key with this part of all rows is joined by broadcast.
HOT_PART = 1000
_LARGEST = 1 << 27

Codebooks = list[np.ndarray]


def bounds(width: int, parts: int) -> list[tuple[int, int]]:
    """Where each part begins, and its length."""
    edge = [k * width // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, vec_id, label, ints array of long) of the vectors that are kept; row tells repeated ones apart."""
    x = F.col(vector_col)
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(sound).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("ints"))
    return rows.where(F.size("ints") > 0).select(F.monotonically_increasing_id().alias("row"), "*")


def distinct_parts(rows: DataFrame, cut: list[tuple[int, int]]) -> DataFrame:
    """(pos, value array, weight) of the different parts of each position."""
    return parts_of(rows, cut).groupBy("pos", "value").agg(F.count(F.lit(1)).alias("weight"))


def parts_of(rows: DataFrame, cut: list[tuple[int, int]], *keep: str) -> DataFrame:
    values = F.array(*(F.slice("ints", a + 1, n) for a, n in cut))
    return rows.select(*keep, F.posexplode(values).alias("pos", "value"))


def nearest(values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of each value, and its squared distance; a few thousand values at a time."""
    code, error = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    for a in range(0, len(values), 4096):
        d = np.square(values[a : a + 4096, None, :] - book[None]).sum(2)
        code[a : a + 4096] = d.argmin(1)
        error[a : a + 4096] = d.min(1)
    return code, error


def _by_position(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Position, the batch's rows of it, and their values."""
    pos, values = batch.column("pos").to_numpy(), batch.column("value")
    for p in np.unique(pos).tolist():
        at = np.flatnonzero(pos == p)
        yield p, at, values.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), books[p].shape[1])


def moved(distinct: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: each entry is the floor of its values' weighted mean; entries without values stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sums = [np.zeros(len(b), np.int64) for b in books], [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            for p, at, values in _by_position(batch, books):
                code, _ = nearest(values, books[p])
                np.add.at(weights[p], code, weight[at])
                np.add.at(sums[p], code, values * weight[at, None])
        rows = [(p, k, int(n), sums[p][k].tolist()) for p, w in enumerate(weights) for k, n in enumerate(w) if n]
        pos, entry, n, total = zip(*rows, strict=True) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(pos, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))], ["pos", "entry", "n", "total"])

    width = max(b.shape[1] for b in books)
    found = distinct.mapInArrow(run, "pos int, entry int, n long, total array<long>")
    sums = found.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(k))).alias(f"s{k}") for k in range(width)))
    out = [b.copy() for b in books]
    for r in sums.collect():  # parts * entries rows at most
        out[r.pos][r.entry] = [r[f"s{k}"] // r.n for k in range(out[r.pos].shape[1])]
    return out


def coded(distinct: DataFrame, books: Codebooks) -> DataFrame:
    """(pos, value, weight, code, error) of each distinct value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for p, at, values in _by_position(batch, books):
                code[at], error[at] = nearest(values, books[p])
            yield batch.append_column("code", pa.array(code)).append_column("error", pa.array(error))

    return distinct.mapInArrow(run, "pos int, value array<long>, weight long, code long, error long")


def joined(rows: DataFrame, facts: DataFrame, on: Column, weight: str, total: int) -> DataFrame:
    """rows with their facts, of which there is one a key: hot keys by broadcast, the others by a shuffle."""
    hot = F.col(weight) * HOT_PART >= total
    common, others = F.broadcast(facts.where(hot)), facts.where(~hot)  # weights add up to the rows, so at most HOT_PART keys a position are hot
    return rows.join(common, on).unionByName(rows.join(common, on, "left_anti").join(others.hint("shuffle_hash"), on))


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def fitted(distinct: DataFrame, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    for _ in range(rounds):
        books = moved(distinct, books)
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, codes array of long by position, error, label_error) of each vector that is kept, and the codebooks."""
    rows = written(whole_numbers(vectors, id_col, vector_col, label_col, scale))
    facts = rows.agg(F.max(F.size("ints")).alias("width"), F.max(F.array_max(F.transform("ints", F.abs))).alias("largest")).first()
    if (facts.largest or 0) >= _LARGEST:
        raise ValueError(f"a component is {facts.largest / scale} or so; whole numbers of {_LARGEST} and more don't fit the sums")
    width = facts.width or parts
    cut, rows = bounds(width, parts), rows.where(F.size("ints") == width)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()  # as many as entries
    begin = np.array([r.ints for r in first], np.int64).reshape(len(first), width)
    books = [begin[:, a : a + n].copy() for a, n in cut]
    empty = not len(first)
    distinct = written(distinct_parts(rows, cut))
    books = books if empty else fitted(distinct, books, rounds)
    codes = written(coded(distinct, books).select(F.col("pos").alias("_pos"), F.col("value").alias("_value"), "weight", "code", "error"))
    total = rows.count()
    found = joined(parts_of(rows, cut, "row", "vec_id", "label"), codes, (F.col("pos") == F.col("_pos")) & (F.col("value") == F.col("_value")), "weight", total)
    found = written(found.groupBy("row").agg(F.first("vec_id").alias("vec_id"), F.first("label").alias("label"), F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("_codes"), F.sum("error").alias("error")))
    by_label = found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("weight")).withColumnRenamed("label", "_label")
    found = joined(found, written(by_label, few=True), F.col("label").eqNullSafe(F.col("_label")), "weight", total)
    return found.select("vec_id", "label", F.col("_codes.code").alias("codes"), "error", "label_error"), books


def decoded(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """codes with the column vector: what the codebooks have for them, as numbers (the middle of a step)."""
    tables = [F.array(*(F.array(*(F.lit((float(x) + 0.5) / scale) for x in entry)) for entry in b)) for b in books]
    return codes.withColumn("vector", F.flatten(F.array(*(F.get(t, F.get("codes", F.lit(p)).cast("int")) for p, t in enumerate(tables)))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return found.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _rounds() -> str:
    """The rounds of the SQL: each value's nearest entry, then the entries' floors of means."""
    out = []
    for r in range(1, ROUNDS + 2):
        near = f"SELECT p.row, p.pos, min({{d: list_sum(list_transform(list_zip(p.value, b.entry), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT, k: b.k}}) AS near FROM parts p JOIN b{r - 1} b ON p.pos = b.pos GROUP BY p.row, p.pos"
        out.append(f"n{r} AS ({near})")
        if r <= ROUNDS:
            means = f"SELECT pos, k, list(m ORDER BY i) AS entry FROM (SELECT p.pos, n.near.k AS k, i, floor(sum(p.value[i]) / count(*))::BIGINT AS m FROM n{r} n JOIN parts p ON p.row = n.row AND p.pos = n.pos, range(1, {64 // PARTS} + 1) AS t(i) GROUP BY p.pos, n.near.k, i) GROUP BY pos, k"
            out.append(f"b{r} AS (SELECT o.pos, o.k, coalesce(m.entry, o.entry) AS entry FROM b{r - 1} o LEFT JOIN ({means}) m ON o.pos = m.pos AND o.k = m.k)")
    return ", ".join(out)


#: Of vectors of 64 components without repeated ids.
OP12_SQL = f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS (SELECT vec_id AS row, pos, ints[pos * {64 // PARTS} + 1 : pos * {64 // PARTS} + {64 // PARTS}] AS value FROM kept, range(0, {PARTS}) AS t(pos)),
b0 AS (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY row) - 1 AS k, value AS entry FROM parts SEMI JOIN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}) ON row = vec_id),
{_rounds()},
codes AS (SELECT row, string_agg(printf('%02x', near.k), '' ORDER BY pos) AS code, sum(near.d)::BIGINT AS error FROM n{ROUNDS + 1} GROUP BY row),
books AS (SELECT sha256(string_agg(list_aggregate(entry, 'string_agg', ','), ',' ORDER BY pos, k)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN codes ON row = vec_id, books"""
