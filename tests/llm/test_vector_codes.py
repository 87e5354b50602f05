"""Codes of vectors against a brute-force run of all rounds."""

import hashlib
import math

import numpy as np
import pytest

from freightlens.llm import vector_codes as codes
from tests.llm.cases import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, width, parts=8, entries=16, rounds=6):
    kept = [(i, v, label) for i, v, label in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [(k * width // parts, (k + 1) * width // parts) for k in range(parts)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in cut]
    near = lambda v, book: min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            got = [near(v[a:b], books[p])[1] for _, v, _ in kept]
            for k in range(len(books[p])):
                own = [v[a:b] for (_, v, _), g in zip(kept, got, strict=True) if g == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out, sums = [], {}
    for i, v, label in kept:
        found = [near(v[a:b], books[p]) for p, (a, b) in enumerate(cut)]
        out.append((i, label, [k for _, k in found], sum(d for d, _ in found)))
        sums[label] = sums.get(label, 0) + out[-1][3]
    text = ",".join(str(x) for b in books for e in b for x in e)
    order = lambda r: str(r)
    return sorted(((*r, sums[r[1]]) for r in out), key=order), hashlib.sha256(text.encode()).hexdigest()


def found(frame, **how):
    rows, books = codes.compress(frame, **how)
    return sorted((tuple(r) for r in rows.collect()), key=str), codes.digest(books)


def vectors(seed, n, width):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.2, width).astype("float32").tolist(), int(rng.integers(0, 4)) if i % 5 else None) for i in rng.permutation(n) * 3 + 1]
    same = rows[0][1]
    rows += [(10_000 + k, same, 7) for k in range(n // 2)]  # a third of all rows
    rows += [(10_000, same, 7), rows[3], (4, rows[5][1], 1), (None, rows[6][1], 1)]
    return rows


def test_brute_force_with_repeats_ties_and_bad_rows(spark):
    rows = vectors(1, 120, 16)
    bad = [(0, None, 1), (2, [None] * 16, 1), (-1, [float("nan")] * 16, 2), (-2, [float("inf")] + [0.0] * 15, 2), (-3, [], 3), (-4, [0.5] * 8, 3), (-5, rows[0][1][:15] + [float("-inf")], None)]
    frame = clashing(spark.createDataFrame(rows + bad, SCHEMA).repartition(5), "row", "pos", "value", "weight", "code", "ints")
    assert found(frame) == brute(rows, 16)


@pytest.mark.parametrize("hot", [2, 100000])
def test_common_values_by_broadcast_and_by_shuffle(spark, hot, monkeypatch):
    monkeypatch.setattr(codes, "HOT_PART", hot)
    rows = vectors(2, 60, 8)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 8)


def test_parts_that_are_not_equal_and_few_vectors(spark):
    rows = vectors(3, 8, 11)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 11)
    assert found(spark.createDataFrame(rows[:1], SCHEMA)) == brute(rows[:1], 11)
    assert found(spark.createDataFrame([(1, [0.1, 0.2], 1)], SCHEMA), parts=8) == brute([(1, [0.1, 0.2], 1)], 2)


def test_nothing(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        assert codes.compress(spark.createDataFrame(rows, SCHEMA))[0].collect() == []


def test_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="fit the sums"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_decoded_vectors_are_near(spark):
    rows = vectors(4, 100, 16)
    frame = spark.createDataFrame(rows, SCHEMA)
    coded, books = codes.compress(frame, entries=64, rounds=8)
    got = codes.decoded(coded, books).select("vec_id", "vector", "error").collect()
    by_id = {i: v for i, v, _ in rows}
    for r in got:
        if r.vec_id in by_id and r.vec_id != 4 and r.vec_id != 10_000:
            assert sum((a - b) ** 2 for a, b in zip(r.vector, by_id[r.vec_id], strict=True)) == pytest.approx(r.error / 4096**2, abs=0.01)
