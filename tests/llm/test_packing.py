"""Packing against the tokenizer's own ids, the rules of a packing, and the fewest sequences there can be."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from freightlens.llm import best_fit_packing as packing
from tests.llm.cases import clashing, documents, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b\n c \t d  ", " x y", "y ", "  ", "x <|endoftext|> y<|endoftext|>z", "it 's 'll\n\n  k", "a , b . c\x1c. d.. e., f,. g!? ², 5, x\n. ́. é. ", "a\xa0 b 　c \x85d \x0bf", "", " ", "a\x1f b \x1f c", None]


def plain_ids(texts):
    return [x.ids for x in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def checked(rows, texts, capacity=1024):
    """rows: (doc_id, piece, start, length, ids_crc32, sequence_id, offset); texts: of all documents, in any order."""
    want = []
    for ids in plain_ids(texts):
        ids = np.array([*ids, 2], "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(min(first, len(ids)), len(ids), capacity), len(ids)]
        want += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    assert sorted(tuple(r)[1:5] for r in rows) == sorted(want)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), packing.least([n for *_, n, _ in want], capacity)


def test_ids_are_the_tokenizers():
    texts = ODD + ["word " * 50, "数据 über, model. " * 30]
    encode, want = packing.Encoder(PATH), plain_ids(texts)
    assert [x.tolist() for x in encode(pa.array(texts))] == want
    assert [encode.long(t or "", part=5).tolist() for t in texts] == want
    small = packing.Encoder(PATH, most=8)  # forgets after each call
    assert [small(pa.array([t], pa.string()))[0].tolist() for t in texts] == want


def test_edge_cases(spark):
    docs = clashing(documents(spark), "length", "part", "nth", "offset", "_level")
    docs = docs.unionByName(spark.createDataFrame([(900 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string"), allowMissingColumns=True)
    rows = packing.pack_documents(docs, PATH).collect()
    used, least = checked(rows, [r.text for r in docs.select("text").collect()])
    assert used <= least + 1


@pytest.mark.parametrize("slots", [40, 300])
def test_levels_of_copies(spark, slots):
    """A few slots stand for many pieces; a third of all have one length."""
    rng = random.Random(slots)
    texts = ["w " * n for n in [rng.randint(0, 1500) for _ in range(400)] + [300] * 200]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = packing.pack_documents(docs, PATH, slots=slots, offspring=8, epochs=2).collect()
    used, least = checked(rows, texts)
    assert used <= least * 1.05


def test_small_sequences_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j"), (1, "a b"), (None, None)], "doc_id long, text string")
    used, least = checked(packing.pack_documents(docs, PATH, capacity=4).collect(), ["a b c d e f g h i j", "a b", None], 4)
    assert used == least
    assert packing.pack_documents(empty(spark), PATH).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, n=20)
    rows = packing.pack_documents(docs, PATH, keep_ids=True)
    whole = packing.sequences(rows).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(x) + 1 for x in plain_ids([r.text for r in docs.collect()]))
    assert all(len(r.ids) <= 1024 and len(r.starts) == len(r.doc_ids) and r.starts[0] == 0 for r in whole)


def test_evolution_finds_a_better_packing():
    """Children of best fits have fewer or fuller sequences than best fit of falling sizes."""
    sizes, rng = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6] * 3, random.Random(3)
    plain = packing.beginning(sizes, 60, rng, plain=True)
    population = [plain] + [packing.beginning(sizes, 60, rng, plain=False) for _ in range(5)]
    best = packing.evolved(population, 600, rng)[0]
    assert (np.bincount(best.chromosome(), np.array(sizes)) <= 60).all()
    assert best.fitness() < plain.fitness()


def test_children_hold_every_slot_once():
    rng = random.Random(5)
    sizes = [rng.randint(1, 100) for _ in range(200)]
    parents = [packing.beginning(sizes, 100, rng, plain=False) for _ in range(2)]
    for _ in range(50):
        child = packing.crossed(*parents, rng)
        where = child.chromosome()
        assert sorted(s for g in child.groups for s in g) == list(range(200)) and (np.bincount(where, np.array(sizes)) <= 100).all()
        assert child.room == [100 - int(x) for x in np.bincount(where, np.array(sizes))]
        assert packing.Groups.of(where, sizes, 100).fitness() == child.fitness()


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = packing.op11_best_fit_packing(spark, path).collect()
    texts = [r.text for r in spark.read.parquet(f"{path}/documents.parquet").select("text").collect()]
    used, least = checked(rows, texts)
    assert used <= least * 1.002 + 1
