"""Substring, line and SimHash dedup against brute force."""

import random
import re
import threading
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from freightlens.llm import common, line_dedup, quality_rules
from freightlens.llm.common import Words
from freightlens.llm.line_dedup import LineRuns, dedup_lines
from freightlens.llm.simhash_dedup import Likeness, bits_of, components, first_of_each, forest, links, near_duplicates, shingle_hashes
from freightlens.llm.substring_dedup import repeated_windows, rolled

from .cases import LOWER, clashing, documents, empty


def words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]


@pytest.mark.parametrize("size, lot", [(3, 2048), (16, 2048), (35, 2048), (16, 2)])
def test_repeated_windows(spark, size, lot):
    docs = documents(spark)
    found = repeated_windows(clashing(docs, "data", "pack", "n_words"), keep=("doc_id",), size=size, pack_bytes=2000 if size == 16 else 6 << 20, lot=lot)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect())
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    seen = Counter(tuple(w[i : i + size]) for _, w in rows for i in range(len(w) - size + 1))
    want = Counter()
    for doc, w in rows:
        gone = {p for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for p in range(i, i + size)}
        want[doc, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)] += 1
    assert got == want and sum(n for _, _, n, _ in want) > 100


def test_windows_over_themselves_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a b " * 40), (2, "c " * 36), (3, "d " * 35)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeated_windows(docs, keep=("doc_id",)).collect()}
    assert got == {1: 80, 2: 36, 3: 0}
    assert repeated_windows(empty(spark), keep=("doc_id",)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 35])
def test_equal_runs_and_only_they_hash_alike(size):
    rng = np.random.default_rng(3)
    word = rng.integers(0, 3 if size > 3 else 9, 3000)
    h = rng.integers(0, 2**63, 9, dtype=np.uint64)[word]
    h[500:600] = h[900:1000]
    runs = [tuple(h[i : i + size].tolist()) for i in range(len(h) - size + 1)]
    got = rolled(h, size, np.uint64(1000003)).tolist()
    assert len(got) == len(runs) and len(set(got)) == len(set(runs)) == len(set(zip(got, runs, strict=True)))
    assert len(rolled(h[: size - 1], size, np.uint64(3))) == 0


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s[:n], s[:n].translate(str.maketrans("ab", "ba"))


def test_structured_words_are_not_taken_for_each_other(spark):
    # Polynomials modulo a power of two take these for equal, whatever the base; so do they for words in that order.
    rest = " ".join(f"w{k}" for k in range(34))
    rows = [f"{x} {rest}" for n in (64, 250, 1024, 4096) for x in thue_morse(n)]
    rows += [" ".join({"a": "one", "b": "two"}[c] for c in x) for x in thue_morse(64)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeated_windows(docs, keep=("doc_id",), size=35).collect()}
    seen = Counter(tuple(r.split()[i : i + 35]) for r in rows for i in range(len(r.split()) - 34))
    want = {k: len({p for i in range(len(r.split()) - 34) if seen[tuple(r.split()[i : i + 35])] > 1 for p in range(i, i + 35)}) for k, r in enumerate(rows)}
    assert got == want and all(want[k] == 0 for k in range(8))


def test_word_hashes():
    rng = random.Random(2)
    every = ["".join(rng.choice("ab\x00é数") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 90, 300]))) for _ in range(5000)]
    got = Words([" ".join(every).encode()]).hashes(1)
    assert len(got) == len(every) and len(set(got.tolist())) == len(set(every)) == len(set(zip(got.tolist(), every, strict=True)))
    assert Words([w.encode() for w in every]).hashes(1).tolist() == got.tolist() != Words([w.encode() for w in every]).hashes(2).tolist()
    assert Words([b"ABC abc " + b"X" * 400 + b" " + b"x" * 400], fold=True).hashes(1).tolist()[::2] == Words([b"ABC abc " + b"X" * 400 + b" " + b"x" * 400], fold=True).hashes(1).tolist()[1::2]


def brute_lines(rows, length=40, enough=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(set)  # documents are ids; rows without one are one document
    for doc, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= length:
                holders[k].add(doc)
    keeper = {k: max((d for d in ds if d is not None), default=None) for k, ds in holders.items() if len(ds) >= enough}
    out = Counter()
    for doc, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc]
        out[doc, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("batches, fanout, part", [(1, 2, 1000), (3, 2, 1), (5, 3, 1000)])
def test_lines(spark, monkeypatch, batches, fanout, part):
    monkeypatch.setattr(line_dedup, "HOT_PART", part)  # at 1 no key is joined by broadcast
    docs = documents(spark)
    found = dedup_lines(clashing(docs, "h1", "keeper", "id", "n"), batches=batches, fanout=fanout, buckets=3)
    assert {"h1", "keeper", "lang"} <= set(found.columns)
    got = Counter((r["doc_id"], r["__n_lines"], r["__n_dropped"], r["__kept"]) for r in found.collect())
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want and sum(n for _, _, n, _ in want) > 10


def test_runs_are_compacted_and_keep_counting(spark):
    runs = LineRuns(spark, buckets=2, fanout=2, min_length=1, min_documents=3)
    batch = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    for rows in ([(9, "x"), (8, "x\ny")], [(7, "x\nz")], [(6, "y"), (5, "z")], [(4, "y")]):
        runs.add(batch(*rows))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    gone = {r.id for r in runs.doomed().collect()}
    assert gone == {8, 7, 6, 4}  # x is kept by 9, y by 8; z is in two documents


LINE = "This line is forty characters long or more, so it counts."


def test_repeated_rows_are_one_document(spark, tmp_path):
    import duckdb

    rows = [(1, f"{LINE}\nx")] * 3 + [(2, LINE), (3, LINE)]
    more = [(k, f"{LINE.upper()}?\n{LINE}?") for k in range(4, 9)] + [(4, f"a\n{LINE}?")]
    for own, dropped in ((rows, 0), (rows + more, 9)):
        spark.createDataFrame(own, "doc_id long, text string").write.parquet(str(tmp_path / f"{len(own)}/documents.parquet"))
        got = line_dedup.op8_line_dedup(spark, str(tmp_path / str(len(own))))
        c = duckdb.connect()
        c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/{len(own)}/documents.parquet/*.parquet'")
        want = Counter(map(tuple, c.sql(line_dedup.OP8_SQL).fetchall()))
        assert Counter(map(tuple, got.collect())) == want and sum(r[2] * n for r, n in want.items()) == dropped


def test_ids_of_text_and_long_texts(spark):
    long = "\n".join(f"line {k} {LINE}" for k in range(60_000))
    rows = [(x, long) for x in "abcdef"]
    got = {r.doc_id: (r["__n_lines"], r["__n_dropped"], len(r["__kept"])) for r in dedup_lines(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {x: (60_000, 60_000, 0) for x in "abcde"} | {"f": (60_000, 0, len(long))}


def test_lines_of_an_empty_table(spark):
    assert dedup_lines(empty(spark)).count() == 0


def brute_fingerprint(t, size=3):
    w = words((t or "").translate(LOWER))
    shingles = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, near):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near(rows[i], rows[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), doc) if x is not None), default=None)
    return [least[root(i)] for i in range(len(rows))]


@pytest.mark.parametrize("tile", [2, 8192])
def test_near_duplicates(spark, tile):
    docs = documents(spark)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    label = brute_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 2)
    want = Counter((d, f, c) for (d, f), c in zip(rows, label, strict=True))
    found = near_duplicates(clashing(docs, "fp", "more", "size"), tile=tile)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in found.collect()) == want
    assert near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("radius, tile", [(2, 5), (9, 16), (9, 8192)])
def test_links_find_all_pairs_in_reach(spark, radius, tile):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = sorted({int(b ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k, dtype=np.uint64))) for b in base for k in (1, 2, 3, 6, 9, 12)} | {0})
    rows = [(x - 2**64 if x >> 63 else x, [x - 2**64 if x >> 63 else x], []) for x in fps]
    nodes = spark.createDataFrame(rows, "node long, bits array<long>, cells array<long>")
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links(nodes, Likeness(radius=radius), tile).collect()]
    own = dict((f, k) for k, f in enumerate(fps))
    label = brute_components([(k, f) for k, f in enumerate(fps)], lambda a, b: (a[1] ^ b[1]).bit_count() <= radius)
    edges = {frozenset((own[a], own[b])) for a, b in pairs}
    assert brute_components([(k, k) for k in range(len(fps))], lambda a, b: frozenset((a[1], b[1])) in edges) == label


@pytest.mark.parametrize("words", [1, 2])
def test_forest_skips_nothing(words):
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2 ** (12 // words), (400, words), dtype=np.uint64), axis=0)
    x, y = forest(a, None, 1, block=16)
    edges = {frozenset(p) for p in zip(x.tolist(), y.tolist(), strict=True)}
    fps = [tuple(r) for r in a.tolist()]
    want = brute_components(list(enumerate(fps)), lambda p, q: sum((u ^ v).bit_count() for u, v in zip(p[1], q[1], strict=True)) <= 1)
    assert brute_components([(k, k) for k in range(len(fps))], lambda p, q: frozenset((p[1], q[1])) in edges) == want


def test_components_of_a_path(spark):
    rows = [(k, k + 1) for k in range(20)] + [(31, 30), (30, 32), (40, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(21), 0) | {30: 30, 31: 30, 32: 30}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    long = " ".join(f"w{k}" for k in range(400))
    near = long.replace("w200 ", "changed ")
    rows = [(5, long), (3, near), (9, long), (9, long), (7, "something else altogether that is here"), (None, "lone text without a number of its own"), (None, "lone text without a number of its own"), (None, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1))
    got = Counter((r.doc_id, r.text) for r in first_of_each(docs).collect())
    assert got == Counter({(3, near): 1, (7, rows[4][1]): 1, (None, rows[5][1]): 1})
    assert first_of_each(empty(spark)).count() == 0


def test_an_id_used_again_keeps_both_components(spark):
    one, two = (" ".join(f"{p}{k}" for k in range(100)) for p in "uv")
    rows = [(1, one), (2, one + " end"), (1, two), (2, two + " end"), (1, one)]
    got = first_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter({(1, one): 1, (1, two): 1})


def five_word_sets(t, size=5):
    w = words((t or "").translate(LOWER))
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def alike(a, b):
    return a[1] == b[1] or 10 * len(a[1] & b[1]) >= 8 * len(a[1] | b[1])


def edited(rng, text, n):
    w = text.split()
    for k in rng.sample(range(len(w)), n):
        w[k] = f"new{rng.random()}"
    return " ".join(w)


@pytest.mark.parametrize("tile, hashes", [(4, 1 << 21), (4096, 1 << 21), (4096, 500)])
def test_near_copies_are_those_of_brute_force_similarity(spark, tile, hashes):
    # Similarities on both sides of 0.8, and chains of them; bits alone link many pairs of 0.7 to 0.8.
    rng, texts = random.Random(4), ["", None, "few words", "Few  words"]
    for size in (60, 200, 400):
        for _ in range(3):
            texts.append(" ".join(f"w{rng.random()}" for _ in range(size)))
            for n in (1, 2, 3, 4, 5, 6, 7, 8):
                texts.append(edited(rng, rng.choice(texts[-n:]), max(1, size * n // 200)))
    texts.append(texts[4] + " " + texts[4])  # the same shingles, twice as many
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    sets = [(k, five_word_sets(t)) for k, t in rows]
    want = sorted(set(brute_components(sets, alike)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in first_of_each(docs, tile=tile, tile_hashes=hashes).collect()) == want


def test_fingerprint_of_little():
    bits = lambda t, words=1: bits_of(shingle_hashes(t, 3), words)
    assert bits(b"") == [0] and bits(b" \t", 4) == [0] * 4 and len(shingle_hashes(b"", 3)) == 0
    assert bits(b"One two") == [xxhash.xxh64_intdigest(b"one two", 42)]
    assert bits("ä b c d".encode()) == [brute_fingerprint("ä b c d")]


def test_shared_tables_can_be_cleared(spark):
    there = lambda p: (q := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(q)
    outer = common.written(spark.range(2))
    path = common._SCOPES.all[-1][-1]
    with common.scoped(spark):
        assert common.written(spark.range(3)).count() == 3
        dedup_lines(documents(spark)).count()
        inner = list(common._SCOPES.all[-1])
        tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("fl_run_")]
        assert tables and len(inner) > 3
    left = {t.name for t in spark.catalog.listTables()}
    assert not any(there(p) for p in inner if not p.startswith("table:")) and not left & {p.removeprefix("table:") for p in inner}
    assert there(path) and outer.count() == 2
    common.clear_shared(spark)
    assert not there(path)


def test_a_threads_tables_are_its_own(spark):
    """Two queries at a time: one that has read its results deletes nothing of the other."""
    made, read = threading.Barrier(2, timeout=60), threading.Event()

    def first():
        with common.scoped(spark):
            common.written(spark.range(3))
            made.wait()
        read.set()

    def second():
        table = common.written(spark.range(5))
        made.wait()
        read.wait(60)
        found = table.count()
        common.clear_shared(spark)
        return found

    with ThreadPoolExecutor(2) as pool:
        one, two = pool.submit(first), pool.submit(second)
        one.result()
        assert two.result() == 5


def test_operators_leave_the_sessions_batches(spark):
    name = common._BATCH
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        quality_rules.measured(documents(spark, n=12)).count()
        assert spark.conf.get(name) == "64m"
        spark.conf.set(name, "7m")
        common.small_batches(spark)
        assert spark.conf.get(name) == "7m"
    finally:
        spark.conf.set(name, before)


def test_few_buckets_give_the_same_lines(spark, monkeypatch):
    docs = documents(spark)
    found = lambda: sorted(map(str, line_dedup.dedup_lines(docs).select("doc_id", "text", "__n_lines", "__n_dropped", "__kept").collect()))
    many = found()
    monkeypatch.setattr(line_dedup, "MOST_BUCKETS", 1)
    assert found() == many


def test_a_line_is_hot_by_its_lines(spark):
    """Six documents repeat a line 4,000 times each: by its documents it would be one of many."""
    hot, rows = "This very common line has more than forty characters.", []
    rows += [(k, "\n".join([hot] * 4000)) for k in range(6)]
    rows += [(10 + k, f"Another line of more than forty characters, number {k}.") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    runs = line_dedup.LineRuns(spark, buckets=4)
    runs.add(docs)
    totals = runs._totals(runs.runs())
    common_keys = totals.where((F.col("n") >= 5) & (F.col("lines") * line_dedup.HOT_PART >= 24_050)).collect()
    assert [(r.n, r["lines"]) for r in common_keys] == [(6, 24_000)]
    kept = {r.doc_id: r["__n_dropped"] for r in runs.cut(docs).collect()}
    assert [kept[k] for k in range(6)] == [4000] * 5 + [0] and not any(kept[10 + k] for k in range(50))
