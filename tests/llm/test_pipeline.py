"""The pipeline stage by stage against brute force, and the registration of the queries."""

import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from freightlens.llm import quality_cnn, source_mixing
from freightlens.llm.queries import oracle_sql, queries
from freightlens.llm.sentencepiece_viterbi import default_model

from .cases import clashing, documents, empty
from .test_dedup import alike, brute_components, brute_lines, five_word_sets
from .test_models import slow_quotas

ROOT = Path(__file__).resolve().parents[2]
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def before(place):
    """The environment with a folder before all others that Python looks in."""
    return os.environ | {"PYTHONPATH": os.pathsep.join(filter(None, (str(place), os.environ.get("PYTHONPATH", ""))))}


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries())
    assert numbers == list(range(1, 14)) and set(oracle_sql()) <= set(queries())
    import __spark_entry__ as entry

    assert set(queries()) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5


def test_the_rest_works_without_this_package(tmp_path):
    for name in ("freightlens", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "freightlens/llm")
    code = "import __spark_entry__ as e, sys; q = e.queries(); assert 'spine' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q); assert not any('llm' in m for m in sys.modules)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=before(tmp_path), check=True, timeout=120)


def test_a_choice_of_the_other_tests_passes_without_this_package(tmp_path):
    for name in ("freightlens", "tests", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "freightlens/llm")
    shutil.rmtree(tmp_path / "tests/llm")
    chosen = "config or csv or object_store or source_types or catalog or star_except or entry or uniqueness"
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-k", chosen, "-p", "no:cacheprovider"], cwd=tmp_path, env=before(tmp_path), timeout=400, capture_output=True, text=True)
    assert found.returncode == 0 and " passed" in found.stdout, found.stdout[-2000:]


@needs_tables
def test_stages(spark, tmp_path):
    def stage(k, docs):
        out = corpus_pipeline.STAGES[k][1](spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        return spark.read.parquet(str(tmp_path / str(k)))

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    good = stage(0, docs)
    net = quality_cnn.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    every = rows(docs)
    score = net.score([t.encode() for _, t in every])
    # Texts are scored in batches, whose sizes may move a score's last digits.
    near = {d for (d, _), s in zip(every, score, strict=True) if abs(s - 0.3) < 1e-6}
    assert good.columns == docs.columns
    assert {d for d, _ in rows(good)} - near == {d for (d, _), s in zip(every, score, strict=True) if s >= 0.3} - near

    lines = stage(1, good)
    want = Counter((d, kept) for d, _, _, kept in brute_lines(rows(good)).elements())
    assert lines.columns == docs.columns and Counter(rows(lines)) == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    once = stage(2, lines)
    sets = [(d, five_word_sets(t)) for d, t in rows(lines)]
    stays = Counter(set(brute_components(sets, alike)))
    assert Counter(d for d, _ in rows(once)) == stays and len(stays) < len(sets)

    mix = stage(3, once)
    levels = once.select("doc_id", "text", *(c.alias(n) for n, c in source_mixing.levels().items())).collect()
    supply = Counter()
    for r in levels:
        supply[r["__domain"], r["__lang"], r["__source"]] += len(r.text.split())
    due = slow_quotas(dict(supply), source_mixing.WEIGHTS, 0.9 * sum(supply.values()), 1)
    taken, longest = Counter(), Counter()
    chosen = {d for d, _ in rows(mix)}
    for r in levels:
        leaf = (r["__domain"], r["__lang"], r["__source"])
        longest[leaf] = max(longest[leaf], len(r.text.split()))
        taken[leaf] += len(r.text.split()) * (r.doc_id in chosen)
    assert mix.columns == docs.columns and chosen <= {d for d, _ in rows(once)}
    assert all(due[leaf] <= taken[leaf] < due[leaf] + max(1, longest[leaf]) for leaf in supply)

    import sentencepiece

    last = {r.doc_id: r for r in stage(4, mix).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_proto=default_model())
    kept = rows(mix)
    assert {d: last[d].ids for d, _ in kept} == dict(zip([d for d, _ in kept], sp.encode([t for _, t in kept]), strict=True))
    assert len(last) == len(kept) and all(r.n_pieces == len(r.ids) for r in last.values())


@needs_tables
def test_run_is_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "lang", "source", "n_pieces", "ids", "decoded_sha256"] and 0 < got.count() < 200


def labels_of(spark, docs):
    return docs.selectExpr("doc_id", "cast(length(text) > 300 as int) AS quality", "0 AS toxic").where("doc_id % 2 = 0")


@pytest.mark.parametrize("nothing", [False, True])
def test_stages_on_odd_tables(spark, tmp_path, nothing):
    # Nulls in every column, empty and long texts, ties, repeated rows, and columns that stages use inside.
    docs = empty(spark) if nothing else documents(spark)
    more = clashing(docs, "__score", "__kept", "id", "n", "th", "node", "n_tokens", "copies", "quality", "ids")
    more.write.parquet(str(tmp_path / "documents.parquet"))
    labels_of(spark, docs).write.parquet(str(tmp_path / "labels.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, table, str(tmp_path))
        assert found.columns == (corpus_pipeline.COLUMNS if k < 4 else ["doc_id", "lang", "source", "n_pieces", "ids", "decoded_sha256"])
        assert found.count() <= docs.count() and (found.count() == 0) == nothing
    n = corpus_pipeline.run(spark, str(tmp_path)).count()
    assert n == 0 if nothing else 0 < n < docs.count()


OVER_DOCUMENTS = sorted(n for n in queries() if not n.startswith(("op12_", "op13_")))


@pytest.mark.parametrize("name", OVER_DOCUMENTS)
def test_queries_on_odd_tables(spark, tmp_path, name):
    for which, docs in (("some", documents(spark)), ("none", empty(spark))):
        docs.write.parquet(str(tmp_path / which / "documents.parquet"))
        labels_of(spark, docs).write.parquet(str(tmp_path / which / "labels.parquet"))
        found = queries()[name](spark, str(tmp_path / which))
        rows = found.where("piece = 0") if name.startswith("op11_") else found
        assert rows.count() == docs.count()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_near_copies_of_the_drivers_documents(spark):
    """The stage keeps the documents that the similarities of all pairs of whole texts keep."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = [(r.doc_id, five_word_sets(r.text)) for r in docs.collect()]

    def close(a, b):
        return 10 * min(len(a[1]), len(b[1])) >= 8 * max(len(a[1]), len(b[1])) and alike(a, b)

    stays = set(brute_components(sets, close))
    found = [r.doc_id for r in corpus_pipeline.STAGES[2][1](spark, docs, "/root/testdata/sf0.01").collect()]
    assert sorted(found) == sorted(stays) and len(stays) < len(sets)


def test_a_very_long_text_goes_through_all_stages(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = np.array(["w" + str(k) for k in range(5000)])
    rows = [(k, " ".join(rng.choice(words, 60)), "en", f"src{k % 3}", 0) for k in range(40)] + [(100, " ".join(rng.choice(words, 300_000)), "en", "src1", 0), (101, "x" * 1_000_000, "en", "src1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        ids = {r.doc_id for r in stage(spark, table, str(tmp_path)).select("doc_id").collect()}
        assert k == 3 or {100, 101} <= ids


@needs_tables
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, want = queries()[name](spark, SF), c.sql(oracle_sql()[name])
    order = [want.columns.index(x) for x in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[k] for k in order) for r in want.fetchall())


def test_scores_do_not_depend_on_the_batch():
    net = quality_cnn.train([b"good text here" * 3, b"BAD!! BAD!!" * 3] * 8, np.array([1, 0] * 8))
    texts = [b"a" * n for n in range(0, 4000, 37)]
    assert np.allclose(net.score(texts), np.concatenate([net.score([t]) for t in texts]), atol=1e-6)
