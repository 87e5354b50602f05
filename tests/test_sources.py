"""Readers, run folders, resuming and reuse, publishing, configuration and the command line."""

import datetime as dt
import time
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from freightlens.__main__ import main
from freightlens.plans.scopes import ScopeGraph, selected
from freightlens.plans.windows import DateWindow
from freightlens.sources.config import expand, object_store, run_name, truth
from freightlens.sources.extraction import ExtractionError, extract, plan_waves
from freightlens.sources.publishing import current, publish, published
from freightlens.sources.readers import JdbcTable, TableCatalog, as_source, demo_tables, read_csv, read_jdbc, read_parquet, with_keys
from freightlens.sources.runs import Run, Store, clear_work, rows_written, work_folder, write_results, write_table
from tests.test_shipments import scoped

WINDOW = DateWindow(dt.date(2026, 5, 1), dt.date(2026, 6, 1))


def test_config():
    assert expand({"a": ["${X:-d}", "${Y}"]}, {"Y": "1"}) == {"a": ["d", "1"]}
    with pytest.raises(KeyError):
        expand("${NONE}", {})
    assert truth("Yes") and truth(True) and not truth("off") and not truth(None)
    assert run_name(" May run/1 ") == "May_run_1"


def test_object_store():
    assert object_store({}) == {}
    found = object_store({"S3_ENDPOINT": "http://store:9000/", "S3_ACCESS_KEY": "a", "S3_SECRET_KEY": "b"})
    assert found == {"fs.s3a.endpoint": "store:9000", "fs.s3a.access.key": "a", "fs.s3a.secret.key": "b", "fs.s3a.path.style.access": "true", "fs.s3a.connection.ssl.enabled": "false"}
    assert object_store({"S3_REGION": "x", "S3_PATH_STYLE": "no"})["fs.s3a.path.style.access"] == "false"


def test_database_gets_columns_and_filters(spark):
    spark._jvm.System.setProperty("derby.stream.error.file", "/dev/null")
    url, driver = "jdbc:derby:memory:readers;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(20).selectExpr("cast(id as int) AS N", "cast(id * 2 as int) AS M").coalesce(1).write.jdbc(url, "T", properties=driver)
    df = read_jdbc(spark, url, "T", columns=["M"], where="N > 4 AND M < 20", split=("N", 0, 20, 3), **driver)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.M for r in df.collect()) == [10, 12, 14, 16, 18] and df.rdd.getNumPartitions() == 3
    assert "GreaterThan(N,4)" in plan and "ReadSchema: struct<M:int>" in plan


def test_missing_guard_is_told_and_scopes_are_stored_once(spark):
    made = []
    graph = ScopeGraph(scoped(spark), WINDOW, store=lambda name, keys: made.append(name) or keys)
    graph.keys("MFBAG"), graph.keys("MANIFEST"), graph.keys("MFBAG")
    assert sorted(made) == ["CNOTE", "MANIFEST", "MFBAG"]
    with pytest.warns(UserWarning, match="NOT_THERE"):
        graph._guard(spark.range(1), "NOT_THERE")


def test_physical_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 7 AS a", "1000 - id AS b").repartition(5)
    assert write_table(rows, str(tmp_path / "t"), order=["a", "b", "none"], partitions=3) == 1000
    parts = [[tuple(r) for r in spark.read.parquet(str(p)).collect()] for p in sorted((tmp_path / "t").glob("part-*.parquet"))]
    assert all(p == sorted(p) for p in parts) and sorted(x for p in parts for x in p) == sorted((k % 7, 1000 - k) for k in range(1000))


def test_parquet_with_missing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "a")], "KNOWN int, B string").write.parquet(str(tmp_path / "t"))
    df = read_parquet(spark, str(tmp_path / "t"), ["KNOWN", "MISSING"], distinct=True)
    assert df.columns == ["KNOWN"] and df.count() == 1


def test_csv_width(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,\n2,b\n")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv"), ["x", "y"]).collect()] == [("1", None), ("2", "b")]
    (tmp_path / "b.csv").write_text("x,y\n1,2\n1,2,3\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, str(tmp_path / "b.csv")).collect()
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "a.csv"), ["x", "z"])


def test_source_types(spark):
    df = spark.sql("SELECT 1.50BD AS n, 2 AS i, 1.5D AS d, true AS b, DATE '2026-05-01' AS t")
    assert [f.dataType.simpleString() for f in as_source(df).schema] == ["string", "string", "double", "boolean", "timestamp_ntz"]


def test_run_resume_and_reuse(spark, tmp_path):
    graph = ScopeGraph(scoped(spark), WINDOW)
    specs = selected(["CMS_CNOTE", "CMS_MFBAG", "ORA_ZONE"])
    run = Run(spark, str(tmp_path / "lake"), WINDOW, "first", dt.date(2026, 6, 2))
    assert set(extract(run, graph, specs, lambda t: ["SECRET"]).values()) == {"written"}
    assert extract(run, graph, specs)["CMS_CNOTE"] == "kept" and rows_written(spark, f"{run.path}/cms_cnote") == 3
    again = Run(spark, str(tmp_path / "lake"), WINDOW, "second", dt.date(2026, 6, 3))
    done = extract(again, graph, specs, reuse=Run.open(spark, run.path), count_scopes=True)
    assert done == {"CMS_CNOTE": "written", "CMS_MFBAG": "written", "ORA_ZONE": "reused"}
    opened = Run.open(spark, again.path)
    assert opened.scopes["MANIFEST"] == 1 and opened.catalog()("ORA_ZONE").count() == 1
    assert not opened.catalog().available("CMS_MSJ")


def test_rolling_files(spark, tmp_path):
    assert write_table(spark.range(10).coalesce(1), str(tmp_path / "t"), rows_per_file=4) == 10
    assert len(list((tmp_path / "t").glob("part-*.parquet"))) == 3
    assert write_table(spark.range(0), str(tmp_path / "e")) == 0 and rows_written(spark, str(tmp_path / "e")) == 0
    assert rows_written(spark, str(tmp_path / "none")) is None


def test_publish(spark, tmp_path):
    target, audit = str(tmp_path / "mart"), str(tmp_path / "audit")
    assert publish(spark, {"a": spark.range(3), "r": spark.range(2)}, target, audit, "run1") == {"a": 3, "r": 2}
    opened = published(spark, target)
    assert publish(spark, {"a": spark.range(5), "r": spark.range(9)}, target, audit, "run2", skip=["r"]) == {"a": 5}
    now = published(spark, target)
    assert now("a").count() == 5 and now("r").count() == 2 and opened("a").count() == 3
    with pytest.raises(ValueError):
        publish(spark, {"a": spark.range(1), "r": spark.range(1)}, target, audit, "run3", expected={"r": 2})
    now = published(spark, target)
    assert now("a").count() == 5 and now("r").count() == 2
    assert sorted(r.status for r in spark.read.parquet(audit).collect()) == ["FAILED", "SUCCESS", "SUCCESS"]


def test_old_versions_go_once_no_table_lies_in_them(spark, tmp_path):
    target = str(tmp_path / "mart")
    publish(spark, {"a": spark.range(1), "kept": spark.range(7)}, target, run_id="r0")
    for k in range(1, 5):
        publish(spark, {"a": spark.range(k)}, target, run_id=f"r{k}")
    stays = {p.name.split("-")[0] for p in (tmp_path / "mart/_versions").iterdir()}
    assert stays == {"r0", "r3", "r4"} and len(current(spark, target)["versions"]) == 5
    assert published(spark, target)("kept").count() == 7 and published(spark, target)("a").count() == 4


def test_a_pointer_is_replaced_whole(spark, tmp_path):
    store, path = Store(spark), f"file://{tmp_path}/p.json"
    for text in ("one", "two, longer", "3"):
        store.replace(path, text)
        assert store.read(path) == text
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["p.json"]


def waiting(tables, seconds=1.5):
    """Tables that take some time to be read, and when each was."""
    times = {}

    def read(name):
        times.setdefault(name, time.monotonic())
        time.sleep(seconds)
        return tables(name)

    return read, times


def test_tables_of_a_wave_overlap(spark, tmp_path):
    tables, times = waiting(scoped(spark))
    run = Run(spark, str(tmp_path / "lake"), WINDOW, "waves", dt.date(2026, 6, 2))
    extract(run, ScopeGraph(tables, WINDOW), selected(["CMS_CNOTE", "CMS_MFBAG", "ORA_ZONE"]))
    facts = Run.open(spark, run.path).tables
    assert {n: f["wave"] for n, f in facts.items()} == {"CMS_CNOTE": 0, "ORA_ZONE": 0, "CMS_MFBAG": 2}
    assert facts["CMS_CNOTE"]["started"] < facts["ORA_ZONE"]["ended"] and facts["ORA_ZONE"]["started"] < facts["CMS_CNOTE"]["ended"]
    assert facts["CMS_MFBAG"]["started"] > facts["CMS_CNOTE"]["ended"]


def test_a_failed_table_keeps_back_what_depends_on_it(spark, tmp_path):
    good = scoped(spark)

    def broken(name):
        if name == "CMS_MFCNOTE":
            raise OSError("gone")
        return good(name)

    specs = selected(["CMS_CNOTE", "CMS_MFCNOTE", "CMS_MFBAG", "ORA_ZONE"])
    run = Run(spark, str(tmp_path / "lake"), WINDOW, "broken", dt.date(2026, 6, 2))
    with pytest.raises(ExtractionError):
        extract(run, ScopeGraph(broken, WINDOW), specs)
    opened = Run.open(spark, run.path)
    assert set(opened.tables) == {"CMS_CNOTE", "ORA_ZONE"} and opened.failed["CMS_MFBAG"] == "waits for MANIFEST" and "gone" in opened.failed["CMS_MFCNOTE"]
    assert extract(opened, ScopeGraph(good, WINDOW), specs) == {"CMS_CNOTE": "kept", "ORA_ZONE": "kept", "CMS_MFCNOTE": "written", "CMS_MFBAG": "written"}
    assert Run.open(spark, run.path).failed == {}


def test_waves_follow_the_scopes():
    names = [[t.name for t in wave] for wave in plan_waves(selected(["CMS_CNOTE", "CMS_MMBAG", "CMS_MSMU", "ORA_USER"]), limited=True)]
    assert names[0] == ["CNOTE", "ORA_USER"] and "CMS_CNOTE" in names[1] and names[-1] == ["CMS_MSMU"]
    at = {n: k for k, wave in enumerate(names) for n in wave}
    assert at["MANIFEST"] < at["MFBAG"] < at["DMBAG"] < at["CMS_MMBAG"] == at["SMU"] < at["CMS_MSMU"]


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def database(spark, tmp_path, n):
    spark._jvm.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = spark.range(n).selectExpr("concat('K', lpad(id, 5, '0')) AS K", "CAST(id AS INT) AS N", "id % 7 AS V").coalesce(1)
    rows.write.option("createTableColumnTypes", "K VARCHAR(20)").jdbc(url, "T", properties=DERBY)
    return url


def scanned(df):
    """A frame's rows, the rows that its database scans gave, and its plan."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        read = sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()) if "JDBC" in leaves.apply(k).nodeName())
        return rows, read, df._jdf.queryExecution().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def test_keys_go_to_the_database(spark, tmp_path):
    table = JdbcTable(spark, database(spark, tmp_path, 2000), "T", **DERBY)
    keys = spark.createDataFrame([(f"K{k:05d}",) for k in range(0, 2000, 400)] + [("K9", ), (None,), ("it's",)], "k string")
    rows, read, plan = scanned(table.within("K", keys).where("V < 4").select("K", "V"))
    assert sorted(r.K for r in rows) == [f"K{k:05d}" for k in range(0, 2000, 400) if k % 7 < 4]
    assert read <= 5 and "In(K" in plan.replace(" ", "").replace("*", "") and "K00400" in plan
    numbers, read, _ = scanned(table.within("N", spark.createDataFrame([("7",), ("9",)], "k string")))
    assert sorted(r.N for r in numbers) == ["7", "9"] and read == 2
    assert table.within("K", keys.where("k = 'none'")).collect() == []


def test_many_keys_go_to_the_database_as_ranges(spark, tmp_path):
    raw = JdbcTable(spark, database(spark, tmp_path, 2000), "T", **DERBY).read()
    keys = spark.createDataFrame([(f"K{k:05d}",) for k in [*range(100, 150, 2), *range(1700, 1750, 2)]], "k string")
    rows, read, plan = scanned(with_keys(raw, "K", keys, most=10, ranges=8))
    assert sorted(r.K for r in rows) == sorted(r.k for r in keys.collect())
    assert 50 <= read < 600 and "GreaterThanOrEqual(K" in plan.replace("*", "")
    some = with_keys(raw, "K", keys, most=1000, chunk=7)
    assert sorted(r.K for r in some.collect()) == sorted(r.k for r in keys.collect())


def test_text_keys_are_no_columns_on_the_driver(spark, tmp_path, monkeypatch):
    """A column object a key takes minutes for 50,000 keys; and the union of their lists is made by halves."""
    from freightlens.sources import readers

    raw = JdbcTable(spark, database(spark, tmp_path, 300), "T", **DERBY).read()
    keys = spark.createDataFrame([(f"K{k:05d}",) for k in range(0, 300, 3)] + [("it's",), ("a\\b",)], "k string")
    made, depth = [], lambda plan: 1 + max([0, *(depth(plan.children().apply(k)) for k in range(plan.children().size()))])
    lit = readers.F.lit
    monkeypatch.setattr(readers.F, "lit", lambda v: made.append(v) or lit(v))
    found = with_keys(raw, "K", keys, chunk=6)
    assert sorted(r.K for r in found.collect()) == [f"K{k:05d}" for k in range(0, 300, 3)]
    assert not made and depth(found._jdf.queryExecution().analyzed()) < 12


def test_scopes_push_their_keys(spark, tmp_path):
    spark._jvm.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    own = scoped(spark)
    own("CMS_MFCNOTE").coalesce(1).write.option("createTableColumnTypes", "MFCNOTE_NO VARCHAR(20)").jdbc(url, "CMS_MFCNOTE", properties=DERBY)
    tables = TableCatalog({"CMS_CNOTE": lambda: own("CMS_CNOTE"), "CMS_MFCNOTE": JdbcTable(spark, url, "CMS_MFCNOTE", **DERBY)})
    pushed, plain = (ScopeGraph(t, WINDOW).restricted("CMS_MFCNOTE") for t in (tables, own))
    rows, _, plan = scanned(pushed)
    assert sorted(map(str, rows)) == sorted(map(str, plain.select(*pushed.columns).collect())) and rows
    assert "JDBCRelation" in plan and "In(MFCNOTE_NO" in plan.replace("*", "")


def test_work_folders_are_deleted(spark, tmp_path):
    place = work_folder(spark, str(tmp_path))
    spark.range(1).write.parquet(place)
    clear_work(spark)
    assert not Path(place).exists()


def test_results_keep_their_columns(spark, tmp_path):
    write_results(spark.createDataFrame([], "a string, b int"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r.parquet")).columns == ["a", "b"]
    write_results(spark.createDataFrame([("x", None)], "a string, b int"), str(tmp_path / "s"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "s.parquet")).collect()] == [("x", "")]


def test_catalog_substitution(spark):
    t = TableCatalog({"A": lambda: spark.range(1), "B": lambda: spark.range(2)}).use("A", "B").use("B", "NONE")
    assert t("a").count() == 2 and t.available("A") and not t.available("C")
    with pytest.raises(KeyError):
        t("C")


def test_demo_and_command_line(spark, tmp_path, capsys):
    assert demo_tables(spark)("CMS_CNOTE").count() == 50
    main(["demo"], spark)
    shown = capsys.readouterr().out
    assert "COMP1B1 " in shown and "FAIL" in shown
