"""Queries that write and read again: run folders, resuming, publishing, results, the execution loop, readers."""

from __future__ import annotations

from contextlib import closing
from datetime import date
from glob import glob
from pathlib import Path
from zipfile import ZipFile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.operators import links, spine
from freightlens.operators.rules import run_rules
from freightlens.operators.rules.families import with_route_parts
from freightlens.sources.config import expand
from freightlens.sources.extraction import extract
from freightlens.sources.publishing import publish, published
from freightlens.sources.readers import JdbcTable, TableCatalog, read_csv, read_jdbc, read_parquet
from freightlens.sources.runs import Run, work_folder, write_results, write_table

from . import oracle as o
from .catalog_sql import totals_sql
from .queries import _BAGS, _CHAIN, _ENRICHED, _IN, _SCOPE, _SUMMED, _WINDOW, CATALOG, _guard, _merge, _some, query
from .scopes import ScopeGraph, selected
from .standins import Standins
from .windows import DateWindow


def _rows(t: Standins, rows: list[tuple], schema: str) -> DataFrame:
    return t.spark.createDataFrame(rows, schema)


@query("rolling_parts", "SELECT * FROM CMS_MRSHEET")
def _(t):
    """Parts of at most 200 rows, read again by a pattern over their names."""
    path = work_folder(t.spark)
    write_table(t("CMS_MRSHEET"), path, rows_per_file=200)
    return read_parquet(t.spark, f"{path}/part-*.parquet")


@query("sorted_parts", "SELECT MFCNOTE_NO, MFCNOTE_MAN_NO, CAST(0 AS BIGINT) AS inversions FROM CMS_MFCNOTE")
def _(t):
    """Rows in the order of a physical key; inversions: rows of a part that stand before a smaller one."""
    path = work_folder(t.spark)
    write_table(t("CMS_MFCNOTE").select("MFCNOTE_NO", "MFCNOTE_MAN_NO"), path, order=["MFCNOTE_MAN_NO", "MFCNOTE_NO"])
    rows = t.spark.read.parquet(path).select("*", F.xxhash64("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    # As many tasks as files, so that a task's memory is that of some files however many there are.
    dealt = rows.repartition(max(1, len(t.spark.read.parquet(path).inputFiles())), "file")
    before = F.lag(F.struct("MFCNOTE_MAN_NO", "MFCNOTE_NO")).over(Window.partitionBy("file").orderBy("at"))
    odd = dealt.select((before > F.struct("MFCNOTE_MAN_NO", "MFCNOTE_NO")).alias("odd")).agg(F.count_if("odd").alias("n"))
    return rows.select("MFCNOTE_NO", "MFCNOTE_MAN_NO", odd.scalar().alias("inversions"))


_NAMES = ["CMS_CNOTE", "CMS_MFCNOTE", "CMS_MFBAG", "ORA_ZONE"]
_COUNTS = f"""n AS (SELECT 'CMS_CNOTE' AS name, count(*) AS rows FROM CMS_CNOTE WHERE CNOTE_DATE >= DATE '1995-01-01' AND CNOTE_DATE < DATE '1995-04-01'
  UNION ALL SELECT 'CMS_MFCNOTE', count(*) FROM f UNION ALL SELECT 'CMS_MFBAG', count(*) FROM CMS_MFBAG SEMI JOIN m ON MFBAG_MAN_NO = k WHERE {_guard("MFBAG_CRDATE")} UNION ALL SELECT 'ORA_ZONE', count(*) FROM ORA_ZONE)"""


def _extracted(t: Standins, root: str, name: str, **how) -> tuple[Run, dict[str, str]]:
    run = Run(t.spark, root, _WINDOW, name, date(1995, 6, 1))
    return run, extract(run, ScopeGraph(t, _WINDOW), selected(_NAMES), **how)


@query("run_resume_and_reuse", _CHAIN.rstrip() + f", {_COUNTS} SELECT r.run, r.done, n.name, n.rows FROM n JOIN (VALUES ('first', 'written'), ('first again', 'kept'), ('second', 'written'), ('second', 'reused')) AS r(run, done) ON (r.done <> 'reused' OR n.name = 'ORA_ZONE') AND NOT (r.run = 'second' AND r.done = 'written' AND n.name = 'ORA_ZONE')")
def _(t):
    """What an extraction did with each table: at first, resumed, and in a later run that reuses references."""
    root, out = work_folder(t.spark), []
    for title, name, reuse in (("first", "one", None), ("first again", "one", None), ("second", "two", "one")):
        earlier = Run.open(t.spark, Run(t.spark, root, _WINDOW, reuse, date(1995, 6, 1)).path) if reuse else None
        run, done = _extracted(t, root, name, reuse=earlier)
        out += [(title, done[n], n, Run.open(t.spark, run.path).tables[n]["rows"]) for n in _NAMES]
    return _rows(t, out, "run string, done string, name string, rows long")


@query("run_scopes", _CHAIN + "SELECT 'CNOTE' AS scope, count(*) AS n FROM c UNION ALL SELECT 'MANIFEST', count(*) FROM m")
def _(t):
    """Key sets that an extraction wrote once each."""
    run, _ = _extracted(t, work_folder(t.spark), "one", count_scopes=True)
    return _rows(t, sorted(Run.open(t.spark, run.path).scopes.items()), "scope string, n long")


@query("run_tables_by_manifest", _CHAIN + f"SELECT MFBAG_NO, MFBAG_MAN_NO, MFBAG_CRDATE, MFBAG_ACT_WEIGHT FROM CMS_MFBAG SEMI JOIN m ON MFBAG_MAN_NO = k WHERE {_guard('MFBAG_CRDATE')}")
def _(t):
    run, _ = _extracted(t, work_folder(t.spark), "one", exclude=lambda _: ["MFBAG_MAN_REF"])
    return Run.open(t.spark, run.path).catalog()("CMS_MFBAG")


@query("spine_written", f"SELECT count(*) AS rows, count(*) FILTER (shipment_scope = 'Unknown') AS unknown, count(*) FILTER (shipment_scope = 'Unknown') * 100 > count(*) AS warned, true AS complete FROM ({_merge(o.SPINE)})", over_standins=False)
def _(t):
    """The spine in a run's folder, with what its writing job counted."""
    run = Run(t.spark, work_folder(t.spark), _WINDOW, "spine", date(1995, 6, 1))
    quality, anchor = spine.quality_counts(), t("CMS_CNOTE").count()
    n = run.add("CMS_CNOTE_TRANSFORMED", spine.build_spine(t), derived=True, observed=quality)
    found = spine.judged_quality(n, quality["unknown"], anchor)
    run.save()
    stored = Run.open(t.spark, run.path).catalog()("CMS_CNOTE").count()
    return _rows(t, [(n, quality["unknown"], any("unknown" in w for w in found["wrong"]), n == anchor == stored)], "rows long, unknown long, warned boolean, complete boolean")


_TEXT = ", ".join(f"NULLIF(coalesce(CAST({c} AS VARCHAR), ''), '') AS {c}" for c in ("DSMU_NO", "DSMU_BAG_NO", "DSMU_BAG_ORIGIN", "ESB_TIME", "DSMU_WEIGHT"))


@query("results_as_csv", f"SELECT {_TEXT} FROM CMS_DSMU")
def _(t):
    """Results written as Parquet and CSV, and the CSV read strictly: all text, empty as null."""
    path, rows = work_folder(t.spark), t("CMS_DSMU")
    write_results(rows, path)
    return read_csv(t.spark, f"{path}.csv", rows.columns)


_ZONES = "(SELECT count(*) FROM ORA_ZONE)"
_BRANCHES = "(SELECT count(*) FROM ORA_BRANCH)"


@query("publish_audit", f"SELECT 'one' AS run_id, 'SUCCESS' AS status, 2 AS tables, {_ZONES} + {_BRANCHES} AS total_rows, {_ZONES} AS zones, {_BRANCHES} AS branches UNION ALL SELECT 'two', 'SUCCESS', 1, {_BRANCHES}, {_ZONES}, {_BRANCHES} UNION ALL SELECT 'three', 'FAILED', 1, {_ZONES}, {_ZONES}, {_BRANCHES}")
def _(t):
    """Publishing with a stage that is kept, one that fails its row count and changes nothing, and the audit's rows."""
    place = work_folder(t.spark)
    target, audit, out = f"{place}/mart", f"{place}/audit", {}
    zones, branches = t("ORA_ZONE"), t("ORA_BRANCH")
    for name, frames, how in (("one", {"zones": zones, "branches": branches}, {}), ("two", {"zones": zones.limit(1), "branches": branches}, {"skip": ["zones"]}), ("three", {"zones": zones}, {"expected": {"zones": -1}})):
        try:
            publish(t.spark, frames, target, audit, name, **how)
        except ValueError:
            pass  # the third one's row count can't be right
        now = published(t.spark, target)
        out[name] = (now("zones").count(), now("branches").count())
    counts = _rows(t, [(k, *v) for k, v in out.items()], "run_id string, zones long, branches long")
    return t.spark.read.parquet(audit).join(counts, "run_id").select("run_id", "status", "tables", "total_rows", "zones", "branches")


_SHOWN = "(SELECT count(*) AS zones FROM ORA_ZONE{z}), (SELECT count(*) AS branches, min(BRANCH_CODE) AS first FROM ORA_BRANCH{b})"


@query("publish_all_or_nothing", "SELECT 'one' AS run_id, zones, branches, first FROM " + _SHOWN.format(z="", b="") + " UNION ALL SELECT 'two', zones, branches, first FROM " + _SHOWN.format(z="", b="") + " UNION ALL SELECT 'three', zones, branches, first FROM " + _SHOWN.format(z=" WHERE ZONE_CODE > 'Z1'", b=" WHERE BRANCH_CODE > 'BR2'"))
def _(t):
    """What readers see after a publication, one that fails at its second table, and one of other rows: never tables of two."""
    target, shown = f"{work_folder(t.spark)}/mart", []
    zones, branches = t("ORA_ZONE"), t("ORA_BRANCH")
    less = {"zones": zones.where("ZONE_CODE > 'Z1'"), "branches": branches.where("BRANCH_CODE > 'BR2'")}
    for name, frames, how in (("one", {"zones": zones, "branches": branches}, {}), ("two", less, {"expected": {"branches": -1}}), ("three", less, {})):
        try:
            publish(t.spark, frames, target, run_id=name, **how)
        except ValueError:
            pass  # the second one's branches can't be so many, after its zones are written
        now = published(t.spark, target)
        counts = now("branches").agg(F.count(F.lit(1)).alias("branches"), F.min("BRANCH_CODE").alias("first"))
        shown.append(counts.select(F.lit(name).alias("run_id"), now("zones").agg(F.count(F.lit(1))).scalar().alias("zones"), "branches", "first"))
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


class _Failing:
    """Tables, one of which can't be read."""

    def __init__(self, t: Standins, name: str):
        self.t, self.name = t, name

    def __call__(self, name: str) -> DataFrame:
        if name == self.name:
            raise OSError(f"{name} can't be reached")
        return self.t(name)


_WAVES = "(VALUES ('CMS_CNOTE', 0), ('ORA_ZONE', 0), ('CMS_MFCNOTE', 1), ('CMS_MFBAG', 2)) AS w(name, wave)"


@query("extraction_waves", _CHAIN.rstrip() + f", {_COUNTS} SELECT r.run, n.name, w.wave, CASE WHEN r.run = 'first' AND n.name = 'CMS_MFCNOTE' THEN 'failed' WHEN r.run = 'first' AND n.name = 'CMS_MFBAG' THEN 'waiting' WHEN r.run = 'first' OR n.name IN ('CMS_MFCNOTE', 'CMS_MFBAG') THEN 'written' ELSE 'kept' END AS done, CASE WHEN r.run = 'second' OR w.wave = 0 THEN n.rows ELSE 0 END AS rows FROM n JOIN {_WAVES} ON n.name = w.name CROSS JOIN (VALUES ('first'), ('second')) AS r(run)")
def _(t):
    """Extraction by waves in threads: a table that can't be read keeps back what depends on it alone, and the next call does the rest."""
    root, out = work_folder(t.spark), []
    for title, tables in (("first", _Failing(t, "CMS_MFCNOTE")), ("second", t)):
        run = Run(t.spark, root, _WINDOW, "waves", date(1995, 6, 1))
        done = extract(run, ScopeGraph(tables, _WINDOW), selected(_NAMES), strict=False)
        waves = {"CMS_CNOTE": 0, "ORA_ZONE": 0, "CMS_MFCNOTE": 1, "CMS_MFBAG": 2} | {n: f["wave"] for n, f in run.tables.items()}
        stored = Run.open(t.spark, run.path)
        out += [(title, n, waves[n], done[n], stored.tables[n]["rows"] if n in stored.tables else 0) for n in _NAMES]
    return _rows(t, out, "run string, name string, wave int, done string, rows long")


@query("parts_with_other_columns", "SELECT MSTATUS_NO, MSTATUS_UID, NULL::VARCHAR AS MSTATUS_ZONE_CODE FROM CMS_MSTATUS UNION SELECT MSTATUS_NO, NULL, MSTATUS_ZONE_CODE FROM CMS_MSTATUS")
def _(t):
    """Parts of one table with different columns, some columns asked for that no part has, without repeated rows."""
    one, two, rows = work_folder(t.spark), work_folder(t.spark), t("CMS_MSTATUS")
    rows.select("MSTATUS_NO", "MSTATUS_UID").union(rows.select("MSTATUS_NO", "MSTATUS_UID")).write.parquet(one)
    rows.select("MSTATUS_NO", "MSTATUS_ZONE_CODE").write.parquet(two)
    return read_parquet(t.spark, [one, two], ["MSTATUS_NO", "MSTATUS_UID", "MSTATUS_ZONE_CODE", "NOT_THERE"], distinct=True)


_RAN = f"SELECT index_code, rule_family, table_name, total_checked, total_failed, total_checked AS result_rows, CASE WHEN index_code = 'COMP1B18' THEN 'SKIPPED' WHEN total_checked = 0 THEN 'NO_ROWS' WHEN total_failed > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({_SUMMED})"


@query("rules_run", _RAN)
def _(t):
    """The execution loop, each rule by itself: checks and results are written once, the summary counts them."""
    return run_rules(t.spark, t, _some(), t.available, isolate=True).summary.select("index_code", "rule_family", "table_name", "total_checked", "total_failed", "result_rows", "status")


@query("rules_of_catalog", totals_sql(CATALOG))
def _(t):
    """All 493 rules in one run, which scans and joins for groups of rules: totals and status of each."""
    tables = lambda n: with_route_parts(t(n)) if n == "CMS_DROURATE" else t(n)
    columns = ("index_code", "rule_family", "table_name", "total_checked", "total_failed", "result_rows", "status")
    return run_rules(t.spark, tables, CATALOG, t.available, summary_only=True).summary.select(*columns)


@query("results_published", f"SELECT * EXCLUDE (link_method), 'R000000000000' AS result_id FROM ({_merge(_ENRICHED)})", over_standins=False)
def _(t):
    """All columns of the results as they are published; of the running number its form (result_ids counts them)."""
    found = run_rules(t.spark, t, _BAGS, t.available, links=links.build_links(t, t.available, sources={r.table for r in _BAGS}, restricted=False)).results
    return found.withColumn("result_id", F.regexp_replace("result_id", "[0-9]", "0"))


@query("result_ids", f"SELECT CAST(sum(total_checked) AS BIGINT) AS n, CAST(sum(total_checked) AS BIGINT) AS ids, 'R000000000001' AS first, printf('R%012d', CAST(sum(total_checked) AS BIGINT)) AS last FROM ({_SUMMED})")
def _(t):
    """Running numbers of the results, none left out."""
    ids = run_rules(t.spark, t, _some(), t.available).results.select("result_id")
    # Different ids are counted as bits of their numbers, so that no id moves; those of another form than theirs as texts.
    number = F.when(F.col("result_id").rlike("^R[0-9]{12}$"), F.substring("result_id", 2, 12).cast("long"))
    other = ids.where(number.isNull()).agg(F.countDistinct("result_id")).scalar()
    rows = ids.withColumn("number", number).groupBy(F.bitmap_bucket_number("number").alias("bucket"))
    blocks = rows.agg(F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("number"))).alias("ids"), F.min("result_id").alias("first"), F.max("result_id").alias("last"))
    sums = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "ids")), F.min("first").alias("first"), F.max("last").alias("last"))
    return sums.select("n", (F.col("ids") + other).alias("ids"), "first", "last")


_DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _database(t: Standins, **tables: tuple[DataFrame, str]) -> str:
    """The address of a database with these tables (rows, columns' types), which any number of Java processes may read.

    Derby's files are open to one process at a time, those in an archive to all that only read. So Spark writes the rows as
    files, Derby imports them and is shut down, and its folder becomes an archive (stored, so that pages are found by their
    place). The work folder must be one that driver and executors mount.
    """
    jvm, place = t.spark._jvm, work_folder(t.spark)
    local = place.removeprefix("file:").replace("///", "/")
    jvm.System.setProperty("derby.stream.error.file", "/dev/null")  # else it leaves a log where it runs
    connect = lambda how: jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver().connect(f"jdbc:derby:{local}/db;{how}", jvm.java.util.Properties())
    for name, (rows, _) in tables.items():
        text = rows.select(*(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in rows.dtypes))
        text.write.option("quoteAll", True).option("nullValue", None).option("escape", '"').csv(f"{place}/{name}")
    with closing(connect("create=true")) as db, closing(db.createStatement()) as statement:
        for name, (_, types) in tables.items():
            statement.execute(f"CREATE TABLE {name} ({types})")
            for part in sorted(glob(f"{local}/{name}/part-*")):
                statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{name}', '{part}', NULL, NULL, 'UTF-8', 0)")
    try:
        connect("shutdown=true")
    except Py4JJavaError as e:  # Derby tells by an error that it is shut down
        if "08006" not in str(e.java_exception.getSQLState()):
            raise
    with ZipFile(f"{local}/db.jar", "w") as archive:
        for path in sorted(Path(f"{local}/db").rglob("*")):
            archive.write(path, path.relative_to(local))
    return f"jdbc:derby:jar:({local}/db.jar)db"


@query("jdbc_scan", "SELECT ZONE_CODE AS \"ZONE_CODE\" FROM ORA_ZONE WHERE ZONE_CODE > 'Z1'")
def _(t):
    """A database's table, whose columns and rows are chosen there."""
    url = _database(t, ZONES=(t("ORA_ZONE").withColumn("OTHER", F.lit("x")), "ZONE_CODE VARCHAR(40), OTHER VARCHAR(40)"))
    return read_jdbc(t.spark, url, "ZONES", columns=["ZONE_CODE"], where="ZONE_CODE > 'Z1'", **_DERBY)


@query("jdbc_scope", f"WITH c AS ({_SCOPE}) SELECT DHOCNOTE_NO, DHOCNOTE_CNOTE_NO, DHOCNOTE_TDATE FROM CMS_DHOCNOTE SEMI JOIN c ON DHOCNOTE_CNOTE_NO = k WHERE {_guard('DHOCNOTE_TDATE')}")
def _(t):
    """A restricted table of a database, to which the scope's keys and the date guard go."""
    url = _database(t, CMS_DHOCNOTE=(t("CMS_DHOCNOTE"), "DHOCNOTE_NO VARCHAR(40), DHOCNOTE_CNOTE_NO VARCHAR(40), DHOCNOTE_TDATE TIMESTAMP"))
    tables = TableCatalog({"CMS_CNOTE": lambda: t("CMS_CNOTE"), "CMS_DHOCNOTE": JdbcTable(t.spark, url, "CMS_DHOCNOTE", **_DERBY)})
    return ScopeGraph(tables, _WINDOW).restricted("CMS_DHOCNOTE")


@query("configured_window", f"SELECT count(*) AS n FROM CMS_CNOTE WHERE {_IN.replace('o_orderdate', 'CNOTE_DATE')}")
def _(t):
    """A window as a configuration's text names it."""
    window = DateWindow.resolve(expand({"mode": "explicit", "start": "${FROM:-1995-01-01}", "end": "${UNTIL:-1995-04-01}"}, {}))
    return t("CMS_CNOTE").where(window.contains(F.col("CNOTE_DATE"))).agg(F.count(F.lit(1)).alias("n"))

