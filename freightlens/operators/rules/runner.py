"""Running a catalog: what can run, the checks of all rules, their shipments and context, the summary.

Planning happens on the driver from schemas; the data path is one plan for each group of rules that share scans and joins
(see fuse.py), united. A rule that can't be planned or run is reported and doesn't stop the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.functions.classes import branch_region, delivery_category, service_bucket, shipment_scope
from freightlens.functions.values import key
from freightlens.operators.links import sources_of
from freightlens.sources.runs import Store, work_folder, written

from .families import FAMILIES, Frames, RuleSpec, Tables
from .fuse import counted_checks, plan_checks

#: Columns of the results, of their shipments, and of the summary.
RESULT_COLUMNS = (
    "shipment_type result_id cnote_no document_no cnote_origin cnote_destination origin_region destination_region cnote_service_code index_code element "
    "logic_description table_name level stage variable_1 variable_2 column_name main_indicator main_impact impact_details issue_description status"
).split()
LINK_COLUMNS = "result_id cnote_no link_method".split()
SUMMARY_COLUMNS = "index_code element main_indicator rule_family table_name status total_checked total_failed result_rows skip_reason error_message".split()

#: The stage of a shipment's way that a table's documents belong to.
STAGE_OF = {
    "CMS_DRCNOTE": "1. Receival",
    "CMS_MRCNOTE": "1. Receival",
    "CMS_DHI_HOC": "1. Receival",
    "CMS_MHI_HOC": "1. Receival",
    "CMS_DMBAG": "2. Manifest",
    "CMS_DSMU": "2. Manifest",
    "CMS_DSTATUS": "2. Manifest",
    "CMS_MANIFEST": "2. Manifest",
    "CMS_MFBAG": "2. Manifest",
    "CMS_MFCNOTE": "2. Manifest",
    "CMS_MMBAG": "2. Manifest",
    "CMS_MSMU": "2. Manifest",
    "CMS_COST_DTRANSIT_AGEN": "3. Handover",
    "CMS_COST_MTRANSIT_AGEN": "3. Handover",
    "CMS_DBAG_HO": "3. Handover",
    "CMS_DHICNOTE": "3. Handover",
    "CMS_DHOCNOTE": "3. Handover",
    "CMS_DSJ": "3. Handover",
    "CMS_MHICNOTE": "3. Handover",
    "CMS_MHOCNOTE": "3. Handover",
    "CMS_MSJ": "3. Handover",
    "CMS_RDSJ": "3. Handover",
    "CMS_CNOTE_POD": "4. Runsheet",
    "CMS_DHOUNDEL_POD": "4. Runsheet",
    "CMS_DHOV_RSHEET": "4. Runsheet",
    "CMS_DRSHEET": "4. Runsheet",
    "CMS_DRSHEET_PRA": "4. Runsheet",
    "CMS_MHOUNDEL_POD": "4. Runsheet",
    "CMS_MHOV_RSHEET": "4. Runsheet",
    "CMS_MRSHEET": "4. Runsheet",
}
#: Tables whose documents stand for many shipments.
BAG_LEVEL = {
    "CMS_CNOTE_POD",
    "CMS_COST_DTRANSIT_AGEN",
    "CMS_COST_MTRANSIT_AGEN",
    "CMS_DBAG",
    "CMS_DBAG_HO",
    "CMS_DHICNOTE",
    "CMS_DHI_HOC",
    "CMS_DHOCNOTE",
    "CMS_DHOUNDEL_POD",
    "CMS_DHOV_RSHEET",
    "CMS_DMBAG",
    "CMS_DRCNOTE",
    "CMS_DRSHEET",
    "CMS_DRSHEET_PRA",
    "CMS_DSJ",
    "CMS_DSMU",
    "CMS_DSTATUS",
    "CMS_MANIFEST",
    "CMS_MFBAG",
    "CMS_MFCNOTE",
    "CMS_MHICNOTE",
    "CMS_MHI_HOC",
    "CMS_MHOCNOTE",
    "CMS_MHOUNDEL_POD",
    "CMS_MMBAG",
    "CMS_MRCNOTE",
    "CMS_MRSHEET",
    "CMS_MSJ",
    "CMS_MSMU",
    "CMS_RDSJ",
}

def columns_reported(rule: RuleSpec) -> str:
    return ", ".join(FAMILIES[rule.family].names(rule))


def missing(rule: RuleSpec, tables: Tables, available: Callable[[str], bool]) -> str:
    """Why a rule can't run: tables or columns that aren't there; empty if it can. Its family declares what it reads; the document's column may be missing."""
    needs = FAMILIES[rule.family].needs(rule)
    if gone := sorted(t for t in needs if not available(t)):
        return f"missing tables: {', '.join(gone)}"
    gone = sorted(f"{t}.{c}" for t, columns in needs.items() if columns for c in columns - set(tables(t).columns))
    return f"missing columns: {', '.join(gone)}" if gone else ""


#: Checks on documents that are broadcast to the links, some hundred bytes each; more meet them by a shuffle of both.
MOST_CHECKS = 100_000
#: What a result takes from its shipment, regions excepted, which follow from the places.
PLACES = ("cnote_no", "cnote_origin", "cnote_destination", "cnote_service_code", "shipment_type")


def places(shipments: DataFrame) -> DataFrame:
    """PLACES of each shipment, the first row of a number.

    Rows go to their number's task before the first is taken: numbers hardly occur again, so a task that sorted its
    input for that beforehand would sort all of it and drop nothing.
    """
    text = lambda c: key(F.col(c)) if c in shipments.columns else F.lit("")
    own = [c for c in ("delivery_category", "delivery_type", "shipment_scope") if c in shipments.columns]
    kind = F.when(text("delivery_category") != "", text("delivery_category"))
    if "delivery_type" in own or "shipment_scope" in own:
        scope = F.when(text("shipment_scope") != "", text("shipment_scope")).otherwise("Unknown")
        kind = F.coalesce(kind, delivery_category(text("delivery_type"), scope))
    rows = shipments.select(
        text("CNOTE_NO").alias("cnote_no"), text("CNOTE_ORIGIN").alias("cnote_origin"), text("CNOTE_DESTINATION").alias("cnote_destination"), service_bucket(text("CNOTE_SERVICES_CODE")).alias("cnote_service_code"),
        *([F.coalesce(kind, shipment_scope(text("CNOTE_ORIGIN"), text("CNOTE_DESTINATION"))).alias("shipment_type")] if own else []),
    ).where("cnote_no <> ''")
    first = F.min(F.struct(*(c for c in rows.columns if c != "cnote_no")))
    rows = rows.repartition("cnote_no").groupBy("cnote_no").agg(first.alias("first")).select("cnote_no", "first.*")
    # A type that follows from the places alone doesn't move.
    return rows if own else rows.withColumn("shipment_type", shipment_scope(F.col("cnote_origin"), F.col("cnote_destination")))


def contexts(shipments: DataFrame) -> DataFrame:
    """(cnote_no, ...) of each shipment, the first row of a number: places, service, type and regions."""
    return places(shipments).withColumn("origin_region", branch_region(F.col("cnote_origin"))).withColumn("destination_region", branch_region(F.col("cnote_destination")))


def linked(checks: DataFrame, rules: list[RuleSpec], links: DataFrame | None, shipments: DataFrame | None, available: Callable[[str], bool] = lambda _: True) -> DataFrame:
    """(code, _document, status, variables, PLACES): checks with a row per linked shipment, or one without; what else a result has follows from it.

    _document: null where it is the shipment's number.
    """
    spark = checks.sparkSession
    sources = sources_of(available) if links is not None else set()
    bridges = [(r.code, r.table) for r in rules if r.table in sources]
    own = ("status", "variable_1", "variable_2")
    direct = checks.select("code", key(F.col("document_id")).alias("_shipment"), *own)
    direct = direct.where(~F.col("code").isin([c for c, _ in bridges])) if bridges else direct
    if shipments is None:
        direct = direct.withColumn("cnote_no", F.when(F.col("code").isin([r.code for r in rules if r.table == "CMS_CNOTE"]), F.col("_shipment")))
    else:
        shipped = places(shipments)
        direct = direct.join(shipped, F.col("_shipment") == F.col("cnote_no"), "left")
    parts = [direct.withColumnRenamed("_shipment", "_document")]
    if bridges:
        # Only links of the rules' own tables; the paths of others aren't followed.
        edges = links.select(F.upper(key(F.col("source_table"))).alias("_table"), key(F.col("document_id")).alias("_of_document"), key(F.col("cnote_no")).alias("_linked")).where(F.col("_table").isin(sorted({t for _, t in bridges})))
        of = F.broadcast(spark.createDataFrame(bridges, "_code string, _of string"))  # a row per rule of the catalog
        bridged = checks.select("code", key(F.col("document_id")).alias("_document"), *own).join(of, F.col("code") == F.col("_code"))
        same = (F.col("_of") == F.col("_table")) & (F.col("_document") == F.col("_of_document"))
        if shipments is None:
            parts.append(bridged.join(edges.distinct(), same, "left").withColumnRenamed("_linked", "cnote_no"))
        else:
            # Links move once, to their shipment: there they are made distinct, those of no shipment are left out, and the others take its places along.
            met = edges.repartition("_linked").distinct().join(shipped, F.col("_linked") == F.col("cnote_no")).drop("_linked")
            if bridged.count() > MOST_CHECKS:
                parts.append(bridged.join(met, same, "left"))
            else:
                # The checks go to the links, which stay; those without any are found by themselves. Their links name a
                # column of the places, so that both plans read the same shuffle.
                few = F.broadcast(bridged)
                parts.append(met.join(few, same))
                there = met.where(F.col("cnote_service_code").isNotNull()).select("_table", "_of_document").distinct()
                parts.append(bridged.join(there, same, "left_anti"))
    absent = F.lit(None).cast("string")
    rows = [p.select("code", "_document", *own, *(F.col(c) if c in p.columns else absent.alias(c) for c in PLACES)) for p in parts]
    rows = reduce(DataFrame.unionByName, rows)
    return rows.withColumn("_document", F.when(F.col("_document") != F.coalesce("cnote_no", F.lit("")), F.col("_document")))


def described(rows: DataFrame, rules: list[RuleSpec], sources: set[str]) -> DataFrame:
    """Rows of linked() with all that follows from them: regions, documents, and the rules' texts, so that no row carries these through a shuffle or into a file."""
    facts = [(r.code, r.element, r.indicator, r.main_impact, r.impact_details, r.description, r.issue, columns_reported(r), r.table, "bag" if r.table in BAG_LEVEL else "cnote", STAGE_OF.get(r.table, "")) for r in rules]
    names = ("code", "element", "main_indicator", "main_impact", "impact_details", "logic_description", "issue_description", "column_name", "table_name", "level", "stage")
    about = F.broadcast(rows.sparkSession.createDataFrame(facts, ", ".join(f"{n} string" for n in names)))  # a row per rule of the catalog
    for region, place in (("origin_region", "cnote_origin"), ("destination_region", "cnote_destination")):
        rows = rows.withColumn(region, F.when(F.col(place).isNotNull(), branch_region(F.col(place))))
    rows = rows.fillna("", [*PLACES, "origin_region", "destination_region"]).join(about, "code")
    bridged = F.col("table_name").isin(sorted(sources))
    method = F.when(bridged, F.concat(F.lower("table_name"), F.lit("_bridge"))).when(F.col("table_name") == "CMS_CNOTE", "direct_cnote").otherwise("direct_cnote_value")
    rows = rows.withColumn("link_method", method).withColumn("document_id", F.coalesce("_document", "cnote_no")).withColumn("document_no", F.coalesce("_document", F.lit("")))
    return rows.drop("_document").withColumnRenamed("code", "index_code")


def enriched(checks: DataFrame, rules: list[RuleSpec], links: DataFrame | None, shipments: DataFrame | None, available: Callable[[str], bool] = lambda _: True) -> DataFrame:
    """Checks (code, document_id, status, variables) with a row per linked shipment, or one without.

    Documents of a table that has a path of links, all of whose tables are available, go through them; of other tables
    they are taken for shipment numbers. Links may repeat and, where there are shipments, name numbers that none has.
    """
    return described(linked(checks, rules, links, shipments, available), rules, sources_of(available) if links is not None else set())


#: Tasks whose counts are broadcast, some bytes each; beyond that they are joined by a shuffle of the results.
MOST_TASKS = 1_000_000
_ROW_BITS = 33


def placed(rows: DataFrame) -> DataFrame:
    """rows with _place, which tells the task that makes a row and its number there; to be written."""
    return rows.withColumn("_place", F.monotonically_increasing_id())


def numbered(rows: DataFrame) -> DataFrame:
    """result_id: a running number of the rows of a written table with _place, R000000000001 and so on.

    A row's number is its number in the task that wrote it, after the rows of the tasks before. Only a row a task is summed
    up in order, and these sums are broadcast up to MOST_TASKS, so that no result moves for its number.
    """
    task = F.shiftright("_place", _ROW_BITS)
    counts = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    starts = F.broadcast(starts) if counts.count() <= MOST_TASKS else starts
    own = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.join(starts, task == F.col("_task")).withColumn("result_id", F.format_string("R%012d", F.col("_before") + own + 1)).drop("_place", "_task", "_before")


#: Whether a query's shuffle files go with its end, rather than when the driver's memory is next tidied.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Queries that are planned in the block leave no shuffle files when they end; each is to be run once."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


@dataclass
class RunResult:
    """checks: of all rules. results, links: as they are published. summary: SUMMARY_COLUMNS."""

    checks: DataFrame | None
    results: DataFrame | None
    links: DataFrame | None
    summary: DataFrame
    errors: dict[str, str] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    folder: str = ""

    def forget(self) -> None:
        """Deletes what the run has written; its frames can't be read afterwards."""
        Store(self.summary.sparkSession).delete(self.folder)


def run_rules(spark: SparkSession, tables: Tables, catalog: Iterable[RuleSpec], available: Callable[[str], bool] = lambda _: True, links: DataFrame | None = None, strict: bool = True, fail_on_skipped: bool = False, isolate: bool = False, work: str | None = None, summary_only: bool = False) -> RunResult:
    """Runs all enabled rules: keys of references and checks are written once, results are written once from them, all else is read from these.

    work: a folder for them that all executors reach (default: a new one in spark.checkpoint.dir; `RunResult.forget`
    deletes it). isolate: each group of rules that share a plan is written by itself, and if it fails, each of its rules,
    so that one that fails when it runs is reported too and the others still share scans. summary_only: rows are counted
    where rules look at them, a few groups of rules at once, and neither checks nor results are made (billions, from some
    million shipments on); nothing is written.
    """
    if summary_only and links is not None:
        raise ValueError("a summary of linked results counts them, so they have to be made")
    folder = work_folder(spark, work)
    keep = lambda df: written(df, folder)
    enabled = [r for r in catalog if r.enabled]
    errors: dict[str, str] = {}
    tables = Frames(tables)
    skipped = {r.code: why for r in enabled if (why := missing(r, tables, available))}
    runnable = [r for r in enabled if r.code not in skipped]
    checks = counts = None
    if summary_only:
        # A row a rule comes to the driver, and disk holds the shuffle files of a few groups, not of the catalog.
        with tidied(spark):
            counts = spark.createDataFrame(counted_checks(tables, runnable, errors), "code string, total_checked long, total_failed long")
    else:
        checks = plan_checks(tables, runnable, errors, keep, keep if isolate else lambda df: df)
        checks = keep(checks) if checks is not None and not isolate else checks
    runnable = [r for r in runnable if r.code not in errors]
    shipments = tables("CMS_CNOTE") if available("CMS_CNOTE") else None
    results = None
    if checks is not None:
        found = numbered(keep(placed(linked(checks, runnable, links, shipments, available))))
        results = described(found, runnable, sources_of(available) if links is not None else set())
    if checks is not None:
        counts = totals(checks, results)
    elif counts is not None:
        counts = counts.withColumn("result_rows", F.col("total_checked"))  # without links a check is one result: contexts has a row a shipment
    summary = summarised(spark, enabled, skipped, errors, counts)
    if fail_on_skipped and skipped:
        raise RuntimeError(f"{len(skipped)} rules were skipped")
    if strict and errors:
        raise RuntimeError(f"{len(errors)} rules failed: {errors}")
    published = results.select(*RESULT_COLUMNS) if results is not None else None
    numbers = results.where("cnote_no <> ''").select(*LINK_COLUMNS) if results is not None else None
    return RunResult(checks, published, numbers, summary, errors, skipped, folder)


def totals(checks: DataFrame, results: DataFrame) -> DataFrame:
    """(code, total_checked, total_failed, result_rows): checks are counted before shipments multiply them."""
    own = checks.groupBy("code").agg(F.count(F.lit(1)).alias("total_checked"), F.count_if(F.col("status") == "FAIL").alias("total_failed"))
    rows = results.groupBy(F.col("index_code").alias("code")).agg(F.count(F.lit(1)).alias("result_rows"))
    return own.join(rows, "code", "left")


def summarised(spark: SparkSession, rules: list[RuleSpec], skipped: dict[str, str], errors: dict[str, str], counts: DataFrame | None) -> DataFrame:
    facts = [(r.code, r.element, r.indicator, r.family, r.table, skipped.get(r.code, ""), errors.get(r.code, "")) for r in rules]
    about = spark.createDataFrame(facts, "index_code string, element string, main_indicator string, rule_family string, table_name string, skip_reason string, error_message string")
    if counts is None:
        counts = spark.createDataFrame([], "code string, total_checked long, total_failed long, result_rows long")
    rows = about.join(counts, F.col("index_code") == F.col("code"), "left").fillna(0, ["total_checked", "total_failed", "result_rows"])
    status: Column = F.when(F.col("skip_reason") != "", "SKIPPED").when(F.col("error_message") != "", "ERROR").when(F.col("total_checked") == 0, "NO_ROWS").when(F.col("total_failed") > 0, "FAIL").otherwise("PASS")
    return rows.withColumn("status", status).select(*SUMMARY_COLUMNS)
