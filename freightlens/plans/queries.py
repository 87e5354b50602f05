"""The queries by name, over stand-in tables of the driver's data, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.functions.classes import branch_region, delivery_category, route_parts, service_bucket, shipment_scope
from freightlens.functions.events import first_value, last_value, latest
from freightlens.functions.values import key, normal, number, present, rounded, strip
from freightlens.operators import links, mart, spine
from freightlens.operators.rules import RuleSpec, compile_rule, plan_checks
from freightlens.operators.rules.catalog import by_code, load
from freightlens.operators.routes import match_places
from freightlens.operators.rules.families import with_route_parts
from freightlens.operators.rules.runner import RESULT_COLUMNS, contexts, enriched, missing, summarised, totals

from . import oracle as o
from .scopes import ScopeGraph
from .standins import Standins, with_tables
from .windows import DateWindow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None, over_standins: bool = True):
    """Registers f(tables) under a name, with its SQL."""

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(Standins(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql if not over_standins else _merge(sql) if sql.startswith("WITH ") else with_tables(sql)
        return f

    return register


def _merge(sql: str) -> str:
    """Stand-ins before a query that has common table expressions of its own."""
    own = sql.removeprefix("WITH ")
    head = with_tables(own).removesuffix("\n" + own)
    return f"{head},\n{own}"


CATALOG = load()


def rule(name: str, spec: RuleSpec | str, sql: str):
    """A rule's checks as a query."""
    spec = by_code(CATALOG, spec)[0] if isinstance(spec, str) else spec

    @query(name, sql)
    def run(t: Standins) -> DataFrame:
        tables = lambda n: with_route_parts(t(n)) if n == "CMS_DROURATE" else t(n)
        return compile_rule(tables, spec)


def _spec(family: str, table: str, **params) -> RuleSpec:
    return RuleSpec("X", family, table, params)


_pair = lambda a, b, on: f"{a} AS a JOIN {b} AS b ON a.{on[0]} IS NOT DISTINCT FROM b.{on[1]}"

rule("r01_completeness", "COMP1B12", o.checks("CNOTE_NO", f"NOT {o.there('CNOTE_ORIGIN')}", "CNOTE_ORIGIN", "''", "CMS_CNOTE"))
rule("r02_conditional_completeness", _spec("conditional_completeness", "CMS_MHOCNOTE", column="MHOCNOTE_SIGNDATE", condition_column="MHOCNOTE_APPROVE", condition_value="Y", cnote_column="MHOCNOTE_NO"), o.checks("MHOCNOTE_NO", "MHOCNOTE_SIGNDATE IS NULL", "MHOCNOTE_SIGNDATE", "MHOCNOTE_APPROVE", "CMS_MHOCNOTE WHERE upper(trim(MHOCNOTE_APPROVE)) = 'Y'"))
rule("r02_conditional_by_pattern", "COMP3J9", o.checks("MFBAG_NO", "false", "MFBAG_MAN_REF", "MFBAG_MAN_REF", "CMS_MFBAG WHERE regexp_matches(trim(MFBAG_MAN_REF), '(^|/)IM(/|$)')"))
rule("r02_conditional_by_pattern_of_another", _spec("conditional_completeness", "CMS_CNOTE", column="CNOTE_ORIGIN", condition_column="CNOTE_SERVICES_CODE", condition_regex="^(REG|YES)", cnote_column="CNOTE_NO"), o.checks("CNOTE_NO", f"NOT {o.there('CNOTE_ORIGIN')}", "CNOTE_ORIGIN", "CNOTE_SERVICES_CODE", "CMS_CNOTE WHERE regexp_matches(trim(CNOTE_SERVICES_CODE), '^(REG|YES)')"))
rule("r03_reference_conditional_completeness", "COMP2P6", o.checks("DRSHEET_CNOTE_NO", f"NOT {o.there('DRSHEET_FLAG')}", "DRSHEET_FLAG", "DRSHEET_CNOTE_NO", f"CMS_DRSHEET WHERE {o.norm('DRSHEET_CNOTE_NO')} IN {o.ref('CMS_CNOTE_POD', 'CNOTE_POD_NO')}"))
rule("r04_validity_regex", "VALD1B6", o.checks("CNOTE_NO", "NOT regexp_matches(CNOTE_SERVICES_CODE, '^[A-Z0-9]{2,5}$')", "CNOTE_SERVICES_CODE", "'^[A-Z0-9]{2,5}$'", f"CMS_CNOTE WHERE {o.there('CNOTE_SERVICES_CODE')}"))
rule("r05_validity_datetime", _spec("validity_datetime", "CMS_MSTATUS", column="MSTATUS_TEXT", cnote_column="MSTATUS_NO"), o.checks("MSTATUS_NO", "TRY_CAST(MSTATUS_TEXT AS TIMESTAMP) IS NULL", "MSTATUS_TEXT", "''", "CMS_MSTATUS"))
rule("r06_validity_integer", "VALD2B15", o.checks("CNOTE_NO", f"{o.num('CNOTE_WEIGHT')} IS NULL OR {o.num('CNOTE_WEIGHT')} <> {o.half_even(o.num('CNOTE_WEIGHT'))}", "CNOTE_WEIGHT", "''", f"CMS_CNOTE WHERE {o.there('CNOTE_WEIGHT')}"))
rule("r07_validity_in_set", "VALD10S5", o.checks("DHOV_RSHEET_CNOTE", f"{o.norm('DHOV_RSHEET_UNDEL')} NOT IN ('0', '1')", "DHOV_RSHEET_UNDEL", "'0,1'", "CMS_DHOV_RSHEET"))
rule("r08_value_in_reference", "ACCU6B6", o.checks("CNOTE_NO", f"{o.norm('CNOTE_SERVICES_CODE')} NOT IN {o.ref('CMS_DROURATE', 'DROURATE_SERVICE')}", "CNOTE_SERVICES_CODE", "'CMS_DROURATE'", f"CMS_CNOTE WHERE {o.there('CNOTE_SERVICES_CODE')}"))
rule("r09_reference_format", "VALD1B12", o.checks("CNOTE_NO", f"NOT regexp_matches({o.norm('CNOTE_ORIGIN')}, '^[A-Za-z0-9]+$') OR {o.norm('CNOTE_ORIGIN')} NOT IN (SELECT regexp_extract(DROURATE_CODE, '^([A-Z]{{3}}[0-9]{{5}})([A-Z]{{3}}[0-9]{{5}})$', 1) FROM CMS_DROURATE)".replace("{{", "{").replace("}}", "}"), "CNOTE_ORIGIN", "'CMS_DROURATE'", f"CMS_CNOTE WHERE {o.there('CNOTE_ORIGIN')}"))
rule("r10_non_negative", _spec("non_negative", "CMS_CNOTE", column="CNOTE_WEIGHT", cnote_column="CNOTE_NO"), o.checks("CNOTE_NO", f"{o.num('CNOTE_WEIGHT')} < 0", "CNOTE_WEIGHT", "'0'", f"CMS_CNOTE WHERE {o.num('CNOTE_WEIGHT')} IS NOT NULL"))
rule("r11_non_negative_not_in_reference", "ACCU4B15", o.checks("CNOTE_NO", f"{o.num('CNOTE_WEIGHT')} < 0 OR {o.norm('CNOTE_NO')} IN {o.ref('T_CORRECT_AWB', 'C_CNOTE_NO')}", "CNOTE_WEIGHT", "'T_CORRECT_AWB'", f"CMS_CNOTE WHERE {o.num('CNOTE_WEIGHT')} IS NOT NULL"))
rule("r12_uniqueness", "UNIQ1B74", o.checks("CNOTE_NO", "n > 1", "CNOTE_REFNO", "''", "(SELECT *, count(*) OVER (PARTITION BY CNOTE_REFNO) AS n FROM CMS_CNOTE WHERE CNOTE_REFNO IS NOT NULL)"))
rule("r12_uniqueness_of_pairs", "UNIQ2I1", o.checks("MFCNOTE_NO", "n > 1", "concat_ws('|', MFCNOTE_MAN_NO, MFCNOTE_BAG_NO, MFCNOTE_NO)", "''", "(SELECT *, count(*) OVER (PARTITION BY MFCNOTE_MAN_NO, MFCNOTE_BAG_NO, MFCNOTE_NO) AS n FROM CMS_MFCNOTE WHERE MFCNOTE_MAN_NO IS NOT NULL)"))
rule("r13_pair_consistency", "CONS1B12", o.checks("b.CNOTE_NO", "APICUST_ORIGIN <> CNOTE_ORIGIN", "APICUST_ORIGIN", "CNOTE_ORIGIN", _pair("CMS_APICUST", "CMS_CNOTE", ("APICUST_CNOTE_NO", "CNOTE_NO")) + " WHERE APICUST_ORIGIN IS NOT NULL AND CNOTE_ORIGIN IS NOT NULL"))
rule("r13_pair_latest_right", "CONS2R4", o.checks("a.CNOTE_POD_NO", "CNOTE_POD_STATUS <> DRSHEET_STATUS", "CNOTE_POD_STATUS", "DRSHEET_STATUS", "CMS_CNOTE_POD AS a JOIN (SELECT *, row_number() OVER (PARTITION BY DRSHEET_CNOTE_NO ORDER BY DRSHEET_DATE DESC NULLS LAST, DRSHEET_CNOTE_NO, DRSHEET_DATE, DRSHEET_FLAG, DRSHEET_NO, DRSHEET_STATUS) AS rn FROM CMS_DRSHEET) AS b ON a.CNOTE_POD_NO = b.DRSHEET_CNOTE_NO AND b.rn = 1"))
_CORRECT = _pair("CMS_CNOTE", "CMS_DCORRECT_DEST", ("CNOTE_NO", "DCORRECT_CNOTE_NO")) + f" WHERE {o.there('CNOTE_ORIGIN')} AND {o.there('DCORRECT_ORIGIN')}"
rule("r14_prefix_match", "ACCU2B12A", o.checks("CNOTE_NO", "left(trim(CNOTE_ORIGIN), 3) <> left(trim(DCORRECT_ORIGIN), 3)", "trim(CNOTE_ORIGIN)", "trim(DCORRECT_ORIGIN)", _CORRECT))
rule("r15_suffix_after_prefix_match", "ACCU3B12B", o.checks("CNOTE_NO", "trim(CNOTE_ORIGIN)[4:] <> trim(DCORRECT_ORIGIN)[4:]", "trim(CNOTE_ORIGIN)", "trim(DCORRECT_ORIGIN)", _CORRECT))
rule("r16_rounded_pair_consistency", "CONS2I4", o.checks("MFCNOTE_NO", "round_even(x, 0) <> round_even(y, 0)", "x", "y", f"(SELECT a.MFCNOTE_NO, {o.num('MFCNOTE_WEIGHT')} AS x, {o.num('CNOTE_WEIGHT')} AS y FROM {_pair('CMS_MFCNOTE', 'CMS_CNOTE', ('MFCNOTE_NO', 'CNOTE_NO'))}) WHERE x IS NOT NULL AND y IS NOT NULL"))
rule("r17_duplicate_aware_weight", "CONS3K5", f"""WITH p AS (SELECT a.DMBAG_NO AS g, {o.num("DMBAG_WEIGHT")} AS x, {o.num("MFBAG_ACT_WEIGHT")} AS y FROM {_pair("CMS_DMBAG", "CMS_MFBAG", ("DMBAG_BAG_NO", "MFBAG_NO"))}),
w AS (SELECT *, count(*) OVER (PARTITION BY g) > 1 AND min(round_even(x, 0)) OVER (PARTITION BY g) = max(round_even(x, 0)) OVER (PARTITION BY g) AND max(round_even(x, 0)) OVER (PARTITION BY g) > 50 AS s FROM p WHERE x IS NOT NULL AND y IS NOT NULL)
{o.checks("g", "round_even(x, 0) <> round_even(y, 0)", "x", "y", "w WHERE NOT s")} UNION ALL {o.checks("g", "round_even(x, 0) <> round_even(y, 0)", "x", "y", "(SELECT g, sum(x) AS x, sum(y) AS y FROM w WHERE s GROUP BY g)")}""")
rule("r18_bridged_pair_consistency", "CONS2C3", o.checks("d.DRCNOTE_CNOTE_NO", "trim(MRCNOTE_BRANCH_ID) <> trim(CNOTE_BRANCH_ID)", "MRCNOTE_BRANCH_ID", "CNOTE_BRANCH_ID", "CMS_MRCNOTE AS m JOIN CMS_DRCNOTE AS d ON m.MRCNOTE_NO = d.DRCNOTE_NO JOIN CMS_CNOTE AS c ON d.DRCNOTE_CNOTE_NO IS NOT DISTINCT FROM c.CNOTE_NO"))
rule("r18_bridged_rounded", "CONS2X5", o.checks("d.CNOTE_NO", f"round_even({o.num('CTC_WEIGHT')}, 0) <> round_even({o.num('MFCNOTE_WEIGHT')}, 0)", "CTC_WEIGHT", "MFCNOTE_WEIGHT", "CMS_COST_MTRANSIT_AGEN AS m JOIN CMS_COST_DTRANSIT_AGEN AS d ON m.MANIFEST_NO = d.DMANIFEST_NO JOIN CMS_MFCNOTE AS c ON d.CNOTE_NO = c.MFCNOTE_NO"))
rule("r19_bridged_substring_match", "CONS3H4", o.checks("c.CNOTE_NO", "trim(MANIFEST_ROUTE)[9:11] <> trim(CNOTE_DESTINATION)", "trim(MANIFEST_ROUTE)", "trim(CNOTE_DESTINATION)", f"CMS_MANIFEST AS m JOIN CMS_MFCNOTE AS f ON m.MANIFEST_NO = f.MFCNOTE_MAN_NO JOIN CMS_CNOTE AS c ON f.MFCNOTE_NO = c.CNOTE_NO WHERE {o.there('CNOTE_DESTINATION')}"))
rule("r20_aggregate_sum_consistency", "CONS3J3", o.checks("MFBAG_NO", "round_even(x, 0) <> round_even(s, 0)", "x", "s", f"(SELECT MFBAG_NO, {o.num('MFBAG_ACT_WEIGHT')} AS x, s FROM CMS_MFBAG JOIN (SELECT MFCNOTE_BAG_NO AS g, sum({o.num('MFCNOTE_WEIGHT')}) AS s FROM CMS_MFCNOTE GROUP BY 1) ON MFBAG_NO = g)"))
rule("r21_aggregate_count_consistency", "CONS4L6", o.checks("MMBAG_NO", "x <> n", "x", "n", f"(SELECT MMBAG_NO, {o.num('MMBAG_QTY')} AS x, n FROM CMS_MMBAG JOIN (SELECT DMBAG_NO AS g, count(DISTINCT MFCNOTE_NO) AS n FROM CMS_MFCNOTE JOIN CMS_DMBAG ON MFCNOTE_BAG_NO = DMBAG_BAG_NO GROUP BY 1) ON MMBAG_NO = g)"))
rule("r22_count_consistency", "CONS4N9", o.checks("MSMU_NO", "x <> n", "x", "n", f"(SELECT MSMU_NO, {o.num('MSMU_QTY')} AS x, n FROM CMS_MSMU JOIN (SELECT DSMU_NO AS g, count(DISTINCT DSMU_BAG_NO) AS n FROM CMS_DSMU GROUP BY 1) ON MSMU_NO = g)"))
rule("r23_transit_manifest_required", "COMP4J1", o.checks("MFBAG_NO", "NOT contains(upper(MFBAG_MAN_NO), 'TM')", "concat(DSMU_BAG_ORIGIN, ' / ', MSMU_ORIGIN)", "MFBAG_MAN_NO", "CMS_DSMU AS d JOIN CMS_MSMU AS m ON DSMU_NO = MSMU_NO JOIN CMS_MFBAG AS b ON DSMU_BAG_NO = MFBAG_NO WHERE left(DSMU_BAG_ORIGIN, 3) <> left(MSMU_ORIGIN, 3)"))
rule("r24_timeliness", "TIME1H15 (OM)", o.checks("MANIFEST_NO", "MANIFEST_CRDATE > MFBAG_CRDATE", "MANIFEST_CRDATE", "MFBAG_CRDATE", "CMS_MANIFEST JOIN CMS_MFBAG ON MANIFEST_NO = MFBAG_MAN_NO"))
rule("r25_bridged_timeliness", "TIME1B2", o.checks("CNOTE_NO", "CNOTE_DATE > MHI_APPROVE_DATE", "CNOTE_DATE", "MHI_APPROVE_DATE", "CMS_CNOTE JOIN CMS_DHI_HOC ON CNOTE_NO = DHI_CNOTE_NO JOIN CMS_MHI_HOC ON DHI_NO = MHI_NO"))
rule("r25_bridged_earliest", "TIME1C9", o.checks("k", "a > b", "a", "b", "(SELECT DRCNOTE_CNOTE_NO AS k, min(MRCNOTE_SIGNDATE) AS a, min(MFBAG_CRDATE) AS b FROM CMS_MRCNOTE JOIN CMS_DRCNOTE ON MRCNOTE_NO = DRCNOTE_NO JOIN CMS_MFCNOTE ON DRCNOTE_CNOTE_NO = MFCNOTE_NO JOIN CMS_MFBAG ON MFCNOTE_BAG_NO = MFBAG_NO GROUP BY 1)"))
rule("r25_bridged_first_start", _spec("bridged_timeliness", "CMS_MHOCNOTE", left_table="CMS_MHOCNOTE", start_column="MHOCNOTE_DATE", end_column="MSJ_SIGNDATE", joins=[{"table": "CMS_DSJ", "left_on": "MHOCNOTE_NO", "right_on": "DSJ_HVO_NO"}, {"table": "CMS_MSJ", "left_on": "DSJ_NO", "right_on": "MSJ_NO"}], first_start_group="MSJ_NO", cnote_column="MHOCNOTE_NO"), o.checks("MHOCNOTE_NO", "MHOCNOTE_DATE > MSJ_SIGNDATE", "MHOCNOTE_DATE", "MSJ_SIGNDATE", "(SELECT *, row_number() OVER (PARTITION BY MSJ_NO ORDER BY MHOCNOTE_DATE, MSJ_SIGNDATE, MHOCNOTE_NO) AS rn FROM CMS_MHOCNOTE JOIN CMS_DSJ ON MHOCNOTE_NO = DSJ_HVO_NO JOIN CMS_MSJ ON DSJ_NO = MSJ_NO) WHERE rn = 1 AND MSJ_SIGNDATE IS NOT NULL"))
_SEQ = f"WITH e AS (SELECT MFCNOTE_NO AS k, {o.norm('MANIFEST_CODE')} AS c, MFCNOTE_CRDATE AS t FROM CMS_MFCNOTE JOIN CMS_MANIFEST ON MFCNOTE_MAN_NO = MANIFEST_NO), g AS (SELECT k, max(t) FILTER (c = '1') AS om, min(t) FILTER (c = '2') AS t0, max(t) FILTER (c = '2') AS t1, min(t) FILTER (c = '3') AS im, count(t) FILTER (c = '2') AS n, count(DISTINCT t) FILTER (c = '2') AS d FROM e GROUP BY k) "
rule("r26_sequence_outbound", "TIME1I9 (OM)", _SEQ + o.checks("k", "om > t0", "om", "t0", "g WHERE om IS NOT NULL AND t0 IS NOT NULL"))
rule("r26_sequence_transit", "TIME1I9 (TM)", _SEQ + o.checks("k", "n > d OR coalesce(t1 > im, false)", "t1", "im", "g WHERE n > 1 OR (t1 IS NOT NULL AND im IS NOT NULL)"))
rule("r26_sequence_inbound", "TIME1I9 (IM)", _SEQ + o.checks("k", "im < t1", "t1", "im", "g WHERE t1 IS NOT NULL AND im IS NOT NULL"))
rule("r27_inbound_before_travel", _spec("cnote_im_manifest_before_msj", "CMS_MFCNOTE"), f"""WITH a AS (SELECT MFCNOTE_NO AS k, min(MANIFEST_DATE) AS t FROM CMS_MFCNOTE JOIN CMS_MANIFEST ON MFCNOTE_MAN_NO = MANIFEST_NO WHERE {o.norm("MANIFEST_CODE")} = '3' GROUP BY 1),
b AS (SELECT DHICNOTE_CNOTE_NO AS k, min(MSJ_SIGNDATE) AS u FROM CMS_DHICNOTE JOIN CMS_RDSJ ON DHICNOTE_NO = RDSJ_HVI_NO JOIN CMS_DSJ ON RDSJ_HVO_NO = DSJ_HVO_NO JOIN CMS_MSJ ON DSJ_NO = MSJ_NO GROUP BY 1) {o.checks("k", "t > u", "t", "u", "a JOIN b USING (k) WHERE t IS NOT NULL AND u IS NOT NULL")}""")
rule("r28_integrity_orphan", _spec("integrity_orphan", "CMS_DRCNOTE", child_table="CMS_DRCNOTE", child_column="DRCNOTE_NO", parent_table="CMS_MRCNOTE", parent_column="MRCNOTE_NO", cnote_column="DRCNOTE_CNOTE_NO"), o.checks("DRCNOTE_CNOTE_NO", "DRCNOTE_NO NOT IN (SELECT MRCNOTE_NO FROM CMS_MRCNOTE)", "DRCNOTE_NO", "'CMS_MRCNOTE'", "CMS_DRCNOTE"))


@query("spine", o.SPINE)
def _(t):
    return spine.build_spine(t)


@query("spine_category_matrix", f"SELECT delivery_type, shipment_scope, delivery_category, count(*) AS n FROM ({_merge(o.SPINE)}) GROUP BY ALL", over_standins=False)
def _(t):
    return spine.classification_matrix(spine.build_spine(t))


for _name in o.STAGES:
    _take = {
        "orders_stage": lambda t: mart.orders_stage(t, mart.zones(t)).drop(mart.SPREAD),
        "receipt_stage": lambda t: mart.receipt_stage(t, mart.zones(t)).drop("RECV_SIGN_DATE"),
        "manifest_stage": lambda t: mart.manifest_stage(t, mart.zones(t)),
        "linehaul_stage": mart.linehaul_stage,
        "handover_stage": mart.handover_stage,
        "transit_stage": lambda t: mart.transit_stage(t, mart.zones(t)),
        "delivery_stage": lambda t: mart.delivery_stage(t, mart.zones(t)),
        "irregular_stage": mart.irregular_stage,
    }[_name]
    query(f"mart_{_name}", o.stage(_name))(_take)


@query("wide_mart", o.MART)
def _(t):
    return mart.build_mart(t)


@query("zone_priority", f"WITH {o.ZONE} SELECT u AS user_id, z AS zone_code FROM zone")
def _(t):
    return mart.zones(t).select(F.col("_user").alias("user_id"), F.col("_zone").alias("zone_code"))


LINKS = o.LINKS


@query("document_links", LINKS)
def _(t):
    return links.build_links(t, t.available)


@query("links_two_hop", "SELECT DISTINCT trim(MSMU_NO) AS document_id, trim(MFCNOTE_NO) AS cnote_no FROM CMS_MSMU JOIN CMS_DSMU ON MSMU_NO = DSMU_NO JOIN CMS_MFCNOTE ON DSMU_BAG_NO = MFCNOTE_BAG_NO")
def _(t):
    return links.along(links.PATHS[14], t).distinct()


_WINDOW = DateWindow(date(1995, 1, 1), date(1995, 4, 1))
_IN = "o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-04-01'"
_SCOPE = "SELECT CNOTE_NO AS k FROM CMS_CNOTE WHERE CNOTE_DATE >= DATE '1995-01-01' AND CNOTE_DATE < DATE '1995-04-01' AND CNOTE_NO IS NOT NULL"
_GUARD = ">= DATE '1995-01-01' AND {0} < DATE '1995-05-01'"
_guard = lambda c: f"{c} {_GUARD.format(c)}"
_CHAIN = f"""WITH c AS ({_SCOPE}), f AS (SELECT * FROM CMS_MFCNOTE SEMI JOIN c ON MFCNOTE_NO = k WHERE {_guard("MFCNOTE_CRDATE")}), m AS (SELECT DISTINCT MFCNOTE_MAN_NO AS k FROM f WHERE MFCNOTE_MAN_NO IS NOT NULL),
b AS (SELECT MFCNOTE_BAG_NO AS k FROM f WHERE MFCNOTE_BAG_NO IS NOT NULL UNION SELECT MFBAG_NO FROM CMS_MFBAG SEMI JOIN m ON MFBAG_MAN_NO = k WHERE MFBAG_NO IS NOT NULL), d AS (SELECT DISTINCT DMBAG_NO AS k FROM CMS_DMBAG SEMI JOIN b ON DMBAG_BAG_NO = k WHERE DMBAG_NO IS NOT NULL) """


def _graph(t, **how) -> ScopeGraph:
    return ScopeGraph(t, _WINDOW, **how)


@query("scope_anchor_top_n", f"SELECT k FROM (SELECT CNOTE_NO AS k FROM CMS_CNOTE WHERE CNOTE_DATE >= DATE '1995-01-01' AND CNOTE_DATE < DATE '1995-04-01' ORDER BY CNOTE_DATE, CNOTE_NO NULLS FIRST LIMIT 50) WHERE k IS NOT NULL")
def _(t):
    return _graph(t, limit=50).keys("CNOTE")


@query("scope_union_of_sources", _CHAIN + "SELECT k FROM b")
def _(t):
    return _graph(t).keys("MFBAG")


@query("scope_chain_of_five", _CHAIN + "SELECT DISTINCT DSMU_NO AS k FROM CMS_DSMU SEMI JOIN d ON DSMU_BAG_NO = k WHERE DSMU_NO IS NOT NULL")
def _(t):
    return _graph(t).keys("SMU")


@query("scope_restricted_table", _CHAIN + f"SELECT MFBAG_NO, MFBAG_MAN_NO, MFBAG_CRDATE FROM CMS_MFBAG SEMI JOIN m ON MFBAG_MAN_NO = k WHERE {_guard('MFBAG_CRDATE')}")
def _(t):
    return _graph(t).restricted("CMS_MFBAG", exclude=["mfbag_act_weight", "MFBAG_MAN_REF"])


@query("scope_of_travel_documents", f"""WITH c AS ({_SCOPE}), i AS (SELECT DISTINCT DHICNOTE_NO AS k FROM CMS_DHICNOTE SEMI JOIN c ON DHICNOTE_CNOTE_NO = k), r AS (SELECT DISTINCT RDSJ_HVO_NO AS k FROM CMS_RDSJ SEMI JOIN i ON RDSJ_HVI_NO = k) SELECT DISTINCT DSJ_NO AS k FROM CMS_DSJ SEMI JOIN r ON DSJ_HVO_NO = k""")
def _(t):
    return _graph(t).keys("MSJ")


_SOME = ("COMP1B12", "VALD1B6", "VALD2B15", "UNIQ1B74", "COMP1I1", "TIME1I9 (OM)", "CONS3J3", "COMP1B18")
_some = lambda: by_code(CATALOG, *_SOME)


def _checks(t: Standins):
    rules = [r for r in _some() if not missing(r, t, t.available)]
    return rules, plan_checks(t, rules)


_SUMMED = f"""SELECT 'COMP1B12' AS index_code, 'completeness' AS rule_family, 'CMS_CNOTE' AS table_name, count(*) AS total_checked, count(*) FILTER (NOT {o.there("CNOTE_ORIGIN")}) AS total_failed FROM CMS_CNOTE
UNION ALL SELECT 'VALD1B6', 'validity_regex', 'CMS_CNOTE', count(*), count(*) FILTER (NOT regexp_matches(CNOTE_SERVICES_CODE, '^[A-Z0-9]{{2,5}}$')) FROM CMS_CNOTE
UNION ALL SELECT 'VALD2B15', 'validity_integer', 'CMS_CNOTE', count(*), count(*) FILTER ({o.num("CNOTE_WEIGHT")} <> round_even({o.num("CNOTE_WEIGHT")}, 0)) FROM CMS_CNOTE
UNION ALL SELECT 'UNIQ1B74', 'uniqueness', 'CMS_CNOTE', count(*), count(*) FILTER (n > 1) FROM (SELECT count(*) OVER (PARTITION BY CNOTE_REFNO) AS n FROM CMS_CNOTE)
UNION ALL SELECT 'COMP1I1', 'completeness', 'CMS_MFCNOTE', count(*), count(*) FILTER (MFCNOTE_MAN_NO IS NULL) FROM CMS_MFCNOTE
UNION ALL SELECT 'TIME1I9 (OM)', 'manifest_code_sequence', 'CMS_MFCNOTE', count(*), count(*) FILTER (om > t0) FROM (SELECT max(MFCNOTE_CRDATE) FILTER (c = '1') AS om, min(MFCNOTE_CRDATE) FILTER (c = '2') AS t0 FROM (SELECT *, {o.norm("MANIFEST_CODE")} AS c FROM CMS_MFCNOTE JOIN CMS_MANIFEST ON MFCNOTE_MAN_NO = MANIFEST_NO) GROUP BY MFCNOTE_NO) WHERE om IS NOT NULL AND t0 IS NOT NULL
UNION ALL SELECT 'CONS3J3', 'aggregate_sum_consistency', 'CMS_MFBAG', count(*), count(*) FILTER (round_even({o.num("MFBAG_ACT_WEIGHT")}, 0) <> round_even(s, 0)) FROM CMS_MFBAG JOIN (SELECT MFCNOTE_BAG_NO AS g, sum({o.num("MFCNOTE_WEIGHT")}) AS s FROM CMS_MFCNOTE GROUP BY 1) ON MFBAG_NO = g
UNION ALL SELECT 'COMP1B18', 'completeness', 'CMS_CNOTE', 0, 0"""


@query("rule_summary", f"SELECT *, CASE WHEN index_code = 'COMP1B18' THEN 'missing columns: CMS_CNOTE.CNOTE_SHIPPER_ADDR1' ELSE '' END AS skip_reason, CASE WHEN index_code = 'COMP1B18' THEN 'SKIPPED' WHEN total_checked = 0 THEN 'NO_ROWS' WHEN total_failed > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({_SUMMED})")
def _(t):
    rules, checks = _checks(t)
    skipped = {r.code: why for r in _some() if (why := missing(r, t, t.available))}
    counts = totals(checks, checks.withColumnRenamed("code", "index_code"))
    return summarised(t.spark, _some(), skipped, {}, counts).select("index_code", "rule_family", "table_name", "total_checked", "total_failed", "skip_reason", "status")


_RESULT = (*(c for c in RESULT_COLUMNS if c != "result_id"), "link_method")
_REGION = "coalesce(CASE upper(left(trim({0}), 3)) WHEN 'CGK' THEN 'Jakarta' WHEN 'BDO' THEN 'Jawa Barat' WHEN 'SUB' THEN 'JTBNN' WHEN 'MES' THEN 'Sumbagut' WHEN 'TGR' THEN 'Bodetabekcikcil' WHEN 'UPG' THEN 'Sulampapua' ELSE 'Other' END, 'Other')"
_CONTEXT = f"""x AS (SELECT * EXCLUDE (rn) FROM (SELECT trim(CNOTE_NO) AS cnote_no, {o.key("CNOTE_ORIGIN")} AS cnote_origin, {o.key("CNOTE_DESTINATION")} AS cnote_destination, {_REGION.format("CNOTE_ORIGIN")} AS origin_region, {_REGION.format("CNOTE_DESTINATION")} AS destination_region, CASE WHEN upper(left(CNOTE_SERVICES_CODE, 3)) IN ('YES', 'OKE', 'JTR', 'REG') THEN upper(left(CNOTE_SERVICES_CODE, 3)) ELSE 'Other' END AS cnote_service_code,
  CASE WHEN o = '' OR d = '' OR p = '' OR q = '' THEN 'Unknown' WHEN o = d AND p = q THEN 'Intracity' WHEN o = d THEN 'Intercity' ELSE 'Domestic' END AS shipment_type, row_number() OVER (PARTITION BY trim(CNOTE_NO)) AS rn FROM (SELECT *, regexp_extract(upper({o.key("CNOTE_ORIGIN")}), '^([A-Z]{{3}})', 1) AS o, regexp_extract(upper({o.key("CNOTE_DESTINATION")}), '^([A-Z]{{3}})', 1) AS d,
  regexp_extract(upper({o.key("CNOTE_ORIGIN")}), '^[A-Z]{{3}}([0-9])', 1) AS p, regexp_extract(upper({o.key("CNOTE_DESTINATION")}), '^[A-Z]{{3}}([0-9])', 1) AS q FROM CMS_CNOTE) WHERE trim(CNOTE_NO) <> '') WHERE rn = 1)"""
_BAGS = by_code(CATALOG, "COMP1J3", "COMP1B12")
_ENRICHED = f"""{LINKS.replace("WITH l AS", "WITH l0 AS").replace("SELECT l.* FROM l SEMI", "SELECT l.* FROM l0 AS l SEMI").replace(") SELECT l.*", "), l AS (SELECT l.*")}), {_CONTEXT},
k AS (SELECT 'COMP1J3' AS index_code, trim(MFBAG_NO) AS document_id, CASE WHEN {o.there("MFBAG_ACT_WEIGHT")} THEN 'PASS' ELSE 'FAIL' END AS status, {o.show("MFBAG_ACT_WEIGHT")} AS variable_1 FROM CMS_MFBAG),
n AS (SELECT 'COMP1B12' AS index_code, {o.key("CNOTE_NO")} AS document_id, CASE WHEN {o.there("CNOTE_ORIGIN")} THEN 'PASS' ELSE 'FAIL' END AS status, {o.show("CNOTE_ORIGIN")} AS variable_1 FROM CMS_CNOTE),
r AS (SELECT k.*, l.cnote_no AS c, 'CMS_MFBAG' AS table_name, 'bag' AS level, '2. Manifest' AS stage, 'MFBAG_ACT_WEIGHT' AS column_name, 'Weight' AS main_indicator, 'Reporting' AS main_impact, 'Understated weight' AS impact_details, 'Mandatory Field - Blank' AS issue_description, 'cms_mfbag_bridge' AS link_method FROM k LEFT JOIN l ON l.source_table = 'CMS_MFBAG' AND l.document_id = k.document_id
  UNION ALL SELECT n.*, n.document_id, 'CMS_CNOTE', 'cnote', '', 'CNOTE_ORIGIN', 'Origin', 'TBD', 'TBD', 'TBD', 'direct_cnote' FROM n)
SELECT coalesce(shipment_type, '') AS shipment_type, coalesce(x.cnote_no, '') AS cnote_no, CASE WHEN document_id <> coalesce(x.cnote_no, '') THEN document_id ELSE '' END AS document_no, coalesce(cnote_origin, '') AS cnote_origin, coalesce(cnote_destination, '') AS cnote_destination, coalesce(origin_region, '') AS origin_region, coalesce(destination_region, '') AS destination_region, coalesce(cnote_service_code, '') AS cnote_service_code,
  index_code, 'Completeness' AS element, table_name || '.' || column_name || ' must not be null or empty' AS logic_description, table_name, level, stage, variable_1, '' AS variable_2, column_name, main_indicator, main_impact, impact_details, issue_description, status, link_method FROM r LEFT JOIN x ON r.c = x.cnote_no"""


@query("result_enrichment", _ENRICHED)
def _(t):
    found = links.build_links(t, t.available, sources={r.table for r in _BAGS}, restricted=False)
    return enriched(plan_checks(t, _BAGS), _BAGS, found, t("CMS_CNOTE")).select(*_RESULT)


@query("result_links", f"SELECT index_code, cnote_no, link_method, count(*) AS n FROM ({_merge(_ENRICHED)}) WHERE cnote_no <> '' GROUP BY ALL", over_standins=False)
def _(t):
    found = links.build_links(t, t.available, sources={r.table for r in _BAGS}, restricted=False)
    rows = enriched(plan_checks(t, _BAGS), _BAGS, found, t("CMS_CNOTE")).where("cnote_no <> ''")
    return rows.groupBy("index_code", "cnote_no", "link_method").agg(F.count(F.lit(1)).alias("n"))


@query("shipment_contexts", f"WITH {_CONTEXT} SELECT cnote_no, origin_region, cnote_service_code, shipment_type FROM x")
def _(t):
    return contexts(t("CMS_CNOTE")).select("cnote_no", "origin_region", "cnote_service_code", "shipment_type")


@query("route_reference_match", f"""WITH r AS (SELECT DROURATE_CODE AS c, regexp_matches(DROURATE_CODE, '^[A-Z]{{3}}[0-9]{{5}}[A-Z]{{3}}[0-9]{{5}}$') AS ok FROM CMS_DROURATE), k AS (SELECT DISTINCT CNOTE_ORIGIN AS v FROM CMS_CNOTE WHERE {o.there("CNOTE_ORIGIN")})
SELECT v AS candidate, EXISTS (SELECT 1 FROM r WHERE ok AND left(c, 8) = v) AS matched, (SELECT count(*) FROM r WHERE NOT ok) AS malformed FROM k""")
def _(t):
    candidates = t("CMS_CNOTE").where(present(F.col("CNOTE_ORIGIN"))).select(normal(F.col("CNOTE_ORIGIN")).alias("candidate"))
    return match_places(candidates, t("CMS_DROURATE"), "origin")


@query("route_components", "SELECT DISTINCT DROURATE_CODE AS code, regexp_extract(DROURATE_CODE, '^([A-Z]{3}[0-9]{5})([A-Z]{3}[0-9]{5})$', 1) AS origin, regexp_extract(DROURATE_CODE, '^([A-Z]{3}[0-9]{5})([A-Z]{3}[0-9]{5})$', 2) AS destination FROM CMS_DROURATE")
def _(t):
    a, b, _ = route_parts(F.col("DROURATE_CODE"))
    return t("CMS_DROURATE").select(F.col("DROURATE_CODE").alias("code"), a.alias("origin"), b.alias("destination")).distinct()


@query("region_and_service_lookup", f"SELECT {_REGION.format('CNOTE_ORIGIN')} AS region, CASE WHEN upper(left(CNOTE_SERVICES_CODE, 3)) IN ('YES', 'OKE', 'JTR', 'REG') THEN upper(left(CNOTE_SERVICES_CODE, 3)) ELSE 'Other' END AS service, count(*) AS n FROM CMS_CNOTE GROUP BY ALL")
def _(t):
    return t("CMS_CNOTE").groupBy(branch_region(F.col("CNOTE_ORIGIN")).alias("region"), service_bucket(F.col("CNOTE_SERVICES_CODE")).alias("service")).agg(F.count(F.lit(1)).alias("n"))


# Single operators on the driver's own tables.

_EVENTS = "SELECT user_id, arg_min(v, ts) AS first_v, arg_max(v, ts) AS last_v, min(ts) FILTER (event_type = 'click') AS first_click, count(*) FILTER (event_type = 'view') AS views FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS v FROM events) GROUP BY user_id"


@query("argmin_nonnull", _EVENTS, over_standins=False)
def _(t):
    e = t.raw("events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))
    kind = lambda k: F.col("event_type") == k
    return e.groupBy("user_id").agg(first_value("v", "ts").alias("first_v"), last_value("v", "ts").alias("last_v"), F.min(F.when(kind("click"), F.col("ts"))).alias("first_click"), F.count_if(kind("view")).alias("views"))


@query("latest_row", "SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1", over_standins=False)
def _(t):
    return latest(t.raw("events"), "user_id", [F.col("ts").desc_nulls_last(), F.col("event_id")]).select("user_id", "event_id", "ts")


@query("window_counts", "SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events", over_standins=False)
def _(t):
    w = Window.partitionBy("user_id")
    return t.raw("events").select("event_id", F.row_number().over(w.orderBy("ts", "event_id")).cast("long").alias("rn"), F.count(F.lit(1)).over(w).alias("n"))


@query("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier", over_standins=False)
def _(t):
    return t.raw("customer").select(F.col("c_nationkey").alias("k")).union(t.raw("supplier").select("s_nationkey")).distinct()


@query("star_except", "SELECT * EXCLUDE (c_acctbal, c_mktsegment) FROM customer", over_standins=False)
def _(t):
    return t.raw("customer").drop("c_acctbal", "c_mktsegment")


@query("null_safe_join", "SELECT a.CNOTE_NO AS a, b.CNOTE_NO AS b FROM CMS_CNOTE AS a JOIN (SELECT DISTINCT CNOTE_NO FROM CMS_CNOTE) AS b ON a.CNOTE_NO IS NOT DISTINCT FROM b.CNOTE_NO")
def _(t):
    a = t("CMS_CNOTE").select(F.col("CNOTE_NO").alias("a"))
    b = t("CMS_CNOTE").select(F.col("CNOTE_NO").alias("b")).distinct()
    return a.join(b, F.col("a").eqNullSafe(F.col("b")))


@query("parsed_values", f"SELECT CNOTE_DATE, {o.num('CNOTE_QTY')} AS qty, {o.norm('CNOTE_QTY')} AS code, round_even({o.num('CNOTE_WEIGHT')}, 0) AS weight, trim(CNOTE_USER) AS user_id, {o.key('CNOTE_DESTINATION')} AS destination, {o.there('CNOTE_DESTINATION')} AS given FROM CMS_CNOTE")
def _(t):
    c = F.col
    return t("CMS_CNOTE").select("CNOTE_DATE", number(c("CNOTE_QTY")).alias("qty"), normal(c("CNOTE_QTY")).alias("code"), rounded(number(c("CNOTE_WEIGHT")), 0).alias("weight"), strip(c("CNOTE_USER")).alias("user_id"), key(c("CNOTE_DESTINATION")).alias("destination"), present(c("CNOTE_DESTINATION")).alias("given"))


_PLACES = f"regexp_extract(upper({o.key('CNOTE_ORIGIN')}), '^([A-Z]{{3}})', 1) AS a, regexp_extract(upper({o.key('CNOTE_DESTINATION')}), '^([A-Z]{{3}})', 1) AS b, regexp_extract(upper({o.key('CNOTE_ORIGIN')}), '^[A-Z]{{3}}([0-9])', 1) AS p, regexp_extract(upper({o.key('CNOTE_DESTINATION')}), '^[A-Z]{{3}}([0-9])', 1) AS q"


@query("delivery_categories", f"""SELECT kind, scope, CASE WHEN scope = 'Domestic' THEN kind || ' Domestic' ELSE scope END AS category, count(*) AS n FROM (
SELECT kind, CASE WHEN a = '' OR b = '' OR p = '' OR q = '' THEN 'Unknown' WHEN a = b AND p = q THEN 'Intracity' WHEN a = b THEN 'Intercity' ELSE 'Domestic' END AS scope FROM (
SELECT CASE WHEN CNOTE_CANCEL = 'Y' THEN 'Transit' ELSE 'Direct' END AS kind, {_PLACES} FROM CMS_CNOTE)) GROUP BY ALL""")
def _(t):
    """Categories of the shipments by kind and by the places' scope."""
    kind = F.when(F.col("CNOTE_CANCEL") == "Y", "Transit").otherwise("Direct")
    rows = t("CMS_CNOTE").select(kind.alias("kind"), shipment_scope(key(F.col("CNOTE_ORIGIN")), key(F.col("CNOTE_DESTINATION"))).alias("scope"))
    rows = rows.withColumn("category", delivery_category(F.col("kind"), F.col("scope")))
    return rows.groupBy("kind", "scope", "category").agg(F.count(F.lit(1)).alias("n"))


from . import run_queries  # noqa: E402, F401  its queries need those above
