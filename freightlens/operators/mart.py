"""The wide mart: one row per shipment with its order, receipt, manifests, linehaul, handovers, transit, delivery and irregularities.

Each stage is one row per shipment (or bag). Where rows tie in the order that makes one of them first, more columns
decide, so that the result is the same in every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.classes import order_type
from freightlens.functions.events import first_value, firsts_and_lasts, last_value, latest, ranked
from freightlens.functions.values import strip

Tables = Callable[[str], DataFrame]


def zones(tables: Tables) -> DataFrame:
    """(_user, _zone): the zone of each user, the user table before the couriers' one. Small: a row per employee."""
    sides = []
    for priority, (table, user, zone) in enumerate((("ORA_USER", "USER_ID", "USER_ZONE_CODE"), ("LASTMILE_COURIER", "COURIER_ID", "COURIER_ZONE"))):
        sides.append(tables(table).select(strip(F.col(user)).alias("_user"), strip(F.col(zone)).alias("_zone"), F.lit(priority).alias("_priority")))
    both = sides[0].unionByName(sides[1]).where("_user <> '' AND _zone <> ''")
    return both.groupBy("_user").agg(F.min_by("_zone", F.struct("_priority", "_zone")).alias("_zone"))


def with_zone(rows: DataFrame, zone: DataFrame, user: str, name: str) -> DataFrame:
    # Broadcast, as a row per employee is; the size that Spark expects of it is that of the tables it comes from.
    return rows.join(F.broadcast(zone), strip(F.col(user)) == F.col("_user"), "left").withColumnRenamed("_zone", name).drop("_user")


def _select(rows: DataFrame, **names: str) -> DataFrame:
    """Columns under new names."""
    return rows.select(*(F.col(old).alias(new) for new, old in names.items()))


def with_master(tables: Tables, detail: str, master: str, on: tuple[str, str]) -> DataFrame:
    return tables(detail).join(tables(master), F.col(on[0]) == F.col(on[1]), "left")


#: A join's key on the left: the shipment's number; of a row without one a text that no number equals, different by row.
SPREAD = "_spread"


def spread(rows: DataFrame, on: str) -> DataFrame:
    """rows with SPREAD, so that those without a key, which join nothing, don't all go to one task."""
    return rows.withColumn(SPREAD, F.coalesce(on, F.concat(F.lit("\x00"), F.xxhash64(*(c for c in rows.columns if c != on)).cast("string"))))


def orders_stage(tables: Tables, zone: DataFrame) -> DataFrame:
    newest = lambda t, k: latest(tables(t).where(F.col(k).isNotNull()), k, [F.col("CREATE_DATE").desc_nulls_last(), *(F.col(c) for c in sorted(tables(t).columns))])
    api = newest("CMS_APICUST", "APICUST_CNOTE_NO").withColumnRenamed("CREATE_DATE", "API_DATE")
    cancel = newest("T_CANCEL_CNOTE_API", "API_CNOTE_NO").select("API_CNOTE_NO", F.col("CREATE_DATE").alias("API_CANCELED_DATE"))
    # Cancellations go to their orders first: most shipments have no such order, and a null key would put them in one task.
    api = api.join(cancel, F.col("APICUST_CNOTE_NO") == F.col("API_CNOTE_NO"), "left")
    rows = spread(tables("CMS_CNOTE"), "CNOTE_NO").join(api, F.col(SPREAD) == F.col("APICUST_CNOTE_NO"), "left")
    rows = with_zone(rows, zone, "CNOTE_USER", "CNOTE_USER_ZONE")
    kind = order_type(F.col("APICUST_SHIPMENT_TYPE"), F.col("CNOTE_ORIGIN"), F.col("CNOTE_DESTINATION"))
    own = ["CNOTE_DATE", "CNOTE_CRDATE", "CNOTE_CUST_NO", "CNOTE_USER", "CNOTE_ORIGIN", "CNOTE_DESTINATION", "CNOTE_SERVICES_CODE", "CNOTE_WEIGHT", "CNOTE_AMOUNT", "CNOTE_CANCEL", "CNOTE_USER_ZONE", "API_DATE"]
    api_columns = {"API_CUST_ID": "CUST_NO", "API_ORIGIN": "ORIGIN", "API_DESTINATION": "DESTINATION", "API_SERVICES": "SERVICES_CODE", "API_FM_TYPE": "SHIPMENT_TYPE", "API_WEIGHT": "WEIGHT"}
    return rows.select(SPREAD, "CNOTE_NO", F.coalesce("API_DATE", "CNOTE_CRDATE").alias("DB_CRDATE"), kind.alias("SHIPMENT_TYPE"), *own, *(F.col(f"APICUST_{c}").alias(n) for n, c in api_columns.items()), "API_CANCELED_DATE")


def receipt_stage(tables: Tables, zone: DataFrame) -> DataFrame:
    """The first receipt scan of either receipt process."""
    pickup = with_zone(with_master(tables, "CMS_DRCNOTE", "CMS_MRCNOTE", ("DRCNOTE_NO", "MRCNOTE_NO")), zone, "MRCNOTE_USER_ID", "RECV_ZONE")
    counter = with_zone(with_master(tables, "CMS_DHI_HOC", "CMS_MHI_HOC", ("DHI_NO", "MHI_NO")), zone, "MHI_UID", "RECV_ZONE")
    names = ("RECV_CNOTE_NO", "RECV_NO", "RECV_SCAN_DATE", "RECV_USER_ID", "RECV_ZONE", "RECV_DATE", "RECV_SIGN_DATE")
    pick = lambda rows, columns: _select(rows, **dict(zip(names, columns, strict=True)))
    pickup = pick(pickup, ("DRCNOTE_CNOTE_NO", "DRCNOTE_NO", "DRCNOTE_TDATE", "MRCNOTE_USER_ID", "RECV_ZONE", "MRCNOTE_DATE", "MRCNOTE_SIGNDATE")).withColumn("_source", F.lit(0))
    counter = pick(counter, ("DHI_CNOTE_NO", "DHI_NO", "CDATE", "MHI_UID", "RECV_ZONE", "MHI_DATE", "MHI_APPROVE_DATE")).withColumn("_source", F.lit(1))
    both = pickup.unionByName(counter).where(F.col("RECV_CNOTE_NO").isNotNull())
    return latest(both, "RECV_CNOTE_NO", [F.col("RECV_SCAN_DATE").asc_nulls_last(), F.col("_source"), F.col("RECV_NO"), F.col("RECV_DATE")]).drop("_source")


def manifest_stage(tables: Tables, zone: DataFrame) -> DataFrame:
    """First outbound, first and last transit and first inbound manifest, and the first pre-run-sheet."""
    rows = with_zone(with_master(tables, "CMS_MFCNOTE", "CMS_MANIFEST", ("MFCNOTE_MAN_NO", "MANIFEST_NO")), zone, "MANIFEST_UID", "ZONE")
    rows = _select(rows, MF_CNOTE_NO="MFCNOTE_NO", NO="MFCNOTE_MAN_NO", BAG_NO="MFCNOTE_BAG_NO", SCAN_DATE="MFCNOTE_CRDATE", DATE="MANIFEST_DATE", USER="MANIFEST_UID", ZONE="ZONE", code="MANIFEST_CODE")
    rows = rows.where(F.col("MF_CNOTE_NO").isNotNull()).withColumn("code", F.col("code").cast("string"))
    # The scan decides, then the manifest and bag, so that equal scans have one answer.
    order = F.when(F.col("SCAN_DATE").isNotNull(), F.struct("SCAN_DATE", "NO", "BAG_NO"))
    is_ = lambda code: F.col("code") == code

    def pick(by, prefix: str, code: str, fields: tuple[str, ...]) -> list[Column]:
        out = [by(f, order, is_(code)).alias(f"{prefix}_{f}") for f in fields]
        scan = (F.min if by is first_value else F.max)(F.when(is_(code), F.col("SCAN_DATE"))).alias(f"{prefix}_SCAN_DATE")
        at = 2 if "BAG_NO" in fields else 1
        return [*out[:at], scan, *out[at:]]

    common = ("DATE", "USER", "ZONE")
    tag = F.when(F.count_if(is_("1")) == 0, "Null OM").when(F.count_if(is_("3")) == 0, "Null OM-IM").otherwise("Complete")
    pivot = rows.groupBy("MF_CNOTE_NO").agg(
        *pick(first_value, "OM", "1", ("NO", "BAG_NO", *common)), F.count_if(is_("2")).alias("TM_COUNT"), *pick(first_value, "TM_FIRST", "2", ("NO", *common)),
        *pick(last_value, "TM_LAST", "2", ("NO", *common)), *pick(first_value, "IM", "3", ("NO", *common)), tag.alias("MANIFEST_TAG"),
    )
    pra = with_zone(with_master(tables, "CMS_DRSHEET_PRA", "CMS_MRSHEET_PRA", ("DRSHEET_NO", "MRSHEET_NO")), zone, "MRSHEET_UID", "ZONE")
    first = F.when(F.col("MRSHEET_DATE").isNotNull(), F.struct("MRSHEET_DATE", "DRSHEET_NO"))
    pra = pra.where(F.col("DRSHEET_CNOTE_NO").isNotNull()).groupBy("DRSHEET_CNOTE_NO").agg(
        first_value("DRSHEET_NO", first).alias("DRI_PRA_NO"), F.min("MRSHEET_DATE").alias("DRI_PRA_DATE"), first_value("MRSHEET_UID", first).alias("DRI_PRA_USER"), first_value("ZONE", first).alias("DRI_PRA_ZONE")
    )
    return pivot.join(pra, F.col("MF_CNOTE_NO") == F.col("DRSHEET_CNOTE_NO"), "full").drop("DRSHEET_CNOTE_NO")


def linehaul_stage(tables: Tables) -> DataFrame:
    """First, second and last linehaul document of each bag."""
    fields = {"NO": "MSMU_NO", "ESB_TIME": "ESB_TIME", "DATE": "MSMU_DATE", "FLIGHT_DATE": "MSMU_FLIGHT_DATE", "WH_DATE": "MSMU_WRH_DATE", "OFF_DATE": "MSMU_OFF_DATE", "MODA": "MSMU_MODA"}
    rows = with_master(tables, "CMS_DSMU", "CMS_MSMU", ("DSMU_NO", "MSMU_NO")).where("DSMU_BAG_NO IS NOT NULL AND DSMU_NO IS NOT NULL")
    rows = ranked(_select(rows, SM_BAG="DSMU_BAG_NO", **fields), "SM_BAG", [F.col("ESB_TIME").asc_nulls_last(), F.col("NO"), F.col("DATE"), F.col("MODA")])
    out = [F.count(F.lit(1)).alias("SM_COUNT")]
    out += [first_value(f, "_rank").alias(f"SM_FIRST_{f}") for f in fields]
    out += [F.max(F.when(F.col("_rank") == 2, F.col(f))).alias(f"SM_SECOND_{f}") for f in fields]
    out += [last_value(f, "_rank").alias(f"SM_LAST_{f}") for f in fields]
    return rows.groupBy("SM_BAG").agg(*out)


def _two_way(out: DataFrame, back: DataFrame, names: tuple[str, str], key: str) -> DataFrame:
    """First and last events of two feeds as one sequence; out and back have k, NO, DATE, USER, ZONE."""
    fields = ("NO", "DATE", "USER", "ZONE")
    wide = []
    for rows, own in ((out, 0), (back, 1)):
        columns = [F.col("k")]
        for i in (0, 1):
            columns += [(F.col(f) if i == own else F.lit(None).cast(rows.schema[f].dataType)).alias(f"{names[i]}_{f}") for f in fields]
        wide.append(rows.select(*columns, F.lit(own).alias("side")))
    both = wide[0].unionByName(wide[1]).where(F.col("k").isNotNull())
    when = F.coalesce(f"{names[0]}_DATE", f"{names[1]}_DATE")
    rows = ranked(both, "k", [when.asc_nulls_last(), F.col("side"), F.coalesce(f"{names[0]}_NO", f"{names[1]}_NO"), F.coalesce(f"{names[0]}_USER", f"{names[1]}_USER")])
    tag = F.when(F.count_if(F.col("side") == 0).cast("boolean") & F.count_if(F.col("side") == 1).cast("boolean"), "Mixed").otherwise("Incomplete")
    return rows.groupBy(F.col("k").alias(f"{key}_CNOTE_NO")).agg(F.count(F.lit(1)).alias(f"{key}_COUNT"), tag.alias(f"{names[0]}_{names[1]}_TAG"), *firsts_and_lasts({n: fields for n in names}, "_rank"))


def handover_stage(tables: Tables) -> DataFrame:
    sides = []
    for way in ("O", "I"):
        rows = with_master(tables, f"CMS_DH{way}CNOTE", f"CMS_MH{way}CNOTE", (f"DH{way}CNOTE_NO", f"MH{way}CNOTE_NO"))
        m = f"MH{way}CNOTE"
        sides.append(_select(rows, k=f"DH{way}CNOTE_CNOTE_NO", NO=f"{m}_NO", DATE=f"{m}_DATE", USER=f"{m}_USER_ID", ZONE=f"{m}_ZONE"))
    return _two_way(*sides, ("HVO", "HVI"), "HVO")


def transit_stage(tables: Tables, zone: DataFrame) -> DataFrame:
    rows = with_zone(with_master(tables, "CMS_COST_DTRANSIT_AGEN", "CMS_COST_MTRANSIT_AGEN", ("DMANIFEST_NO", "MANIFEST_NO")), zone, "MANIFEST_UID", "ZONE")
    side = lambda test: _select(rows.where(test), k="CNOTE_NO", NO="DMANIFEST_NO", DATE="ESB_TIME", USER="MANIFEST_UID", ZONE="ZONE")
    return _two_way(side("DMANIFEST_DOC_REF IS NULL"), side("DMANIFEST_DOC_REF IS NOT NULL"), ("MTS", "MTI"), "MTS")


def delivery_stage(tables: Tables, zone: DataFrame) -> DataFrame:
    """Delivery attempts and run-sheet handovers; a shipment of either side has a row."""
    rows = with_zone(with_master(tables, "CMS_DRSHEET", "CMS_MRSHEET", ("DRSHEET_NO", "MRSHEET_NO")), zone, "MRSHEET_UID", "ZONE").where("DRSHEET_CNOTE_NO IS NOT NULL")
    rows = _select(rows, k="DRSHEET_CNOTE_NO", DRI_NO="DRSHEET_NO", DRI_DATE="MRSHEET_DATE", DRI_USER="MRSHEET_UID", DRI_ZONE="ZONE", DRI_COURIER_ID="MRSHEET_COURIER_ID", DRI_POD_DATE="DRSHEET_DATE", DRI_POD_STATUS="DRSHEET_STATUS")
    rows = ranked(rows, "k", [F.col("DRI_DATE").asc_nulls_last(), F.col("DRI_NO"), F.col("DRI_POD_DATE"), F.col("DRI_POD_STATUS")])
    attempts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("DRI_ATTEMPT"), *firsts_and_lasts({"DRI": ("NO", "DATE", "USER", "ZONE", "COURIER_ID", "POD_DATE", "POD_STATUS")}, "_rank"))
    rows = with_zone(with_master(tables, "CMS_DHOV_RSHEET", "CMS_MHOV_RSHEET", ("DHOV_RSHEET_NO", "MHOV_RSHEET_NO")), zone, "MHOV_RSHEET_UID", "ZONE").where("DHOV_RSHEET_CNOTE IS NOT NULL")
    rows = _select(rows, h="DHOV_RSHEET_CNOTE", HRS_NO="MHOV_RSHEET_NO", HRS_DATE="MHOV_RSHEET_DATE", HRS_USER="MHOV_RSHEET_UID", HRS_ZONE="ZONE")
    rows = ranked(rows, "h", [F.col("HRS_DATE").asc_nulls_last(), F.col("HRS_NO"), F.col("HRS_USER")])
    handed = rows.groupBy("h").agg(F.count(F.lit(1)).alias("HRS_COUNT"), *firsts_and_lasts({"HRS": ("NO", "DATE", "USER", "ZONE")}, "_rank"))
    tag = F.when(F.col("h").isNotNull() & F.col("k").isNull(), "Incomplete").otherwise("Complete")
    both = attempts.join(handed, F.col("k") == F.col("h"), "full")
    return both.select(F.coalesce("k", "h").alias("DRI_CNOTE_NO"), *(c for c in both.columns if c not in ("k", "h")), tag.alias("HRS_TAG"))


def irregular_stage(tables: Tables) -> DataFrame:
    """The latest irregularity of a shipment and how many it has."""
    rows = with_master(tables, "CMS_DSTATUS", "CMS_MSTATUS", ("DSTATUS_NO", "MSTATUS_NO")).where("DSTATUS_CNOTE_NO IS NOT NULL")
    rows = _select(rows, IRG_CNOTE_NO="DSTATUS_CNOTE_NO", IRG_NO="MSTATUS_NO", IRG_STATUS="DSTATUS_STATUS", IRG_DATE="DSTATUS_STATUS_DATE", IRG_USER="MSTATUS_UID", IRG_ZONE="MSTATUS_ZONE_CODE")
    counted = rows.withColumn("IRG_COUNT", F.count(F.lit(1)).over(Window.partitionBy("IRG_CNOTE_NO")))
    order = [F.col("IRG_DATE").desc_nulls_last(), F.col("IRG_NO").desc(), F.col("IRG_STATUS"), F.col("IRG_USER")]
    return latest(counted, "IRG_CNOTE_NO", order).select("IRG_CNOTE_NO", "IRG_COUNT", "IRG_NO", "IRG_STATUS", "IRG_DATE", "IRG_USER", "IRG_ZONE")


def build_mart(tables: Tables) -> DataFrame:
    """All stages on the anchor; as many rows as the anchor.

    The stages of a shipment come first, so the wide rows stay where the shipment's hash put them. The linehaul hangs
    on the first outbound bag and moves them once, at the end; shipments without a bag are spread by their own number,
    as a null key would put them all in one task.
    """
    zone = zones(tables)
    stages = {
        "RECV_CNOTE_NO": receipt_stage(tables, zone).drop("RECV_SIGN_DATE"), "MF_CNOTE_NO": manifest_stage(tables, zone), "HVO_CNOTE_NO": handover_stage(tables),
        "MTS_CNOTE_NO": transit_stage(tables, zone), "DRI_CNOTE_NO": delivery_stage(tables, zone), "IRG_CNOTE_NO": irregular_stage(tables),
    }
    rows = orders_stage(tables, zone)
    names = [c for c in rows.columns if c != SPREAD]
    haul = linehaul_stage(tables)
    for key, side in stages.items():
        rows = rows.join(side, F.col(SPREAD) == F.col(key), "left")
        names += side.columns + (haul.columns if key == "MF_CNOTE_NO" else [])
    bag = F.coalesce("OM_BAG_NO", F.concat(F.lit("\x00"), F.col(SPREAD)))
    return rows.join(haul, bag == F.col("SM_BAG"), "left").select(*names)
