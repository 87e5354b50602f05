"""DuckDB SQL of the queries over stand-in tables, written on its own: window and CASE forms, no shared code with the plans."""

from __future__ import annotations

_C = "coalesce(CAST({} AS VARCHAR), '')"


def show(x: str) -> str:
    return _C.format(x)


def there(x: str) -> str:
    return f"({x} IS NOT NULL AND trim(CAST({x} AS VARCHAR)) <> '')"


def key(x: str) -> str:
    return f"coalesce(trim(CAST({x} AS VARCHAR)), '')"


def norm(x: str) -> str:
    return f"regexp_replace({key(x)}, '\\.0+$', '')"


def num(x: str) -> str:
    return f"TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE)"


def half_even(x: str) -> str:
    return f"round_even({x}, 0)"


def checks(document: str, failed: str, one: str, two: str, source: str) -> str:
    return f"SELECT {show(document)} AS document_id, CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END AS status, {show(one)} AS variable_1, {show(two)} AS variable_2 FROM {source}"


def ref(table: str, column: str) -> str:
    return f"(SELECT {norm(column)} FROM {table} WHERE {there(column)})"


def zone(user: str, alias: str) -> str:
    return f"LEFT JOIN zone AS {alias} ON trim(CAST({user} AS VARCHAR)) = {alias}.u"


ZONE = """zone AS (SELECT u, arg_min(z, p * 1000 + rank) AS z FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY p, z) AS rank FROM (
  SELECT trim(USER_ID) AS u, trim(USER_ZONE_CODE) AS z, 0 AS p FROM ORA_USER WHERE trim(USER_ID) <> '' AND trim(USER_ZONE_CODE) <> ''
  UNION ALL SELECT trim(COURIER_ID), trim(COURIER_ZONE), 1 FROM LASTMILE_COURIER WHERE trim(COURIER_ID) <> '' AND trim(COURIER_ZONE) <> '')) GROUP BY u)"""

ORDERS = f"""orders_stage AS (SELECT c.CNOTE_NO, coalesce(a.CREATE_DATE, c.CNOTE_CRDATE) AS DB_CRDATE,
  CASE WHEN upper(a.APICUST_SHIPMENT_TYPE) = 'INTERNATIONAL' THEN 'Intl' WHEN c.CNOTE_ORIGIN = c.CNOTE_DESTINATION THEN 'Intracity' WHEN left(c.CNOTE_ORIGIN, 3) = left(c.CNOTE_DESTINATION, 3) THEN 'Intercity' ELSE 'Domestic' END AS SHIPMENT_TYPE,
  c.CNOTE_DATE, c.CNOTE_CRDATE, c.CNOTE_CUST_NO, c.CNOTE_USER, c.CNOTE_ORIGIN, c.CNOTE_DESTINATION, c.CNOTE_SERVICES_CODE, c.CNOTE_WEIGHT, c.CNOTE_AMOUNT, c.CNOTE_CANCEL, z.z AS CNOTE_USER_ZONE, a.CREATE_DATE AS API_DATE,
  a.APICUST_CUST_NO AS API_CUST_ID, a.APICUST_ORIGIN AS API_ORIGIN, a.APICUST_DESTINATION AS API_DESTINATION, a.APICUST_SERVICES_CODE AS API_SERVICES, a.APICUST_SHIPMENT_TYPE AS API_FM_TYPE, a.APICUST_WEIGHT AS API_WEIGHT, t.CREATE_DATE AS API_CANCELED_DATE
  FROM CMS_CNOTE AS c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY APICUST_CNOTE_NO ORDER BY CREATE_DATE DESC NULLS LAST) AS rn FROM CMS_APICUST) AS a ON c.CNOTE_NO = a.APICUST_CNOTE_NO AND a.rn = 1
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY API_CNOTE_NO ORDER BY CREATE_DATE DESC NULLS LAST) AS rn FROM T_CANCEL_CNOTE_API) AS t ON a.APICUST_CNOTE_NO = t.API_CNOTE_NO AND t.rn = 1
  {zone("c.CNOTE_USER", "z")})"""

RECEIPT = f"""receipt_stage AS (SELECT RECV_CNOTE_NO, RECV_NO, RECV_SCAN_DATE, RECV_USER_ID, RECV_ZONE, RECV_DATE FROM (SELECT *, row_number() OVER (PARTITION BY RECV_CNOTE_NO ORDER BY RECV_SCAN_DATE NULLS LAST, p, RECV_NO, RECV_DATE) AS rn FROM (
  SELECT d.DRCNOTE_CNOTE_NO AS RECV_CNOTE_NO, d.DRCNOTE_NO AS RECV_NO, d.DRCNOTE_TDATE AS RECV_SCAN_DATE, m.MRCNOTE_USER_ID AS RECV_USER_ID, z.z AS RECV_ZONE, m.MRCNOTE_DATE AS RECV_DATE, 0 AS p FROM CMS_DRCNOTE AS d LEFT JOIN CMS_MRCNOTE AS m ON d.DRCNOTE_NO = m.MRCNOTE_NO {zone("m.MRCNOTE_USER_ID", "z")}
  UNION ALL SELECT d.DHI_CNOTE_NO, d.DHI_NO, d.CDATE, m.MHI_UID, z.z, m.MHI_DATE, 1 FROM CMS_DHI_HOC AS d LEFT JOIN CMS_MHI_HOC AS m ON d.DHI_NO = m.MHI_NO {zone("m.MHI_UID", "z")}) WHERE RECV_CNOTE_NO IS NOT NULL) WHERE rn = 1)"""


def _pick(prefix: str, code: str, fields: str, last: bool = False) -> str:
    how, scan = ("arg_max", "max") if last else ("arg_min", "min")
    return ", ".join(f"{scan}(SCAN_DATE) FILTER (code = '{code}') AS {prefix}_SCAN_DATE" if f == "SCAN_DATE" else f"{how}({f}, rn) FILTER (code = '{code}' AND SCAN_DATE IS NOT NULL) AS {prefix}_{f}" for f in fields.split())


MANIFEST = f"""manifest_rows AS (SELECT *, row_number() OVER (PARTITION BY MF_CNOTE_NO ORDER BY SCAN_DATE, NO NULLS FIRST, BAG_NO NULLS FIRST) AS rn FROM (
  SELECT f.MFCNOTE_NO AS MF_CNOTE_NO, f.MFCNOTE_MAN_NO AS NO, f.MFCNOTE_BAG_NO AS BAG_NO, f.MFCNOTE_CRDATE AS SCAN_DATE, m.MANIFEST_DATE AS DATE, m.MANIFEST_UID AS "USER", z.z AS ZONE, m.MANIFEST_CODE AS code FROM CMS_MFCNOTE AS f LEFT JOIN CMS_MANIFEST AS m ON f.MFCNOTE_MAN_NO = m.MANIFEST_NO {zone("m.MANIFEST_UID", "z")}) WHERE MF_CNOTE_NO IS NOT NULL),
manifest_stage AS (SELECT m.*, p.* EXCLUDE (k) FROM (SELECT MF_CNOTE_NO, {_pick("OM", "1", 'NO BAG_NO SCAN_DATE DATE "USER" ZONE').replace('_"USER"', "_USER")}, CAST(count(*) FILTER (code = '2') AS BIGINT) AS TM_COUNT, {_pick("TM_FIRST", "2", 'NO SCAN_DATE DATE "USER" ZONE').replace('_"USER"', "_USER")},
  {_pick("TM_LAST", "2", 'NO SCAN_DATE DATE "USER" ZONE', True).replace('_"USER"', "_USER")}, {_pick("IM", "3", 'NO SCAN_DATE DATE "USER" ZONE').replace('_"USER"', "_USER")},
  CASE WHEN count(*) FILTER (code = '1') = 0 THEN 'Null OM' WHEN count(*) FILTER (code = '3') = 0 THEN 'Null OM-IM' ELSE 'Complete' END AS MANIFEST_TAG FROM manifest_rows GROUP BY MF_CNOTE_NO) AS m
  FULL JOIN (SELECT DRSHEET_CNOTE_NO AS k, arg_min(DRSHEET_NO, rn) FILTER (MRSHEET_DATE IS NOT NULL) AS DRI_PRA_NO, min(MRSHEET_DATE) AS DRI_PRA_DATE, arg_min(MRSHEET_UID, rn) FILTER (MRSHEET_DATE IS NOT NULL) AS DRI_PRA_USER, arg_min(z, rn) FILTER (MRSHEET_DATE IS NOT NULL) AS DRI_PRA_ZONE
    FROM (SELECT d.*, m.MRSHEET_DATE, m.MRSHEET_UID, z.z, row_number() OVER (PARTITION BY d.DRSHEET_CNOTE_NO ORDER BY m.MRSHEET_DATE, d.DRSHEET_NO) AS rn FROM CMS_DRSHEET_PRA AS d LEFT JOIN CMS_MRSHEET_PRA AS m ON d.DRSHEET_NO = m.MRSHEET_NO {zone("m.MRSHEET_UID", "z")}) WHERE DRSHEET_CNOTE_NO IS NOT NULL GROUP BY DRSHEET_CNOTE_NO) AS p ON m.MF_CNOTE_NO = p.k)"""

_HAUL = "NO ESB_TIME DATE FLIGHT_DATE WH_DATE OFF_DATE MODA".split()
LINEHAUL = f"""linehaul_stage AS (SELECT SM_BAG, count(*) AS SM_COUNT, {", ".join(f"arg_min({f}, rn) AS SM_FIRST_{f}" for f in _HAUL)}, {", ".join(f"max({f}) FILTER (rn = 2) AS SM_SECOND_{f}" for f in _HAUL)}, {", ".join(f"arg_max({f}, rn) AS SM_LAST_{f}" for f in _HAUL)} FROM (
  SELECT d.DSMU_BAG_NO AS SM_BAG, m.MSMU_NO AS NO, d.ESB_TIME, m.MSMU_DATE AS DATE, m.MSMU_FLIGHT_DATE AS FLIGHT_DATE, m.MSMU_WRH_DATE AS WH_DATE, m.MSMU_OFF_DATE AS OFF_DATE, m.MSMU_MODA AS MODA, row_number() OVER (PARTITION BY d.DSMU_BAG_NO ORDER BY d.ESB_TIME NULLS LAST, m.MSMU_NO NULLS FIRST) AS rn
  FROM CMS_DSMU AS d LEFT JOIN CMS_MSMU AS m ON d.DSMU_NO = m.MSMU_NO WHERE d.DSMU_BAG_NO IS NOT NULL AND d.DSMU_NO IS NOT NULL) GROUP BY SM_BAG)"""


def _two_way(name: str, key_: str, one: str, two: str, rows: str) -> str:
    fields = [(f"{x}_{f}", f"{x}_{w}_{f}", how) for w, how in (("FIRST", "arg_min"), ("LAST", "arg_max")) for x in (one, two) for f in ("NO", "DATE", "USER", "ZONE")]
    return f"""{name} AS (SELECT k AS {key_}_CNOTE_NO, count(*) AS {key_}_COUNT, CASE WHEN count(*) FILTER (side = 0) > 0 AND count(*) FILTER (side = 1) > 0 THEN 'Mixed' ELSE 'Incomplete' END AS {one}_{two}_TAG, {", ".join(f"{how}({a}, rn) AS {b}" for a, b, how in fields)}
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY coalesce({one}_DATE, {two}_DATE) NULLS LAST, side, coalesce({one}_NO, {two}_NO) NULLS FIRST) AS rn FROM ({rows}) WHERE k IS NOT NULL) GROUP BY k)"""


def _side(side: int, one: str, two: str, key_: str, no: str, date: str, user: str, zone_: str, source: str) -> str:
    own, other = (one, two) if side == 0 else (two, one)
    return f"SELECT {key_} AS k, {no} AS {own}_NO, {date} AS {own}_DATE, {user} AS {own}_USER, {zone_} AS {own}_ZONE, NULL AS {other}_NO, NULL AS {other}_DATE, NULL AS {other}_USER, NULL AS {other}_ZONE, {side} AS side FROM {source}"


HANDOVER = _two_way(
    "handover_stage", "HVO", "HVO", "HVI",
    _side(0, "HVO", "HVI", "d.DHOCNOTE_CNOTE_NO", "m.MHOCNOTE_NO", "m.MHOCNOTE_DATE", "m.MHOCNOTE_USER_ID", "m.MHOCNOTE_ZONE", "CMS_DHOCNOTE AS d LEFT JOIN CMS_MHOCNOTE AS m ON d.DHOCNOTE_NO = m.MHOCNOTE_NO")
    + " UNION ALL BY NAME " + _side(1, "HVO", "HVI", "d.DHICNOTE_CNOTE_NO", "m.MHICNOTE_NO", "m.MHICNOTE_DATE", "m.MHICNOTE_USER_ID", "m.MHICNOTE_ZONE", "CMS_DHICNOTE AS d LEFT JOIN CMS_MHICNOTE AS m ON d.DHICNOTE_NO = m.MHICNOTE_NO"),
)
_AGENT = f"CMS_COST_DTRANSIT_AGEN AS d LEFT JOIN CMS_COST_MTRANSIT_AGEN AS m ON d.DMANIFEST_NO = m.MANIFEST_NO {zone('m.MANIFEST_UID', 'z')} WHERE d.DMANIFEST_DOC_REF IS"
TRANSIT = _two_way(
    "transit_stage", "MTS", "MTS", "MTI",
    _side(0, "MTS", "MTI", "d.CNOTE_NO", "d.DMANIFEST_NO", "d.ESB_TIME", "m.MANIFEST_UID", "z.z", f"{_AGENT} NULL")
    + " UNION ALL BY NAME " + _side(1, "MTS", "MTI", "d.CNOTE_NO", "d.DMANIFEST_NO", "d.ESB_TIME", "m.MANIFEST_UID", "z.z", f"{_AGENT} NOT NULL"),
)


def _ends(prefix: str, fields: str) -> str:
    return ", ".join(f"{how}({prefix}_{f}, rn) AS {prefix}_{w}_{f}" for w, how in (("FIRST", "arg_min"), ("LAST", "arg_max")) for f in fields.split())


DELIVERY = f"""delivery_stage AS (SELECT coalesce(d.k, h.k) AS DRI_CNOTE_NO, d.* EXCLUDE (k), h.* EXCLUDE (k), CASE WHEN h.k IS NOT NULL AND d.k IS NULL THEN 'Incomplete' ELSE 'Complete' END AS HRS_TAG FROM
  (SELECT k, count(*) AS DRI_ATTEMPT, {_ends("DRI", "NO DATE USER ZONE COURIER_ID POD_DATE POD_STATUS")} FROM (SELECT d.DRSHEET_CNOTE_NO AS k, d.DRSHEET_NO AS DRI_NO, m.MRSHEET_DATE AS DRI_DATE, m.MRSHEET_UID AS DRI_USER, z.z AS DRI_ZONE, m.MRSHEET_COURIER_ID AS DRI_COURIER_ID, d.DRSHEET_DATE AS DRI_POD_DATE, d.DRSHEET_STATUS AS DRI_POD_STATUS,
    row_number() OVER (PARTITION BY d.DRSHEET_CNOTE_NO ORDER BY m.MRSHEET_DATE NULLS LAST, d.DRSHEET_NO, d.DRSHEET_DATE, d.DRSHEET_STATUS) AS rn FROM CMS_DRSHEET AS d LEFT JOIN CMS_MRSHEET AS m ON d.DRSHEET_NO = m.MRSHEET_NO {zone("m.MRSHEET_UID", "z")} WHERE d.DRSHEET_CNOTE_NO IS NOT NULL) GROUP BY k) AS d
  FULL JOIN (SELECT k, count(*) AS HRS_COUNT, {_ends("HRS", "NO DATE USER ZONE")} FROM (SELECT d.DHOV_RSHEET_CNOTE AS k, m.MHOV_RSHEET_NO AS HRS_NO, m.MHOV_RSHEET_DATE AS HRS_DATE, m.MHOV_RSHEET_UID AS HRS_USER, z.z AS HRS_ZONE,
    row_number() OVER (PARTITION BY d.DHOV_RSHEET_CNOTE ORDER BY m.MHOV_RSHEET_DATE NULLS LAST, m.MHOV_RSHEET_NO NULLS FIRST) AS rn FROM CMS_DHOV_RSHEET AS d LEFT JOIN CMS_MHOV_RSHEET AS m ON d.DHOV_RSHEET_NO = m.MHOV_RSHEET_NO {zone("m.MHOV_RSHEET_UID", "z")} WHERE d.DHOV_RSHEET_CNOTE IS NOT NULL) GROUP BY k) AS h ON d.k = h.k)"""

IRREGULAR = """irregular_stage AS (SELECT IRG_CNOTE_NO, IRG_COUNT, IRG_NO, IRG_STATUS, IRG_DATE, IRG_USER, IRG_ZONE FROM (SELECT d.DSTATUS_CNOTE_NO AS IRG_CNOTE_NO, m.MSTATUS_NO AS IRG_NO, d.DSTATUS_STATUS AS IRG_STATUS, d.DSTATUS_STATUS_DATE AS IRG_DATE, m.MSTATUS_UID AS IRG_USER, m.MSTATUS_ZONE_CODE AS IRG_ZONE, count(*) OVER (PARTITION BY d.DSTATUS_CNOTE_NO) AS IRG_COUNT,
  row_number() OVER (PARTITION BY d.DSTATUS_CNOTE_NO ORDER BY d.DSTATUS_STATUS_DATE DESC NULLS LAST, m.MSTATUS_NO DESC NULLS LAST, d.DSTATUS_STATUS, m.MSTATUS_UID) AS rn FROM CMS_DSTATUS AS d LEFT JOIN CMS_MSTATUS AS m ON d.DSTATUS_NO = m.MSTATUS_NO WHERE d.DSTATUS_CNOTE_NO IS NOT NULL) WHERE rn = 1)"""

STAGES = {"orders_stage": ORDERS, "receipt_stage": RECEIPT, "manifest_stage": MANIFEST, "linehaul_stage": LINEHAUL, "handover_stage": HANDOVER, "transit_stage": TRANSIT, "delivery_stage": DELIVERY, "irregular_stage": IRREGULAR}


def stage(name: str) -> str:
    return f"WITH {ZONE}, {STAGES[name]} SELECT * FROM {name}"


MART = f"""WITH {ZONE}, {", ".join(STAGES.values())} SELECT o.*, r.*, m.*, s.*, h.*, t.*, d.*, i.* FROM orders_stage AS o LEFT JOIN receipt_stage AS r ON o.CNOTE_NO = r.RECV_CNOTE_NO LEFT JOIN manifest_stage AS m ON o.CNOTE_NO = m.MF_CNOTE_NO
  LEFT JOIN linehaul_stage AS s ON m.OM_BAG_NO = s.SM_BAG LEFT JOIN handover_stage AS h ON o.CNOTE_NO = h.HVO_CNOTE_NO LEFT JOIN transit_stage AS t ON o.CNOTE_NO = t.MTS_CNOTE_NO LEFT JOIN delivery_stage AS d ON o.CNOTE_NO = d.DRI_CNOTE_NO LEFT JOIN irregular_stage AS i ON o.CNOTE_NO = i.IRG_CNOTE_NO"""


def _first(detail: str, shipment: str, date: str, join: str = "") -> str:
    return f"(SELECT {shipment} AS k, min(TRY_CAST({date} AS TIMESTAMP)) AS t FROM {detail} {join} WHERE {shipment} IS NOT NULL GROUP BY {shipment})"


def _hours(a: str, b: str) -> str:
    return f"(epoch({b}) - epoch({a})) / 3600.0"


_O, _D = ("regexp_extract(upper(trim(c.CNOTE_{})), '^([A-Z]{{{{3}}}})', 1)".format(x).replace("{{", "{").replace("}}", "}") for x in ("ORIGIN", "DESTINATION"))
_P, _Q = ("regexp_extract(upper(trim(c.CNOTE_{})), '^[A-Z]{{{{3}}}}([0-9])', 1)".format(x).replace("{{", "{").replace("}}", "}") for x in ("ORIGIN", "DESTINATION"))
SPINE = f"""WITH j AS (SELECT c.*, l.n AS legs, p.t AS p, h.t AS h, coalesce(p.t, h.t) AS r, b.t AS b, i.t AS i, o.t AS o, m.t AS m, s.t AS s, v.t AS v,
  CASE WHEN {_O} = '' OR {_D} = '' OR {_P} = '' OR {_Q} = '' THEN 'Unknown' WHEN {_O} = {_D} AND {_P} = {_Q} THEN 'Intracity' WHEN {_O} = {_D} THEN 'Intercity' ELSE 'Domestic' END AS sc FROM CMS_CNOTE AS c
  LEFT JOIN (SELECT MFCNOTE_NO AS k, count(*) AS n FROM CMS_MFCNOTE JOIN CMS_MANIFEST ON MFCNOTE_MAN_NO = MANIFEST_NO WHERE TRY_CAST(MANIFEST_CODE AS INTEGER) = 3 GROUP BY MFCNOTE_NO) AS l ON c.CNOTE_NO = l.k
  LEFT JOIN {_first("CMS_DRCNOTE", "DRCNOTE_CNOTE_NO", "MRCNOTE_DATE", "JOIN CMS_MRCNOTE ON DRCNOTE_NO = MRCNOTE_NO")} AS p ON c.CNOTE_NO = p.k LEFT JOIN {_first("CMS_DHI_HOC", "DHI_CNOTE_NO", "MHI_APPROVE_DATE", "JOIN CMS_MHI_HOC ON DHI_NO = MHI_NO")} AS h ON c.CNOTE_NO = h.k
  LEFT JOIN {_first("CMS_MFCNOTE", "MFCNOTE_NO", "MFBAG_CRDATE", "JOIN CMS_MFBAG ON MFCNOTE_BAG_NO = MFBAG_NO")} AS b ON c.CNOTE_NO = b.k LEFT JOIN {_first("CMS_DHICNOTE", "DHICNOTE_CNOTE_NO", "DHICNOTE_TDATE")} AS i ON c.CNOTE_NO = i.k LEFT JOIN {_first("CMS_DHOCNOTE", "DHOCNOTE_CNOTE_NO", "DHOCNOTE_TDATE")} AS o ON c.CNOTE_NO = o.k
  LEFT JOIN {_first("CMS_DHOCNOTE", "DHOCNOTE_CNOTE_NO", "MHOCNOTE_DATE", "JOIN CMS_MHOCNOTE ON DHOCNOTE_NO = MHOCNOTE_NO")} AS m ON c.CNOTE_NO = m.k LEFT JOIN {_first("CMS_DRSHEET", "DRSHEET_CNOTE_NO", "MRSHEET_DATE", "JOIN CMS_MRSHEET ON DRSHEET_NO = MRSHEET_NO")} AS s ON c.CNOTE_NO = s.k LEFT JOIN {_first("CMS_CNOTE_POD", "CNOTE_POD_NO", "CNOTE_POD_DATE")} AS v ON c.CNOTE_NO = v.k),
k AS (SELECT * EXCLUDE (legs, p, h, r, b, i, o, m, s, v, sc), CNOTE_CRDATE AS cms_cnote_create_date, p AS cms_mrcnote_create_date, h AS cms_mhi_hoc_approve_date, r AS cms_receival_create_date, b AS cms_mfbag_create_date, m AS cms_mhocnote_create_date, s AS cms_mrsheet_create_date, v AS cms_cnote_pod_create_date,
  CASE WHEN legs IS NULL THEN 'Direct' ELSE 'Transit' END AS delivery_type, sc AS shipment_scope, coalesce(legs, 0) AS transit_manifest_count, coalesce(legs, 0) + (r IS NOT NULL)::BIGINT + (i IS NOT NULL)::BIGINT + (o IS NOT NULL)::BIGINT + (s IS NOT NULL)::BIGINT AS handover_count,
  {_hours("r", "v")} AS sla_total_hours, {_hours("CNOTE_CRDATE", "r")} AS total_duration_hour_to_receival, {_hours("r", "b")} AS total_duration_hour_to_manifest, {_hours("coalesce(b, r)", "m")} AS total_duration_hour_to_handover, {_hours("coalesce(m, b, r)", "s")} AS total_duration_hour_to_runsheet, {_hours("s", "v")} AS total_duration_hour_to_delivery FROM j)
SELECT *, CASE WHEN shipment_scope = 'Domestic' THEN delivery_type || ' Domestic' ELSE shipment_scope END AS delivery_category FROM k"""

#: The links of documents to shipments, one SELECT a path.
LINKS = """WITH l AS (
  SELECT 'MFCNOTE' AS document_type, 'CMS_MFCNOTE' AS source_table, trim(t0.MFCNOTE_NO) AS document_id, trim(t0.MFCNOTE_NO) AS cnote_no, 'cms_mfcnote_bridge' AS link_method FROM CMS_MFCNOTE AS t0 WHERE trim(t0.MFCNOTE_NO) <> '' AND trim(t0.MFCNOTE_NO) <> ''
  UNION SELECT 'MFBAG' AS document_type, 'CMS_MFBAG' AS source_table, trim(t0.MFCNOTE_BAG_NO) AS document_id, trim(t0.MFCNOTE_NO) AS cnote_no, 'cms_mfbag_bridge' AS link_method FROM CMS_MFCNOTE AS t0 WHERE trim(t0.MFCNOTE_BAG_NO) <> '' AND trim(t0.MFCNOTE_NO) <> ''
  UNION SELECT 'DMBAG' AS document_type, 'CMS_DMBAG' AS source_table, trim(t0.MFCNOTE_BAG_NO) AS document_id, trim(t0.MFCNOTE_NO) AS cnote_no, 'cms_dmbag_bridge' AS link_method FROM CMS_MFCNOTE AS t0 WHERE trim(t0.MFCNOTE_BAG_NO) <> '' AND trim(t0.MFCNOTE_NO) <> ''
  UNION SELECT 'MANIFEST' AS document_type, 'CMS_MANIFEST' AS source_table, trim(t0.MFCNOTE_MAN_NO) AS document_id, trim(t0.MFCNOTE_NO) AS cnote_no, 'cms_manifest_bridge' AS link_method FROM CMS_MFCNOTE AS t0 WHERE trim(t0.MFCNOTE_MAN_NO) <> '' AND trim(t0.MFCNOTE_NO) <> ''
  UNION SELECT 'DMBAG' AS document_type, 'CMS_DMBAG' AS source_table, trim(t0.DMBAG_NO) AS document_id, trim(t1.MFCNOTE_NO) AS cnote_no, 'cms_dmbag_bridge' AS link_method FROM CMS_DMBAG AS t0 JOIN CMS_MFCNOTE AS t1 ON trim(t0.DMBAG_BAG_NO) = trim(t1.MFCNOTE_BAG_NO) AND trim(t1.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.DMBAG_NO) <> '' AND trim(t1.MFCNOTE_NO) <> ''
  UNION SELECT 'MMBAG' AS document_type, 'CMS_MMBAG' AS source_table, trim(t0.MMBAG_NO) AS document_id, trim(t1.MFCNOTE_NO) AS cnote_no, 'cms_mmbag_bridge' AS link_method FROM CMS_MMBAG AS t0 JOIN CMS_MFCNOTE AS t1 ON trim(t0.MMBAG_NO) = trim(t1.MFCNOTE_BAG_NO) AND trim(t1.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.MMBAG_NO) <> '' AND trim(t1.MFCNOTE_NO) <> ''
  UNION SELECT 'MMBAG' AS document_type, 'CMS_MMBAG' AS source_table, trim(t0.MMBAG_NO) AS document_id, trim(t2.MFCNOTE_NO) AS cnote_no, 'cms_mmbag_bridge' AS link_method FROM CMS_MMBAG AS t0 JOIN CMS_DMBAG AS t1 ON trim(t0.MMBAG_NO) = trim(t1.DMBAG_NO) AND trim(t1.DMBAG_NO) <> '' JOIN CMS_MFCNOTE AS t2 ON trim(t1.DMBAG_BAG_NO) = trim(t2.MFCNOTE_BAG_NO) AND trim(t2.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.MMBAG_NO) <> '' AND trim(t2.MFCNOTE_NO) <> ''
  UNION SELECT 'MRSHEET' AS document_type, 'CMS_MRSHEET' AS source_table, trim(t0.DRSHEET_NO) AS document_id, trim(t0.DRSHEET_CNOTE_NO) AS cnote_no, 'cms_mrsheet_bridge' AS link_method FROM CMS_DRSHEET AS t0 WHERE trim(t0.DRSHEET_NO) <> '' AND trim(t0.DRSHEET_CNOTE_NO) <> ''
  UNION SELECT 'MHICNOTE' AS document_type, 'CMS_MHICNOTE' AS source_table, trim(t0.DHICNOTE_NO) AS document_id, trim(t0.DHICNOTE_CNOTE_NO) AS cnote_no, 'cms_mhicnote_bridge' AS link_method FROM CMS_DHICNOTE AS t0 WHERE trim(t0.DHICNOTE_NO) <> '' AND trim(t0.DHICNOTE_CNOTE_NO) <> ''
  UNION SELECT 'MHI_HOC' AS document_type, 'CMS_MHI_HOC' AS source_table, trim(t0.DHI_NO) AS document_id, trim(t0.DHI_CNOTE_NO) AS cnote_no, 'cms_mhi_hoc_bridge' AS link_method FROM CMS_DHI_HOC AS t0 WHERE trim(t0.DHI_NO) <> '' AND trim(t0.DHI_CNOTE_NO) <> ''
  UNION SELECT 'MHOCNOTE' AS document_type, 'CMS_MHOCNOTE' AS source_table, trim(t0.DHOCNOTE_NO) AS document_id, trim(t0.DHOCNOTE_CNOTE_NO) AS cnote_no, 'cms_mhocnote_bridge' AS link_method FROM CMS_DHOCNOTE AS t0 WHERE trim(t0.DHOCNOTE_NO) <> '' AND trim(t0.DHOCNOTE_CNOTE_NO) <> ''
  UNION SELECT 'MHOUNDEL_POD' AS document_type, 'CMS_MHOUNDEL_POD' AS source_table, trim(t0.DHOUNDEL_NO) AS document_id, trim(t0.DHOUNDEL_CNOTE_NO) AS cnote_no, 'cms_mhoundel_pod_bridge' AS link_method FROM CMS_DHOUNDEL_POD AS t0 WHERE trim(t0.DHOUNDEL_NO) <> '' AND trim(t0.DHOUNDEL_CNOTE_NO) <> ''
  UNION SELECT 'DSMU' AS document_type, 'CMS_DSMU' AS source_table, trim(t0.DSMU_NO) AS document_id, trim(t1.MFCNOTE_NO) AS cnote_no, 'cms_dsmu_bridge' AS link_method FROM CMS_DSMU AS t0 JOIN CMS_MFCNOTE AS t1 ON trim(t0.DSMU_BAG_NO) = trim(t1.MFCNOTE_BAG_NO) AND trim(t1.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.DSMU_NO) <> '' AND trim(t1.MFCNOTE_NO) <> ''
  UNION SELECT 'DSMU' AS document_type, 'CMS_DSMU' AS source_table, trim(t0.DSMU_NO) AS document_id, trim(t2.MFCNOTE_NO) AS cnote_no, 'cms_dsmu_bridge' AS link_method FROM CMS_DSMU AS t0 JOIN CMS_DMBAG AS t1 ON trim(t0.DSMU_BAG_NO) = trim(t1.DMBAG_NO) AND trim(t1.DMBAG_NO) <> '' JOIN CMS_MFCNOTE AS t2 ON trim(t1.DMBAG_BAG_NO) = trim(t2.MFCNOTE_BAG_NO) AND trim(t2.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.DSMU_NO) <> '' AND trim(t2.MFCNOTE_NO) <> ''
  UNION SELECT 'MSMU' AS document_type, 'CMS_MSMU' AS source_table, trim(t0.MSMU_NO) AS document_id, trim(t2.MFCNOTE_NO) AS cnote_no, 'cms_msmu_bridge' AS link_method FROM CMS_MSMU AS t0 JOIN CMS_DSMU AS t1 ON trim(t0.MSMU_NO) = trim(t1.DSMU_NO) AND trim(t1.DSMU_NO) <> '' JOIN CMS_MFCNOTE AS t2 ON trim(t1.DSMU_BAG_NO) = trim(t2.MFCNOTE_BAG_NO) AND trim(t2.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.MSMU_NO) <> '' AND trim(t2.MFCNOTE_NO) <> ''
  UNION SELECT 'MSMU' AS document_type, 'CMS_MSMU' AS source_table, trim(t0.MSMU_NO) AS document_id, trim(t3.MFCNOTE_NO) AS cnote_no, 'cms_msmu_bridge' AS link_method FROM CMS_MSMU AS t0 JOIN CMS_DSMU AS t1 ON trim(t0.MSMU_NO) = trim(t1.DSMU_NO) AND trim(t1.DSMU_NO) <> '' JOIN CMS_DMBAG AS t2 ON trim(t1.DSMU_BAG_NO) = trim(t2.DMBAG_NO) AND trim(t2.DMBAG_NO) <> '' JOIN CMS_MFCNOTE AS t3 ON trim(t2.DMBAG_BAG_NO) = trim(t3.MFCNOTE_BAG_NO) AND trim(t3.MFCNOTE_BAG_NO) <> '' WHERE trim(t0.MSMU_NO) <> '' AND trim(t3.MFCNOTE_NO) <> ''
  UNION SELECT 'DSJ' AS document_type, 'CMS_DSJ' AS source_table, trim(t0.DSJ_NO) AS document_id, trim(t2.DHICNOTE_CNOTE_NO) AS cnote_no, 'cms_dsj_bridge' AS link_method FROM CMS_DSJ AS t0 JOIN CMS_RDSJ AS t1 ON trim(t0.DSJ_HVO_NO) = trim(t1.RDSJ_HVO_NO) AND trim(t1.RDSJ_HVO_NO) <> '' JOIN CMS_DHICNOTE AS t2 ON trim(t1.RDSJ_HVI_NO) = trim(t2.DHICNOTE_NO) AND trim(t2.DHICNOTE_NO) <> '' WHERE trim(t0.DSJ_NO) <> '' AND trim(t2.DHICNOTE_CNOTE_NO) <> ''
  UNION SELECT 'RDSJ' AS document_type, 'CMS_RDSJ' AS source_table, trim(t0.RDSJ_NO) AS document_id, trim(t1.DHOCNOTE_CNOTE_NO) AS cnote_no, 'cms_rdsj_bridge' AS link_method FROM CMS_RDSJ AS t0 JOIN CMS_DHOCNOTE AS t1 ON trim(t0.RDSJ_HVO_NO) = trim(t1.DHOCNOTE_NO) AND trim(t1.DHOCNOTE_NO) <> '' WHERE trim(t0.RDSJ_NO) <> '' AND trim(t1.DHOCNOTE_CNOTE_NO) <> ''
  UNION SELECT 'MSJ' AS document_type, 'CMS_MSJ' AS source_table, trim(t0.MSJ_NO) AS document_id, trim(t3.DHICNOTE_CNOTE_NO) AS cnote_no, 'cms_msj_bridge' AS link_method FROM CMS_MSJ AS t0 JOIN CMS_DSJ AS t1 ON trim(t0.MSJ_NO) = trim(t1.DSJ_NO) AND trim(t1.DSJ_NO) <> '' JOIN CMS_RDSJ AS t2 ON trim(t1.DSJ_HVO_NO) = trim(t2.RDSJ_HVO_NO) AND trim(t2.RDSJ_HVO_NO) <> '' JOIN CMS_DHICNOTE AS t3 ON trim(t2.RDSJ_HVI_NO) = trim(t3.DHICNOTE_NO) AND trim(t3.DHICNOTE_NO) <> '' WHERE trim(t0.MSJ_NO) <> '' AND trim(t3.DHICNOTE_CNOTE_NO) <> ''
) SELECT l.* FROM l SEMI JOIN CMS_CNOTE AS c ON l.cnote_no = trim(c.CNOTE_NO)"""
