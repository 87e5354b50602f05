"""The rule catalog of the shipment tables: 493 rules, made from what is declared for each table.

A code names the kind of check, the table's letters and the column's number: COMP1B12 is the first completeness check
of column 12 of table B. COLUMNS declares, for each table, the checks of single columns by kind and number; RULES has
all others with their parameters. Elements, indicators and descriptions follow from a rule's kind and columns; issues
and impacts are in texts.py, and other texts can be given to load() by code.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from .families import RuleSpec
from .texts import NONE, TEXTS, indicator_of


@dataclass(frozen=True)
class Columns:
    """A table's checks of single columns. checks: by kind, then number, the column and what it is held against.

    A text is a column; matches(column, pattern), within(column, reference) and together(columns...) say more.
    """

    table: str
    letters: str
    document: str
    checks: dict[str, dict[int, Any]]


def matches(column: str, pattern: str) -> dict[str, Any]:
    return {"family": "validity_regex", "column": column, "pattern": pattern}


def within(column: str, reference: str) -> dict[str, Any]:
    return {"family": "reference_format", "column": column, **REFERENCES[reference]}


def together(*columns: str) -> dict[str, Any]:
    return {"family": "uniqueness", "columns": list(columns)}


def join(table: str, left_on: str, right_on: str) -> dict[str, str]:
    return {"table": table, "left_on": left_on, "right_on": right_on}


def rule(code: str, family: str, table: str, **params: Any) -> tuple[str, str, str, dict[str, Any]]:
    return code, family, table, params


#: Families of the kinds whose checks are a column alone, elements of codes, and references.
KINDS = {"COMP1": "completeness", "COMP2": "completeness", "VALD2": "validity_integer", "VALD3": "validity_integer", "VALD4": "validity_datetime", "UNIQ1": "uniqueness", "UNIQ2": "uniqueness"}
ELEMENTS = {"COMP": "Completeness", "VALD": "Validity", "UNIQ": "Uniqueness", "CONS": "Consistency", "TIME": "Timeliness", "ACCU": "Accuracy", "INTG": "Integrity"}
REFERENCES = {
    "route": {"reference_table": "CMS_DROURATE", "reference_column": "DROURATE_CODE"},
    "origin": {"reference_table": "CMS_DROURATE", "reference_column": "DROURATE_CODE", "reference_component": "origin"},
    "destination": {"reference_table": "CMS_DROURATE", "reference_column": "DROURATE_CODE", "reference_component": "destination"},
    "service": {"reference_table": "CMS_DROURATE", "reference_column": "DROURATE_SERVICE"},
    "branch": {"reference_table": "ORA_BRANCH", "reference_column": "BRANCH_CODE"},
    "zone": {"reference_table": "ORA_ZONE", "reference_column": "ZONE_CODE"},
}

#: The checks of each table's columns.
COLUMNS = (
    Columns(
        "CMS_APICUST", "A", "APICUST_CNOTE_NO",
        {
            "COMP1": {
                1: "APICUST_ORDER_ID",
                2: "APICUST_CNOTE_NO",
                3: "APICUST_ORIGIN",
                4: "APICUST_BRANCH",
                5: "APICUST_CUST_NO",
                6: "APICUST_SERVICES_CODE",
                7: "APICUST_DESTINATION",
                24: "APICUST_QTY",
                25: "APICUST_WEIGHT",
            },
            "VALD1": {
                3: within("APICUST_ORIGIN", "origin"),
                4: within("APICUST_BRANCH", "branch"),
                6: within("APICUST_SERVICES_CODE", "service"),
                7: within("APICUST_DESTINATION", "destination"),
            },
            "VALD2": {
                25: "APICUST_WEIGHT",
                26: "APICUST_GOODS_VALUE",
            },
            "VALD3": {
                24: "APICUST_QTY",
                29: "APICUST_COD_AMOUNT",
            },
            "VALD4": {
                30: "CREATE_DATE",
            },
            "VALD9": {
                11: matches("APICUST_SHIPPER_ZIP", r"^\d{5}$"),
                19: matches("APICUST_RECEIVER_ZIP", r"^\d{5}$"),
            },
            "VALD12": {
                4: within("APICUST_BRANCH", "branch"),
            },
            "UNIQ1": {
                2: together("APICUST_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_CNOTE", "B", "CNOTE_NO",
        {
            "COMP1": {
                1: "CNOTE_NO",
                2: "CNOTE_DATE",
                3: "CNOTE_BRANCH_ID",
                6: "CNOTE_SERVICES_CODE",
                10: "CNOTE_CUST_NO",
                11: "CNOTE_ROUTE_CODE",
                12: "CNOTE_ORIGIN",
                13: "CNOTE_DESTINATION",
                14: "CNOTE_QTY",
                15: "CNOTE_WEIGHT",
                17: "CNOTE_SHIPPER_NAME",
                18: "CNOTE_SHIPPER_ADDR1",
                66: "CNOTE_USER",
                99: "CNOTE_CRDATE",
            },
            "VALD1": {
                6: matches("CNOTE_SERVICES_CODE", r"^[A-Z0-9]{2,5}$"),
                11: within("CNOTE_ROUTE_CODE", "route"),
                12: within("CNOTE_ORIGIN", "origin"),
                13: within("CNOTE_DESTINATION", "destination"),
            },
            "VALD2": {
                15: "CNOTE_WEIGHT",
            },
            "VALD3": {
                14: "CNOTE_QTY",
            },
            "VALD4": {
                2: "CNOTE_DATE",
                99: "CNOTE_CRDATE",
            },
            "VALD5": {
                48: matches("CNOTE_GOODS_TYPE", r"^[12]$"),
            },
            "VALD12": {
                3: within("CNOTE_BRANCH_ID", "branch"),
            },
            "UNIQ1": {
                1: together("CNOTE_NO"),
                74: together("CNOTE_REFNO"),
            },
        },
    ),
    Columns(
        "CMS_CNOTE_POD", "R", "CNOTE_POD_NO",
        {
            "COMP1": {
                1: "CNOTE_POD_NO",
                2: "CNOTE_POD_DATE",
                4: "CNOTE_POD_STATUS",
                5: "CNOTE_POD_DELIVERED",
                6: "CNOTE_POD_DOC_NO",
                7: "CNOTE_POD_CREATION_DATE",
            },
            "VALD4": {
                2: "CNOTE_POD_DATE",
                7: "CNOTE_POD_CREATION_DATE",
            },
            "VALD8": {
                5: matches("CNOTE_POD_DELIVERED", r"^Y$"),
            },
            "VALD11": {
                4: matches("CNOTE_POD_STATUS", r"^[DU]\d+$"),
            },
            "UNIQ1": {
                1: together("CNOTE_POD_NO"),
            },
            "UNIQ2": {
                1: together("CNOTE_POD_NO", "CNOTE_POD_DOC_NO"),
            },
        },
    ),
    Columns(
        "CMS_COST_DTRANSIT_AGEN", "Y", "COST_D_CNOTE_NO",
        {
            "COMP1": {
                1: "DMANIFEST_NO",
                2: "CNOTE_NO",
                3: "CNOTE_ORIGIN",
                4: "CNOTE_DESTINATION",
                5: "CNOTE_QTY",
                6: "CNOTE_WEIGHT",
                8: "CNOTE_SERVICES_CODE",
                9: "ESB_TIME",
                10: "ESB_ID",
            },
            "VALD1": {
                3: within("CNOTE_ORIGIN", "origin"),
                4: within("CNOTE_DESTINATION", "destination"),
                6: within("CNOTE_SERVICES_CODE", "service"),
            },
            "VALD2": {
                15: "CNOTE_WEIGHT",
            },
            "VALD3": {
                14: "CNOTE_QTY",
            },
            "VALD4": {
                9: "ESB_TIME",
            },
            "UNIQ1": {
                2: together("CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_COST_MTRANSIT_AGEN", "X", "COST_M_MANIFEST_NO",
        {
            "COMP1": {
                1: "MANIFEST_NO",
                2: "MANIFEST_DATE",
                3: "BRANCH_ID",
                4: "DESTINATION",
                5: "CTC_WEIGHT",
                6: "ACT_WEIGHT",
                11: "MANIFEST_UID",
                12: "ESB_TIME",
                13: "ESB_ID",
            },
            "VALD1": {
                4: within("DESTINATION", "destination"),
            },
            "VALD2": {
                5: "CTC_WEIGHT",
                6: "ACT_WEIGHT",
            },
            "VALD4": {
                3: "MANIFEST_DATE",
                12: "ESB_TIME",
            },
            "VALD8": {
                8: matches("MANIFEST_APPROVED", r"^Y$"),
            },
            "VALD12": {
                3: within("BRANCH_ID", "branch"),
            },
            "UNIQ1": {
                1: together("MANIFEST_NO"),
            },
        },
    ),
    Columns(
        "CMS_DBAG_HO", "AE", "DBAG_CNOTE_NO",
        {
            "COMP1": {
                1: "DBAG_HO_NO",
                2: "DBAG_NO",
                3: "DBAG_CNOTE_NO",
                4: "DBAG_CNOTE_QTY",
                5: "DBAG_CNOTE_WEIGHT",
                6: "DBAG_CNOTE_DESTINATION",
                7: "CDATE",
                8: "DBAG_CNOTE_SERVICE",
                9: "DBAG_CNOTE_DATE",
                10: "DBAG_ZONE_DEST",
            },
            "VALD1": {
                6: within("DBAG_CNOTE_DESTINATION", "destination"),
                8: within("DBAG_CNOTE_SERVICE", "service"),
            },
            "VALD2": {
                5: "DBAG_CNOTE_WEIGHT",
            },
            "VALD3": {
                4: "DBAG_CNOTE_QTY",
            },
            "VALD4": {
                7: "CDATE",
                9: "DBAG_CNOTE_DATE",
            },
            "VALD13": {
                10: within("DBAG_ZONE_DEST", "zone"),
            },
            "UNIQ2": {
                1: together("DBAG_HO_NO", "DBAG_NO", "DBAG_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DHICNOTE", "AC", "DHICNOTE_CNOTE_NO",
        {
            "COMP1": {
                1: "DHICNOTE_NO",
                3: "DHICNOTE_CNOTE_NO",
                4: "DHICNOTE_QTY",
                6: "DHICNOTE_TDATE",
            },
            "VALD4": {
                6: "DHICNOTE_TDATE",
            },
            "UNIQ2": {
                1: together("DHICNOTE_NO", "DHICNOTE_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DHI_HOC", "F", "DHI_HOC_CNOTE_NO",
        {
            "COMP1": {
                1: "DHI_NO",
                3: "DHI_ONO",
                5: "DHI_CNOTE_NO",
                6: "DHI_CNOTE_QTY",
                7: "CDATE",
            },
            "VALD3": {
                6: "DHI_CNOTE_QTY",
            },
            "VALD4": {
                7: "CDATE",
            },
            "UNIQ1": {
                5: together("DHI_CNOTE_NO"),
            },
            "UNIQ2": {
                1: together("DHI_NO", "DHI_ONO", "DHI_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DHOCNOTE", "W", "DHOCNOTE_CNOTE_NO",
        {
            "COMP1": {
                1: "DHOCNOTE_NO",
                3: "DHOCNOTE_CNOTE_NO",
                4: "DHOCNOTE_QTY",
                6: "DHOCNOTE_TDATE",
            },
            "VALD3": {
                4: "DHOCNOTE_QTY",
            },
            "VALD4": {
                6: "DHOCNOTE_TDATE",
            },
            "UNIQ2": {
                1: together("DHOCNOTE_NO", "DHOCNOTE_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DHOUNDEL_POD", "U", "DHOUNDEL_CNOTE_NO",
        {
            "COMP1": {
                1: "DHOUNDEL_NO",
                3: "DHOUNDEL_CNOTE_NO",
                4: "DHOUNDEL_QTY",
                10: "DHOUNDEL_HRS",
                11: "CREATE_DATE",
            },
            "VALD3": {
                4: "DHOUNDEL_QTY",
            },
            "VALD4": {
                11: "CREATE_DATE",
            },
            "UNIQ2": {
                1: together("DHOUNDEL_NO", "DHOUNDEL_CNOTE_NO", "DHOUNDEL_HRS"),
            },
        },
    ),
    Columns(
        "CMS_DHOV_RSHEET", "S", "DHOV_RSHEET_CNOTE",
        {
            "COMP1": {
                1: "DHOV_RSHEET_NO",
                2: "DHOV_RSHEET_CNOTE",
                4: "DHOV_RSHEET_COD",
                8: "DHOV_RSHEET_QTY",
                9: "CREATE_DATE",
                10: "DHOV_RSHEET_UZONE",
                11: "DHOV_RSHEET_CYCLE",
                13: "DHOV_RSHEET_RSHEETNO",
                17: "DHOV_DRSHEET_EPAY_DEVICE",
                19: "DHOV_DRSHEET_STATUS",
            },
            "VALD3": {
                4: "DHOV_RSHEET_COD",
                8: "DHOV_RSHEET_QTY",
                16: "DHOV_DRSHEET_EPAY_AMOUNT",
            },
            "VALD4": {
                9: "CREATE_DATE",
            },
            "VALD8": {
                11: matches("DHOV_RSHEET_CYCLE", r"^Y$"),
            },
            "VALD11": {
                19: matches("DHOV_DRSHEET_STATUS", r"^[DU]\d+$"),
            },
            "VALD13": {
                10: within("DHOV_RSHEET_UZONE", "zone"),
            },
            "UNIQ1": {
                2: together("DHOV_RSHEET_CNOTE"),
            },
            "UNIQ2": {
                1: together("DHOV_RSHEET_NO", "DHOV_RSHEET_CNOTE", "DHOV_RSHEET_RSHEETNO"),
            },
        },
    ),
    Columns(
        "CMS_DMBAG", "K", "DMBAG_BAG_NO",
        {
            "COMP1": {
                1: "DMBAG_NO",
                2: "DMBAG_BAG_NO",
                3: "DMBAG_ORIGIN",
                4: "DMBAG_DESTINATION",
                5: "DMBAG_WEIGHT",
                10: "ESB_TIME",
                11: "ESB_ID",
            },
            "VALD1": {
                3: within("DMBAG_ORIGIN", "origin"),
                4: within("DMBAG_DESTINATION", "destination"),
            },
            "VALD2": {
                5: "DMBAG_WEIGHT",
            },
            "VALD4": {
                10: "ESB_TIME",
            },
            "UNIQ1": {
                1: together("DMBAG_BAG_NO"),
            },
        },
    ),
    Columns(
        "CMS_DRCNOTE", "D", "DRCNOTE_CNOTE_NO",
        {
            "COMP1": {
                1: "DRCNOTE_NO",
                2: "DRCNOTE_CNOTE_NO",
                3: "DRCNOTE_QTY",
                5: "DRCNOTE_TDATE",
            },
            "VALD3": {
                3: "DRCNOTE_QTY",
            },
            "VALD4": {
                5: "DRCNOTE_TDATE",
            },
            "UNIQ2": {
                1: together("DRCNOTE_NO", "DRCNOTE_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DRSHEET", "P", "DRSHEET_CNOTE_NO",
        {
            "COMP1": {
                1: "DRSHEET_NO",
                2: "DRSHEET_CNOTE_NO",
                3: "DRSHEET_DATE",
                4: "DRSHEET_STATUS",
                5: "DRSHEET_RECEIVER",
                7: "DRSHEET_UID",
                8: "DRSHEET_UDATE",
                9: "CREATION_DATE",
            },
            "VALD4": {
                3: "DRSHEET_DATE",
                8: "DRSHEET_UDATE",
                9: "CREATION_DATE",
            },
            "VALD8": {
                6: matches("DRSHEET_FLAG", r"^Y$"),
            },
            "VALD11": {
                4: matches("DRSHEET_STATUS", r"^[DU][0-9]{2}$"),
            },
            "VALD13": {
                7: within("DRSHEET_UID", "zone"),
            },
            "UNIQ2": {
                1: together("DRSHEET_NO", "DRSHEET_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DRSHEET_PRA", "O", "DRSHEET_CNOTE_NO",
        {
            "COMP1": {
                1: "DRSHEET_NO",
                2: "DRSHEET_CNOTE_NO",
                9: "CREATION_DATE",
            },
            "VALD4": {
                9: "CREATION_DATE",
            },
            "UNIQ1": {
                1: together("DRSHEET_NO"),
                2: together("DRSHEET_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_DSJ", "AA", "DSJ_NO",
        {
            "COMP1": {
                1: "DSJ_NO",
                2: "DSJ_BAG_NO",
                3: "DSJ_HVO_NO",
                4: "DSJ_UID",
                5: "DSJ_CDATE",
            },
            "VALD4": {
                5: "DSJ_CDATE",
            },
            "UNIQ2": {
                2: together("DSJ_BAG_NO", "DSJ_HVO_NO"),
            },
        },
    ),
    Columns(
        "CMS_DSMU", "M", "DSMU_NO",
        {
            "COMP1": {
                1: "DSMU_NO",
                2: "DSMU_FLIGHT_NO",
                3: "DSMU_FLIGHT_DATE",
                4: "DSMU_BAG_NO",
                5: "DSMU_WEIGHT",
                6: "DSMU_BAG_ORIGIN",
                7: "DSMU_BAG_DESTINATION",
                11: "ESB_TIME",
                12: "ESB_ID",
            },
            "VALD1": {
                6: within("DSMU_BAG_ORIGIN", "origin"),
                7: within("DSMU_BAG_DESTINATION", "destination"),
            },
            "VALD2": {
                5: "DSMU_WEIGHT",
            },
            "VALD4": {
                3: "DSMU_FLIGHT_DATE",
                11: "ESB_TIME",
            },
            "UNIQ1": {
                4: together("DSMU_BAG_NO"),
            },
        },
    ),
    Columns(
        "CMS_DSTATUS", "G", "DSTATUS_CNOTE_NO",
        {
            "VALD4": {
                5: "CREATE_DATE",
                6: "DSTATUS_STATUS_DATE",
            },
            "VALD13": {
                13: within("DSTATUS_ZONE_CODE", "zone"),
            },
            "UNIQ1": {
                1: together("DSTATUS_NO"),
                2: together("DSTATUS_CNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_MANIFEST", "H", "MANIFEST_NO",
        {
            "COMP1": {
                1: "MANIFEST_NO",
                3: "MANIFEST_DATE",
                5: "MANIFEST_FROM",
                8: "MANIFEST_APPROVED",
                10: "MANIFEST_CODE",
                11: "MANIFEST_UID",
                15: "MANIFEST_CRDATE",
                16: "MANIFEST_CANCELED",
            },
            "VALD1": {
                4: within("MANIFEST_ROUTE", "route"),
                5: within("MANIFEST_FROM", "origin"),
                6: within("MANIFEST_THRU", "destination"),
                9: within("MANIFEST_ORIGIN", "origin"),
            },
            "VALD4": {
                3: "MANIFEST_DATE",
                15: "MANIFEST_CRDATE",
            },
            "VALD7": {
                10: matches("MANIFEST_CODE", r"^[1-3]$"),
            },
            "UNIQ1": {
                1: together("MANIFEST_NO"),
            },
        },
    ),
    Columns(
        "CMS_MFBAG", "J", "MFBAG_NO",
        {
            "COMP1": {
                1: "MFBAG_MAN_NO",
                2: "MFBAG_NO",
                3: "MFBAG_ACT_WEIGHT",
                4: "MFBAG_CTC_WEIGHT",
                10: "MFBAG_ROUTE",
                18: "MFBAG_CRDATE",
                20: "ESB_TIME",
                21: "ESB_ID",
            },
            "VALD1": {
                10: within("MFBAG_ROUTE", "route"),
            },
            "VALD2": {
                3: "MFBAG_ACT_WEIGHT",
                4: "MFBAG_CTC_WEIGHT",
            },
            "VALD4": {
                18: "MFBAG_CRDATE",
                20: "ESB_TIME",
            },
            "UNIQ2": {
                1: together("MFBAG_MAN_NO", "MFBAG_NO", "ESB_ID"),
            },
        },
    ),
    Columns(
        "CMS_MFCNOTE", "I", "MFCNOTE_NO",
        {
            "COMP1": {
                1: "MFCNOTE_MAN_NO",
                2: "MFCNOTE_BAG_NO",
                3: "MFCNOTE_NO",
                4: "MFCNOTE_WEIGHT",
                19: "MFCNOTE_CRDATE",
            },
            "VALD2": {
                4: "MFCNOTE_WEIGHT",
            },
            "VALD4": {
                19: "MFCNOTE_CRDATE",
            },
            "UNIQ2": {
                1: together("MFCNOTE_MAN_NO", "MFCNOTE_BAG_NO", "MFCNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_MHICNOTE", "AB", "MHICNOTE_NO",
        {
            "COMP1": {
                1: "MHICNOTE_BRANCH_ID",
                2: "MHICNOTE_ZONE",
                3: "MHICNOTE_NO",
                4: "MHICNOTE_REF_NO",
                5: "MHICNOTE_DATE",
                6: "MHICNOTE_ZONE_ORIG",
                7: "MHICNOTE_USER_ID",
                10: "MHICNOTE_SIGNDATE",
            },
            "VALD4": {
                5: "MHICNOTE_DATE",
                10: "MHICNOTE_SIGNDATE",
            },
            "VALD8": {
                11: matches("MHICNOTE_APPROVE", r"^Y$"),
            },
            "VALD12": {
                1: within("MHICNOTE_BRANCH_ID", "branch"),
            },
            "VALD13": {
                2: within("MHICNOTE_ZONE", "zone"),
            },
        },
    ),
    Columns(
        "CMS_MHI_HOC", "E", "MHI_NO",
        {
            "COMP1": {
                1: "MHI_NO",
                2: "MHI_REF_NO",
                3: "MHI_DATE",
                4: "MHI_UID",
                5: "MHI_APPROVE",
                6: "MHI_BRANCH",
                7: "MHI_APPROVE_DATE",
                9: "MHI_USER1",
                11: "MHI_ZONE",
            },
            "VALD4": {
                3: "MHI_DATE",
                7: "MHI_APPROVE_DATE",
            },
            "VALD12": {
                6: within("MHI_BRANCH", "branch"),
            },
            "VALD13": {
                11: within("MHI_ZONE", "zone"),
            },
        },
    ),
    Columns(
        "CMS_MHOCNOTE", "V", "MHOCNOTE_NO",
        {
            "COMP1": {
                1: "MHOCNOTE_BRANCH_ID",
                2: "MHOCNOTE_ZONE",
                3: "MHOCNOTE_NO",
                4: "MHOCNOTE_DATE",
                5: "MHOCNOTE_ZONE_DEST",
                6: "MHOCNOTE_USER_ID",
                10: "MHOCNOTE_APPROVE",
            },
            "VALD4": {
                9: "MHOCNOTE_SIGNDATE",
                19: "MHOCNOTE_APP_DATE",
            },
            "VALD8": {
                10: matches("MHOCNOTE_APPROVE", r"^Y$"),
            },
            "VALD12": {
                1: within("MHOCNOTE_BRANCH_ID", "branch"),
            },
            "VALD13": {
                2: within("MHOCNOTE_ZONE", "zone"),
                5: within("MHOCNOTE_ZONE_DEST", "zone"),
            },
        },
    ),
    Columns(
        "CMS_MHOUNDEL_POD", "T", "MHOUNDEL_NO",
        {
            "COMP1": {
                1: "MHOUNDEL_BRANCH_ID",
                2: "MHOUNDEL_NO",
                4: "MHOUNDEL_DATE",
                5: "MHOUNDEL_USER_ID",
                6: "MHOUNDEL_ZONE",
                7: "MHOUNDEL_APPROVE",
                8: "MHOUNDEL_USER1",
                10: "MHOUNDEL_SIGNDATE",
            },
            "VALD4": {
                4: "MHOUNDEL_DATE",
                10: "MHOUNDEL_SIGNDATE",
            },
            "VALD8": {
                7: matches("MHOUNDEL_APPROVE", r"^Y$"),
            },
            "VALD12": {
                1: within("MHOUNDEL_BRANCH_ID", "branch"),
            },
            "VALD13": {
                6: within("MHOUNDEL_ZONE", "zone"),
            },
            "UNIQ1": {
                2: together("MHOUNDEL_NO"),
            },
        },
    ),
    Columns(
        "CMS_MMBAG", "L", "MMBAG_NO",
        {
            "COMP1": {
                1: "MMBAG_BRANCH",
                2: "MMBAG_NO",
                3: "MMBAG_ORIGIN",
                4: "MMBAG_DESTINATION",
                5: "MMBAG_DATE",
                6: "MMBAG_QTY",
                7: "MMBAG_WEIGHT",
                9: "MMBAG_USER",
                10: "MMBAG_USER_APPROVE",
            },
            "COMP2": {
                11: "MMBAG_DATE_APPROVE",
            },
            "VALD1": {
                3: within("MMBAG_ORIGIN", "origin"),
                4: within("MMBAG_DESTINATION", "destination"),
            },
            "VALD4": {
                5: "MMBAG_DATE",
                11: "MMBAG_DATE_APPROVE",
            },
            "VALD8": {
                12: matches("MMBAG_APPROVED", r"^Y$"),
            },
            "VALD12": {
                1: within("MMBAG_BRANCH", "branch"),
            },
            "UNIQ1": {
                2: together("MMBAG_NO"),
            },
        },
    ),
    Columns(
        "CMS_MRCNOTE", "C", "MRCNOTE_NO",
        {
            "COMP1": {
                1: "MRCNOTE_NO",
                2: "MRCNOTE_DATE",
                3: "MRCNOTE_BRANCH_ID",
                4: "MRCNOTE_USER_ID",
                7: "MRCNOTE_USER1",
                8: "MRCNOTE_USER2",
                9: "MRCNOTE_SIGNDATE",
            },
            "VALD4": {
                2: "MRCNOTE_DATE",
                9: "MRCNOTE_SIGNDATE",
            },
            "VALD12": {
                3: within("MRCNOTE_BRANCH_ID", "branch"),
            },
            "UNIQ1": {
                1: together("MRCNOTE_NO"),
            },
        },
    ),
    Columns(
        "CMS_MRSHEET", "Q", "MRSHEET_NO",
        {
            "COMP1": {
                1: "MRSHEET_BRANCH",
                2: "MRSHEET_NO",
                3: "MRSHEET_DATE",
                4: "MRSHEET_COURIER_ID",
                5: "MRSHEET_UID",
                6: "MRSHEET_UDATE",
                7: "MRSHEET_APPROVED_DR",
                8: "MRSHEET_UID_DR",
            },
            "VALD4": {
                3: "MRSHEET_DATE",
                6: "MRSHEET_UDATE",
            },
            "VALD8": {
                7: matches("MRSHEET_APPROVED_DR", r"^Y$"),
            },
            "VALD12": {
                1: within("MRSHEET_BRANCH", "branch"),
            },
        },
    ),
    Columns(
        "CMS_MSJ", "Z", "MSJ_NO",
        {
            "COMP1": {
                1: "MSJ_NO",
                2: "MSJ_BRANCH_ID",
                3: "MSJ_DATE",
                4: "MSJ_USER1",
                5: "MSJ_USER2",
                6: "MSJ_APPROVE",
                7: "MSJ_CDATE",
                8: "MSJ_UID",
                11: "MSJ_DEST",
                12: "MSJ_ORIG",
            },
            "VALD1": {
                11: within("MSJ_DEST", "zone"),
                12: within("MSJ_ORIG", "zone"),
            },
            "VALD4": {
                3: "MSJ_DATE",
                7: "MSJ_CDATE",
                10: "MSJ_SIGNDATE",
            },
            "VALD8": {
                6: matches("MSJ_APPROVE", r"^Y$"),
            },
            "VALD12": {
                2: within("MSJ_BRANCH_ID", "branch"),
            },
            "UNIQ1": {
                1: together("MSJ_NO"),
            },
        },
    ),
    Columns(
        "CMS_MSMU", "N", "MSMU_NO",
        {
            "COMP1": {
                1: "MSMU_NO",
                2: "MSMU_DATE",
                3: "MSMU_ORIGIN",
                4: "MSMU_DESTINATION",
                5: "MSMU_FLIGHT_NO",
                6: "MSMU_FLIGHT_DATE",
                7: "MSMU_ETD",
                8: "MSMU_ETA",
                9: "MSMU_QTY",
                10: "MSMU_WEIGHT",
                11: "MSMU_USER",
                12: "MSMU_FLAG",
                14: "MSMU_STATUS",
                15: "MSMU_WRH_DATE",
                16: "MSMU_WRH_TIME",
                17: "MSMU_OFF_DATE",
                18: "MSMU_OFF_TIME",
                19: "MSMU_CONFIRM",
                24: "MSMU_MODA",
                26: "MSMU_HOURS",
            },
            "VALD1": {
                3: within("MSMU_ORIGIN", "branch"),
                4: within("MSMU_DESTINATION", "branch"),
            },
            "VALD2": {
                10: "MSMU_WEIGHT",
                26: "MSMU_HOURS",
            },
            "VALD3": {
                9: "MSMU_QTY",
            },
            "VALD4": {
                2: "MSMU_DATE",
                6: "MSMU_FLIGHT_DATE",
                7: "MSMU_ETD",
                8: "MSMU_ETA",
                15: "MSMU_WRH_DATE",
                17: "MSMU_OFF_DATE",
            },
            "UNIQ1": {
                1: together("MSMU_NO"),
            },
        },
    ),
    Columns(
        "CMS_RDSJ", "AD", "RDSJ_NO",
        {
            "COMP1": {
                1: "RDSJ_NO",
                2: "RDSJ_BAG_NO",
                3: "RDSJ_HVO_NO",
                5: "RDSJ_CDATE",
                6: "RDSJ_HVI_NO",
            },
            "VALD4": {
                5: "RDSJ_CDATE",
            },
            "UNIQ1": {
                1: together("RDSJ_NO"),
                2: together("RDSJ_BAG_NO"),
                3: together("RDSJ_HVO_NO"),
                6: together("RDSJ_HVI_NO"),
            },
        },
    ),
)

#: Rules over more than one column or table.
RULES = (
    rule("CONS1B15", "pair_consistency", "CMS_CNOTE", left_table="CMS_APICUST", left_column="APICUST_WEIGHT", right_table="CMS_CNOTE", right_column="CNOTE_WEIGHT", join_key="CNOTE_NO", left_join_key="APICUST_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS1B12", "pair_consistency", "CMS_CNOTE", left_table="CMS_APICUST", left_column="APICUST_ORIGIN", right_table="CMS_CNOTE", right_column="CNOTE_ORIGIN", join_key="CNOTE_NO", left_join_key="APICUST_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS1B13", "pair_consistency", "CMS_APICUST", left_table="CMS_APICUST", left_column="APICUST_DESTINATION", right_table="CMS_CNOTE", right_column="CNOTE_DESTINATION", left_join_key="APICUST_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS1B14", "pair_consistency", "CMS_APICUST", left_table="CMS_APICUST", left_column="APICUST_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="APICUST_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS1B3", "pair_consistency", "CMS_APICUST", left_table="CMS_APICUST", left_column="APICUST_BRANCH", right_table="CMS_CNOTE", right_column="CNOTE_BRANCH_ID", left_join_key="APICUST_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS2R2", "pair_consistency", "CMS_CNOTE_POD", left_table="CMS_CNOTE_POD", left_column="CNOTE_POD_DATE", right_table="CMS_DRSHEET", right_column="DRSHEET_DATE", left_join_key="CNOTE_POD_NO", right_join_key="DRSHEET_CNOTE_NO", cnote_column="CNOTE_POD_NO"),
    rule("CONS2R4", "pair_consistency", "CMS_CNOTE_POD", left_table="CMS_CNOTE_POD", left_column="CNOTE_POD_STATUS", right_table="CMS_DRSHEET", right_column="DRSHEET_STATUS", left_join_key="CNOTE_POD_NO", right_join_key="DRSHEET_CNOTE_NO", right_latest_by="DRSHEET_DATE", cnote_column="CNOTE_POD_NO"),
    rule("CONS2Y5", "pair_consistency", "CMS_COST_DTRANSIT_AGEN", left_table="CMS_COST_DTRANSIT_AGEN", left_column="CNOTE_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS2Y8", "pair_consistency", "CMS_COST_DTRANSIT_AGEN", left_table="CMS_COST_DTRANSIT_AGEN", left_column="CNOTE_SERVICES_CODE", right_table="CMS_CNOTE", right_column="CNOTE_SERVICES_CODE", left_join_key="CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("CONS2AE4", "pair_consistency", "CMS_DBAG_HO", left_table="CMS_DBAG_HO", left_column="DBAG_CNOTE_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DBAG_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DBAG_CNOTE_NO"),
    rule("CONS2AE6", "pair_consistency", "CMS_DBAG_HO", left_table="CMS_DBAG_HO", left_column="DBAG_CNOTE_DESTINATION", right_table="CMS_CNOTE", right_column="CNOTE_DESTINATION", left_join_key="DBAG_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DBAG_CNOTE_NO"),
    rule("CONS2AC4", "pair_consistency", "CMS_DHICNOTE", left_table="CMS_DHICNOTE", left_column="DHICNOTE_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DHICNOTE_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DHICNOTE_CNOTE_NO"),
    rule("CONS2F6", "pair_consistency", "CMS_DHI_HOC", left_table="CMS_DHI_HOC", left_column="DHI_CNOTE_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DHI_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DHI_CNOTE_NO"),
    rule("CONS2W4", "pair_consistency", "CMS_DHOCNOTE", left_table="CMS_DHOCNOTE", left_column="DHOCNOTE_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DHOCNOTE_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DHOCNOTE_CNOTE_NO"),
    rule("CONS2U4", "pair_consistency", "CMS_DHOUNDEL_POD", left_table="CMS_DHOUNDEL_POD", left_column="DHOUNDEL_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DHOUNDEL_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DHOUNDEL_CNOTE_NO"),
    rule("CONS2S8", "pair_consistency", "CMS_DHOV_RSHEET", left_table="CMS_DHOV_RSHEET", left_column="DHOV_RSHEET_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DHOV_RSHEET_CNOTE", right_join_key="CNOTE_NO", cnote_column="DHOV_RSHEET_CNOTE"),
    rule("CONS2D3", "pair_consistency", "CMS_DRCNOTE", left_table="CMS_DRCNOTE", left_column="DRCNOTE_QTY", right_table="CMS_CNOTE", right_column="CNOTE_QTY", left_join_key="DRCNOTE_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DRCNOTE_CNOTE_NO"),
    rule("CONS2M2", "pair_consistency", "CMS_DSMU", left_table="CMS_DSMU", left_column="DSMU_FLIGHT_NO", right_table="CMS_MSMU", right_column="MSMU_FLIGHT_NO", left_join_key="DSMU_NO", right_join_key="MSMU_NO", cnote_column="DSMU_NO"),
    rule("CONS2M3", "pair_consistency", "CMS_DSMU", left_table="CMS_DSMU", left_column="DSMU_FLIGHT_DATE", right_table="CMS_MSMU", right_column="MSMU_FLIGHT_DATE", left_join_key="DSMU_NO", right_join_key="MSMU_NO", cnote_column="DSMU_NO"),
    rule("CONS2M6", "pair_consistency", "CMS_DSMU", left_table="CMS_DSMU", left_column="DSMU_BAG_ORIGIN", right_table="CMS_DMBAG", right_column="DMBAG_ORIGIN", left_join_key="DSMU_BAG_NO", right_join_key="DMBAG_BAG_NO", cnote_column="DSMU_NO"),
    rule("CONS2M7", "pair_consistency", "CMS_DSMU", left_table="CMS_DSMU", left_column="DSMU_BAG_DESTINATION", right_table="CMS_DMBAG", right_column="DMBAG_DESTINATION", left_join_key="DSMU_BAG_NO", right_join_key="DMBAG_BAG_NO", cnote_column="DSMU_NO"),
    rule("CONS2J10", "pair_consistency", "CMS_MFBAG", left_table="CMS_MFBAG", left_column="MFBAG_ROUTE", right_table="CMS_MANIFEST", right_column="MANIFEST_ROUTE", left_join_key="MFBAG_MAN_NO", right_join_key="MANIFEST_NO", cnote_column="MFBAG_NO"),
    rule("CONS2L3", "pair_consistency", "CMS_MMBAG", left_table="CMS_MMBAG", left_column="MMBAG_ORIGIN", right_table="CMS_DMBAG", right_column="DMBAG_ORIGIN", left_join_key="MMBAG_NO", right_join_key="DMBAG_NO", cnote_column="MMBAG_NO"),
    rule("CONS2L4", "pair_consistency", "CMS_MMBAG", left_table="CMS_MMBAG", left_column="MMBAG_DESTINATION", right_table="CMS_DMBAG", right_column="DMBAG_DESTINATION", left_join_key="MMBAG_NO", right_join_key="DMBAG_NO", cnote_column="MMBAG_NO"),
    rule("TIME1B2", "bridged_timeliness", "CMS_CNOTE", left_table="CMS_CNOTE", start_column="CNOTE_DATE", end_column="MHI_APPROVE_DATE", joins=[join("CMS_DHI_HOC", "CNOTE_NO", "DHI_CNOTE_NO"), join("CMS_MHI_HOC", "DHI_NO", "MHI_NO")], cnote_column="CNOTE_NO"),
    rule("TIME1E7", "bridged_timeliness", "CMS_MHI_HOC", left_table="CMS_MHI_HOC", start_column="MHI_APPROVE_DATE", end_column="MRCNOTE_SIGNDATE", joins=[join("CMS_DHI_HOC", "MHI_NO", "DHI_NO"), join("CMS_DRCNOTE", "DHI_CNOTE_NO", "DRCNOTE_CNOTE_NO"), join("CMS_MRCNOTE", "DRCNOTE_NO", "MRCNOTE_NO")], cnote_column="DHI_CNOTE_NO"),
    rule("TIME1C9", "bridged_timeliness", "CMS_MRCNOTE", left_table="CMS_MRCNOTE", start_column="MRCNOTE_SIGNDATE", end_column="MFBAG_CRDATE", joins=[join("CMS_DRCNOTE", "MRCNOTE_NO", "DRCNOTE_NO"), join("CMS_MFCNOTE", "DRCNOTE_CNOTE_NO", "MFCNOTE_NO"), join("CMS_MFBAG", "MFCNOTE_BAG_NO", "MFBAG_NO")], cnote_column="DRCNOTE_CNOTE_NO", aggregate_by_cnote="earliest"),
    rule("TIME1Q3", "bridged_timeliness", "CMS_MRSHEET", left_table="CMS_MRSHEET", start_column="MRSHEET_DATE", end_column="CNOTE_POD_DATE", joins=[join("CMS_DRSHEET", "MRSHEET_NO", "DRSHEET_NO"), join("CMS_CNOTE_POD", "DRSHEET_CNOTE_NO", "CNOTE_POD_NO")], cnote_column="DRSHEET_CNOTE_NO"),
    rule("TIME1Z10", "bridged_timeliness", "CMS_MSJ", left_table="CMS_MSJ", start_column="MSJ_SIGNDATE", end_column="MHICNOTE_DATE", joins=[join("CMS_DSJ", "MSJ_NO", "DSJ_NO"), join("CMS_RDSJ", "DSJ_HVO_NO", "RDSJ_HVO_NO"), join("CMS_MHICNOTE", "RDSJ_HVI_NO", "MHICNOTE_NO")], cnote_column="MHICNOTE_NO"),
    rule("TIME1AB5", "bridged_timeliness", "CMS_MHICNOTE", left_table="CMS_MHICNOTE", start_column="MHICNOTE_DATE", end_column="MRSHEET_DATE", joins=[join("CMS_DHICNOTE", "MHICNOTE_NO", "DHICNOTE_NO"), join("CMS_DRSHEET", "DHICNOTE_CNOTE_NO", "DRSHEET_CNOTE_NO"), join("CMS_MRSHEET", "DRSHEET_NO", "MRSHEET_NO")], cnote_column="DHICNOTE_CNOTE_NO"),
    rule("ACCU2B12A", "prefix_match", "CMS_CNOTE", left_table="CMS_CNOTE", left_column="CNOTE_ORIGIN", right_table="CMS_DCORRECT_DEST", right_column="DCORRECT_ORIGIN", left_join_key="CNOTE_NO", right_join_key="DCORRECT_CNOTE_NO", cnote_column="CNOTE_NO", prefix_length=3),
    rule("ACCU2B13A", "prefix_match", "CMS_CNOTE", left_table="CMS_CNOTE", left_column="CNOTE_DESTINATION", right_table="CMS_DCORRECT_DEST", right_column="DCORRECT_DEST", left_join_key="CNOTE_NO", right_join_key="DCORRECT_CNOTE_NO", cnote_column="CNOTE_NO", prefix_length=3),
    rule("CONS2N3", "prefix_match", "CMS_MSMU", left_table="CMS_MSMU", left_column="MSMU_ORIGIN", right_table="CMS_DSMU", right_column="DSMU_BAG_ORIGIN", left_join_key="MSMU_NO", right_join_key="DSMU_NO", cnote_column="MSMU_NO", prefix_length=3),
    rule("CONS2N4", "prefix_match", "CMS_MSMU", left_table="CMS_MSMU", left_column="MSMU_DESTINATION", right_table="CMS_DSMU", right_column="DSMU_BAG_DESTINATION", left_join_key="MSMU_NO", right_join_key="DSMU_NO", cnote_column="MSMU_NO", prefix_length=3),
    rule("ACCU3B12B", "suffix_after_prefix_match", "CMS_CNOTE", left_table="CMS_CNOTE", left_column="CNOTE_ORIGIN", right_table="CMS_DCORRECT_DEST", right_column="DCORRECT_ORIGIN", left_join_key="CNOTE_NO", right_join_key="DCORRECT_CNOTE_NO", cnote_column="CNOTE_NO", prefix_length=3),
    rule("ACCU3B13B", "suffix_after_prefix_match", "CMS_CNOTE", left_table="CMS_CNOTE", left_column="CNOTE_DESTINATION", right_table="CMS_DCORRECT_DEST", right_column="DCORRECT_DEST", left_join_key="CNOTE_NO", right_join_key="DCORRECT_CNOTE_NO", cnote_column="CNOTE_NO", prefix_length=3),
    rule("COMP2V19", "conditional_completeness", "CMS_MHOCNOTE", column="MHOCNOTE_APP_DATE", condition_column="MHOCNOTE_APPROVE", condition_value="Y", cnote_column="MHOCNOTE_NO"),
    rule("COMP2V9", "conditional_completeness", "CMS_MHOCNOTE", column="MHOCNOTE_SIGNDATE", condition_column="MHOCNOTE_APPROVE", condition_value="Y", cnote_column="MHOCNOTE_NO"),
    rule("COMP2Z10", "conditional_completeness", "CMS_MSJ", column="MSJ_SIGNDATE", condition_column="MSJ_APPROVE", condition_value="Y", cnote_column="MSJ_NO"),
    rule("COMP2H4", "conditional_completeness", "CMS_MANIFEST", column="MANIFEST_ROUTE", condition_column="MANIFEST_APPROVED", condition_value="Y", cnote_column="MANIFEST_NO"),
    rule("COMP2H6", "conditional_completeness", "CMS_MANIFEST", column="MANIFEST_THRU", condition_column="MANIFEST_APPROVED", condition_value="Y", cnote_column="MANIFEST_NO"),
    rule("COMP2H9", "conditional_completeness", "CMS_MANIFEST", column="MANIFEST_ORIGIN", condition_column="MANIFEST_APPROVED", condition_value="Y", cnote_column="MANIFEST_NO"),
    rule("COMP2R3", "conditional_completeness", "CMS_CNOTE_POD", column="CNOTE_POD_RECEIVER", condition_column="CNOTE_POD_DELIVERED", condition_value="Y", cnote_column="CNOTE_POD_NO"),
    rule("COMP3J9", "conditional_completeness", "CMS_MFBAG", column="MFBAG_MAN_REF", condition_column="MFBAG_MAN_REF", condition_regex="(?:^|/)IM(?:/|$)", cnote_column="MFBAG_NO"),
    rule("COMP2AB11", "conditional_completeness", "CMS_MHICNOTE", column="MHICNOTE_APPROVE", condition_column="MHICNOTE_SIGNDATE", condition_mode="not_null", cnote_column="MHICNOTE_NO"),
    rule("COMP2L12", "conditional_completeness", "CMS_MMBAG", column="MMBAG_APPROVED", condition_column="MMBAG_DATE_APPROVE", condition_mode="not_null", cnote_column="MMBAG_NO"),
    rule("CONS2I4", "rounded_pair_consistency", "CMS_MFCNOTE", left_table="CMS_MFCNOTE", left_column="MFCNOTE_WEIGHT", right_table="CMS_CNOTE", right_column="CNOTE_WEIGHT", left_join_key="MFCNOTE_NO", right_join_key="CNOTE_NO", cnote_column="MFCNOTE_NO", decimals=0),
    rule("CONS2Y6", "rounded_pair_consistency", "CMS_COST_DTRANSIT_AGEN", left_table="CMS_COST_DTRANSIT_AGEN", left_column="CNOTE_WEIGHT", right_table="CMS_CNOTE", right_column="CNOTE_WEIGHT", left_join_key="CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="CNOTE_NO", decimals=0),
    rule("CONS2AE5", "rounded_pair_consistency", "CMS_DBAG_HO", left_table="CMS_DBAG_HO", left_column="DBAG_CNOTE_WEIGHT", right_table="CMS_CNOTE", right_column="CNOTE_WEIGHT", left_join_key="DBAG_CNOTE_NO", right_join_key="CNOTE_NO", cnote_column="DBAG_CNOTE_NO", decimals=0),
    rule("CONS2M5", "rounded_pair_consistency", "CMS_DSMU", left_table="CMS_DSMU", left_column="DSMU_WEIGHT", right_table="CMS_DMBAG", right_column="DMBAG_WEIGHT", left_join_key="DSMU_BAG_NO", right_join_key="DMBAG_BAG_NO", cnote_column="DSMU_NO", decimals=0),
    rule("TIME1H15 (OM)", "timeliness", "CMS_MANIFEST", start_table="CMS_MANIFEST", start_column="MANIFEST_CRDATE", end_table="CMS_MFBAG", end_column="MFBAG_CRDATE", start_join_key="MANIFEST_NO", end_join_key="MFBAG_MAN_NO", cnote_column="MANIFEST_NO"),
    rule("COMP4J1", "transit_manifest_required_for_origin_mismatch", "CMS_MFBAG"),
    rule("VALD10S5", "validity_in_set", "CMS_DHOV_RSHEET", column="DHOV_RSHEET_UNDEL", allowed=["0", "1"], cnote_column="DHOV_RSHEET_CNOTE"),
    rule("CONS2L7", "aggregate_sum_consistency", "CMS_MMBAG", master_table="CMS_MMBAG", master_key="MMBAG_NO", master_value_column="MMBAG_WEIGHT", detail_table="CMS_DMBAG", detail_key="DMBAG_NO", detail_value_column="DMBAG_WEIGHT", cnote_column="MMBAG_NO", decimals=0),
    rule("CONS3J3", "aggregate_sum_consistency", "CMS_MFBAG", master_table="CMS_MFBAG", master_key="MFBAG_NO", master_value_column="MFBAG_ACT_WEIGHT", detail_table="CMS_MFCNOTE", detail_key="MFCNOTE_BAG_NO", detail_value_column="MFCNOTE_WEIGHT", cnote_column="MFBAG_NO", decimals=0),
    rule("CONS3J4", "aggregate_sum_consistency", "CMS_MFBAG", master_table="CMS_MFBAG", master_key="MFBAG_NO", master_value_column="MFBAG_CTC_WEIGHT", detail_table="CMS_MFCNOTE", detail_key="MFCNOTE_BAG_NO", detail_value_column="MFCNOTE_WEIGHT", cnote_column="MFBAG_NO", decimals=0),
    rule("CONS3N10", "aggregate_sum_consistency", "CMS_MSMU", master_table="CMS_MSMU", master_key="MSMU_NO", master_value_column="MSMU_WEIGHT", detail_table="CMS_MFCNOTE", detail_key="DSMU_NO", detail_value_column="MFCNOTE_WEIGHT", joins=[join("CMS_DMBAG", "MFCNOTE_BAG_NO", "DMBAG_BAG_NO"), join("CMS_DSMU", "DMBAG_BAG_NO", "DSMU_BAG_NO")], cnote_column="MSMU_NO", decimals=0),
    rule("CONS4N9", "count_consistency", "CMS_MSMU", master_table="CMS_MSMU", master_column="MSMU_QTY", master_key="MSMU_NO", child_table="CMS_DSMU", child_key="DSMU_NO", count_column="DSMU_BAG_NO", cnote_column="MSMU_NO"),
    rule("ACCU1A25", "non_negative", "CMS_APICUST", column="APICUST_WEIGHT", cnote_column="APICUST_CNOTE_NO"),
    rule("ACCU5A6", "value_in_reference", "CMS_APICUST", column="APICUST_SERVICES_CODE", reference_table="CMS_DROURATE", reference_column="DROURATE_SERVICE", cnote_column="APICUST_CNOTE_NO"),
    rule("ACCU6B6", "value_in_reference", "CMS_CNOTE", column="CNOTE_SERVICES_CODE", reference_table="CMS_DROURATE", reference_column="DROURATE_SERVICE", cnote_column="CNOTE_NO"),
    rule("ACCU4B15", "non_negative_not_in_reference", "CMS_CNOTE", column="CNOTE_WEIGHT", reference_table="T_CORRECT_AWB", reference_column="C_CNOTE_NO", cnote_column="CNOTE_NO"),
    rule("COMP2P6", "reference_conditional_completeness", "CMS_DRSHEET", column="DRSHEET_FLAG", condition_column="DRSHEET_CNOTE_NO", reference_table="CMS_CNOTE_POD", reference_column="CNOTE_POD_NO", cnote_column="DRSHEET_CNOTE_NO"),
    rule("TIME1I9 (OM)", "manifest_code_sequence", "CMS_MFCNOTE", mode="om_before_tm", date_table="CMS_MFCNOTE", date_column="MFCNOTE_CRDATE", manifest_code_column="MANIFEST_CODE", cnote_column="MFCNOTE_NO"),
    rule("TIME1I9 (TM)", "manifest_code_sequence", "CMS_MFCNOTE", mode="tm_sequence_before_im", date_table="CMS_MFCNOTE", date_column="MFCNOTE_CRDATE", manifest_code_column="MANIFEST_CODE", cnote_column="MFCNOTE_NO"),
    rule("TIME1I9 (IM)", "manifest_code_sequence", "CMS_MFCNOTE", mode="im_after_tm", date_table="CMS_MFCNOTE", date_column="MFCNOTE_CRDATE", manifest_code_column="MANIFEST_CODE", cnote_column="MFCNOTE_NO"),
    rule("CONS2C3", "bridged_pair_consistency", "CMS_MRCNOTE", left_table="CMS_MRCNOTE", left_column="MRCNOTE_BRANCH_ID", right_column="CNOTE_BRANCH_ID", joins=[join("CMS_DRCNOTE", "MRCNOTE_NO", "DRCNOTE_NO"), join("CMS_CNOTE", "DRCNOTE_CNOTE_NO", "CNOTE_NO")], cnote_column="DRCNOTE_CNOTE_NO"),
    rule("CONS2K3", "bridged_pair_consistency", "CMS_DMBAG", left_table="CMS_DMBAG", left_column="DMBAG_ORIGIN", right_column="MANIFEST_FROM", joins=[join("CMS_MFBAG", "DMBAG_BAG_NO", "MFBAG_NO"), join("CMS_MANIFEST", "MFBAG_MAN_NO", "MANIFEST_NO")], cnote_column="DMBAG_BAG_NO"),
    rule("CONS2K4", "bridged_pair_consistency", "CMS_DMBAG", left_table="CMS_DMBAG", left_column="DMBAG_DESTINATION", right_column="MANIFEST_THRU", joins=[join("CMS_MFBAG", "DMBAG_BAG_NO", "MFBAG_NO"), join("CMS_MANIFEST", "MFBAG_MAN_NO", "MANIFEST_NO")], cnote_column="DMBAG_BAG_NO"),
    rule("CONS2X4", "bridged_pair_consistency", "CMS_COST_MTRANSIT_AGEN", left_table="CMS_COST_MTRANSIT_AGEN", left_column="DESTINATION", right_column="CNOTE_DESTINATION", joins=[join("CMS_COST_DTRANSIT_AGEN", "MANIFEST_NO", "DMANIFEST_NO"), join("CMS_CNOTE", "CNOTE_NO", "CNOTE_NO")], cnote_column="CNOTE_NO"),
    rule("CONS2X5", "bridged_pair_consistency", "CMS_COST_MTRANSIT_AGEN", left_table="CMS_COST_MTRANSIT_AGEN", left_column="CTC_WEIGHT", right_column="MFCNOTE_WEIGHT", joins=[join("CMS_COST_DTRANSIT_AGEN", "MANIFEST_NO", "DMANIFEST_NO"), join("CMS_MFCNOTE", "CNOTE_NO", "MFCNOTE_NO")], cnote_column="CNOTE_NO", decimals=0),
    rule("CONS2X6", "bridged_pair_consistency", "CMS_COST_MTRANSIT_AGEN", left_table="CMS_COST_MTRANSIT_AGEN", left_column="ACT_WEIGHT", right_column="CNOTE_WEIGHT", joins=[join("CMS_COST_DTRANSIT_AGEN", "MANIFEST_NO", "DMANIFEST_NO"), join("CMS_CNOTE", "CNOTE_NO", "CNOTE_NO")], cnote_column="CNOTE_NO", decimals=0),
    rule("CONS3H4", "bridged_substring_match", "CMS_MANIFEST", left_table="CMS_MANIFEST", left_column="MANIFEST_ROUTE", right_column="CNOTE_DESTINATION", joins=[join("CMS_MFCNOTE", "MANIFEST_NO", "MFCNOTE_MAN_NO"), join("CMS_CNOTE", "MFCNOTE_NO", "CNOTE_NO")], substring_start=8, substring_length=3, cnote_column="CNOTE_NO"),
    rule("CONS3K5", "duplicate_aware_weight_consistency", "CMS_DMBAG", left_table="CMS_DMBAG", left_column="DMBAG_WEIGHT", right_table="CMS_MFBAG", right_column="MFBAG_ACT_WEIGHT", left_join_key="DMBAG_BAG_NO", right_join_key="MFBAG_NO", duplicate_key="DMBAG_NO", cnote_column="DMBAG_NO", duplicate_threshold=50, decimals=0),
    rule("CONS4L6", "aggregate_count_consistency", "CMS_MMBAG", master_table="CMS_MMBAG", master_key="MMBAG_NO", master_count_column="MMBAG_QTY", detail_table="CMS_MFCNOTE", detail_key="DMBAG_NO", detail_count_column="MFCNOTE_NO", joins=[join("CMS_DMBAG", "MFCNOTE_BAG_NO", "DMBAG_BAG_NO")], cnote_column="MMBAG_NO"),
)


def _describe(family: str, table: str, params: Mapping[str, Any]) -> str:
    named = ("column", "left_column", "start_column", "child_column", "master_column", "master_value_column", "master_count_column")
    what = ", ".join(str(params[k]) for k in named if k in params) or ", ".join(params.get("columns", []))
    said = {"completeness": "must not be null or empty", "uniqueness": "must be unique", "validity_datetime": "must be a timestamp", "validity_integer": "must be a whole number"}
    return f"{table}.{what} {said.get(family, family.replace('_', ' '))}" if what else f"{table}: {family.replace('_', ' ')}"


def _spec(code: str, family: str, table: str, params: dict[str, Any]) -> RuleSpec:
    issue, impact, details = TEXTS.get(code, (NONE, NONE, NONE))
    return RuleSpec(code, family, table, params, ELEMENTS[code[:4]], indicator_of(code, params), _describe(family, table, params), issue, impact, details)


def _column_rules() -> Iterable[RuleSpec]:
    for own in COLUMNS:
        for kind, checks in own.checks.items():
            for number, check in checks.items():
                params = dict(check) if isinstance(check, dict) else {"family": KINDS[kind], "column": check}
                family = params.pop("family")
                yield _spec(f"{kind}{own.letters}{number}", family, own.table, {"cnote_column": own.document} | params)


def load(texts: Mapping[str, Mapping[str, str]] | None = None, carrier: str = "Carrier") -> list[RuleSpec]:
    """All rules. texts: other fields of rules by code, such as their issue or impact. carrier: the company's name in the texts."""
    texts = texts or {}
    named = lambda r: replace(r, issue=r.issue.format(carrier=carrier), impact_details=r.impact_details.format(carrier=carrier))
    rules = (*_column_rules(), *(_spec(*r) for r in RULES))
    return [replace(named(r), **texts.get(r.code, {})) for r in rules]


def by_code(rules: Iterable[RuleSpec], *codes: str) -> list[RuleSpec]:
    return [r for r in rules if r.code in codes]


def kind_of(code: str) -> str:
    """The kind of check in a code: COMP1 of COMP1B12."""
    return re.match(r"[A-Z]+\d+", code)[0]
