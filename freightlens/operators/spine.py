"""The spine: one row per shipment with its first events, counts, durations and classes.

Every event side is reduced to one row per shipment before it is joined, so the joins can't multiply rows and the
spine has as many rows as the anchor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.classes import delivery_category, shipment_scope
from freightlens.functions.events import earliest
from freightlens.functions.values import hours_between, moment, whole

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class FirstEvent:
    """The earliest `date` of a detail table's shipments, or of the masters that its details point to."""

    name: str
    detail: str
    shipment: str
    date: str
    master: str = ""
    on: tuple[str, str] = ("", "")

    def side(self, tables: Tables) -> DataFrame:
        rows = tables(self.detail)
        if self.master:
            rows = rows.join(tables(self.master), F.col(self.on[0]) == F.col(self.on[1]))
        return earliest(rows, self.shipment, moment(F.col(self.date)), self.name)


FIRST_EVENTS = (
    FirstEvent("pickup", "CMS_DRCNOTE", "DRCNOTE_CNOTE_NO", "MRCNOTE_DATE", "CMS_MRCNOTE", ("DRCNOTE_NO", "MRCNOTE_NO")),
    FirstEvent("hoc_approved", "CMS_DHI_HOC", "DHI_CNOTE_NO", "MHI_APPROVE_DATE", "CMS_MHI_HOC", ("DHI_NO", "MHI_NO")),
    FirstEvent("bagged", "CMS_MFCNOTE", "MFCNOTE_NO", "MFBAG_CRDATE", "CMS_MFBAG", ("MFCNOTE_BAG_NO", "MFBAG_NO")),
    FirstEvent("handed_in", "CMS_DHICNOTE", "DHICNOTE_CNOTE_NO", "DHICNOTE_TDATE"),
    FirstEvent("handed_out", "CMS_DHOCNOTE", "DHOCNOTE_CNOTE_NO", "DHOCNOTE_TDATE"),
    FirstEvent("handover", "CMS_DHOCNOTE", "DHOCNOTE_CNOTE_NO", "MHOCNOTE_DATE", "CMS_MHOCNOTE", ("DHOCNOTE_NO", "MHOCNOTE_NO")),
    FirstEvent("runsheet", "CMS_DRSHEET", "DRSHEET_CNOTE_NO", "MRSHEET_DATE", "CMS_MRSHEET", ("DRSHEET_NO", "MRSHEET_NO")),
    FirstEvent("delivered", "CMS_CNOTE_POD", "CNOTE_POD_NO", "CNOTE_POD_DATE"),
)

#: The columns that the spine adds to the anchor's, in order.
ADDED = (
    "cms_cnote_create_date", "cms_mrcnote_create_date", "cms_mhi_hoc_approve_date", "cms_receival_create_date", "cms_mfbag_create_date",
    "cms_mhocnote_create_date", "cms_mrsheet_create_date", "cms_cnote_pod_create_date", "delivery_type", "shipment_scope",
    "transit_manifest_count", "handover_count", "sla_total_hours", "total_duration_hour_to_receival", "total_duration_hour_to_manifest",
    "total_duration_hour_to_handover", "total_duration_hour_to_runsheet", "total_duration_hour_to_delivery", "delivery_category",
)


def transit_legs(tables: Tables) -> DataFrame:
    """(_key, legs): manifests of code 3 of each shipment."""
    rows = tables("CMS_MFCNOTE").join(tables("CMS_MANIFEST"), F.col("MFCNOTE_MAN_NO") == F.col("MANIFEST_NO"))
    return rows.where((whole(F.col("MANIFEST_CODE")) == 3) & F.col("MFCNOTE_NO").isNotNull()).groupBy(F.col("MFCNOTE_NO").alias("_key")).agg(F.count(F.lit(1)).alias("legs"))


def build_spine(tables: Tables) -> DataFrame:
    anchor = tables("CMS_CNOTE")
    rows = anchor
    for side in (transit_legs(tables), *(e.side(tables) for e in FIRST_EVENTS)):
        rows = rows.join(side, F.col("CNOTE_NO") == F.col("_key"), "left").drop("_key")
    created, legs = moment(F.col("CNOTE_CRDATE")), F.coalesce("legs", F.lit(0))
    received = F.coalesce("pickup", "hoc_approved")
    flag = lambda c: F.when(c.isNotNull(), 1).otherwise(0)
    col = F.col
    kind = F.when(col("legs").isNotNull(), "Transit").otherwise("Direct")
    scope = shipment_scope(col("CNOTE_ORIGIN"), col("CNOTE_DESTINATION"))
    values: list[Column] = [
        created, col("pickup"), col("hoc_approved"), received, col("bagged"), col("handover"), col("runsheet"), col("delivered"), kind, scope, legs,
        legs + flag(received) + flag(col("handed_in")) + flag(col("handed_out")) + flag(col("runsheet")),
        hours_between(received, col("delivered")),
        hours_between(created, received),
        hours_between(received, col("bagged")),
        hours_between(F.coalesce(col("bagged"), received), col("handover")),
        hours_between(F.coalesce(col("handover"), col("bagged"), received), col("runsheet")),
        hours_between(col("runsheet"), col("delivered")),
        delivery_category(kind, scope),
    ]
    return rows.select(*(F.col(f"`{c}`") for c in anchor.columns), *(v.alias(n) for v, n in zip(values, ADDED, strict=True)))


def classification_matrix(spine: DataFrame) -> DataFrame:
    classes = ["delivery_type", "shipment_scope", "delivery_category"]
    return spine.groupBy(*classes).agg(F.count(F.lit(1)).alias("n")).orderBy(*classes)


def quality_counts() -> dict[str, Column]:
    """Aggregates over a spine that its writing job can take along (see write_table)."""
    return {"unknown": F.count_if(F.col("shipment_scope") == "Unknown")}


def judged_quality(rows: int, unknown: int, anchor_rows: int) -> dict:
    """Rows, the share of unknown scopes, and what is wrong: a row count unlike the anchor's, over 1 % unknown."""
    share = unknown / rows if rows else 0.0
    wrong = ([f"the spine has {rows} rows, the anchor {anchor_rows}"] if rows != anchor_rows else []) + ([f"{share:.1%} of scopes are unknown"] if share > 0.01 else [])
    return {"rows": rows, "unknown_share": share, "wrong": wrong}


def quality_of(spine: DataFrame, anchor_rows: int) -> dict:
    r = spine.agg(F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in quality_counts().items())).first()
    return judged_quality(r.n, r.unknown, anchor_rows)
