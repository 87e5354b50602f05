"""Texts of rules: indicators by rule of the column, issues and impacts by code. {carrier} stands for the company whose shipments are looked at."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

#: What a rule has whose text isn't settled.
NONE = "TBD"

#: Indicators by kind of check, then by what the column's name holds; the first that fits. The names.
_BY_KIND = {"VALD13": "Zone Code", "VALD8": "Flag", "VALD10": "Flag", "VALD4": "Timestamp", "TIME1": "Timestamp", "UNIQ1": "Unique Identifier", "UNIQ2": "Unique Identifier"}
_BY_CODE = {"VALD3S4": "Flag", "COMP1S4": "Status", "COMP1R5": "Status", "COMP2AB11": "Timestamp", "COMP1E5": "Timestamp", "COMP1V10": "Timestamp", "COMP2L12": "Timestamp", "COMP4J1": "Unique Identifier"}
_BY_COLUMN = (
    (r"ZIP$", "Zip Code"),
    (r"GOODS_TYPE$", "Package Type"),
    (r"SHIPPER_(NAME|ADDR\d)$", "Package Detail"),
    (r"EPAY_DEVICE$", "Payment Type"),
    (r"AMOUNT$|GOODS_VALUE$", "Payment Amount"),
    (r"MANIFEST_CODE$", "Manifest Type"),
    (r"_MODA$", "Mode Transport"),
    (r"^APICUST_CUST_NO$", "Customer Number"),
    (r"^DSMU_FLIGHT_NO$", "Flight No"),
    (r"^DRSHEET_RECEIVER$", "Receiver Name"),
    (r"^CNOTE_POD_RECEIVER$", "User ID"),
    (r"ZONE", "Zone Code"),
    (r"(DATE|TIME|ETA|ETD|HOURS)$|_DATE_APPROVE$", "Timestamp"),
    (r"WEIGHT$", "Weight"),
    (r"QTY$", "Quantity"),
    (r"(UID|UID_DR|USER\d?|USER_ID|USER_APPROVE|COURIER_ID)$", "User ID"),
    (r"BRANCH(_ID)?$", "Branch ID"),
    (r"(ORIGIN|ORIG|FROM)$", "Origin"),
    (r"(DESTINATION|DEST|THRU)$", "Destination"),
    (r"SERVICE(S_CODE)?$", "Service Code"),
    (r"ROUTE(_CODE)?$", "Route Code"),
    (r"(STATUS|CANCELED)$", "Status"),
    (r"(APPROVE|APPROVED|APPROVED_DR|HRS|CYCLE|UNDEL|FLAG|CONFIRM|DELIVERED|COD)$", "Flag"),
)


def indicator_of(code: str, params: Mapping[str, Any]) -> str:
    """What a rule looks at: told by its code or kind, else by its column's name; numbers are identifiers."""
    kind = re.match(r"[A-Z]+\d+", code)[0]
    if found := _BY_CODE.get(code) or _BY_KIND.get(kind):
        return found
    names = ("column", "left_column", "start_column", "master_value_column", "master_column", "master_count_column")
    column = next((str(params[n]) for n in names if params.get(n)), "")
    return next((text for pattern, text in _BY_COLUMN if re.search(pattern, column)), "Unique Identifier")


#: Issue, main impact and its details of the rules that have them, in the catalog's order.
TEXTS = {
    "COMP1A6": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1A7": ("Mandatory Field - Blank", "Billing", "Over-billing/Under-billing"),
    "COMP1A24": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1A25": ("Mandatory Field - Blank", "Billing", "Under-billing"),
    "VALD1A3": ("Origin Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD1A6": ("Service Code Does Not Exist in CMS DROURATE Service Reference", NONE, NONE),
    "VALD2A25": ("Weight Rounding", "Billing", "Over-billing/Under-billing"),
    "VALD9A11": ("Invalid Zip Code Format", NONE, NONE),
    "VALD9A19": ("Invalid Zip Code Format", NONE, NONE),
    "COMP1B14": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1B15": ("Mandatory Field - Blank", "Billing", "Under-billing"),
    "COMP1B18": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1B6": ("Invalid Service Code Format", NONE, NONE),
    "VALD2B15": ("Weight Rounding", "Billing", "Over-billing/Under-billing"),
    "UNIQ1B74": ("Duplicate Identifier", NONE, NONE),
    "COMP1R5": ("Mandatory Field - Blank", NONE, NONE),
    "VALD8R5": ("Invalid Delivered/Flag Format", NONE, NONE),
    "VALD11R4": ("Invalid Status Format", NONE, NONE),
    "UNIQ2R1": ("Duplicate Identifier", NONE, NONE),
    "COMP1AE4": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1AE5": ("Mandatory Field - Blank", "Reporting", "Understated weight"),
    "COMP1AE6": ("Mandatory Field - Blank", "Operation", "Internal Dispute"),
    "COMP1AE8": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1AE9": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1AE10": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1AE8": ("Service Code Does Not Exist in CMS DROURATE Service Reference", NONE, NONE),
    "VALD2AE5": ("Weight Rounding", "Billing", "Over-billing/Under-billing"),
    "COMP1AC4": ("Mandatory Field - Blank", NONE, NONE),
    "UNIQ2AC1": ("Duplicate Identifier", NONE, NONE),
    "UNIQ2W1": ("Duplicate Identifier", NONE, NONE),
    "COMP1S4": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1S8": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1S11": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1S17": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1S19": ("Mandatory Field - Blank", NONE, NONE),
    "VALD11S19": ("Invalid Status Format", NONE, NONE),
    "UNIQ1S2": ("Duplicate Identifier", NONE, NONE),
    "UNIQ2S1": ("Duplicate Identifier", NONE, NONE),
    "COMP1K1": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1K3": ("Origin Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD1K4": ("Destination Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD2K5": ("Weight Rounding", "Billing", "Over-billing/Under-billing"),
    "UNIQ1K1": ("Duplicate Identifier", NONE, NONE),
    "COMP1D3": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1P5": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1P7": ("Mandatory Field - Blank", NONE, NONE),
    "VALD8P6": ("Invalid Delivered/Flag Format", NONE, NONE),
    "VALD11P4": ("Invalid Status Format", NONE, NONE),
    "VALD13P7": ("User/Zone Code Does Not Exist in ORA_ZONE", NONE, NONE),
    "UNIQ2P1": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1O1": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1O2": ("Duplicate Identifier", NONE, NONE),
    "VALD1M6": ("Origin Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD1M7": ("Destination Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "UNIQ1M4": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1G1": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1G2": ("Duplicate Identifier", NONE, NONE),
    "COMP1H8": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1H5": ("Origin Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD1H6": ("Destination Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD1H9": ("Origin Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "COMP1J3": ("Mandatory Field - Blank", "Reporting", "Understated weight"),
    "COMP1J4": ("Mandatory Field - Blank", "Reporting", "Understated weight"),
    "COMP1I4": ("Mandatory Field - Blank", "Reporting", "Understated weight"),
    "VALD2I4": ("Weight Rounding", "Billing", "Over-billing/Under-billing"),
    "UNIQ2I1": ("Duplicate Identifier", NONE, NONE),
    "COMP1AB10": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1E2": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1E7": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1E11": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1V10": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1L10": ("Mandatory Field - Blank", NONE, NONE),
    "COMP2L11": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1L3": ("Origin Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "VALD1L4": ("Destination Code Does Not Exist in Route Reference", "Operation", "Internal Dispute"),
    "COMP1Q5": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1Q8": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1Z11": ("Destination Zone Code Does Not Exist in ORA_ZONE", "Operation", "Internal Dispute"),
    "VALD1Z12": ("Origin Zone Code Does Not Exist in ORA_ZONE", "Operation", "Internal Dispute"),
    "COMP1N12": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1N15": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1N16": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1N17": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1N18": ("Mandatory Field - Blank", NONE, NONE),
    "COMP1N19": ("Mandatory Field - Blank", NONE, NONE),
    "VALD1N3": ("Origin Branch Code Does Not Exist in ORA_BRANCH", "Operation", "Internal Dispute"),
    "VALD1N4": ("Destination Branch Code Does Not Exist in ORA_BRANCH", "Operation", "Internal Dispute"),
    "UNIQ1N1": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1AD1": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1AD3": ("Duplicate Identifier", NONE, NONE),
    "UNIQ1AD6": ("Duplicate Identifier", NONE, NONE),
    "CONS1B15": ("Weight Difference (CMS Cnote Weight vs Apicust Weight)", "Billing", "Seller & {carrier} Dispute"),
    "CONS1B12": ("Origin Difference (Marketplace Seller vs {carrier})", "Operation", "Internal Dispute"),
    "CONS1B13": ("Destination Difference (Marketplace vs CMS Cnote)", "Billing", "Over-billing/Under-billing"),
    "CONS1B14": ("Quantity Difference (Marketplace Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS1B3": ("Branch Difference (Marketplace Seller vs {carrier})", NONE, NONE),
    "CONS2R2": ("Timestamp Difference (POD Date vs Runsheet Date)", NONE, NONE),
    "CONS2R4": ("Status Difference (POD Status vs Runsheet Status)", NONE, NONE),
    "CONS2Y5": ("Quantity Difference (DTS Agent Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2Y8": ("Service Code Difference (DTS Agent Service Code vs CMS Cnote Service Code)", NONE, NONE),
    "CONS2AE4": ("Quantity Difference (Handover Bag Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2AE6": ("Destination Difference (Handover Bag vs CMS Cnote)", "Operation", "Internal Dispute"),
    "CONS2AC4": ("Quantity Difference (Inbound Handover Cnote Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2F6": ("Quantity Difference (Inbound Handover Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2W4": ("Quantity Difference (Outbound Handover Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2S8": ("Quantity Difference (Handover Runsheet Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2D3": ("Quantity Difference (DRCNOTE Quantity vs CMS Cnote Quantity)", NONE, NONE),
    "CONS2M2": ("Flight Number Difference (SMU Detail Flight No vs SMU Master Flight No)", NONE, NONE),
    "CONS2M6": ("Origin Difference (SMU Bag Origin vs Detail Bag Origin)", "Operation", "Internal Dispute"),
    "CONS2M7": ("Destination Difference (SMU Bag Destination vs Detail Bag Destination)", "Operation", "Internal Dispute"),
    "CONS2L3": ("Origin Difference (Master Bag Origin vs Detail Bag Origin)", "Operation", "Internal Dispute"),
    "CONS2L4": ("Destination Difference (Master Bag Destination vs Detail Bag Destination)", "Operation", "Internal Dispute"),
    "TIME1B2": ("Timestamp Sequence Issue", NONE, NONE),
    "TIME1C9": ("Timestamp Sequence Issue", NONE, NONE),
    "CONS2N3": ("Origin Difference (SMU Master Origin vs SMU Detail Bag Origin)", "Operation", "Internal Dispute"),
    "CONS2N4": ("Destination Difference (SMU Master Destination vs SMU Detail Bag Destination)", "Operation", "Internal Dispute"),
    "ACCU3B13B": ("Prefix Destination Code Difference (CMS Cnote vs DCorrect Destination)", "Billing", "Over-billing/Under-billing"),
    "COMP2V19": ("Mandatory Field - Blank", NONE, NONE),
    "COMP2V9": ("Mandatory Field - Blank", NONE, NONE),
    "COMP2Z10": ("Mandatory Field - Blank", NONE, NONE),
    "COMP2H4": ("Mandatory Field - Blank", NONE, NONE),
    "COMP2H6": ("Mandatory Field - Blank", "Operation", "Internal Dispute"),
    "COMP2H9": ("Mandatory Field - Blank", "Operation", "Internal Dispute"),
    "COMP2R3": ("Mandatory Field - Blank", NONE, NONE),
    "COMP2L12": ("Mandatory Field - Blank", NONE, NONE),
    "CONS2I4": ("Weight Difference (MFCnote Weight vs CMS Cnote Weight)", "Reporting", "Internal Dispute"),
    "CONS2Y6": ("Weight Difference (DTS Agent Weight vs CMS Cnote Weight)", "Reporting", "Internal Dispute"),
    "CONS2AE5": ("Weight Difference (Handover Bag in Cabang Weight vs Cnote Weight)", "Reporting", "Internal Dispute"),
    "CONS2M5": ("Weight Difference (SMU Detail Weight vs Detail Bag Weight)", "Reporting", "Internal Dispute"),
    "TIME1H15 (OM)": ("Manifest Timestamp Sequence Issue", NONE, NONE),
    "COMP4J1": ("Transit Manifest Required When Origin Differs", NONE, NONE),
    "VALD10S5": ("Invalid Flag Value", NONE, NONE),
    "CONS2L7": ("Weight Difference (Master Bag Weight vs Detail Bag Weight Sum)", "Reporting", "Internal Dispute"),
    "CONS3J3": ("Weight Difference (Manifest Bag Actual Weight vs MFCnote Weight Sum)", "Reporting", "Internal Dispute"),
    "CONS3J4": ("Weight Difference (Manifest Bag CTC Weight vs MFCnote Weight Sum)", "Reporting", "Internal Dispute"),
    "CONS3N10": ("Weight Difference (SMU Master Weight vs MFCnote Weight Sum)", "Reporting", "Internal Dispute"),
    "CONS4N9": ("Quantity Difference (SMU Quantity vs DSMU Bag Count)", NONE, NONE),
    "ACCU5A6": ("Service Code Does Not Exist (APICUST Service Code vs CMS DROURATE Service)", NONE, NONE),
    "ACCU6B6": ("Service Code Does Not Exist (CMS Cnote Service Code vs CMS DROURATE Service)", NONE, NONE),
    "ACCU4B15": ("Package is weighted again due to volumetric weight issues", "Billing", "Potential Revenue Loss"),
    "COMP2P6": ("Mandatory Field - Blank", NONE, NONE),
    "TIME1I9 (OM)": ("Manifest Timestamp Sequence Issue", NONE, NONE),
    "TIME1I9 (TM)": ("Manifest Timestamp Sequence Issue", NONE, NONE),
    "TIME1I9 (IM)": ("Manifest Timestamp Sequence Issue", NONE, NONE),
    "CONS2C3": ("Branch Difference (MRCNOTE Branch vs CMS Cnote Branch)", NONE, NONE),
    "CONS2K3": ("Origin Difference (Detail Bag Origin vs Manifest From)", "Operation", "Internal Dispute"),
    "CONS2K4": ("Destination Difference (Detail Bag Destination vs Manifest Thru)", "Operation", "Internal Dispute"),
    "CONS2X4": ("Destination Difference (MTS Agent Destination vs CMS Cnote Destination)", "Operation", "Internal Dispute"),
    "CONS2X5": ("Weight Difference (MTS Agent CTC Weight vs MFCnote Weight)", "Reporting", "Internal Dispute"),
    "CONS2X6": ("Weight Difference (MTS Agent Actual Weight vs CMS Cnote Weight)", "Reporting", "Internal Dispute"),
    "CONS3K5": ("Weight Difference (Detail Bag Weight vs Manifest Bag Weight)", "Reporting", "Internal Dispute"),
    "CONS4L6": ("Quantity Difference (Master Bag Quantity vs MFCnote Count)", NONE, NONE),
}
