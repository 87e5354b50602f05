"""Classifications of a shipment by its origin, destination and service."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import key

#: The region of each branch prefix.
REGION_OF = {
    "AMI": "JTBNN",
    "AMQ": "Sulampapua",
    "BDJ": "Kalimantan",
    "BDO": "Jawa Barat",
    "BKI": "Bodetabekcikcil",
    "BKS": "Sumbagsel",
    "BOO": "Bodetabekcikcil",
    "BPN": "Kalimantan",
    "BTG": "Kalimantan",
    "BTH": "Sumbagut",
    "BTJ": "Sumbagut",
    "CBN": "Jawa Barat",
    "CGK": "Jakarta",
    "CKR": "Bodetabekcikcil",
    "CLG": "Bodetabekcikcil",
    "CXP": "Jawa Tengah",
    "DJB": "Sumbagsel",
    "DJJ": "Sulampapua",
    "DPK": "Bodetabekcikcil",
    "DPS": "JTBNN",
    "DTB": "Sumbagut",
    "GRT": "Jawa Barat",
    "GTO": "Sulampapua",
    "JBR": "JTBNN",
    "JOG": "Jawa Tengah",
    "KDI": "Sulampapua",
    "KDR": "JTBNN",
    "KOE": "JTBNN",
    "KRW": "Jawa Barat",
    "LBJ": "JTBNN",
    "MDC": "Sulampapua",
    "MDN": "JTBNN",
    "MES": "Sumbagut",
    "MGL": "Jawa Tengah",
    "MJK": "JTBNN",
    "MKQ": "Sulampapua",
    "MKW": "Sulampapua",
    "MXG": "JTBNN",
    "PBL": "JTBNN",
    "PDG": "Sumbagut",
    "PGK": "Sumbagsel",
    "PKU": "Sumbagut",
    "PKY": "Kalimantan",
    "PLM": "Sumbagsel",
    "PLW": "Sulampapua",
    "PNK": "Kalimantan",
    "PSR": "JTBNN",
    "PWT": "Jawa Barat",
    "SDA": "JTBNN",
    "SMD": "Kalimantan",
    "SMI": "Jawa Barat",
    "SOC": "Jawa Tengah",
    "SOQ": "Sulampapua",
    "SRG": "Jawa Tengah",
    "SUB": "JTBNN",
    "TGL": "Jawa Tengah",
    "TGR": "Bodetabekcikcil",
    "TIM": "Sulampapua",
    "TJQ": "Sumbagsel",
    "TKG": "Sumbagsel",
    "TNJ": "Sumbagut",
    "TRK": "Kalimantan",
    "TSM": "Jawa Barat",
    "TTE": "Sulampapua",
    "UPG": "Sulampapua",
}
#: Service prefixes with a bucket of their own.
SERVICES = ("YES", "OKE", "JTR", "REG")
OTHER = "Other"


def branch_region(place: Column) -> Column:
    regions = F.create_map(*(F.lit(x) for x in chain.from_iterable(REGION_OF.items())))
    return F.coalesce(F.try_element_at(regions, F.substring(F.upper(key(place)), 1, 3)), F.lit(OTHER))


def service_bucket(service: Column) -> Column:
    prefix = F.substring(F.upper(key(service)), 1, 3)
    return F.when(prefix.isin(*SERVICES), prefix).otherwise(OTHER)


def shipment_scope(origin: Column, destination: Column) -> Column:
    """By the city code (three letters) and the digit after it. A null place isn't unknown but falls to Domestic."""
    up = [F.upper(F.trim(c)) for c in (origin, destination)]
    (o_city, d_city), (o_digit, d_digit) = ([F.regexp_extract(c, p, 1) for c in up] for p in ("^([A-Z]{3})", "^[A-Z]{3}([0-9])"))
    unknown = (o_city == "") | (d_city == "") | (o_digit == "") | (d_digit == "")
    return F.when(unknown, "Unknown").when((o_city == d_city) & (o_digit == d_digit), "Intracity").when(o_city == d_city, "Intercity").otherwise("Domestic")


def delivery_category(kind: Column, scope: Column) -> Column:
    return F.when((scope == "Domestic") & kind.isin("Transit", "Direct"), F.concat(kind, F.lit(" Domestic"))).otherwise(scope)


def order_type(api_type: Column, origin: Column, destination: Column) -> Column:
    """The order system's own split: whole codes first, then the city code."""
    return (
        F.when(F.upper(api_type.cast("string")) == "INTERNATIONAL", "Intl")
        .when(origin == destination, "Intracity")
        .when(F.substring(origin.cast("string"), 1, 3) == F.substring(destination.cast("string"), 1, 3), "Intercity")
        .otherwise("Domestic")
    )


def route_parts(route: Column) -> tuple[Column, Column, Column]:
    """Origin and destination of a route of two place codes, and whether it is one."""
    pattern = "^([A-Z]{3}[0-9]{5})([A-Z]{3}[0-9]{5})$"
    return F.regexp_extract(route, pattern, 1), F.regexp_extract(route, pattern, 2), F.coalesce(route.rlike(pattern), F.lit(False))
