"""Document links: which shipments an operational document concerns, along paths of key tables.

An edge list (document_type, source_table, document_id, cnote_no, link_method), never a map in one process. Keys are
text without white space at the ends; blank keys link nothing. Paths are united, made distinct, and restricted to the
shipments of the anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.values import key

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Path:
    """From `start` (its document column) over hops (table, own key, key of the table before) to `shipment` of the last table."""

    source: str
    start: str
    document: str
    shipment: str
    hops: tuple[tuple[str, str, str], ...] = ()
    method: str = ""

    def tables(self) -> set[str]:
        return {self.start, *(t for t, _, _ in self.hops)}


_BAGS = ("CMS_MFCNOTE", "MFCNOTE_BAG_NO")
_DMBAG = ("CMS_DMBAG", "DMBAG_NO")
PATHS = (
    Path("CMS_MFCNOTE", "CMS_MFCNOTE", "MFCNOTE_NO", "MFCNOTE_NO"),
    Path("CMS_MFBAG", "CMS_MFCNOTE", "MFCNOTE_BAG_NO", "MFCNOTE_NO"),
    Path("CMS_DMBAG", "CMS_MFCNOTE", "MFCNOTE_BAG_NO", "MFCNOTE_NO"),
    Path("CMS_MANIFEST", "CMS_MFCNOTE", "MFCNOTE_MAN_NO", "MFCNOTE_NO"),
    Path("CMS_DMBAG", "CMS_DMBAG", "DMBAG_NO", "MFCNOTE_NO", ((*_BAGS, "DMBAG_BAG_NO"),)),
    Path("CMS_MMBAG", "CMS_MMBAG", "MMBAG_NO", "MFCNOTE_NO", ((*_BAGS, "MMBAG_NO"),)),
    Path("CMS_MMBAG", "CMS_MMBAG", "MMBAG_NO", "MFCNOTE_NO", ((*_DMBAG, "MMBAG_NO"), (*_BAGS, "DMBAG_BAG_NO"))),
    Path("CMS_MRSHEET", "CMS_DRSHEET", "DRSHEET_NO", "DRSHEET_CNOTE_NO"),
    Path("CMS_MHICNOTE", "CMS_DHICNOTE", "DHICNOTE_NO", "DHICNOTE_CNOTE_NO"),
    Path("CMS_MHI_HOC", "CMS_DHI_HOC", "DHI_NO", "DHI_CNOTE_NO"),
    Path("CMS_MHOCNOTE", "CMS_DHOCNOTE", "DHOCNOTE_NO", "DHOCNOTE_CNOTE_NO"),
    Path("CMS_MHOUNDEL_POD", "CMS_DHOUNDEL_POD", "DHOUNDEL_NO", "DHOUNDEL_CNOTE_NO"),
    Path("CMS_DSMU", "CMS_DSMU", "DSMU_NO", "MFCNOTE_NO", ((*_BAGS, "DSMU_BAG_NO"),)),
    Path("CMS_DSMU", "CMS_DSMU", "DSMU_NO", "MFCNOTE_NO", ((*_DMBAG, "DSMU_BAG_NO"), (*_BAGS, "DMBAG_BAG_NO"))),
    Path("CMS_MSMU", "CMS_MSMU", "MSMU_NO", "MFCNOTE_NO", (("CMS_DSMU", "DSMU_NO", "MSMU_NO"), (*_BAGS, "DSMU_BAG_NO"))),
    Path("CMS_MSMU", "CMS_MSMU", "MSMU_NO", "MFCNOTE_NO", (("CMS_DSMU", "DSMU_NO", "MSMU_NO"), (*_DMBAG, "DSMU_BAG_NO"), (*_BAGS, "DMBAG_BAG_NO"))),
    Path("CMS_DSJ", "CMS_DSJ", "DSJ_NO", "DHICNOTE_CNOTE_NO", (("CMS_RDSJ", "RDSJ_HVO_NO", "DSJ_HVO_NO"), ("CMS_DHICNOTE", "DHICNOTE_NO", "RDSJ_HVI_NO"))),
    Path("CMS_RDSJ", "CMS_RDSJ", "RDSJ_NO", "DHOCNOTE_CNOTE_NO", (("CMS_DHOCNOTE", "DHOCNOTE_NO", "RDSJ_HVO_NO"),)),
    Path("CMS_MSJ", "CMS_MSJ", "MSJ_NO", "DHICNOTE_CNOTE_NO", (("CMS_DSJ", "DSJ_NO", "MSJ_NO"), ("CMS_RDSJ", "RDSJ_HVO_NO", "DSJ_HVO_NO"), ("CMS_DHICNOTE", "DHICNOTE_NO", "RDSJ_HVI_NO"))),
)


def sources_of(available: Callable[[str], bool] = lambda _: True, paths: tuple[Path, ...] = PATHS) -> set[str]:
    """The tables whose documents have links: those with a path all of whose tables are there."""
    return {p.source for p in paths if all(map(available, p.tables()))}


def key_tables(tables: Tables, available: Callable[[str], bool] = lambda _: True, paths: tuple[Path, ...] = PATHS) -> Tables:
    """The key columns of each table that paths need, as text, distinct: the same rows whatever the path, so that plans share them."""
    need: dict[str, set[str]] = {}
    for path in paths:
        later = {b for _, _, b in path.hops} | {path.shipment, path.document}
        for table, own in ((path.start, path.document), *((t, o) for t, o, _ in path.hops)):
            if available(table):
                need.setdefault(table, set()).update(c for c in tables(table).columns if c in later | {own})
    made = {t: tables(t).select(*(key(F.col(c)).alias(c) for c in sorted(names))).distinct() for t, names in need.items()}
    return made.__getitem__


def along(path: Path, tables: Tables, keyed: bool = False, repeated: bool = False) -> DataFrame:
    """(document_id, cnote_no) of one path; each hop reads its two or three key columns, distinct, so fan-out stays that of the keys.

    keyed: the tables are key_tables, whose rows need no second reduction where a path reads all their columns.
    repeated: a path without hops gives its rows as they are; who reads them makes them distinct.
    """
    later = {b for _, _, b in path.hops} | {path.shipment, path.document}

    def keys(table: str, *own: str) -> DataFrame:
        rows = tables(table)
        names = [c for c in rows.columns if c in later or c in own]
        if keyed and names == rows.columns:
            return rows
        rows = rows.select(*(key(F.col(c)).alias(c) for c in names))
        return rows if repeated and not path.hops else rows.distinct()

    rows = keys(path.start, path.document)
    for table, own, before in path.hops:
        side = keys(table, own)
        side = side.select(*(F.col(c).alias(f"_{c}") for c in side.columns))
        rows = rows.where(F.col(before) != "").join(side, F.col(before) == F.col(f"_{own}"))
        rows = rows.select(*(F.col(c) for c in rows.columns if not c.startswith("_") and f"_{c}" not in side.columns), *(F.col(c).alias(c[1:]) for c in side.columns))
    return rows.select(F.col(path.document).alias("document_id"), F.col(path.shipment).alias("cnote_no")).where("document_id <> '' AND cnote_no <> ''")


def build_links(tables: Tables, available: Callable[[str], bool] = lambda _: True, paths: tuple[Path, ...] = PATHS, sources: Iterable[str] | None = None, restricted: bool = True) -> DataFrame:
    """Links of all paths whose tables there are. sources: the tables whose documents are linked, if not all.

    restricted: distinct links to the anchor's shipments. If not, links may repeat and name others, for a reader that
    takes them to the shipments anyway (`enriched`); then they needn't move for that here.
    """
    paths = paths if sources is None else tuple(p for p in paths if p.source in set(sources))
    parts, keys = [], key_tables(tables, available, paths)
    for path in paths:
        if all(map(available, path.tables())):
            kind = path.source.removeprefix("CMS_")
            rows = along(path, keys, keyed=True) if restricted or path.hops else along(path, tables, repeated=True)
            parts.append(rows.select(F.lit(kind).alias("document_type"), F.lit(path.source).alias("source_table"), "document_id", "cnote_no", F.lit(f"{path.source.lower()}_bridge").alias("link_method")))
    if not parts:
        raise ValueError("no path has all its tables")
    if not restricted:
        return reduce(DataFrame.unionByName, parts)
    universe = tables("CMS_CNOTE").select(key(F.col("CNOTE_NO")).alias("cnote_no")).distinct()
    return reduce(DataFrame.unionByName, parts).distinct().join(universe, "cnote_no", "left_semi").select("document_type", "source_table", "document_id", "cnote_no", "link_method")
