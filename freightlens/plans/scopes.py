"""Scopes: the key sets that carry the anchor's date window along foreign keys to all other tables."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import DateWindow

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class SourceTable:
    """A table of the source: its stage, and by which column and scope its rows are restricted, within which dates."""

    name: str
    stage: str
    column: str = ""
    scope: str = ""
    guard: str = ""


#: The source tables.
_TABLES = (
    SourceTable("CMS_CNOTE", "anchor"),
    SourceTable("CMS_APICUST", "cnote", column="APICUST_CNOTE_NO", scope="CNOTE"),
    SourceTable("T_CANCEL_CNOTE_API", "cnote", column="API_CNOTE_NO", scope="CNOTE", guard="CREATE_DATE"),
    SourceTable("CMS_CNOTE_AMO", "cnote", column="CNOTE_NO", scope="CNOTE", guard="CDATE"),
    SourceTable("CMS_DRCNOTE", "cnote", column="DRCNOTE_CNOTE_NO", scope="CNOTE"),
    SourceTable("CMS_MRCNOTE", "cnote", column="MRCNOTE_NO", scope="DRCNOTE", guard="MRCNOTE_DATE"),
    SourceTable("CMS_DHI_HOC", "cnote", column="DHI_CNOTE_NO", scope="CNOTE", guard="CDATE"),
    SourceTable("CMS_MHI_HOC", "cnote", column="MHI_NO", scope="DHI_HOC", guard="MHI_DATE"),
    SourceTable("CMS_DSTATUS", "cnote", column="DSTATUS_CNOTE_NO", scope="CNOTE", guard="CREATE_DATE"),
    SourceTable("CMS_CNOTE_POD", "cnote", column="CNOTE_POD_NO", scope="CNOTE", guard="CNOTE_POD_DATE"),
    SourceTable("CMS_DHOV_RSHEET", "cnote", column="DHOV_RSHEET_CNOTE", scope="CNOTE", guard="CREATE_DATE"),
    SourceTable("CMS_MHOV_RSHEET", "cnote", column="MHOV_RSHEET_NO", scope="HOV_RSHEET", guard="CREATE_DATE"),
    SourceTable("CMS_DHOUNDEL_POD", "cnote", column="DHOUNDEL_CNOTE_NO", scope="CNOTE", guard="CREATE_DATE"),
    SourceTable("CMS_MHOUNDEL_POD", "cnote", column="MHOUNDEL_NO", scope="DHOUNDEL", guard="MHOUNDEL_DATE"),
    SourceTable("CMS_DRSHEET", "cnote", column="DRSHEET_CNOTE_NO", scope="CNOTE", guard="DRSHEET_DATE"),
    SourceTable("CMS_DRSHEET_PRA", "cnote", column="DRSHEET_CNOTE_NO", scope="CNOTE", guard="CREATION_DATE"),
    SourceTable("CMS_MRSHEET_PRA", "cnote", column="MRSHEET_NO", scope="DRSHEET_PRA", guard="MRSHEET_DATE"),
    SourceTable("CMS_DBAG_HO", "cnote", column="DBAG_CNOTE_NO", scope="CNOTE", guard="CDATE"),
    SourceTable("CMS_DHOCNOTE", "cnote", column="DHOCNOTE_CNOTE_NO", scope="CNOTE", guard="DHOCNOTE_TDATE"),
    SourceTable("CMS_DHICNOTE", "cnote", column="DHICNOTE_CNOTE_NO", scope="CNOTE", guard="DHICNOTE_TDATE"),
    SourceTable("CMS_COST_DTRANSIT_AGEN", "cnote", column="CNOTE_NO", scope="CNOTE", guard="ESB_TIME"),
    SourceTable("CMS_MFCNOTE", "cnote", column="MFCNOTE_NO", scope="CNOTE", guard="MFCNOTE_CRDATE"),
    SourceTable("CMS_DCORRECT_DEST", "cnote", column="DCORRECT_CNOTE_NO", scope="CNOTE", guard="DCORRECT_CDATE"),
    SourceTable("T_CORRECT_AWB", "cnote", column="C_CNOTE_NO", scope="CNOTE"),
    SourceTable("CMS_MANIFEST", "bag_manifest", column="MANIFEST_NO", scope="MANIFEST", guard="MANIFEST_DATE"),
    SourceTable("CMS_MFBAG", "bag_manifest", column="MFBAG_MAN_NO", scope="MANIFEST", guard="MFBAG_CRDATE"),
    SourceTable("CMS_DMBAG", "bag_manifest", column="DMBAG_BAG_NO", scope="MFBAG", guard="ESB_TIME"),
    SourceTable("CMS_MMBAG", "bag_manifest", column="MMBAG_NO", scope="DMBAG", guard="MMBAG_DATE"),
    SourceTable("CMS_DSMU", "bag_manifest", column="DSMU_BAG_NO", scope="DMBAG", guard="ESB_TIME"),
    SourceTable("CMS_MSMU", "bag_manifest", column="MSMU_NO", scope="SMU", guard="MSMU_DATE"),
    SourceTable("CMS_COST_MTRANSIT_AGEN", "bag_manifest", column="MANIFEST_NO", scope="COST_MANIFEST", guard="MANIFEST_DATE"),
    SourceTable("CMS_MRSHEET", "runsheet_do", column="MRSHEET_NO", scope="DRSHEET", guard="MRSHEET_DATE"),
    SourceTable("CMS_MSTATUS", "runsheet_do", column="MSTATUS_NO", scope="DSTATUS", guard="CREATE_DATE"),
    SourceTable("CMS_MSJ", "runsheet_do", column="MSJ_NO", scope="MSJ", guard="MSJ_DATE"),
    SourceTable("CMS_RDSJ", "runsheet_do", column="RDSJ_HVI_NO", scope="HVI", guard="RDSJ_CDATE"),
    SourceTable("CMS_MHICNOTE", "runsheet_do", column="MHICNOTE_NO", scope="HVI", guard="MHICNOTE_DATE"),
    SourceTable("CMS_MHOCNOTE", "runsheet_do", column="MHOCNOTE_NO", scope="HVO", guard="MHOCNOTE_DATE"),
    SourceTable("CMS_DSJ", "runsheet_do", column="DSJ_HVO_NO", scope="RDSJ_HVO", guard="DSJ_CDATE"),
    SourceTable("CMS_DROURATE", "reference"),
    SourceTable("ORA_BRANCH", "reference"),
    SourceTable("ORA_ZONE", "reference"),
    SourceTable("ORA_USER", "reference"),
    SourceTable("T_MDT_CITY_ORIGIN", "reference"),
    SourceTable("LASTMILE_COURIER", "reference"),
)
SOURCES = {t.name: t for t in _TABLES}


@dataclass(frozen=True)
class Step:
    """Keys `key` of the rows of `table` whose `column` is in the scope `parent`."""

    table: str
    key: str
    column: str
    parent: str
    guard: str = ""


#: How each scope but the anchor's comes about; several steps are united.
SCOPES: dict[str, tuple[Step, ...]] = {
    "DRCNOTE": (Step("CMS_DRCNOTE", "DRCNOTE_NO", "DRCNOTE_CNOTE_NO", "CNOTE"),),
    "DHI_HOC": (Step("CMS_DHI_HOC", "DHI_NO", "DHI_CNOTE_NO", "CNOTE"),),
    "HOV_RSHEET": (Step("CMS_DHOV_RSHEET", "DHOV_RSHEET_NO", "DHOV_RSHEET_CNOTE", "CNOTE"),),
    "DHOUNDEL": (Step("CMS_DHOUNDEL_POD", "DHOUNDEL_NO", "DHOUNDEL_CNOTE_NO", "CNOTE"),),
    "DRSHEET": (Step("CMS_DRSHEET", "DRSHEET_NO", "DRSHEET_CNOTE_NO", "CNOTE", "DRSHEET_DATE"),),
    "DRSHEET_PRA": (Step("CMS_DRSHEET_PRA", "DRSHEET_NO", "DRSHEET_CNOTE_NO", "CNOTE", "CREATION_DATE"),),
    "DSTATUS": (Step("CMS_DSTATUS", "DSTATUS_NO", "DSTATUS_CNOTE_NO", "CNOTE"),),
    "MANIFEST": (Step("CMS_MFCNOTE", "MFCNOTE_MAN_NO", "MFCNOTE_NO", "CNOTE", "MFCNOTE_CRDATE"),),
    "MFBAG": (
        Step("CMS_MFCNOTE", "MFCNOTE_BAG_NO", "MFCNOTE_NO", "CNOTE", "MFCNOTE_CRDATE"),
        Step("CMS_MFBAG", "MFBAG_NO", "MFBAG_MAN_NO", "MANIFEST"),
    ),
    "DMBAG": (Step("CMS_DMBAG", "DMBAG_NO", "DMBAG_BAG_NO", "MFBAG"),),
    "SMU": (Step("CMS_DSMU", "DSMU_NO", "DSMU_BAG_NO", "DMBAG"),),
    "COST_MANIFEST": (Step("CMS_COST_DTRANSIT_AGEN", "DMANIFEST_NO", "CNOTE_NO", "CNOTE"),),
    "HVI": (Step("CMS_DHICNOTE", "DHICNOTE_NO", "DHICNOTE_CNOTE_NO", "CNOTE"),),
    "HVO": (Step("CMS_DHOCNOTE", "DHOCNOTE_NO", "DHOCNOTE_CNOTE_NO", "CNOTE"),),
    "RDSJ_HVO": (Step("CMS_RDSJ", "RDSJ_HVO_NO", "RDSJ_HVI_NO", "HVI"),),
    "MSJ": (Step("CMS_DSJ", "DSJ_NO", "DSJ_HVO_NO", "RDSJ_HVO"),),
}
#: Scopes that are another one under a second name.
SAME = {"MMBAG": "DMBAG"}
ANCHOR = SOURCES["CMS_CNOTE"]


def needed(scope: str) -> set[str]:
    """A scope and all that it is derived from."""
    scope = scope.upper()
    if scope in SAME:
        return {scope} | needed(SAME[scope])
    return {scope}.union(*(needed(s.parent) for s in SCOPES.get(scope, ())))


def closure(scopes: Iterable[str]) -> set[str]:
    return set().union(*(needed(s) for s in scopes))


def waves(scopes: Iterable[str]) -> list[set[str]]:
    """The scopes of a closure in the order in which they can be derived, those of a wave at the same time."""
    left, done, out = closure(scopes), set(), []
    while left:
        wave = {s for s in left if needed(s) - {s} <= done}
        out.append(wave)
        done |= wave
        left -= wave
    return out


class ScopeGraph:
    """Key sets over a catalog of tables. Each scope is one DataFrame `k`, lazy unless `store` (name, keys) puts it somewhere.

    Without a store Spark plans a chain of scopes as a whole; with one each is computed once, however many tables need it.
    """

    def __init__(self, tables: Tables, window: DateWindow, limit: int | None = None, back: int = 0, ahead: int = 30, anchor_date: str = "CNOTE_DATE", guards: bool = True, store: Callable[[str, DataFrame], DataFrame] | None = None):
        if limit is not None and limit < 1:
            raise ValueError("the anchor's limit is at least 1")
        self.tables, self.window, self.limit, self.back, self.ahead = tables, window, limit, back, ahead
        self.anchor_date, self.guards, self.store, self.made = anchor_date, guards, store, {}

    def _guard(self, df: DataFrame, column: str) -> Column:
        if not self.guards or not column:
            return F.lit(True)
        if column not in df.columns:
            warnings.warn(f"there is no column {column}: its table is not restricted by dates", stacklevel=2)
            return F.lit(True)
        return self.window.guarded(F.col(column), self.back, self.ahead)

    def _within(self, table: str, column: str, scope: str, guard: str) -> DataFrame:
        """The rows of a table whose column is in a scope: chosen by the table's source, if it can, else by a semi join."""
        keys, chosen = self.keys(scope), getattr(self.tables, "within", lambda *_: None)
        rows = chosen(table, column, keys)
        if rows is not None:
            return rows.where(self._guard(rows, guard))
        rows = self.tables(table)
        return rows.where(self._guard(rows, guard)).join(keys, F.col(column) == F.col("k"), "left_semi")

    def keys(self, scope: str) -> DataFrame:
        scope = SAME.get(scope, scope)
        if scope not in self.made:
            keys = self._derive(scope)
            self.made[scope] = self.store(scope, keys) if self.store else keys
        return self.made[scope]

    def _derive(self, scope: str) -> DataFrame:
        if scope == "CNOTE":
            rows = self.tables(ANCHOR.name)
            rows = rows.where(self.window.contains(F.col(self.anchor_date)))
            if self.limit is not None:
                rows = rows.select("CNOTE_NO", self.anchor_date).orderBy(self.anchor_date, "CNOTE_NO").limit(self.limit)
            found = [rows.select(F.col("CNOTE_NO").alias("k"))]
        else:
            found = [self._within(step.table, step.column, step.parent, step.guard).select(F.col(step.key).alias("k")) for step in SCOPES[scope]]
        return reduce(DataFrame.union, found).where("k IS NOT NULL").distinct()

    def restricted(self, table: str, columns: list[str] | None = None, exclude: Iterable[str] = ()) -> DataFrame:
        """The rows of a table that belong to the window, some of its columns."""
        spec = SOURCES[table]
        rows = self.tables(table) if not spec.scope else self._within(table, spec.column, spec.scope, spec.guard)
        if spec.stage == "anchor":
            rows = rows.where(self.window.contains(F.col(self.anchor_date)))
            if self.limit is not None:
                rows = rows.join(self.keys("CNOTE"), F.col("CNOTE_NO") == F.col("k"), "left_semi")
        gone = {c.upper() for c in exclude}
        names = [c for c in (columns or rows.columns) if c.upper() not in gone]
        if not names:
            raise ValueError(f"no column of {table} is left")
        return rows.select(*names)


def selected(names: Iterable[str] | None = None, stages: Iterable[str] | None = None) -> list[SourceTable]:
    """Source tables by name (any case) or stage, in the inventory's order; unknown names are an error."""
    wanted = None if names is None else {n.strip().upper() for n in names}
    if wanted and wanted - set(SOURCES):
        raise ValueError(f"unknown tables: {sorted(wanted - set(SOURCES))}")
    chosen = None if stages is None else set(stages)
    return [s for s in SOURCES.values() if (wanted is None or s.name in wanted) and (chosen is None or s.stage in chosen)]
