"""A run's folder: tables as Parquet with row counts, a manifest, and tables that are kept or taken from earlier runs.

    <root>/window_start=…/window_end=…/extract_date=…/run_id=…/<table>/part-*.parquet, _SUCCESS, _rows
    <root>/…/run_id=…/manifest.json

Files are written and read by Spark's own file systems, so a root may be in any store that Spark reaches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freightlens.plans.windows import DateWindow

from .config import run_name
from .readers import TableCatalog, read_parquet


class Store:
    """Small files beside the data, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark._jvm

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def write(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        size = fs.getFileStatus(p).getLen()
        stream = fs.open(p)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Puts a small file in the place of another; readers see the old one or the new one.

        By a rename that overwrites, where a store has one; in object stores a file is there once it is whole.
        """
        fs, p = self._at(path)
        if p.toUri().getScheme() in ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs"):
            self.write(path, text)
            return
        new = f"{path}.{uuid.uuid4().hex}"
        self.write(new, text)
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self.jvm.org.apache.hadoop.fs.Path(new), p, options)

    def delete(self, path: str) -> None:
        if path in _WORK:
            _WORK.remove(path)
        fs, p = self._at(path)
        fs.delete(p, True)

    def has_parts(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and any(s.getPath().getName().startswith("part-") for s in fs.listStatus(p))


#: Work folders of this process that are still there.
_WORK: list[str] = []


def work_folder(spark: SparkSession, work: str | None = None) -> str:
    """A new folder in work, or in the folder that the cluster shares (spark.checkpoint.dir)."""
    place = work or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = f"/tmp/checkpoints/{uuid.uuid4().hex}"
    _WORK.append(f"{place.rstrip('/')}/work-{uuid.uuid4().hex}")
    return _WORK[-1]


def clear_work(spark: SparkSession) -> None:
    """Deletes the work folders of this process; call it when what was made of them has been read."""
    store = Store(spark)
    while _WORK:
        store.delete(_WORK.pop())


def written(df: DataFrame, work: str | None = None) -> DataFrame:
    """df as a table in a work folder, read back: computed once, whatever reads it."""
    path = work_folder(df.sparkSession, work)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, path: str, rows_per_file: int = 250_000, compression: str = "zstd", partitions: int | None = None, order: Iterable[str] = (), observed: dict[str, Column] | None = None) -> int:
    """Writes parts of at most rows_per_file rows, counts the rows in the same job, and leaves the count in _rows.

    order: the physical sort key; rows go to parts by ranges of it and are sorted in each, so readers skip parts by its
    least and greatest values. Without partitions there are as many ranges as files, so that what a task sorts doesn't grow
    with the table; the rows are counted for that. observed: further aggregates of the same job; their values replace them in the dict.
    """
    out, counted = df, Observation()
    if order := [c for c in order if c in df.columns]:
        out = out.repartitionByRange(partitions or max(1, -(-df.count() // rows_per_file)), *order).sortWithinPartitions(*order)
    elif partitions:
        out = out.repartition(partitions)
    # Last, as ranges are found by reading the rows once before.
    out = out.observe(counted, F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in (observed or {}).items()))
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", compression).parquet(path)
    n = int(counted.get["n"])
    if observed is not None:
        observed.update({k: counted.get[k] for k in observed})
    Store(df.sparkSession).write(f"{path}/_rows", f"{n}\n")
    return n


def rows_written(spark: SparkSession, path: str) -> int | None:
    """The row count of a finished table, None if it isn't finished."""
    store = Store(spark)
    if not (store.exists(f"{path}/_SUCCESS") and store.exists(f"{path}/_rows") and (store.has_parts(path) or store.read(f"{path}/_rows").strip() == "0")):
        return None
    return int(store.read(f"{path}/_rows").strip())


@dataclass
class Run:
    """A run's place and manifest."""

    spark: SparkSession
    root: str
    window: DateWindow
    run_id: str
    extract_date: date
    tables: dict[str, dict] = field(default_factory=dict)
    derived: dict[str, dict] = field(default_factory=dict)
    scopes: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.run_id = run_name(self.run_id)

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.window.label()}/extract_date={self.extract_date}/run_id={self.run_id}"

    def save(self, complete: bool = True) -> None:
        rows = {k: v["rows"] for k, v in self.tables.items()}
        body = {
            "run_id": self.run_id, "window": [str(self.window.start), str(self.window.end)], "extract_date": str(self.extract_date), "scopes": self.scopes,
            "tables": self.tables, "derived": self.derived, "failed": self.failed, "total_rows": sum(rows.values()), "complete": complete, "written_at": datetime.now(timezone.utc).isoformat(),
        }
        Store(self.spark).write(f"{self.path}/manifest.json", json.dumps(body, indent=1))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Run:
        body = json.loads(Store(spark).read(f"{path}/manifest.json"))
        root = path.split("/window_start=")[0]
        return cls(spark, root, DateWindow(*map(date.fromisoformat, body["window"])), body["run_id"], date.fromisoformat(body["extract_date"]), body["tables"], body["derived"], body["scopes"], body.get("failed", {}))

    def add(self, name: str, df: DataFrame, derived: bool = False, **how) -> int:
        path = f"{self.path}/{name.lower()}"
        n = write_table(df, path, **how)
        (self.derived if derived else self.tables)[name.upper()] = {"path": path, "rows": n}
        return n

    def catalog(self) -> TableCatalog:
        """The run's tables; a spine, where there is one, stands for the anchor."""
        found = {**self.tables, **self.derived}
        return TableCatalog({k: (lambda p=v["path"]: read_parquet(self.spark, p)) for k, v in found.items()}).use("CMS_CNOTE", "CMS_CNOTE_TRANSFORMED")


def write_results(results: DataFrame, path: str) -> None:
    """Results as Parquet and CSV, all text, null as empty; an empty result still leaves its columns."""
    text = results.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in results.columns))
    text.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}.parquet")
    spark = results.sparkSession
    spark.read.schema(text.schema).parquet(f"{path}.parquet").write.mode("overwrite").option("header", True).option("quoteAll", False).option("emptyValue", "").csv(f"{path}.csv")
