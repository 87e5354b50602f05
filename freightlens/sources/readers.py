"""Tables from Parquet, CSV and JDBC, and catalogs that give them by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_parquet(spark: SparkSession, paths: str | Iterable[str], columns: Iterable[str] | None = None, distinct: bool = False) -> DataFrame:
    """Parquet parts whose columns may differ; columns that no part has are left out, and Spark reads only the others."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    if columns is not None:
        df = df.select(*(c for c in dict.fromkeys(columns) if c in df.columns))
    return df.distinct() if distinct else df


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV file with a header, all text, empty as null. A row that is wider or narrower than the header is an error.

    columns: the header that is expected.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    if columns is not None and header != columns:
        raise ValueError(f"the header is {header}, expected {columns}")
    schema = StructType([StructField(c, StringType()) for c in header])
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False, nullValue="", emptyValue="", multiLine=True, escape='"')


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str] | None = None, where: str | None = None, split: tuple[str, object, object, int] | None = None, fetch: int = 10_000, **options: str) -> DataFrame:
    """A database table; columns and filters reach the database. split: (column, low, high, parts) reads in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch).options(**options)
    if split:
        column, low, high, parts = split
        reader = reader.option("partitionColumn", column).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts)
    df = reader.load()
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def _united(parts: list[DataFrame]) -> DataFrame:
    """The union of frames, by halves: one after the other, Spark would look through all of the lists before at each step."""
    if len(parts) == 1:
        return parts[0]
    return _united(parts[: len(parts) // 2]).union(_united(parts[len(parts) // 2 :]))


def with_keys(rows: DataFrame, column: str, keys: DataFrame, most: int = 50_000, chunk: int = 1000, ranges: int = 64) -> DataFrame:
    """The rows of a database's table whose column is among keys (one column), chosen by the database.

    Up to `most` keys go there as lists of `chunk`, each list a query (Oracle takes a thousand); they are counted before
    they are collected. More keys go there as ranges, each with its least and greatest key, and what the ranges let
    through is joined with the keys here. Filters and columns that are chosen later reach the database too.
    """
    spark, k, kind = rows.sparkSession, keys.columns[0], rows.schema[column].dataType
    keys = keys.select(F.col(k).alias("_key")).where("_key IS NOT NULL").distinct()
    if keys.limit(most + 1).count() <= most:
        found = sorted(r._key for r in keys.collect())
        lists = [found[at : at + chunk] for at in range(0, len(found), chunk)]
        # Texts go as they are: a column object for each of 50,000 keys takes the driver minutes to make and to plan.
        values = (lambda part: part) if isinstance(kind, StringType) else lambda part: [F.lit(v).cast(kind) for v in part]
        return _united([rows.where(F.col(column).isin(*values(part))) for part in lists]) if lists else spark.createDataFrame([], rows.schema)
    edges = keys.select(F.col("_key").cast(kind).alias("_key")).repartitionByRange(ranges, "_key").groupBy(F.spark_partition_id()).agg(F.min("_key").alias("low"), F.max("_key").alias("high"))
    parts = [rows.where(F.col(column).between(F.lit(r.low).cast(kind), F.lit(r.high).cast(kind))) for r in edges.collect()]
    return _united(parts).join(keys, F.col(column).cast("string") == F.col("_key").cast("string"), "left_semi")


class JdbcTable:
    """A database's table for a catalog: all its rows, or those with some keys."""

    def __init__(self, spark: SparkSession, url: str, table: str, **options):
        self.read = lambda: read_jdbc(spark, url, table, preferTimestampNTZ="true", **options)

    def __call__(self) -> DataFrame:
        return as_source(self.read())

    def within(self, column: str, keys: DataFrame) -> DataFrame:
        return as_source(with_keys(self.read(), column, keys))


def as_source(df: DataFrame) -> DataFrame:
    """Types as they are kept at rest: numbers but floating ones and binary values as text, times without zone."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("timestamp", "date"):
            out.append(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name))
        elif kind in ("timestamp_ntz", "double", "float", "boolean", "string"):
            out.append(F.col(f"`{f.name}`").cast("double" if kind == "float" else kind).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
    return df.select(*out)


class TableCatalog:
    """Tables by name from readers that run when a table is first asked for; callable, as operators take it.

    A derived table can stand for a source table: `use("CMS_CNOTE", "SPINE")`.
    """

    def __init__(self, readers: dict[str, Callable[[], DataFrame]]):
        self._readers, self._made, self._instead = {k.upper(): v for k, v in readers.items()}, {}, {}

    def use(self, name: str, instead: str) -> TableCatalog:
        if instead.upper() in self._readers:
            self._instead[name.upper()] = instead.upper()
        return self

    def within(self, name: str, column: str, keys: DataFrame) -> DataFrame | None:
        """The rows of a table whose column is among keys, chosen by its source; None if its source can't."""
        reader = self._readers.get(self._instead.get(name.upper(), name.upper()))
        return reader.within(column, keys) if hasattr(reader, "within") else None

    def available(self, name: str) -> bool:
        return self._instead.get(name.upper(), name.upper()) in self._readers

    def __call__(self, name: str) -> DataFrame:
        name = self._instead.get(name.upper(), name.upper())
        if name not in self._made:
            if name not in self._readers:
                raise KeyError(f"no table {name}")
            self._made[name] = self._readers[name]()
        return self._made[name]


def demo_tables(spark: SparkSession, n: int = 50) -> TableCatalog:
    """Small tables of n shipments, each with one planted defect, for a run without data. The same in every call."""
    day = date(2026, 6, 1)
    ids = spark.range(1, n + 1).withColumn("k", F.format_string("CNOTE%04d", "id"))
    at = lambda hours: (F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(hours=hours))
    i = F.col("id")
    frames = {
        "CMS_CNOTE": ids.select(F.when(i == 1, F.lit(None)).when(i == 2, " ").when(i == 6, "CNOTE0005").otherwise(F.col("k")).alias("CNOTE_NO"), F.when(i == 3, "??").otherwise("REG19").alias("CNOTE_SERVICES_CODE"), F.when(i == 4, "XXX99999").otherwise("CGK10000").alias("CNOTE_ORIGIN"), F.lit("BDO10000").alias("CNOTE_DESTINATION"), F.when(i == 11, F.lit(None)).otherwise((i % 7 + 1).cast("double")).alias("CNOTE_WEIGHT"), at(i.cast("int")).alias("CNOTE_DATE"), at(i.cast("int")).alias("CNOTE_CRDATE")),
        "CMS_DRCNOTE": ids.select(F.format_string("DR%04d", "id").alias("DRCNOTE_NO"), F.when(i == 10, "ORPHAN").otherwise(F.col("k")).alias("DRCNOTE_CNOTE_NO")),
        "CMS_APICUST": ids.select(F.col("k").alias("APICUST_CNOTE_NO"), ((i % 7 + 1) + F.when(i == 7, 5).otherwise(0)).cast("double").alias("APICUST_WEIGHT"), F.when(i == 8, "SUB10000").otherwise("CGK10000").alias("APICUST_ORIGIN")),
        "CMS_MHOCNOTE": ids.select(F.format_string("HO%04d", "id").alias("MHOCNOTE_NO"), F.lit("Y").alias("MHOCNOTE_APPROVE"), F.when(i != 14, at(i.cast("int"))).alias("MHOCNOTE_APP_DATE"), F.when(i != 15, at(i.cast("int"))).alias("MHOCNOTE_SIGNDATE")),
        "CMS_MFCNOTE": ids.select(F.col("k").alias("MFCNOTE_NO"), F.format_string("MF%04d", "id").alias("MFCNOTE_MAN_NO"), ((i % 7 + 1) + F.when(i == 20, 2).otherwise(0)).cast("double").alias("MFCNOTE_WEIGHT")),
        "CMS_MANIFEST": ids.select(F.format_string("MF%04d", "id").alias("MANIFEST_NO"), F.lit("Y").alias("MANIFEST_APPROVED"), F.when(i != 17, "R").alias("MANIFEST_ROUTE"), F.when(i != 18, "T").alias("MANIFEST_THRU"), F.when(i != 19, "O").alias("MANIFEST_ORIGIN"), at(i.cast("int") + 4).alias("MANIFEST_CRDATE")),
        "CMS_MFBAG": ids.select(F.format_string("BAG%04d", "id").alias("MFBAG_NO"), F.format_string("MF%04d", "id").alias("MFBAG_MAN_NO"), at(i.cast("int") + F.when(i == 21, 1).otherwise(6)).alias("MFBAG_CRDATE")),
        "CMS_DCORRECT_DEST": ids.select(F.col("k").alias("DCORRECT_CNOTE_NO"), F.when(i == 12, "SUB10000").when(i == 13, "CGK20000").otherwise("CGK10000").alias("DCORRECT_ORIGIN"), F.lit("BDO10000").alias("DCORRECT_DEST")),
        "CMS_MHI_HOC": ids.select(F.col("k").alias("MHI_CNOTE_NO"), at(i.cast("int") + F.when(i == 9, -3).otherwise(3)).alias("MHI_APPROVE_DATE")),
        "CMS_MSJ": ids.select(F.format_string("SJ%04d", "id").alias("MSJ_NO"), F.lit("Y").alias("MSJ_APPROVE"), F.when(i != 16, at(i.cast("int") + 8)).alias("MSJ_SIGNDATE")),
        "CMS_DRSHEET": ids.select(F.format_string("RS%04d", "id").alias("DRSHEET_NO"), F.col("k").alias("DRSHEET_CNOTE_NO"), at(i.cast("int") + 20).alias("DRSHEET_DATE")),
        "CMS_CNOTE_POD": ids.select(F.col("k").alias("CNOTE_POD_NO"), at(i.cast("int") + F.when(i == 22, 21).otherwise(20)).alias("CNOTE_POD_DATE")),
        "CMS_MMBAG": ids.select(F.format_string("MB%04d", "id").alias("MMBAG_NO"), F.lit("Y").alias("MMBAG_APPROVE"), F.when(i != 23, at(i.cast("int") + 6)).alias("MMBAG_DATE_APPROVE")),
        "CMS_DROURATE": spark.createDataFrame([("CGK10000BDO10000", "REG19", "CGK10000", "BDO10000"), ("SUB10000BDO10000", "YES19", "SUB10000", "BDO10000")], "DROURATE_CODE string, DROURATE_SERVICE string, __origin_component string, __destination_component string"),
        "ORA_BRANCH": spark.createDataFrame([("CGK000",), ("BDO000",)], "BRANCH_CODE string"),
    }
    return TableCatalog({k: (lambda v=v: v) for k, v in frames.items()})
