"""Line dedup with levelled sorted runs of line hashes; DataFrame functions only.

Documents arrive in batches. Of each batch the long lines' keys are hashed (128 bits) and added up to one row a key: the
number of documents, that of lines and the largest id. The batch is then merge-anti-joined against each run so far: keys found in none
are fresh and their holder in this batch becomes the keeper; keys seen before only add to the count. Both go into a new
run of level 0, bucketed and sorted by hash, so that later joins move the new batch and not the runs. When a level has
`fanout` runs they are compacted to one of the next level.

A line goes if its key has at least `min_length` characters, is in at least `min_documents` documents, and the
document isn't the keeper: the largest id of the earliest batch that holds the key. Fed with batches of falling ids
this is the largest id of all. A frequent line is one key with a count, summed before any shuffle by key. Lines that go
are found by joining their keys with the few that are frequent: keys with a thousandth of all lines or more, at most a
thousand, by broadcast, so that no task gets all lines of such a key; the others by shuffle. Their places in each text
come together as one list, and what stays is put together by place, in time that is linear in the text's lines.

Null and empty texts are one empty line. A document is an id: repeated rows count once, and rows that share an id share
its verdict; rows without an id are one document, with the smallest id. If no holder has an id, all keep the line. Of
lines that repeat in one document all go or all stay; of equal lines (ties) only their documents' ids decide. A text of any length is one row of lines. An empty table has no
rows. Ids may be of any type that has an order; they are cut in batches if they are numbers. Extra columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import LOWER, SPACE_CHARS, UPPER, ceil_div, named_table, placed, text_bytes, written

KEY = ["h1", "h2"]
#: Keys with this part of all lines are joined by broadcast.
HOT_PART = 1000
#: Spark takes 100,000 buckets at most; in a corpus that would need more, buckets are larger, and their sorts spill.
MOST_BUCKETS = 1 << 16


def key_of(line: Column) -> Column:
    """The line without white space at its ends and with A-Z lower-cased; lower() does that for text of ASCII alone."""
    bare = F.btrim(line, F.lit(SPACE_CHARS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """The runs of a growing corpus. Each run is a bucketed table in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int = 32, fanout: int = 2, min_length: int = 40, min_documents: int = 5):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.min_length, self.min_documents = min_length, min_documents
        self.levels: list[list[str]] = []
        self.lines: list[DataFrame] = []
        self.place = placed(spark, "runs")

    def runs(self, bucketed: bool = False) -> list[DataFrame]:
        """The runs as tables with their buckets, for joins one by one; else as plain files, for unions."""
        names = [name for level in self.levels for name in level]
        return [self.spark.table(name) if bucketed else self._plain(name) for name in names]

    def _plain(self, name: str) -> DataFrame:
        # A union of bucketed tables claims their partitioning without having it, so sums over it would be wrong.
        return self.spark.read.schema(self.spark.table(name).schema).parquet(f"{self.place}/{name}")

    def _keep(self, rows: DataFrame, level: int) -> None:
        name = named_table()
        rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.place}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        every = batch.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
        long = every.withColumn("k", key_of(F.col("line"))).where(F.char_length("k") >= self.min_length)
        lines = written(long.select("id", "th", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(7), F.col("k")).alias("h2")))
        self.lines.append(lines)
        by_document = lines.groupBy("id", *KEY).agg(F.count(F.lit(1)).alias("lines"))
        own = by_document.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.sum("lines").alias("lines"), F.max("id").alias("keeper"))
        if self.runs():
            own = written(own, few=True)
            fresh = reduce(lambda left, run: left.join(run.hint("merge"), KEY, "left_anti"), self.runs(bucketed=True), own)
            again = own.join(reduce(DataFrame.unionByName, [r.select(*KEY) for r in self.runs()]), KEY, "left_semi")
            own = fresh.unionByName(again.withColumn("keeper", F.lit(None).cast(own.schema["keeper"].dataType)))
        self._keep(own, 0)
        self._compact()

    def _totals(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("n").alias("n"), F.sum("lines").alias("lines"), F.max("keeper").alias("keeper"))

    def _compact(self) -> None:
        for level in range(len(self.levels)):
            if len(old := self.levels[level]) >= self.fanout:
                self._keep(self._totals([self._plain(x) for x in old]), level + 1)
                self.levels[level] = []

    def doomed(self) -> DataFrame:
        """(id, th, gone array of int): for each id and text, the places of the lines that go."""
        frequent = self._totals(self.runs()).where(F.col("n") >= self.min_documents).select(*KEY, "lines", "keeper")
        frequent = written(frequent, few=True)
        lines = reduce(DataFrame.unionByName, self.lines)
        hot = F.col("lines") * HOT_PART >= lines.count()
        # The keys' lines add up to all lines, so at most HOT_PART of them are hot.
        common, others = F.broadcast(frequent.where(hot).drop("lines")), frequent.where(~hot).drop("lines")
        lost = lines.join(common, KEY).unionByName(lines.join(common, KEY, "left_anti").join(others, KEY))
        return lost.where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "th").agg(F.collect_set("pos").alias("gone"))

    def cut(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """docs with the columns __n_lines, __n_dropped and __kept (text) besides their own."""
        gone = self.doomed().withColumnsRenamed({"id": "__id", "th": "__th", "gone": "__gone"})
        rows = docs.join(gone.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("__id")) & (text_hash(text_col) == F.col("__th")), "left")
        rows = rows.withColumn("__lines", lines_of(F.col(text_col)))
        rows = rows.withColumn("__stay", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone"))
        n, left = F.size("__lines").cast("long"), F.coalesce(F.when(F.col("__gone").isNotNull(), F.size("__stay")), F.size("__lines"))
        kept = F.array_join(F.transform("__stay", lambda p: F.get(F.col("__lines"), p)), "\n")
        kept = F.when(F.col("__gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept)
        return rows.select(*(F.col(f"`{c}`") for c in docs.columns), n.alias("__n_lines"), (n - left).alias("__n_dropped"), kept.alias("__kept"))


def falling_batches(docs: DataFrame, n: int, id_col: str = "doc_id") -> list[DataFrame]:
    """docs by ranges of a numeric id, the largest first and null ids last; ids of another type are one batch."""
    n = n if isinstance(docs.schema[id_col].dataType, NumericType) else 1
    cuts = docs.agg(F.percentile_approx(id_col, F.array(*(F.lit(k / n) for k in range(1, n)))).alias("c")).first().c if n > 1 else None
    cuts = sorted(set(cuts or []))
    col = F.col(id_col)
    bounds = [None, *cuts, None]
    parts = []
    for low, high in reversed(list(zip(bounds, bounds[1:], strict=False))):
        test = F.lit(True) if low is None and high is None else None
        if low is not None:
            test = col > low
        if high is not None:
            test = (col <= high) if test is None else test & (col <= high)
        parts.append(docs.where(test if low is not None else test | col.isNull()))
    return parts


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 3, **how) -> DataFrame:
    total = text_bytes(docs, text_col)
    runs = LineRuns(docs.sparkSession, **({"buckets": min(max(16, ceil_div(total, 64 << 20)), MOST_BUCKETS)} | how))
    for batch in falling_batches(docs, batches, id_col):
        runs.add(batch, id_col, text_col)
    return runs.cut(docs, id_col, text_col)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of 40 characters or more that 5 documents share and a larger id keeps."""
    found = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("__kept", 256).alias("kept_sha256"))


#: The same in DuckDB's SQL, a row for each row of the table.
OP8_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
l AS (SELECT r, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS i FROM d)),
f AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.r, l.doc_id, l.i, l.line, f.k IS NOT NULL AND l.doc_id <> f.keeper AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
