"""Mixing sources to target weights by hierarchical budgeting.

A tree of domains, languages and sources has a weight at each node. A budget of tokens flows from the root: children
share their parent's budget by weight, none gets more than it can give (its tokens times the epochs allowed), and what
a child can't take is shared again among its siblings by weight until they are full too. Only what no sibling can take
goes up and is shared among the parent's siblings, and so on; if the root is full the mix is smaller than asked.

Each leaf then gives its token prefix of seeded epochs: in every epoch its documents stand in an order of their own,
by a hash of seed, epoch and document, and the leaf gives whole epochs and of the next one the shortest prefix with
the tokens still due. So a document is taken `copies` times, and runs with the same seed agree.

Shares among siblings are a water level: each child gets the lesser of its supply and level times weight. The level of
every family is found at once by sums over slots of supply by weight, which close in on the place where the budget ends
(`SLOTS` slots a round, or, of few children, a slot for each ratio in one round); so a family of any number of children is only summed, and neither the tree nor its leaves are
gathered anywhere.

A leaf can hold a third of all rows, so no leaf is sorted as a whole: the hash is cut in slices, tokens are summed by
leaf and slice (map-side first), and only the slice that the prefix ends in is put in order, to find the place where
the prefix ends; then each row is compared with its leaf's place. Slices hold about `slice_rows` rows, so no task's
rows grow with a leaf. Spark broadcasts a table with a row per leaf if its size allows it.

Words are runs of characters other than white space, in texts of any length; null and empty texts have none and ride
along with their leaf's order, at no cost. Null domains, languages and sources are leaves of their own, named by the
empty text. Rows that the tree doesn't name get `other` as their weight. Repeated rows tie for a place: all of them are
taken or none. An empty table gives no rows. Columns other than the key columns pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

#: Slots of a round, and rounds at most: the level is known to a part in SLOTS ** ROUNDS of its range.
SLOTS, ROUNDS = 256, 6
#: Up to so many children each ratio is a slot of its own, and one round is enough.
FEW = 10_000


def water_levels(children: DataFrame, family: list[str]) -> DataFrame:
    """(family, level double): where the lesser of s and level * w, summed over a family's children, is its budget b.

    children: family, s, w (both above 0), b. The level is null if the budget is the sum of s or more.
    """
    rows = children.select(*family, "s", "w", "b", (F.col("s") / F.col("w")).alias("r"))
    ends = rows.groupBy(*family).agg(F.first("b").alias("b"), F.min("r").alias("low"), F.max("r").alias("high"))
    by = Window.partitionBy(*family).orderBy("slot")
    few = children.count() <= FEW
    for _ in range(1 if few else ROUNDS):
        part = (F.log2("r") - F.log2("low")) / F.greatest(F.log2("high") - F.log2("low"), F.lit(1e-300))
        slot = F.when(F.col("r") < F.col("low"), -1).when(F.col("r") > F.col("high"), SLOTS).otherwise(F.least(F.floor(part * SLOTS), F.lit(SLOTS - 1)))
        slot = F.col("r") if few else slot
        sums = rows.drop("b").join(ends, family).groupBy(*family, slot.alias("slot")).agg(F.first("b").alias("b"), F.sum("s").alias("s"), F.sum("w").alias("w"), F.min("r").alias("low"), F.max("r").alias("high"))
        # What is given out at the level of a slot's first child: smaller children are full, it and larger ones get by weight.
        full = F.coalesce(F.sum("s").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        larger = F.coalesce(F.sum("w").over(by.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))
        sums = sums.select("*", full.alias("full"), larger.alias("larger")).withColumn("given", F.col("full") + F.col("low") * (F.col("w") + F.col("larger")))
        last = F.max_by(F.struct("low", "high", "given", "w", "larger"), F.when(F.col("given") <= F.col("b"), F.col("slot"))).alias("at")
        first = F.min_by(F.struct("low", (F.col("w") + F.col("larger")).alias("all")), "slot").alias("first")
        found = written(sums.groupBy(*family).agg(F.first("b").alias("b"), last, first), few=True)
        if few or found.where("at.low < at.high").isEmpty():
            break
        ends = found.select(*family, "b", F.coalesce("at.low", "first.low").alias("low"), F.coalesce("at.high", "first.low").alias("high"))
    # Children of the last slot have the same ratio and are full; were there rounds too few, they count as not full.
    left = F.col("at.larger") + F.when(F.col("at.low") < F.col("at.high"), F.col("at.w")).otherwise(0.0)
    above = F.col("at.low") + (F.col("b") - F.col("at.given")) / F.when(left > 0, left)
    return found.select(*family, F.when(F.col("at").isNull(), F.col("b") / F.col("first.all")).otherwise(above).alias("level"))


def quotas(leaves: DataFrame, path: list[str], weights: dict[tuple, float], budget: float, epochs: float, other: float = 1.0) -> DataFrame:
    """(path, due long): tokens that each leaf gives. leaves: path and tokens; weights: by path of any length, else `other`."""
    spark = leaves.sparkSession
    rows = leaves.withColumn("s", F.col("tokens") * float(epochs)).withColumn("__root", F.lit(0))
    for k in range(1, len(path) + 1):
        named = [(*p, float(w)) for p, w in weights.items() if len(p) == k]
        own = spark.createDataFrame(named, ", ".join([*(f"`{n}` string" for n in path[:k]), f"w{k} double"]))
        rows = rows.join(own, path[:k], "left").withColumn(f"w{k}", F.coalesce(f"w{k}", F.lit(float(other))))
        rows = rows.withColumn("s", F.when(F.col(f"w{k}") > 0, F.col("s")).otherwise(0.0))  # a branch without weight gives nothing
    rows = written(rows.where("s > 0"), few=True)
    share = rows.groupBy("__root").agg(F.least(F.lit(float(budget)), F.sum("s")).alias("b"))
    for k in range(1, len(path) + 1):
        family, own = ["__root", *path[: k - 1]], ["__root", *path[:k]]
        children = rows.groupBy(*own).agg(F.sum("s").alias("s"), F.first(f"w{k}").alias("w"))
        children = written(children.join(share, family).where("b > 0"), few=True)
        given = F.least(F.col("s"), F.coalesce(F.col("level") * F.col("w"), F.col("s")))
        share = children.join(water_levels(children, family), family).select(*own, given.alias("b"))
    return leaves.select(*path).join(share, path, "left").select(*path, F.coalesce(F.bround("b"), F.lit(0)).cast("long").alias("due"))


def n_tokens(text: Column) -> Column:
    """Runs of characters other than the six white-space bytes."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def mixed(docs: DataFrame, path: dict[str, Column], weights: dict[tuple, float], budget: float, epochs: int = 4, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", other: float = 1.0, slice_rows: int = 2_000) -> DataFrame:
    """docs with the path's columns, n_tokens long and copies int (0: not in the mix).

    path: name and expression of each level of the tree, the root's children first. budget: tokens of the mix, or, at
    1 or less, their share of all tokens. Columns of docs with these names are replaced.
    """
    names = list(path)
    docs = docs.drop(*names, "n_tokens", "copies")
    leaf = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in path.items()]
    rows = docs.select("*", *leaf, n_tokens(F.col(text_col)).alias("n_tokens"), F.xxhash64(id_col, text_col).alias("__h"))
    narrow = written(rows.select(*names, "n_tokens", "__h"))
    totals = written(narrow.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), few=True)
    if budget <= 1:
        budget *= totals.agg(F.sum("tokens").alias("t")).first().t or 0
    due, has = quotas(totals.select(*names, "tokens"), names, weights, budget, epochs, other), F.col("tokens") > 0
    whole, rest = F.when(has, F.floor(F.col("due") / F.col("tokens"))), F.when(has, F.col("due") % F.col("tokens"))
    slices = F.greatest(F.lit(1), F.ceil(F.col("n") / slice_rows))
    plan = totals.join(due, names).select(*names, F.coalesce(whole, F.lit(0)).cast("int").alias("__whole"), F.coalesce(rest, F.lit(0)).alias("__rest"), slices.cast("int").alias("__slices"))
    plan = written(plan, few=True)
    # A row's place in the order of the epoch in which its leaf's prefix ends, from 0 to 2^62.
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__whole", "__h"), 2).alias("__place")
    piece = F.floor(F.col("__place") / F.lit(2.0**62) * F.col("__slices")).cast("int").alias("__slice")
    placed = narrow.join(plan, names).where("__rest > 0").select(*names, "n_tokens", "__rest", "__slices", place).select("*", piece)
    sums = placed.groupBy(*names, "__slice").agg(F.sum("n_tokens").alias("__own"), F.first("__rest").alias("__rest"))
    before = lambda what, order: F.coalesce(F.sum(what).over(Window.partitionBy(*names).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("__before", before("__own", "__slice"))
    edge = sums.where("__before < __rest AND __before + __own >= __rest").select(*names, F.col("__slice").alias("__edge"), (F.col("__rest") - F.col("__before")).alias("__left"))
    edge = written(edge, few=True)  # a row a leaf, as `cut`; written, so that Spark knows their sizes
    inside = placed.join(edge, names).where(F.col("__slice") == F.col("__edge")).groupBy(*names, "__place").agg(F.sum("n_tokens").alias("__own"), F.first("__left").alias("__left"))
    cut = inside.withColumn("__before", before("__own", "__place")).where("__before < __left").groupBy(*names).agg(F.max("__place").alias("__cut"))
    cut = written(cut, few=True)
    found = rows.join(plan, names).join(cut, names, "left").select("*", place)
    copies = F.col("__whole") + F.coalesce((F.col("__place") <= F.col("__cut")).cast("int"), F.lit(0))
    return found.select(*docs.columns, *names, "n_tokens", copies.alias("copies"))


def domain_of(source: Column) -> Column:
    """The two domains of the driver's sources: curated ones have an odd number."""
    return F.when(source.rlike("[13579]$"), F.lit("curated")).otherwise(F.lit("web"))


#: Weights of the query: domains, languages in each, some sources; the rest weigh 1.
WEIGHTS = {
    ("web",): 0.4, ("curated",): 0.6,
    ("web", "en"): 0.55, ("web", "de"): 0.15, ("web", "fr"): 0.15, ("web", "es"): 0.15,
    ("curated", "en"): 0.4, ("curated", "de"): 0.2, ("curated", "fr"): 0.2, ("curated", "es"): 0.2,
    ("web", "en", "src0"): 2.0, ("curated", "en", "src7"): 3.0,
}


def levels() -> dict[str, Column]:
    return {"__domain": domain_of(F.coalesce(F.col("source"), F.lit(""))), "__lang": F.col("lang"), "__source": F.col("source")}


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its tokens and how many times the mix takes it: half of all tokens, at most 4 epochs of a leaf."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    found = mixed(docs, levels(), WEIGHTS, budget=0.5, epochs=4)
    return found.select("doc_id", F.col("__domain").alias("domain"), "lang", "source", "n_tokens", "copies")
