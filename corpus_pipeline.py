"""A corpus pipeline of five stages over `documents`: quality, lines, near copies, mix, pieces.

Each stage gets all that the stage before kept, as a table that was written and read again, and decides over whole
texts. The first four return the columns of documents; the last adds the pieces.

In every stage a null text counts as an empty one; empty texts are scored, are one empty line, are near copies of no
text with words (texts without words are copies of one another) and have no pieces. Very long texts are scored, cut in
lines, compared and encoded whole. Ties go to the smaller id: of equal scores none decides, of lines that documents share
the largest id keeps them, of a group of near copies the smallest id stays, and of documents at a budget's edge a seeded
order decides. Repeated rows are documents until the near-copy stage, where one row stays; a null id is an id. Empty
tables give empty tables. Extra columns are dropped, clashing names with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm import line_dedup, quality_cnn, sentencepiece_viterbi, simhash_dedup, source_mixing
from freightlens.llm.common import discard, placed, scoped, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network scores 0.3 or more; it learns from the labelled ones outside the held-out fold."""
    small_batches(spark)
    net = quality_cnn.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.scored(docs, net, name="__score").where(F.col("__score") >= quality_cnn.THRESHOLD).select(*COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long lines that five documents share and a larger id keeps; all documents stay."""
    small_batches(spark)
    rows = line_dedup.dedup_lines(docs.select(*COLUMNS))
    kept = F.when(F.col("__n_dropped") > 0, F.col("__kept")).otherwise(F.col("text"))
    return rows.withColumn("text", kept).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of a five-word similarity of 0.8 or more join; fingerprints propose, the texts decide."""
    small_batches(spark)
    return simhash_dedup.first_of_each(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, by the tree's weights as far as its leaves reach.

    One epoch at most, as the stage before has just taken out what repeats.
    """
    small_batches(spark)
    mix = source_mixing.mixed(docs.select(*COLUMNS), source_mixing.levels(), source_mixing.WEIGHTS, budget=0.9, epochs=1)
    return mix.where("copies > 0").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces long, ids array of int, decoded_sha256 string)."""
    small_batches(spark)
    model = sentencepiece_viterbi.default_model()
    found = sentencepiece_viterbi.encoded(docs, model, keep=("lang", "source"))
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("simhash near-dedup", near_deduplication),
    ("mixing sources to target weights", mixing),
    ("sentencepiece encoding", pieces),
]

#: The first, third and last stage can't be put in SQL; tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage needed, its input too, is deleted once its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = placed(spark, "stage")
        with scoped(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
