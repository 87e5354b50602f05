"""The queries of this package by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .best_fit_packing import op11_best_fit_packing
from .common import small_batches
from .conversation_repair import OP13_SQL, op13_conversation_repair
from .license_scan import op9_license_scan
from .line_dedup import OP8_SQL, op8_line_dedup
from .lm_scoring import op6_lm_scoring
from .media_source import op4_media_columns
from .quality_cnn import op2_quality_cnn
from .quality_rules import op3_quality_rules
from .sentencepiece_viterbi import op7_sentencepiece_viterbi
from .simhash_dedup import op10_simhash_near_dedup
from .source_mixing import op1_source_mixing
from .substring_dedup import OP5_SQL, op5_substring_dedup
from .vector_codes import OP12_SQL, op12_vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def in_small_batches(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_source_mixing": op1_source_mixing,
        "op2_quality_cnn": op2_quality_cnn,
        "op3_quality_rules": op3_quality_rules,
        "op4_media_columns": op4_media_columns,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_sentencepiece_viterbi": op7_sentencepiece_viterbi,
        "op8_line_dedup": op8_line_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_simhash_near_dedup": op10_simhash_near_dedup,
        "op11_best_fit_packing": op11_best_fit_packing,
        "op12_vector_codes": op12_vector_codes,
        "op13_conversation_repair": op13_conversation_repair,
    }
    return {name: in_small_batches(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op5_substring_dedup": OP5_SQL, "op8_line_dedup": OP8_SQL, "op12_vector_codes": OP12_SQL, "op13_conversation_repair": OP13_SQL}
