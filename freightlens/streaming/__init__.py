"""The date window over streams of child rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.plans.windows import DateWindow


def scoped_stream(rows: DataFrame, keys: DataFrame, column: str, event_time: str, window: DateWindow, back: int = 0, ahead: int = 30) -> DataFrame:
    """Rows of a stream of a child table whose key is in a (static) scope `k` and whose time is in the guarded window.

    The look-ahead of the guard is the watermark: how late a child may come. Works on batches alike.
    """
    if rows.isStreaming:
        rows = rows.withWatermark(event_time, f"{max(ahead, 1)} days")
    return rows.where(window.guarded(F.col(event_time), back, ahead)).join(keys, F.col(column) == F.col("k"), "left_semi")


def first_events_stream(rows: DataFrame, key: str, event_time: str) -> DataFrame:
    """(key, first_time, n): the earliest event of each key, kept up to date."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(event_time).alias("first_time"), F.count(F.lit(1)).alias("n"))
