"""Picks from event feeds: first and last values that aren't null, conditional pivots, the latest row of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_value(value: str | Column, order: str | Column, where: Column | None = None) -> Column:
    """The value at the smallest order among rows where neither is null (and `where` holds)."""
    return _pick(F.min_by, value, order, where)


def last_value(value: str | Column, order: str | Column, where: Column | None = None) -> Column:
    return _pick(F.max_by, value, order, where)


def _pick(by, value: str | Column, order: str | Column, where: Column | None) -> Column:
    value, order = (F.col(x) if isinstance(x, str) else x for x in (value, order))
    usable = value.isNotNull() if where is None else value.isNotNull() & where
    # A null order is ignored by min_by and max_by, so hiding it there is a filter before the aggregate.
    return by(value, F.when(usable, order))


def firsts_and_lasts(prefixes: dict[str, tuple[str, ...]], order: str, last: bool = True) -> list[Column]:
    """For PREFIX and its fields: PREFIX_FIRST_field and PREFIX_LAST_field of columns PREFIX_field."""
    out = []
    for pick, word in ((first_value, "FIRST"), (last_value, "LAST"))[: 1 + last]:
        out += [pick(f"{p}_{f}", order).alias(f"{p}_{word}_{f}") for p, fields in prefixes.items() for f in fields]
    return out


def latest(df: DataFrame, by: str | list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in `order`; the rank filter stands next to the window, so Spark limits groups early."""
    w = Window.partitionBy(*([by] if isinstance(by, str) else by)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def ranked(df: DataFrame, by: str, order: list[Column], name: str = "_rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order)))


def earliest(df: DataFrame, by: str, when: Column, name: str) -> DataFrame:
    """(by, name): the earliest moment of each key, null keys left out."""
    return df.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("_key")).agg(F.min(when).alias(name))
