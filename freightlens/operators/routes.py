"""Matching a few places against a large route reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.classes import route_parts
from freightlens.functions.values import normal


def match_places(candidates: DataFrame, reference: DataFrame, which: str, route: str = "DROURATE_CODE") -> DataFrame:
    """(candidate, matched boolean, malformed long) of each different candidate: whether it is the origin or destination (`which`) of a route.

    The reference is read once for the matches: its rows meet the candidates in a semi join, which Spark broadcasts by
    their size, and only matches move. malformed: its codes that aren't two places.
    """
    candidates = candidates.distinct()
    origin, destination, whole = route_parts(normal(F.col(route)))
    places = reference.select((origin if which == "origin" else destination).alias("place"), whole.alias("whole"))
    matches = places.where("whole").select("place").join(candidates, F.col("place") == F.col("candidate"), "left_semi").distinct()
    bad = places.agg(F.count_if(~F.col("whole")).alias("malformed"))
    return candidates.join(matches, F.col("candidate") == F.col("place"), "left").select("candidate", F.col("place").isNotNull().alias("matched"), bad.scalar().alias("malformed"))
