"""Exact quantile of one column without gathering the column in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def _neighbours(values: DataFrame, column: str, rank: int, low: float, high: float) -> tuple[float, float]:
    """Values with the zero-based ranks ``rank`` and ``rank + 1`` (the first one again if it is the last).

    Each pass counts the rows still in the bracket [low, high] into at most BUCKETS groups, combined
    map-side, and moves to the smallest and largest value of the group that holds the rank. The two ends
    of a bracket never share a group, so it shrinks on every pass whatever the distribution.
    """
    before, above = 0, None
    while True:
        inside = values.filter(F.col(column).between(low, high))
        width = (high - low) / BUCKETS
        slot = F.floor((F.col(column) - F.lit(low)) / F.lit(width)) if low < high else F.lit(0)
        counts = (
            inside.groupBy(F.least(F.lit(BUCKETS - 1), slot).alias("slot"))
            .agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            .orderBy("slot")
            .collect()
        )
        for i, row in enumerate(counts):
            if before + row["n"] > rank:
                break
            before += row["n"]
        if i + 1 < len(counts):
            above = counts[i + 1]["lo"]
        low, high = row["lo"], row["hi"]
        if low == high:
            repeated = before + row["n"] > rank + 1
            return low, low if repeated or above is None else above


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    """Quantile with linear interpolation between neighbours; nulls and NaN are left out; null on no rows.
    Infinite values count with their rank; a quantile that falls on one, or next to one, is infinite.

    Reads the one column three or four times for amounts in cents.
    """
    values = df.select(F.col(column).cast("double").alias(column)).filter(F.col(column).isNotNull() & ~F.isnan(column))
    finite = F.abs(column) < math.inf
    stats = values.agg(
        F.count("*").alias("n"), F.count_if(F.col(column) == -math.inf).alias("below"), F.count_if(finite).alias("inside"),
        F.min(F.when(finite, F.col(column))).alias("lo"), F.max(F.when(finite, F.col(column))).alias("hi"),
    ).first()
    if stats["n"] == 0:
        return None
    position = p * (stats["n"] - 1)
    k = math.floor(position)
    rank = k - stats["below"]
    if rank < 0:
        return -math.inf
    if rank >= stats["inside"] or (rank + 1 == stats["inside"] < stats["n"] - stats["below"] and position > k):
        return math.inf
    lower, upper = _neighbours(values.filter(finite), column, rank, stats["lo"], stats["hi"])
    return lower + (upper - lower) * (position - k)
