"""Left join of a large frame to one with unique keys, safe where one key holds very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of the second join column: more than there are tasks, and few enough that it takes two bytes in a shuffle, where a whole hash takes eight.
SLICES = 2**15


def slice_of(*columns: str) -> Column:
    """A number below ``SLICES`` by the hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(SLICES)).cast("short")


def left_join(facts: DataFrame, dim: DataFrame, key: str, spread: str | None = None) -> DataFrame:
    """``facts`` with the columns of ``dim``, which has one row per key.

    The join is on the key and a slice of its hash. A row without a key matches nothing and takes the slice of its
    ``spread`` column instead (any column with many values), which spreads such rows over all tasks; a
    repeated task computes the same slice. The second column also gives a side that was aggregated by the key
    a shuffle of its own: AQE splits a hot key only between two plain shuffles.
    """
    own = slice_of(key)
    left_hash = own if spread is None else F.when(F.col(key).isNull(), slice_of(spread)).otherwise(own)
    left, right = facts.withColumn("_hash", left_hash), dim.withColumn("_hash", own)
    return left.join(right, [key, "_hash"], "left").drop("_hash")
