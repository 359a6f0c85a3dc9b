"""One row per key, with a survivor that does not depend on the order of arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("ingestion_timestamp",), wanted: Sequence[str] | None = None
) -> DataFrame:
    """Keep the row with the greatest ``order_by``; ties go to the greatest row in column order. Give the columns that are
    ``wanted``, and none behind the last of them in that order is read: it only tells rows apart that are equal in all wanted ones.

    Written as an aggregate and not as ``row_number() = 1``: it combines map-side, so a key with very
    many copies sends one row per task, and Catalyst knows that the keys are unique afterwards, so a left
    join to the result is dropped where no column of it is used.
    """
    rest = [c for c in df.columns if c not in (*keys, *order_by)]
    if wanted is not None:
        while rest and rest[-1] not in wanted:
            rest.pop()
        df = df.select(*[c for c in df.columns if c in (*keys, *order_by, *rest)])
    if not order_by and not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*order_by, *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns if wanted is None or c in (*keys, *wanted)])


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where any survivor will do: the greatest in column order."""
    return latest_per_key(df, keys, order_by=())


def top_per_group(df: DataFrame, group: Sequence[str], order_by: str, tie_break: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order_by`` in each group; ties go to the smallest ``tie_break``.

    Spark limits each group to one row in every map task before the shuffle.
    """
    best = Window.partitionBy(*group).orderBy(F.col(order_by).desc(), *tie_break)
    return df.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") == 1).drop("_rank")
