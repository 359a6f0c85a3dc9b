"""Connected components by alternating stars, as joins and map-side combined minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and all its partners v. The minima are a written table, so that a node with very
    many partners meets them in a join whose sides have shuffles of their own, which AQE can split."""
    least = written(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not the root itself; root: least node reachable.

    Every round links nodes to lesser ones and halves distances; the edges of a round are a written table, so a lost
    executor costs one round. Ends when a round changes nothing.
    """
    stars = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    known = mark(stars)
    while known[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        small = _with_least(large)
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        stars = written(small.filter("u <> v").distinct(), "small")
        now = mark(stars)
        if now == known:
            break
        known = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
