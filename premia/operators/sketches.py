"""Mergeable summaries that are kept per batch: quantile sketches and sets of keys, their unions, and exact answers where a sketch cannot decide.

A sketch has a fixed size whatever the number of rows, so the table of sketches has one row per batch and cell, and an answer over all batches merges
rows of that table; no batch is read again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.skew import left_join

#: Size of quantile sketches. ``rank_error`` gives what it means.
QUANTILE_K = 800
#: Log2 of the keys that a set sketch holds at most. Up to that many different keys it is exact.
SET_LOG2 = 14
#: Standard errors that an estimate may be off before something is taken as decided.
SIGMAS = 4


def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of a quantile sketch of size ``k``, with 99 % confidence."""
    return 2.296 / k**0.9021


def set_error(log2: int = SET_LOG2) -> float:
    """Relative standard error of the number of keys of a set sketch."""
    return 1 / math.sqrt(2**log2)


# Quantiles -----------------------------------------------------------------------------------------


def quantile_sketches(df: DataFrame, dims: Sequence[str], column: str, k: int = QUANTILE_K) -> DataFrame:
    """One row per cell: the sketch of a whole-number column, the rows behind it, and how many of them have a value."""
    value = F.col(column).cast("bigint")
    return df.groupBy(*dims).agg(F.kll_sketch_agg_bigint(value, k).alias("sketch"), F.count("*").alias("rows"), F.count(value).alias("n"))


def merge_quantiles(sketches: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The sketches of all batches of each cell, merged."""
    return sketches.groupBy(*dims).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("rows").alias("rows"), F.sum("n").alias("n"))


def quantiles_of(merged: DataFrame, dims: Sequence[str], named: dict[str, float]) -> DataFrame:
    """Quantiles by name, with the rows and values of each cell; null where a cell has no value."""
    picked = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))).alias(name) for name, p in named.items()]
    return merged.select(*dims, "rows", "n", *picked)


#: Slots that a bracket is divided into per pass.
SLOTS = 1024


def exact_cell_quantiles(df: DataFrame, dims: Sequence[str], column: str, named: dict[str, float], write) -> DataFrame:
    """Quantiles of every cell with linear interpolation, for all cells and quantiles at once. Nulls, NaN and infinite values are left out.

    For each wanted rank of a cell there is a bracket, at first the cell's least and greatest value. Each pass counts the values inside into ``SLOTS``
    slots, with map-side partial counts, and moves on to the slot that holds the rank. No buffer holds a cell's values, and what is kept between passes has one row per cell and
    rank. ``write(df)`` writes a frame and reads it back; the column and the brackets go through it.
    """
    value, cell = F.col(column).cast("double"), F.to_json(F.struct(*dims), {"ignoreNullFields": "false"})
    rows = df.select(*dims, cell.alias("_cell"), value.alias("_v"))
    rows = write(rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < math.inf)))
    stats = rows.groupBy(*dims, "_cell").agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in named.items()])
    stats = stats.withColumn("_w", F.explode(wanted)).withColumn("_pos", F.col("_w.p") * (F.col("_n") - 1))
    ranks = F.array_distinct(F.array(*[f("_pos").cast("bigint") for f in (F.floor, F.ceil)]))
    state = stats.select(
        *dims, "_cell", F.col("_w.name").alias("_name"), "_pos", F.explode(ranks).alias("_rank"),
        F.lit(0).cast("bigint").alias("_before"), "_lo", "_hi",
    )
    state = write(state)
    while True:
        open_ = state.filter(F.col("_lo") < F.col("_hi"))
        if open_.isEmpty():
            break
        # One row per cell, so that a row of the large side meets one row; a hot cell is counted before it is shuffled.
        brackets = open_.select("_cell", "_rank", "_lo", "_hi").distinct().groupBy("_cell").agg(F.collect_list(F.struct("_rank", "_lo", "_hi")).alias("_b"))
        inside = left_join(rows, brackets, "_cell").select("_cell", "_v", F.explode("_b").alias("_b"))
        inside = inside.filter(F.col("_v").between(F.col("_b._lo"), F.col("_b._hi")))
        share = (F.col("_v") - F.col("_b._lo")) / (F.col("_b._hi") - F.col("_b._lo"))
        slot = F.least(F.lit(SLOTS - 1), F.floor(share * SLOTS))
        counts = inside.groupBy("_cell", F.col("_b._rank").alias("_rank"), slot.alias("_slot")).agg(
            F.count("*").alias("_m"), F.min("_v").alias("_slo"), F.max("_v").alias("_shi")
        )
        upto = Window.partitionBy("_cell", "_rank").orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_upto", F.sum("_m").over(upto))  # at most SLOTS rows a rank
        held = open_.join(counts, ["_cell", "_rank"]).filter(
            (F.col("_before") + F.col("_upto") > F.col("_rank")) & (F.col("_before") + F.col("_upto") - F.col("_m") <= F.col("_rank"))
        )
        moved = held.select(
            *dims, "_cell", "_name", "_pos", "_rank", (F.col("_before") + F.col("_upto") - F.col("_m")).alias("_before"),
            F.col("_slo").alias("_lo"), F.col("_shi").alias("_hi"),
        )
        state = write(state.filter(F.col("_lo") >= F.col("_hi")).unionByName(moved))
    low, high = F.min(F.struct("_rank", "_lo"))["_lo"], F.max(F.struct("_rank", "_lo"))["_lo"]
    value = low + (high - low) * (F.first("_pos") - F.floor(F.first("_pos")))
    by_name = state.groupBy(*dims, "_name").agg(value.alias("_value"))
    picked = [F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in named]
    return by_name.groupBy(*dims).agg(*picked)


# Sets of keys --------------------------------------------------------------------------------------


def key_sketch(df: DataFrame, key: str, *dims: str, log2: int = SET_LOG2) -> DataFrame:
    """Sketch of the different keys (of each batch, with its columns as ``dims``), the rows, and those without a key."""
    return df.groupBy(*dims).agg(
        F.theta_sketch_agg(F.col(key).cast("string"), log2).alias("keys"), F.count("*").alias("rows"),
        F.count_if(F.col(key).isNull()).alias("without"),
    )


def merge_keys(sketches: DataFrame, *dims: str, log2: int = SET_LOG2) -> DataFrame:
    """The sketches of all batches, merged: a key of several batches is one key."""
    return sketches.groupBy(*dims).agg(F.theta_union_agg("keys", log2).alias("keys"), F.sum("rows").alias("rows"), F.sum("without").alias("without"))


def distinct_estimate(keys: Column | str = "keys") -> Column:
    return F.theta_sketch_estimate(keys)


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row from two sketches of one row: estimated keys of either side, in both, and on the left only."""
    both = left.select(F.col("keys").alias("_l")).withColumn("_r", right.select("keys").scalar())
    return both.select(
        F.theta_sketch_estimate("_l").alias("n_left"),
        F.theta_sketch_estimate("_r").alias("n_right"),
        F.theta_sketch_estimate(F.theta_intersection("_l", "_r")).alias("n_both"),
        F.theta_sketch_estimate(F.theta_difference("_l", "_r")).alias("n_left_only"),
    )


def duplicates(df: DataFrame, key: str, sketches: DataFrame, at_most: float = 0.0, log2: int = SET_LOG2) -> DataFrame:
    """One row: estimated surplus rows per key, whether at most a share ``at_most`` of the rows is surplus, and whether that took an exact count.

    ``sketches`` has the sketches of the batches of ``df``. While these say by more than ``SIGMAS`` standard errors which side of the limit the table
    is on, no row is read; else the keys are counted exactly.
    """
    merged = merge_keys(sketches, log2=log2).select("rows", "without", distinct_estimate().alias("keys"))
    row = merged.first()  # one row
    rows = row["rows"] or 0
    keys = (row["keys"] or 0) + (1 if row["without"] else 0)
    slack = SIGMAS * set_error(log2) * keys if keys > 2**log2 else 0.0
    surplus, limit = rows - keys, at_most * rows
    decided = abs(surplus - limit) > slack or slack == 0.0
    if decided:
        exact = merged.select(F.lit(float(surplus)).alias("duplicates"))
    else:
        distinct = F.count_distinct(key) + F.coalesce(F.max(F.when(F.col(key).isNull(), 1).otherwise(0)), F.lit(0))
        exact = df.agg((F.count("*") - distinct).cast("double").alias("duplicates"))
    return exact.select("duplicates", (F.col("duplicates") <= F.lit(limit)).alias("passed"), F.lit(not decided).alias("counted"))
