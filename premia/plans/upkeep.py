"""Jobs that change written tables: erasure, corrections, retention. Only the partitions concerned are rewritten; all others keep their files.

A rewrite is staged in full before the table changes, and then replaces its partitions; a job that dies is repeated with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from premia.entities import CORRUPT
from premia.operators.dedup import latest_per_key
from premia.plans.medallion import Lake
from premia.sources import readers, sinks

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how Spark writes a null in a path


@dataclass(frozen=True)
class Table:
    """A table of the lake: its partition columns, and the date that decides about rows where a partition cannot."""

    layer: str
    name: str
    partition_by: tuple[str, ...] = ()
    date: str | None = None

    def path(self, lake: Lake) -> str:
        return readers.table_path(lake.root, self.layer, self.name)

    def read(self, spark: SparkSession, lake: Lake) -> DataFrame | None:
        return readers.read_table_if_present(spark, lake.root, self.layer, self.name, merge_schema=self.layer == "bronze")


def tables_of(lake: Lake) -> list[Table]:
    """All tables that hold identifiers."""
    bronze, silver = lake.layout.bronze_partitions, lake.layout.silver_partitions
    return [
        Table("bronze", "claims", bronze), Table("bronze", "policies", bronze), Table("bronze", "clients"), Table("bronze", "payments"),
        Table("dead_letter_queue", "claims", ("_batch_id",)), Table("dead_letter_queue", "policies", ("_batch_id",)),
        Table("silver", "claims", silver, "date_sinistre"), Table("silver", "policies"), Table("silver", "clients"),
        Table("gold", "earned_premium"), Table("gold", "fraud_assessment"), Table("gold", "churn_scores"),
        Table("gold", "claims_aging_detail", ("annee", "type_sinistre")),
    ]


def partitions(df: DataFrame, names: Sequence[str]) -> list[tuple[str | None, ...]]:
    """Partitions of a table as its files lie, without reading one."""
    found = set()
    for file in df.inputFiles():
        values = dict(part.split("=", 1) for part in file.split("/") if "=" in part)
        found.add(tuple(None if values[n] == NO_VALUE else unquote(unquote(values[n])) for n in names))
    return sorted(found, key=repr)


def _one_of(names: Sequence[str], chosen: Sequence[Sequence]) -> Column:
    """Condition on partition columns alone, so that other partitions are not listed for reading."""
    each = [reduce(Column.__and__, [F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(names, values, strict=True)]) for values in chosen]
    return reduce(Column.__or__, each, F.lit(False))


def rewrite(lake: Lake, table: Table, chosen: Sequence[Row], change: Callable[[DataFrame], DataFrame], current: DataFrame) -> int:
    """Replace the chosen partitions by what ``change`` makes of their rows (a table without partitions as a whole); the partitions replaced."""
    spark = current.sparkSession
    names, path = list(table.partition_by), table.path(lake)
    place = f"{lake.root}/staging/rewrite/{table.layer}/{table.name}"
    chosen = [tuple(r) for r in chosen]
    if names and not chosen:
        return 0
    changed = change(current.filter(_one_of(names, chosen)) if names else current)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(place)
    staged = spark.read.schema(changed.schema).parquet(place)
    if names:
        left = {tuple(r) for r in staged.select(*names).distinct().collect()}  # one row per partition
        for values in set(chosen) - left:
            sinks.clear(spark, sinks.partition_path(path, names, values))
        out = staged.hint("rebalance", *[F.col(c) for c in names])
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)
    else:
        sinks.write_table(staged, lake.root, table.layer, table.name)
    sinks.clear(spark, place)
    return len(set(chosen) | left) if names else 1


# Erasure -------------------------------------------------------------------------------------------

KEYS = ("client_id", "policy_id", "claim_id")


def closure(spark: SparkSession, lake: Lake, clients: DataFrame) -> DataFrame:
    """kind and key of all that belongs to the given clients (column client_id): the clients, their policies, and the claims of either.

    Versions of all layers count, so that a policy that changed hands is found by every owner it had.
    """
    keys = clients.select(F.lit("client_id").alias("kind"), F.trim(F.col("client_id").cast("string")).alias("key"))

    def owned(name: str, by: Sequence[str], kind: str, known: DataFrame) -> DataFrame:
        parts = []
        for layer in ("bronze", "silver", "dead_letter_queue"):
            df = readers.read_table_if_present(spark, lake.root, layer, name, merge_schema=layer == "bronze")
            for c in by if df is not None else ():
                wanted = known.filter(F.col("kind") == c).select(F.col("key").alias("_key"))
                rows = df.select(F.trim(F.col(c).cast("string")).alias("_key"), F.trim(F.col(kind).cast("string")).alias("key"))
                parts.append(rows.join(wanted, "_key", "left_semi").select(F.lit(kind).alias("kind"), "key"))
        return reduce(DataFrame.unionAll, parts, known).filter(F.col("key").isNotNull()).distinct()

    place = f"{lake.root}/staging/erase"
    for step, (name, by, kind) in enumerate((("policies", ("client_id",), "policy_id"), ("claims", ("client_id", "policy_id"), "claim_id"))):
        keys = owned(name, by, kind, keys)
        keys.write.mode("overwrite").parquet(f"{place}/{step}")
        keys = spark.read.schema("kind string, key string").parquet(f"{place}/{step}")
    return keys


def marked(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``df`` with ``_gone``: one of its identifiers is a key; of a record that could not be read, one of the words of its text is."""
    hit, out = F.lit(False), df
    for c in [c for c in KEYS if c in df.columns]:
        of_kind = keys.filter(F.col("kind") == c).select(F.col("key").alias("_key"), F.lit(True).alias(f"_is_{c}")).distinct()
        own = F.trim(F.col(c).cast("string"))
        # Rows without the identifier match nothing and are spread.
        out = out.withColumn("_key", own).withColumn("_hash", F.when(own.isNull(), F.xxhash64(*df.columns)).otherwise(F.xxhash64(own)))
        out = out.join(of_kind.withColumn("_hash", F.xxhash64("_key")), ["_key", "_hash"], "left").drop("_key", "_hash")
        hit = hit | F.coalesce(F.col(f"_is_{c}"), F.lit(False))
    if CORRUPT in df.columns:
        broken = df.select(F.col(CORRUPT).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
        words = broken.select("_text", F.explode(F.array_distinct(F.split("_text", r"[^\w-]+"))).alias("key"))
        named = words.join(keys.select("key").distinct(), "key", "left_semi").select(F.col("_text").alias(CORRUPT), F.lit(True).alias("_named")).distinct()
        own = F.when(F.col(CORRUPT).isNull(), F.xxhash64(*df.columns)).otherwise(F.xxhash64(CORRUPT))
        out = out.withColumn("_hash", own).join(named.withColumn("_hash", F.xxhash64(CORRUPT)), [CORRUPT, "_hash"], "left").drop("_hash")
        hit = hit | F.coalesce("_named", F.lit(False))
    return out.select(*df.columns, hit.alias("_gone"))


def erase_clients(spark: SparkSession, lake: Lake, clients: DataFrame) -> dict[str, int]:
    """Erase clients with all that belongs to them from every table that holds identifiers: partitions rewritten, by table.

    Which partitions are concerned is found from the identifiers and the partition columns alone. Tables of totals hold no identifier; run their jobs
    again to take the erased rows out of the totals.
    """
    keys, out = closure(spark, lake, clients), {}
    for table in tables_of(lake):
        df = table.read(spark, lake)
        if df is None:
            continue
        found = marked(df, keys).filter("_gone")
        if table.partition_by:
            chosen = found.select(*table.partition_by).distinct().collect()  # one row per partition
        else:
            chosen = found.select(F.lit(1)).limit(1).collect()
        if chosen:
            kept = lambda rows: marked(rows, keys).filter(~F.col("_gone")).drop("_gone")
            out[f"{table.layer}.{table.name}"] = rewrite(lake, table, chosen, kept, df)
    for step in (0, 1):
        sinks.clear(spark, f"{lake.root}/staging/erase/{step}")
    return out


# Corrections ---------------------------------------------------------------------------------------


def unsettled(current: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keys of the corrections whose rows in the table are not yet the one row that is to stay."""
    held = current.join(changes.select(*keys).distinct(), list(keys), "left_semi").select(*changes.columns, F.lit(True).alias("_held"))
    row = F.struct(*order_by, *[c for c in changes.columns if c not in (*keys, *order_by)])
    versions = held.unionByName(changes.withColumn("_held", F.lit(False)))
    of_key = versions.groupBy(*keys).agg(F.max(row).alias("_stays"), F.max(F.when(F.col("_held"), row)).alias("_is"), F.count_if("_held").alias("_rows"))
    return of_key.filter((F.col("_rows") != 1) | ~F.col("_stays").eqNullSafe(F.col("_is"))).select(*keys)


def correct(spark: SparkSession, lake: Lake, table: Table, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> int:
    """Apply corrections (rows with the table's columns): of each key the latest version stays. Partitions rewritten.

    Rewritten are the partitions that hold a corrected key or receive one; a correction may move its row to another partition. In those, rows of other
    keys pass without a shuffle where the corrections are small. A key whose one row is what the corrections make of it is left alone, so that a second run
    rewrites nothing.
    """
    current = table.read(spark, lake)
    changes = changes.select(*current.columns)
    corrected = unsettled(current, changes, keys, order_by)
    due = corrected.select(*[F.col(k).alias(f"_due_{k}") for k in keys])
    changes = changes.join(due, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_due_{k}")) for k in keys]), "left_semi")
    names = list(table.partition_by)
    chosen = []
    if names:
        held = current.select(*{*keys, *names}).join(corrected, list(keys), "left_semi").select(*names)
        chosen = held.unionByName(changes.select(*names)).distinct().collect()  # one row per partition

    def latest(rows: DataFrame) -> DataFrame:
        versions = rows.join(corrected, list(keys), "left_semi").unionByName(changes)
        return rows.join(corrected, list(keys), "left_anti").select(*current.columns).unionByName(latest_per_key(versions, list(keys), list(order_by)))

    return rewrite(lake, table, chosen, latest, current)


# Retention -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Expired:
    """Partitions of a table that are dropped whole, and those of which some rows are too old."""

    dropped: list = field(default_factory=list)
    cut: list = field(default_factory=list)


def period(values: Sequence[str | None], kinds: Sequence[str]) -> tuple[date, date] | None:
    """First day of the period that partition values stand for, and the first day after it; None if they name none."""
    given = {k: v for k, v in zip(kinds, values, strict=True) if k}
    if given.get("year") is None or not given["year"].isdigit():
        return None
    year, first, months = int(given["year"]), 1, 12
    if given.get("month") is not None:
        first, months = int(given["month"]), 1
    elif given.get("quarter") is not None:
        first, months = int(given["quarter"][-1]) * 3 - 2, 3
    after = year * 12 + first - 1 + months
    return date(year, first, 1), date(after // 12, after % 12 + 1, 1)


#: What partition columns stand for.
PERIODS = {
    "annee_ingestion": "year", "mois_ingestion": "month", "annee_sinistre": "year", "mois_sinistre": "month", "annee": "year", "trimestre": "quarter",
}


def expired(df: DataFrame, table: Table, oldest: date) -> Expired:
    """Partitions older than the first day that is kept, from the paths of the files alone."""
    kinds, out = [PERIODS.get(n, "") for n in table.partition_by], Expired()
    for values in partitions(df, table.partition_by):
        days = period(values, kinds)
        if days and days[1] <= oldest:
            out.dropped.append(values)
        elif days and days[0] < oldest and table.date:
            out.cut.append(values)
    return out


def retained(lake: Lake) -> list[tuple[Table, int]]:
    """Tables with a period in their partitions, and the years they are kept."""
    keep = lake.retention
    return [
        (Table("bronze", "claims", lake.layout.bronze_partitions), keep.bronze),
        (Table("bronze", "policies", lake.layout.bronze_partitions), keep.bronze),
        (Table("silver", "claims", lake.layout.silver_partitions, "date_sinistre"), keep.silver),
        (Table("gold", "portfolio_kpis", lake.layout.gold_partitions), keep.gold),
        (Table("gold", "claims_aging_detail", ("annee", "type_sinistre"), "date_sinistre"), keep.gold),
    ]


def expire(spark: SparkSession, lake: Lake) -> dict[str, Expired]:
    """Drop what is older than its layer's years, by table.

    Whole partitions are dropped without reading a row. In the one period that the limit falls into, rows before it go where the table has a date; where
    it has none, that period stays until it is over. Rows without a period stay.
    """
    out = {}
    for table, years in retained(lake):
        df = table.read(spark, lake)
        if df is None:
            continue
        now = lake.now.date()
        oldest = now.replace(year=now.year - years, day=min(now.day, 28) if now.month == 2 else now.day)
        found = expired(df, table, oldest)
        for values in found.dropped:
            sinks.clear(spark, sinks.partition_path(table.path(lake), table.partition_by, values))
        young = F.col(table.date).isNull() | (F.col(table.date) >= F.lit(oldest)) if table.date else F.lit(True)
        if found.cut and not df.filter(_one_of(table.partition_by, found.cut) & ~young).isEmpty():
            rewrite(lake, table, [Row(*v) for v in found.cut], lambda rows: rows.filter(young), df)
        out[f"{table.layer}.{table.name}"] = found
    return out
