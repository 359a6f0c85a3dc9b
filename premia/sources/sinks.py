"""Writing layer tables. Every write is a single action; row counts come from the write itself."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import quote
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from premia.settings import LakeSettings
from premia.sources.readers import table_path

BRONZE_PARTITIONS = LakeSettings().bronze_partitions

#: Compression of the lake's Parquet tables: a quarter to a third smaller than Snappy, as fast to write.
CODEC = "zstd"
#: Spark then removes the files of a query's shuffles when the query ends, and not when the driver happens to collect garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the writes in the body; those before come back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_ingestion_metadata(
    df: DataFrame, source_system: str, batch_id: str, source_file: str, now: datetime
) -> DataFrame:
    """Time, source, batch and base file name of an ingestion, and its year and month."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.lit(now).cast("timestamp"),
            "source_system": F.lit(source_system),
            "batch_id": F.lit(batch_id),
            "source_file": F.lit(posixpath.basename(source_file)),
            "annee_ingestion": F.lit(f"{now.year}"),
            "mois_ingestion": F.lit(f"{now.month:02d}"),
        }
    )


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    grouped: bool = False,
) -> int:
    """Replace (or append to) a table and return the number of rows written.

    Rows are first rebalanced on the partition columns: small partitions share a task and a file, and a
    partition with very many rows is split over several tasks instead of one. Rows that are read ``grouped``, from files of few partitions each,
    are written where they are read, without a shuffle.
    """
    seen = Observation()
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by and not grouped else df
    out = out.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = out.write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "parquet":
        # A replaced table must not keep partitions of its former content.
        writer = writer.option("partitionOverwriteMode", "static").option("compression", CODEC)
    else:
        writer = writer.option("mergeSchema", True)
        if mode == "overwrite":
            writer = writer.option("overwriteSchema", True)
    with session_settings(df.sparkSession, TIDY):
        writer.save(table_path(root, layer, name))
    return seen.get["n"]


def append_batch(
    df: DataFrame, root: str, layer: str, name: str, batch_id: str, partition_by: Sequence[str] = BRONZE_PARTITIONS
) -> None:
    """Add a batch as a whole. The first partition column names it: all that the table holds of it is replaced, also by
    nothing and whatever the month of the earlier run."""
    first, *others = partition_by
    place = partition_path(table_path(root, layer, name), [first], [batch_id])
    writer = df.drop(first).write.format("parquet").mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
    with session_settings(df.sparkSession, TIDY):
        (writer.partitionBy(*others) if others else writer).save(place)


def stage_split(marked: DataFrame, place: str, rules: str = "_rejection_rules") -> dict[str, int]:
    """Write valid and rejected rows in one pass over the input, as two partitions of one staged table; rows in and valid, from that write.

    Nothing that others read has changed yet: ``staged`` reads a side back to publish it, and a job that dies before is repeated.
    """
    seen = Observation()
    valid = F.size(rules) == 0
    rows = marked.withColumn("_state", F.when(valid, F.lit("valid")).otherwise(F.lit("rejected")))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("_state") == "valid").alias("n_valid"))
    with session_settings(marked.sparkSession, TIDY):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).partitionBy("_state").parquet(place)
    counts = dict(seen.get)
    return counts | {"n_rejected": counts["n_in"] - counts["n_valid"]}


def staged(like: DataFrame, place: str, state: str) -> DataFrame:
    """One side of a staged split: only its partition is read. Without rows on a side there is nothing to read."""
    schema = StructType([*like.schema.fields, StructField("_state", StringType())])
    return like.sparkSession.read.schema(schema).parquet(place).filter(F.col("_state") == state).drop("_state")


def written(df: DataFrame, place: str) -> DataFrame:
    """The rows of ``df``, staged as a table and read again: what was shuffled for them goes. ``clear`` removes the table."""
    with session_settings(df.sparkSession, TIDY):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def partition_path(table: str, names: Sequence[str], values: Sequence[str | None]) -> str:
    """Where a partition of a table lies."""
    texts = ["__HIVE_DEFAULT_PARTITION__" if v is None else quote(str(v), safe=" ,-_.") for v in values]
    return "/".join([table, *[f"{n}={t}" for n, t in zip(names, texts, strict=True)]])


def clear(spark: SparkSession, place: str) -> None:
    """Remove all files of a table or partition: an overwrite by no partition at all leaves none."""
    nothing = spark.range(0).withColumn("none", F.col("id"))
    nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("none").parquet(place)


def write_rejects(rejected: DataFrame, root: str, entity: str, batch_id: str) -> None:
    """Set rejected rows aside, by batch."""
    append_batch(rejected, root, "dead_letter_queue", entity, batch_id, ["_batch_id"])


def export_columns(df: DataFrame | None, columns: Sequence[str], path: str) -> bool:
    """Write the listed columns that exist as Snappy Parquet; an absent or empty table is skipped."""
    if df is None or df.isEmpty():
        return False
    df.select(*[c for c in columns if c in df.columns]).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return True
