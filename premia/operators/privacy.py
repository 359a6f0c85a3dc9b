"""Pseudonyms, masking, erasure, upsert and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators.dedup import latest_per_key

BLOCK = 64  # block size of SHA-256 in bytes


def key_frame(spark: SparkSession, key: bytes) -> DataFrame:
    """A key as a table of one row. Where the key lies in a protected Parquet file (one row, column ``key``), read that instead."""
    return spark.createDataFrame([(bytearray(key),)], "key binary")


def _pad(byte: int) -> Column:
    """The key, filled up to a block, with every byte XORed."""
    short = F.when(F.length("key") > BLOCK, F.unhex(F.sha2("key", 256))).otherwise(F.col("key"))
    text = F.rpad(F.hex(short), 2 * BLOCK, "0")

    def xored(i: Column) -> Column:
        return F.lpad(F.hex(F.conv(F.substring(text, i * 2 + 1, F.lit(2)), 16, 10).cast("int").bitwiseXOR(F.lit(byte))), 2, "0")

    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), xored), ""))


def hmac_sha256(value: Column, key: DataFrame) -> Column:
    """HMAC-SHA256 of a column as hex text, from native hash functions.

    The key is a table of one row (``key``). Its two padded forms are scalar subqueries: they are computed once when the query runs, so
    neither plan, explain text nor event log shows them, and each row costs two native hashes and no Python call.
    """
    inner, outer = (key.select(_pad(b).alias("pad")).scalar() for b in (0x36, 0x5C))
    digest = F.unhex(F.sha2(F.concat(inner, value.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def pseudonymise(df: DataFrame, columns: Sequence[str], key: bytes | DataFrame) -> DataFrame:
    """Replace identifiers by their keyed digest; null stays null."""
    if isinstance(key, (bytes, bytearray)):
        key = key_frame(df.sparkSession, bytes(key))
    return df.withColumns({c: hmac_sha256(F.col(c), key) for c in columns})


def mask(df: DataFrame, columns: Sequence[str], env: str) -> DataFrame:
    """Blank amounts outside production."""
    if env == "prod":
        return df
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns})


def erase(df: DataFrame, keys: DataFrame, key: str = "client_id") -> DataFrame:
    """Rows that belong to none of the erased keys. The key and its hash are compared, with a spread hash for rows without a key, so that
    these do not meet in one task; they stay."""
    own = F.xxhash64(key)
    rows = df.withColumn("_hash", F.when(F.col(key).isNull(), F.xxhash64(*df.columns)).otherwise(own))
    gone = keys.select(key).distinct().withColumn("_hash", own)
    return rows.join(gone, [key, "_hash"], "left_anti").drop("_hash")


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Current rows with corrections applied: the latest version of each key. Write it to a new
    snapshot, never over its own input."""
    return latest_per_key(current.unionByName(changes), keys, order_by)


def retain(df: DataFrame, date: str, years: int, as_of: Column) -> DataFrame:
    """Rows not older than a number of years; rows without a date are kept."""
    return df.filter(F.col(date).isNull() | (F.col(date) >= F.add_months(as_of, -12 * years)))
