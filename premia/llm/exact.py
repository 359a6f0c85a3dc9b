"""Exact de-duplication as a stream with keyed state on disk.

The stream's state (RocksDB, no watermark, so nothing expires) holds per SHA-256 digest the number of copies, the
greatest doc_id and the locator of that row's content (file and row number). ``ingest`` may be called again with more
documents and the same folder: the state goes on from where it was. After a run the state is read as a table, and every
digest that was hit is checked on full bytes: rows are grouped by digest *and* text, with copies reduced before the
shuffle, so a text that a third of all rows share arrives as one row per task. Should two texts ever share a digest,
their rows get their classes from the texts.

Defined results: a null text equals the empty text; of rows with equal doc_id and text, the one with the greatest
locator stays; a null doc_id is below all others; very long texts are
digested and compared whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm.common import chosen, documents, shared_folder, text_of, with_row_id, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Else every partition of the state reserves megabytes of disk for its first manifest and log.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def located(docs: DataFrame) -> DataFrame:
    """doc_id and text with their content locator, rid."""
    return with_row_id(docs.select("doc_id", "text"), "rid")


def digests(rows: DataFrame) -> DataFrame:
    """Stable identifier (doc_id), content locator (rid) and digest of every located row."""
    return rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(), 256)).alias("digest"))


def ingest(slim: DataFrame, state: str, name: str = "digests") -> DataFrame:
    """Streams the rows that are new in the folder of ``slim`` into the state; returns the state: digest, copies, keep."""
    spark = slim.sparkSession
    folder = f"{state}/{name}"
    slim.write.mode("append").parquet(folder)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        (
            spark.readStream.schema(slim.schema)
            .parquet(folder)
            .groupBy("digest")
            .agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("copies"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", f"{state}/state")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return state_table(spark, state)


def state_table(spark: SparkSession, state: str) -> DataFrame:
    rows = spark.read.format("statestore").load(f"{state}/state")
    return rows.select(
        F.col("key.digest").alias("digest"), F.col("value.count").alias("copies"), F.col("value.max").alias("keep")
    )


def collisions(rows: DataFrame, digest=None) -> DataFrame:
    """rid, keep, copies of the rows whose digest stands for more than one text. Reads full bytes; empty unless SHA-256 breaks."""
    rows = rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("digest", digest if digest is not None else F.unhex(F.sha2("text", 256)))
    # Both counts are map-side combined; no group's rows are gathered.
    texts = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("copies"))
    several = written(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"), "several")
    # As a written table its size is known: an empty one is broadcast, and no text is shuffled again.
    struck = rows.join(several, "digest", "left_semi")
    classes = struck.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("copies"))
    out = struck.select("rid", "digest", "text").join(classes, ["digest", "text"]).select("rid", "keep", "copies")
    return written(out, "collisions")


def deduplicate(docs: DataFrame, state: str | None = None) -> DataFrame:
    """One row per document: rid, doc_id, keep_id, group_size, kept, text_sha256."""
    return classify(located(docs), state)


def classify(rows: DataFrame, state: str | None = None) -> DataFrame:
    """The same for rows that have their locator (rid)."""
    state = state or shared_folder(rows.sparkSession, "exact")
    slim = written(digests(rows), "slim")
    found = ingest(slim, state)
    fixed = collisions(rows).select("rid", F.col("keep").alias("own_keep"), F.col("copies").alias("own_copies"))
    joined = slim.join(found, "digest").join(fixed, "rid", "left")
    keep, copies = F.coalesce("own_keep", "keep"), F.coalesce("own_copies", "copies")
    return joined.select(
        "rid", "doc_id", keep["doc_id"].alias("keep_id"), copies.alias("group_size"),
        (keep["rid"] == F.col("rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``."""
    return chosen(docs, lambda rows: classify(rows.select("rid", "doc_id", "text")).select("rid", F.col("kept").cast("int").alias("copies")))


def op3_exact(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return deduplicate(docs).drop("rid")


ORACLE = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
