"""Joins and writes where one key holds a third of the rows, with AQE's size thresholds scaled down to the
small test data."""

import glob

import pytest
from pyspark.sql import functions as F

from premia.functions import left_join
from premia.operators import enrich, fraud
from premia.operators.dedup import one_per_key
from premia.sources import sinks

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def skewed_claims(spark, n=60_000):
    """A third of the claims on one policy and client, another third without policy."""
    i = F.col("id")
    return spark.range(0, n, 1, 12).select(
        i.alias("claim_id"),
        F.when(i % 3 == 0, F.lit(7)).when(i % 3 == 1, i % 20_000).alias("policy_id"),
        F.when(i % 3 == 0, F.lit(7)).otherwise(i % 5000).alias("client_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 50).cast("int")).alias("date_sinistre"),
        F.sha2(i.cast("string"), 256).alias("description"),
    )


def policy_dim(spark):
    key = (F.col("id") * 7919 % 20_000).alias("policy_id")
    return one_per_key(spark.range(20_000).select(key, F.sha2(F.col("id").cast("string"), 256).alias("v")), ["policy_id"])


def test_hot_key_is_split_and_nulls_are_spread(spark, small_thresholds):
    claims = skewed_claims(spark)
    joined = left_join(claims, policy_dim(spark), "policy_id", spread="claim_id")
    rows, plan = final_plan(joined)
    assert "skew=true" in plan
    assert len(rows) == 60_000 and len({r["claim_id"] for r in rows}) == 60_000
    assert all((r["v"] is None) == (r["policy_id"] is None) for r in rows)
    spread = claims.withColumn("_hash", F.when(F.col("policy_id").isNull(), F.xxhash64("claim_id")))
    per_task = spread.filter("policy_id is null").groupBy(F.pmod(F.hash("policy_id", "_hash"), F.lit(16))).count()
    assert per_task.count() == 16 and per_task.agg(F.max("count")).first()[0] < 2000


def test_plain_join_to_an_aggregate_would_not_be_split(spark, small_thresholds):
    """Why left_join adds its second column."""
    _, plan = final_plan(skewed_claims(spark).join(policy_dim(spark), "policy_id", "left"))
    assert "skew=true" not in plan


def test_enrichment_splits_the_hot_policy_and_client(spark, small_thresholds):
    claims = skewed_claims(spark)
    text = F.sha2(F.col("id").cast("string"), 256)
    policies = spark.range(20_000).select(
        (F.col("id") * 7919 % 20_000).alias("policy_id"), F.lit("auto").alias("produit"), *[F.lit(1.0).alias(c) for c in ("prime_annuelle", "prime_mensuelle", "franchise", "plafond_garantie")],
        *[F.lit("2024-01-01").cast("date").alias(c) for c in ("date_souscription", "date_echeance")], text.alias("canal_vente"), F.lit("actif").alias("statut"))
    clients = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("client_id"), F.lit("particulier").alias("client_type"), text.alias("nom"), F.lit("direct").alias("canal_acquisition"),
        F.lit("gold").alias("segment"), F.lit("2020-01-01").cast("date").alias("date_creation"), F.lit(True).alias("actif"))
    rows, plan = final_plan(enrich.enrich_claims(claims, policies, clients))
    assert plan.count("skew=true") >= 2
    assert len(rows) == 60_000 and sum(r["has_valid_policy"] for r in rows) == sum(r["policy_id"] is not None for r in rows)


def test_frequent_rule_takes_the_flag_back_over_split_shuffles(spark, small_thresholds):
    claims = skewed_claims(spark)
    rows, _ = final_plan(fraud.flag_frequent(claims, 1000))
    # 400 claims a day on the hot client: busy from the third day on
    busy = claims.filter("client_id = 7 and date_sinistre >= '2024-01-03'").count()
    assert len(rows) == 60_000 and sum(r["flag_frequent_claimant"] for r in rows) == busy


def test_unused_columns_are_not_read(spark, tmp_path):
    skewed_claims(spark, 100).write.parquet(f"{tmp_path}/c")
    joined = left_join(spark.read.parquet(f"{tmp_path}/c"), policy_dim(spark), "policy_id", spread="claim_id")
    plan = joined.groupBy("v").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<claim_id:bigint,policy_id:bigint>" in plan


def test_hot_partition_is_written_by_several_tasks(spark, small_thresholds, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    df = skewed_claims(spark).withColumn("annee", F.when(F.col("policy_id") == 7, "2024").otherwise("2023"))
    assert sinks.write_table(df, str(tmp_path), "gold", "t", ["annee"]) == 60_000
    assert len(glob.glob(f"{tmp_path}/gold/t/annee=2024/*.parquet")) > 1
