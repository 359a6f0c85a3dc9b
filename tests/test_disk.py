"""What the lake's jobs hold on disk: files of shuffles, staged tables, raw text, and shuffles that are not needed."""

import glob
import gzip
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from premia.operators import enrich, exposure
from premia.plans import medallion, raw_files
from premia.settings import LakeSettings
from premia.sources import driver_tables, sinks
from tests.conftest import rows
from tests.test_driver_tables import tables  # noqa: F401
from tests.test_medallion import raw  # noqa: F401

NOW = datetime(2024, 6, 1, 12)


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


@pytest.mark.parametrize("write", [
    lambda df, to: sinks.write_table(df, to, "gold", "t"),
    lambda df, to: sinks.append_batch(df.withColumn("batch_id", F.lit("b")), to, "bronze", "t", "b", ["batch_id"]),
    lambda df, to: sinks.stage_split(df.withColumn("_rejection_rules", F.array().cast("array<string>")), to),
    lambda df, to: sinks.written(df, to),
])
def test_shuffles_of_a_write_go_with_it(spark, tmp_path, write):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held, before = spark.conf.get(key), shuffle_files(spark)
    write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), f"{tmp_path}/t")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and spark.conf.get(key) == held


def test_settings_come_back_after_a_failure(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError):
        with sinks.session_settings(spark, {"spark.sql.shuffle.partitions": "3", "premia.unknown": "x"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("premia.unknown") == "x"
            1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == held and spark.conf.get("premia.unknown", None) is None


def test_tables_are_packed_closely(spark, tmp_path):
    sinks.write_table(spark.range(9), str(tmp_path), "gold", "t")
    assert glob.glob(f"{tmp_path}/gold/t/*.zstd.parquet") and not glob.glob(f"{tmp_path}/gold/t/*.snappy.parquet")


def test_raw_text_is_packed_in_files_of_bounded_size(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    day = F.lit("2000-01-01").cast("timestamp")
    events = spark.range(30).select(F.col("id").alias("event_id"), F.lit("error").alias("event_type"), F.lit(1).alias("user_id"), day.alias("ts"), F.lit(1.5).alias("value"))
    monkeypatch.setattr(driver_tables, "table", lambda spark, sf, name, read=driver_tables.table: made.get(name, None) or read(spark, sf, name))
    made = {"events": events.coalesce(1), "region": spark.createDataFrame([(2, "north")], "r_regionkey int, r_name string")}
    monkeypatch.setitem(raw_files.PACKED, "maxRecordsPerFile", 8)
    paths = raw_files.write_raw_files(spark, tables, str(tmp_path))
    for name, header in (("claims", 1), ("policies", 0), ("payments", 1)):
        files = [f for f in os.listdir(paths[name]) if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
        assert max(len(gzip.open(f"{paths[name]}/{f}").readlines()) for f in files) <= 8 + header
    lake = medallion.Lake(f"{tmp_path}/lake", NOW, "b1")
    assert medallion.ingest_claims(spark, paths["claims"], lake)["n_in"] == driver_tables.claims(spark, tables).count()
    assert medallion.ingest_payments(spark, paths["payments"], lake) == 30


def test_claims_are_staged_between_the_joins(spark, raw, tmp_path, monkeypatch):  # noqa: F811
    lake, places = medallion.Lake(str(tmp_path), NOW, "b1"), []
    for job in ("claims", "policies"):
        getattr(medallion, f"ingest_{job}")(spark, raw[job], lake)
    medallion.ingest_clients(spark, raw["clients"], lake)
    monkeypatch.setattr(sinks, "written", lambda df, place, write=sinks.written: places.append(place) or write(df, place))
    medallion.bronze_to_silver(spark, lake)
    assert [p.removeprefix(str(tmp_path)) for p in places] == ["/staging/silver/clients", "/staging/silver/claims"]
    assert not glob.glob(f"{tmp_path}/staging/**/*.parquet", recursive=True)
    claims, policies, clients = lake.read(spark, "bronze", "claims"), lake.read(spark, "silver", "policies"), lake.read(spark, "silver", "clients")
    straight = enrich.with_client(enrich.with_policy(claims, policies), clients)
    joined = enrich.enrich_claims(claims, policies, clients)
    assert joined.columns == straight.columns and joined.schema == straight.schema and rows(joined) == rows(straight)


@pytest.mark.parametrize("partitions, grouped", [(("annee_sinistre", "mois_sinistre"), True), (("mois_sinistre",), False)])
def test_aging_needs_a_shuffle_only_where_silver_is_not_by_year(spark, raw, tmp_path, scans, partitions, grouped):  # noqa: F811
    lake = medallion.Lake(str(tmp_path), NOW, "b1", layout=LakeSettings(silver_partitions=partitions))
    for job in ("claims", "policies"):
        getattr(medallion, f"ingest_{job}")(spark, raw[job], lake)
    medallion.ingest_clients(spark, raw["clients"], lake)
    medallion.bronze_to_silver(spark, lake)
    seen = scans()
    counts = medallion.claims_aging(spark, lake)
    store = seen._store()
    written = min(i for i in seen._ids() if i > seen.since)
    plan = store.execution(written).get().physicalPlanDescription()
    assert "claims_aging_detail" in plan and ("Exchange" in plan) != grouped
    detail = lake.read(spark, "gold", "claims_aging_detail")
    assert counts["claims_aging_detail"] == detail.count() == 4 and {r["annee"] for r in detail.collect()} == {"2023"}


def test_both_exposure_tables_come_from_one_pass_over_the_policies(spark, raw, tmp_path, monkeypatch):  # noqa: F811
    lake = medallion.Lake(str(tmp_path), NOW, "b1")
    lake.write(spark.createDataFrame(
        [("p1", "1", "auto", "x", "actif", 100.01, 10.0, "a"), ("p1", "1", "auto", "x", "actif", 100.01, 10.0, "b"), ("p2", "2", "vie", "x", "actif", None, 20.0, "a"),
         ("p3", "2", None, "x", "actif", 33.33, None, "a"), ("p4", None, "auto", "y", "actif", 66.67, 5.0, "a"), ("p5", "2", "vie", "x", "resilié", 9.0, 5.0, "a")],
        "policy_id string, region_code string, produit string, canal_vente string, statut string, prime_annuelle double, plafond_garantie double, garantie_code string",
    ).withColumn("ingestion_timestamp", F.lit(NOW)), "silver", "policies")
    lake.write(spark.createDataFrame(
        [("c1", "1", 50.0, 40.0)], "claim_id string, region_code string, montant_declare double, montant_indemnise double"), "silver", "claims")
    read = []
    monkeypatch.setattr(exposure, "active_policies", lambda df, make=exposure.active_policies: read.append(df) or make(df))
    medallion.portfolio_exposure(spark, lake, raw["regions"])
    assert len(read) == 1
    active = exposure.active_policies(lake.read(spark, "silver", "policies"))
    assert rows(lake.read(spark, "gold", "concentration_risk")) == rows(exposure.concentration(active))
    table = lake.read(spark, "gold", "portfolio_exposure")
    assert table.count() == 4 and {r[0] for r in table.select("portfolio_hhi").collect()} == {exposure.hhi(active, "prime_annuelle", "produit").first()[0]}
    assert not spark._jsparkSession.sharedState().cacheManager().numCachedEntries()
