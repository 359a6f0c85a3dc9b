import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from premia.operators import expectations
from premia.operators.enrich import one_policy_per_id
from premia.plans import medallion
from premia.sources import readers, sinks
from tests.conftest import rows

NOW = datetime(2024, 6, 1, 12)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """A few rows of each entity with defects, as raw files."""
    root = tmp_path_factory.mktemp("raw")
    header = "claim_id,policy_id,client_id,type_sinistre,date_sinistre,date_declaration,date_cloture,montant_declare,montant_provision,montant_indemnise,statut,region_code,description,is_fraud_injected,fraud_rule_injected"
    lines = [
        'c1,p1,k1, VOL ,2023-01-05,2023-01-06,2023-02-01,1000.0,0,900,CLOS,11,"said ""stop"", left",False,',
        "c2,p1,k1,vol,05/02/2023,2023-02-01,,500,400,,ouvert,11,,False,",
        "c3,p2,k2,vol,2023-03-01,2023-09-30,,50000,40000,,en_cours,24,x,True,RULE_005",
        "c4,p9,k9,vol,2023-04-01,2023-04-02,,10,5,,ouvert,24,x,False,",
        "c5,p2,k2,vol,2023-04-01,2023-04-02,,0,5,,ouvert,24,x,False,",
        "c6,p2,k2,vol,2023-04-01,2023-04-02,,abc,5,,ouvert,24,x,False,",
        "c7,p2,k2,boat,2023-04-01,2023-04-02,,10,5,,ouvert,24,x,False,",
        "c1,p1,k1,vol,2023-01-05,2023-01-06,2023-02-01,1000.0,0,900,clos,11,zzz,False,",
    ]
    (root / "claims.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    policy = {"client_id": "k1", "produit": " AUTO ", "date_souscription": "2023-01-04", "date_echeance": "2024-01-04", "prime_annuelle": 365.0,
              "canal_vente": "Agent", "statut": "Actif", "region_code": "11", "plafond_garantie": 1000.0,
              "garanties": [{"code": "VOL", "libelle": "Vol", "plafond": 10.0, "incluse": True}, {"code": "BRIS", "libelle": None, "plafond": 5.0, "incluse": None}]}
    policies = [{"policy_id": "p1", **policy}, {"policy_id": "p2", **policy, "client_id": "k2", "produit": "vie", "region_code": "24", "garanties": []},
                {"policy_id": "p3", **policy, "statut": "lapsed"}]
    (root / "policies.jsonl").write_text("\n".join(map(json.dumps, policies)), encoding="utf-8")
    (root / "policies.json").write_text(json.dumps(policies), encoding="utf-8")
    clients = [(f"k{i}", "particulier", f"n{i}", "A", "11", "2020-01-01", "web", "gold", True) for i in (1, 2, 3)]
    spark.createDataFrame(clients, "client_id string, client_type string, nom string, adresse string, region_code string, date_creation string, canal_acquisition string, segment string, actif boolean").write.parquet(str(root / "clients"))
    (root / "payments.csv").write_text(
        "payment_id,claim_id,policy_id,client_id,date_paiement,montant,devise,statut,mode_paiement,reference_banque,motif_impaye\n"
        "y1,c1,p1,k1,2023-01-01,10.5,EUR,IMPAYE,cb,r,x\ny2,c1,p1,k1,2023-02-01,10.5,EUR,paye,cb,r,\n", encoding="utf-8")
    (root / "regions.csv").write_text("code,nom,population,densite\n11,Nord,10,1\n24,Sud,20,2\n", encoding="utf-8")
    return {n: str(root / f) for n, f in {"claims": "claims.csv", "policies": "policies.jsonl", "policies_array": "policies.json", "clients": "clients",
                                          "payments": "payments.csv", "regions": "regions.csv"}.items()}


@pytest.fixture(scope="module")
def run(spark, raw, tmp_path_factory):
    lake = medallion.Lake(str(tmp_path_factory.mktemp("lake")), NOW, "b1")
    return lake, medallion.run_all(spark, raw, lake)


def test_counts(run):
    _, counts = run
    assert counts["claims"] == {"n_in": 8, "n_valid": 5, "n_rejected": 3}
    assert counts["policies"] == {"n_in": 5, "n_valid": 3, "n_rejected": 2}
    assert counts["silver"] == {"policies": 3, "clients": 3, "claims": 4}
    assert counts["churn"] == 3 and counts["fraud"]["n_out"] == 4


def test_rejects_are_set_aside(spark, run):
    lake, _ = run
    got = {r["claim_id"]: r["_rejection_rules"] for r in lake.read(spark, "dead_letter_queue", "claims").collect()}
    assert got == {"c5": ["montant_declare_not_positive"], "c6": ["montant_declare_missing", "montant_declare_not_positive"], "c7": ["type_sinistre_not_allowed"]}


def test_silver_claims(spark, run):
    lake, _ = run
    got = {r["claim_id"]: r for r in lake.read(spark, "silver", "claims").collect()}
    assert got["c1"]["description"] == "zzz" and got["c1"]["mois_sinistre"] == "01" and got["c1"]["produit"] == "auto"
    assert got["c2"]["delai_declaration_jours"] is None and got["c2"]["montant_indemnise"] == 0.0 and got["c2"]["description"] == ""
    assert (got["c4"]["has_valid_policy"], got["c4"]["has_valid_client"], got["c4"]["produit"]) == (False, False, None)
    assert got["c3"]["trimestre"] == "2023-Q1" and got["c3"]["prime_mensuelle"] == 365.0 / 12


def test_quoted_text_survives(spark, raw):
    first = readers.read_claims(spark, raw["claims"]).filter("claim_id = 'c1'").orderBy("description").first()
    assert first["description"] == 'said "stop", left' and first["fraud_rule_injected"] is None


def test_gold(spark, run):
    lake, _ = run
    fraud = {r["claim_id"]: r["fraud_flags"] for r in lake.read(spark, "gold", "fraud_assessment").collect()}
    assert fraud == {"c1": ["RULE_001"], "c2": ["RULE_004"], "c3": ["RULE_004", "RULE_005"], "c4": []}
    churn = {r["client_id"]: (r["score_unpaid"], r["score_mono_contract"]) for r in lake.read(spark, "gold", "churn_scores").collect()}
    assert churn == {"k1": (0.5, 1.0), "k2": (0.0, 1.0), "k3": (0.0, 1.0)}
    ratio = {(r["produit"], r["trimestre"]): r["loss_ratio_pct"] for r in lake.read(spark, "gold", "loss_ratio").collect()}
    assert ratio == {("auto", "2023-Q1"): round(1300 / 365 * 100, 4), ("vie", "2023-Q1"): round(40000 / 365 * 100, 4)}
    exposure = {r["region_code"]: r["nom"] for r in lake.read(spark, "gold", "portfolio_exposure").collect()}
    assert exposure == {"11": "Nord", "24": "Sud"}


def test_repeated_batch_adds_nothing_and_new_batch_adds(spark, run, raw):
    lake, _ = run
    medallion.ingest_claims(spark, raw["claims"], lake)
    assert lake.read(spark, "bronze", "claims").count() == 5
    later = medallion.Lake(lake.root, datetime(2024, 7, 1), "b2")
    medallion.ingest_claims(spark, raw["claims"], later)
    assert lake.read(spark, "bronze", "claims").count() == 10
    assert medallion.bronze_to_silver(spark, later)["claims"] == 4


def test_json_array_file(spark, raw):
    lines, array = readers.read_json(spark, raw["policies"]), readers.read_json(spark, raw["policies_array"], multiline=True)
    assert rows(lines, "policy_id") == rows(array, "policy_id")


def test_exports(spark, run, tmp_path):
    lake, _ = run
    assert medallion.export_tables(spark, lake, str(tmp_path)) == list(medallion.EXPORTS)
    assert spark.read.parquet(f"{tmp_path}/churn_scores").columns == ["client_id", "segment", "churn_score", "churn_segment", "region_code"]
    assert not sinks.export_columns(spark.range(0).toDF("x"), ["x"], f"{tmp_path}/none")
    assert not sinks.export_columns(None, ["x"], f"{tmp_path}/none")


def test_absent_inputs(spark, tmp_path):
    assert readers.read_regions(spark, f"{tmp_path}/nothing.csv") is None
    assert readers.read_table_if_present(spark, str(tmp_path), "gold", "nothing") is None


def test_bronze_schema_may_grow(spark, tmp_path):
    for batch, df in (("b1", spark.range(2)), ("b2", spark.range(3).withColumn("extra", F.lit("x")))):
        stamped = sinks.with_ingestion_metadata(df, "s", batch, "dir/f.csv", NOW)
        sinks.append_batch(stamped, str(tmp_path), "bronze", "t", batch)
    df = readers.read_table(spark, str(tmp_path), "bronze", "t", merge_schema=True)
    assert df.count() == 5 and df.filter("extra is null").count() == 2
    first = df.first()
    assert (first["source_file"], first["mois_ingestion"], first["annee_ingestion"]) == ("f.csv", "06", "2024")


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    for month, n in ((1, 5), (2, 5), (3, 2), (4, 0)):
        stamped = sinks.with_ingestion_metadata(spark.range(n), "s", "b1", "f.csv", datetime(2024, month, 28))
        sinks.append_batch(stamped, str(tmp_path), "bronze", "t", "b1")
        other = sinks.with_ingestion_metadata(spark.range(3), "s", "b2", "f.csv", datetime(2024, month, 28))
        sinks.append_batch(other, str(tmp_path), "bronze", "t", "b2")
        df = readers.read_table(spark, str(tmp_path), "bronze", "t")
        assert {r["batch_id"]: r["count"] for r in df.groupBy("batch_id").count().collect()} == ({"b1": n, "b2": 3} if n else {"b2": 3})


def test_suites_on_the_lake(spark, run):
    lake, _ = run
    t = {n: lake.read(spark, layer, n) for layer, n in (("silver", "policies"), ("silver", "clients"), ("gold", "portfolio_kpis"),
                                                        ("gold", "earned_premium"), ("gold", "fraud_assessment"), ("gold", "churn_scores"))}
    bronze = expectations.bronze_suite(lake.read(spark, "bronze", "claims"), lake.read(spark, "bronze", "policies"))
    got = {r["check"]: r["passed"] for r in bronze.collect()}
    assert not got["claims.unique_claim_id"] and got["claims.has_columns"] and got["policies.expiry_after_start"]
    gold = expectations.gold_suite(t["earned_premium"], t["portfolio_kpis"], t["fraud_assessment"], t["churn_scores"], t["policies"])
    assert {r["check"]: r["passed"] for r in gold.collect()}["premium_reconciliation"]
    silver = expectations.silver_suite(lake.read(spark, "silver", "claims"), t["policies"], t["clients"], t["portfolio_kpis"], F.lit(NOW.date()))
    got = {r["check"]: r["passed"] for r in silver.collect()}
    assert got["claims.unique_claim_id"] and not got["claims.policy_fk"] and not got["kpis.has_values_produit"]


def test_gold_reads_the_columns_of_policies_it_needs(spark, run, monkeypatch):
    """What decides between the coverages of a policy keeps Spark from leaving out columns by itself."""
    lake, _ = run
    plans = []
    monkeypatch.setattr(medallion.Lake, "write", lambda self, df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or 0)
    medallion.silver_to_gold(spark, lake)
    medallion.portfolio_exposure(spark, lake)
    assert len(plans) == 4
    for plan in plans:
        assert "garantie_code#" in plan and "garantie_libelle#" not in plan.split("Aggregate")[-1].split("Relation")[0]
    kept = lake.read(spark, "silver", "policies")
    for needed, wanted in ((medallion.PREMIUM, ("prime_annuelle", "date_souscription")), (medallion.EXPOSED, ("statut", "plafond_garantie"))):
        few, whole = (rows(one_policy_per_id(df).select("policy_id", *wanted)) for df in (kept.select(*needed), kept))
        assert few == whole
