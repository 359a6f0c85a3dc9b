from datetime import date as D

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from premia.operators import expectations as ex
from premia.operators import privacy, reports
from premia.settings import ChurnSettings, FraudSettings, from_environment
from tests.conftest import rows


def results(df):
    return {r["check"]: (r["observed"], r["passed"]) for r in df.collect()}


def test_checks(frame):
    df = frame([("a", 1.0, "x", "2024-01-01"), ("a", -1.0, "y", "01/01/2024"), (None, None, None, None)], "k string, v double, s string, d string")
    got = results(ex.run_suite(df, [
        ex.unique("k"), ex.not_null("k"), ex.null_rate("s", 0.5), ex.positive("v"), ex.in_set("s", ["x", "y"]),
        ex.between("v", 0, 10), ex.matches("d", r"^\d{4}-\d{2}-\d{2}$"), ex.row_count(1, 2), ex.has_values("s", ["x", "z"]),
        ex.has_columns(df, ["k", "absent"]), ex.rate("neg", F.col("v") < 0, where=F.col("v").isNotNull(), at_most=0.6),
    ]))
    assert got == {
        "unique_k": (1.0, False), "not_null_k": (1.0, False), "null_rate_s": (1 / 3, True), "positive_v": (1.0, False),
        "in_set_s": (0.0, True), "between_v": (1.0, False), "matches_d": (1.0, False), "row_count": (3.0, False),
        "has_values_s": (1.0, False), "has_columns": (1.0, False), "neg": (0.5, True),
    }


def test_empty_table_fails_every_check(frame):
    got = results(ex.run_suite(frame([], "k string, v double"), [ex.unique("k"), ex.positive("v"), ex.row_count(0, 5)]))
    assert {p for _, p in got.values()} == {False}


def test_unique_allows_one_null(frame):
    assert results(ex.run_suite(frame([("a",), (None,)], "k string"), [ex.unique("k")])) == {"unique_k": (0.0, True)}


def test_orphans_coverage_reconciliation(frame):
    child = frame([("p1",)] * 98 + [("zz",), (None,)], "k string")
    parent = frame([("p1",), ("p1",), ("p2",)], "k string")
    assert results(ex.orphan_rate(child, parent, "k", "fk", 0.05)) == {"fk": (0.02, True)}
    assert results(ex.orphan_rate(child, parent, "k", "fk", 0.02)) == {"fk": (0.02, False)}
    assert results(ex.coverage(child, parent, "k", "c", 1.0)) == {"c": (1.0, True)}
    assert results(ex.missing_from(child, parent, "k", "m")) == {"m": (1.0, False)}
    one, two = frame([(50.0,)], "total double"), frame([(100.0,)], "total double")
    assert results(ex.reconcile(one, two, "r", 0.1, 1.05)) == {"r": (0.5, True)}
    assert results(ex.reconcile(two, one, "r", 0.1, 1.05)) == {"r": (2.0, False)}


def test_declared_suite_from_json():
    import json

    text = json.dumps({"expectations": list(ex.CLAIMS_SUITE)})
    assert [c.name for c in ex.declared_checks(text)] == [c.name for c in ex.declared_checks(ex.CLAIMS_SUITE)]


def test_anomalies(frame):
    schema = "delai_declaration_jours int, montant_declare double, produit string"
    assert rows(ex.anomalies(frame([(1, 5.0, "a")], schema)))[0][0] == "Aucune"
    got = {r["type"]: (r["count"], r["severity"]) for r in ex.anomalies(frame([(-1, 2e6, None), (-2, 5.0, "a")], schema)).collect()}
    assert got == {"Délai négatif": (2, "high"), "Montant extrême": (1, "medium"), "Sinistre orphelin": (1, "medium")}


def test_bands(frame):
    df = frame([(v,) for v in (0, 25, 26, 50, 51, 100)], "fraud_score int")
    assert [r["count"] for r in reports.score_bands(df).collect()] == [1, 1, 2, 1, 1]
    assert [r["nb"] for r in reports.score_histogram(df).collect()] == [2, 2, 1, 1]
    assert len(reports.named_bands(df).collect()) == 5
    empty = frame([], "fraud_score int")
    assert reports.score_bands(empty).collect() == [] and [r["nb"] for r in reports.score_histogram(empty).collect()] == [0, 0, 0, 0]


def test_null_keys_are_left_out_of_groups(frame):
    df = frame([("a", True), ("a", False), (None, True)], "g string, b boolean")
    assert rows(reports.rate_by(df, "g", F.col("b"))) == [("a", 2, 1, 50.0)]


def test_paid_rate_drops_zero_denominator(frame):
    df = frame([("a", 1.0, 2.0), ("b", 1.0, 0.0)], "produit string, montant_indemnise double, montant_declare double")
    assert rows(reports.paid_rate_by(df, ["produit"])) == [("a", 1.0, 2.0, 50.0)]


def test_crosstab(frame):
    df = frame([("r1", "a", 1.0), ("r1", "b", 2.0), ("r2", "a", 3.0)], "r string, c string, v double")
    assert rows(reports.crosstab(df, "r", "c", ["a", "b"], F.sum("v"), fill=0.0)) == [("r1", 1.0, 2.0, 0.0), ("r2", 3.0, 0.0, 0.0)]
    listed = rows(reports.crosstab(df.union(frame([("r1", "inconnu", 5.0), ("r1", None, 9.0)], df.schema)), "r", "c", ["a"], F.sum("v"), fill=0.0))
    assert listed == [("r1", 1.0, 7.0), ("r2", 3.0, 0.0)]  # totals reconcile
    assert rows(reports.crosstab(df, "r", "c", None, F.sum("v"))) == [("r1", 1.0, 2.0), ("r2", 3.0, None)]


def test_histogram(frame):
    df = frame([("a", float(v)) for v in range(10)] + [("b", 9.0), (None, 1.0), ("a", None)], "produit string, montant_declare double")
    got = {(r["produit"], r["bin"]): r["nb"] for r in reports.histogram(df, bins=3).collect()}
    assert got == {("a", 0): 3, ("a", 1): 3, ("a", 2): 4, ("b", 2): 1}
    assert reports.histogram(df, below=-1.0).collect() == []


def test_five_numbers_and_steps(frame):
    df = frame([("s", float(v)) for v in (1, 2, 3, 4)], "churn_segment string, churn_score double")
    assert rows(reports.five_numbers(df)) == [("s", 1.0, 1.75, 2.5, 3.25, 4.0)]
    steps = frame([("r1", 1.5, 10, 1), ("r1", 2.0, None, None), ("r2", 1.0, 0, 5)], "run_id string, duration_sec double, nb_out long, nb_rejected long")
    summary = reports.summarise_steps(steps)
    assert rows(summary) == [("r1", 3.5, 10, 1, 10.0), ("r2", 1.0, 0, 5, 500.0)]
    assert reports.latest_run(summary).first()["run_id"] == "r2"


def test_pseudonym_is_an_hmac(frame):
    for key in (b"short", b"k" * 64, b"long" * 50):
        out = privacy.pseudonymise(frame([("élan",), (None,)], "client_id string"), ["client_id"], key)
        assert {r[0] for r in out.collect()} == {hmac.new(key, "élan".encode(), hashlib.sha256).hexdigest(), None}


def test_mask_erase_upsert_retain(frame):
    df = frame([("a", 1.0, D(2020, 1, 1)), ("b", 2.0, D(2014, 12, 31)), ("c", 3.0, None)], "client_id string, v double, d date")
    assert privacy.mask(df, ["v"], "prod").filter("v is null").count() == 0
    assert privacy.mask(df, ["v"], "dev").filter("v is null").count() == 3
    assert rows(privacy.erase(df, frame([("a",)], "client_id string")).select("client_id")) == [("b",), ("c",)]
    newer = frame([("a", 9.0, D(2021, 1, 1)), ("z", 0.0, D(2021, 1, 1))], "client_id string, v double, d date")
    assert rows(privacy.upsert(df, newer, ["client_id"], ["d"]).select("client_id", "v")) == [("a", 9.0), ("b", 2.0), ("c", 3.0), ("z", 0.0)]
    assert rows(privacy.retain(df, "d", 5, F.lit(D(2020, 1, 1))).select("client_id")) == [("a",), ("c",)]


def test_settings_from_environment():
    env = {"FRAUD_EARLY_CLAIM_HOURS": "72", "FRAUD_HIGH_AMOUNT_STDDEV": "2.5"}
    cfg = from_environment(FraudSettings, "FRAUD", env)
    assert (cfg.early_claim_hours, cfg.high_amount_stddev, cfg.late_declaration_days) == (72, 2.5, 180)
    assert sum(cfg.weights.values()) == 100
    assert from_environment(ChurnSettings, "CHURN", {"CHURN_W_MONO": "0.5"}).w_mono == 0.5
    with pytest.raises(ValueError):
        from_environment(FraudSettings, "FRAUD", {"FRAUD_EARLY_CLAIM_HOURS": "soon"})
