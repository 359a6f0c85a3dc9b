from datetime import date as D

import pytest
from pyspark.sql import functions as F

from premia.functions import exact_quantile
from premia.operators import clean, dedup
from tests.conftest import rows


def test_latest_row_survives(frame):
    df = frame([("a", 1000.0, "2024-01-01"), ("a", 2000.0, "2024-01-02"), ("b", 5.0, "2024-01-01")],
               "claim_id string, montant double, ingestion_timestamp string")
    assert rows(dedup.latest_per_key(df, ["claim_id"])) == [("a", 2000.0, "2024-01-02"), ("b", 5.0, "2024-01-01")]


def test_no_duplicates_left_unchanged(frame):
    df = frame([("a", "x"), ("b", "x")], "claim_id string, ingestion_timestamp string")
    assert rows(dedup.latest_per_key(df, ["claim_id"])) == [("a", "x"), ("b", "x")]


def test_tied_rows_have_a_fixed_survivor(frame):
    data = [("a", i, None if i % 2 else "s") for i in range(50)]
    for shuffled in (data, data[::-1], data[25:] + data[:25]):
        df = frame(shuffled, "k string, v int, s string").repartition(5)
        assert rows(dedup.one_per_key(df, ["k"])) == [("a", 49, None)]


def test_key_with_a_third_of_the_rows_sends_one_row_per_task(frame):
    df = frame([("hot", i, "x" * 20) for i in range(3000)] + [(f"k{i}", i, "y") for i in range(6000)], "k string, v int, s string")
    out = dedup.latest_per_key(df.repartition(6), ["k"], ["v"])
    assert out.count() == 6001 and out.filter("k = 'hot'").first()["v"] == 2999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_unused_join_to_deduplicated_side_is_dropped(frame):
    left = frame([(1, "a")], "k int, v string")
    right = dedup.one_per_key(frame([(1, "x"), (1, "y")], "k int, w string"), ["k"])
    plan = left.join(right, "k", "left").select("v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_clean_claims(frame):
    df = frame([(None, None, None, None, "  OUVERT  ", " VOL "), (1.0, 2.0, 3.0, " x ", None, None)],
               "montant_declare double, montant_provision double, montant_indemnise double, description string, statut string, type_sinistre string")
    assert rows(clean.clean_claims(df)) == [(0.0, 0.0, 0.0, "", "ouvert", "vol"), (1.0, 2.0, 3.0, "x", "inconnu", "inconnu")]


def test_cast_claims_rejects_text_and_nan(frame):
    df = frame([(" 1 ", "12.5", "true"), ("2", "abc", "maybe"), ("3", "NaN", None)], "claim_id string, montant_declare string, is_fraud_injected string")
    assert rows(clean.cast_claims(df)) == [("1", 12.5, True), ("2", None, None), ("3", None, None)]


def test_clean_policies_monthly_default(frame):
    df = frame([(1200.0, None, None, None, " AUTO "), (1200.0, 90.0, 5.0, "ACTIF", None)],
               "prime_annuelle double, prime_mensuelle double, franchise double, statut string, produit string")
    assert rows(clean.clean_policies(df)) == [(1200.0, 90.0, 5.0, "actif", "inconnu"), (1200.0, 100.0, 0.0, "inconnu", "auto")]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-06-15", D(2024, 6, 15)), ("15/06/2024", D(2024, 6, 15)), ("06/25/2024", D(2024, 6, 25)),
        ("2024/06/15", D(2024, 6, 15)), ("15-06-2024", D(2024, 6, 15)), ("03/04/2024", D(2024, 4, 3)),
        ("junk", None), (None, None),
    ],
)
def test_parse_dates(frame, text, day):
    df = clean.parse_dates(frame([(text,)], "date_sinistre string"), ["date_sinistre", "absent"])
    assert rows(df) == [(day,)]


def test_delays(frame):
    data = [(D(2024, 1, 1), D(2024, 1, 11)), (D(2024, 1, 11), D(2024, 1, 1)), (D(2024, 1, 1), D(2024, 1, 1)), (None, D(2024, 1, 1))]
    df = frame(data, "date_sinistre date, date_declaration date")
    out = clean.declaration_delay(df).select("delai_declaration_jours").collect()
    assert [r[0] for r in out] == [10, None, 0, None]
    for how, expected in (("zero", [10, 0, 0, 0]), ("keep", [10, -10, 0, None])):
        gaps = clean.day_gap(df, "date_sinistre", "date_declaration", "g", how).collect()
        assert [r["g"] for r in gaps] == expected
    with pytest.raises(ValueError):
        clean.day_gap(df, "date_sinistre", "date_declaration", "g", "other")


def test_period(frame):
    out = clean.with_period(frame([(D(2023, 7, 15),)], "date_sinistre date"))
    assert rows(out) == [(D(2023, 7, 15), "2023", "07", "2023-Q3")]


def test_processing_delay_and_buckets(frame):
    day = D(2024, 1, 1)
    data = [(1, day, None), (2, day, D(2023, 12, 1)), (3, None, day), (4, day, D(2024, 1, 8)), (5, day, D(2024, 1, 31)), (6, day, D(2024, 3, 31)), (7, day, D(2024, 4, 1))]
    df = clean.processing_delay(frame(data, "i int, date_declaration date, date_cloture date"), F.lit(D(2024, 1, 9)))
    got = [(r[0], r["delai_traitement_jours"], r["b"], r["o"]) for r in df.withColumns({"b": clean.aging_bucket(), "o": clean.aging_order()}).orderBy("i").collect()]
    assert got == [
        (1, 8, "7_30j", 2), (2, 0, "0_7j", 1), (3, 0, "0_7j", 1), (4, 7, "0_7j", 1),
        (5, 30, "7_30j", 2), (6, 90, "30_90j", 3), (7, 91, "90j_plus", 4),
    ]


def test_explode_keeps_policies_without_coverage(frame):
    schema = "policy_id string, garanties array<struct<code:string,libelle:string,plafond:double,incluse:boolean>>"
    df = frame([("p1", [(" VOL", "Vol", 5.0, True), ("bris", None, None, None)]), ("p2", []), ("p3", None)], schema)
    flat = clean.explode_struct(df, "garanties", "garantie", ("code", "libelle", "plafond", "incluse"))
    assert rows(clean.normalise_policies(flat)) == [
        ("p1", "bris", "Non renseigné", None, False), ("p1", "vol", "Vol", 5.0, True),
        ("p2", "inconnu", "Non renseigné", None, False), ("p3", "inconnu", "Non renseigné", None, False),
    ]


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 0.99, 1.0])
def test_exact_quantile(frame, p):
    import numpy as np

    rng = np.random.default_rng(3)
    for values in (rng.lognormal(8, 2, 4001).round(2), np.array([5.0] * 900 + [1e9, -3.5, 0.01]), np.array([7.25])):
        df = frame([(float(v),) for v in values] + [(None,)], "v double")
        assert exact_quantile(df, "v", p) == pytest.approx(float(np.quantile(values, p)), rel=1e-12)
    assert exact_quantile(frame([(None,)], "v double"), "v", p) is None
