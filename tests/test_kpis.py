from datetime import date as D

from pyspark.sql import functions as F

from premia.operators import aging, churn, exposure, kpis, premium
from tests.conftest import rows


def test_incurred_loss(frame):
    data = [("clos", 10.0, 5.0), ("ouvert", 10.0, 5.0), ("en_cours", 10.0, 5.0), ("en_litige", 10.0, None), ("refuse", 10.0, 5.0), ("inconnu", 1.0, 1.0), ("clos", None, 2.0)]
    out = premium.incurred_loss(frame(data, "statut string, montant_indemnise double, montant_provision double")).collect()
    assert [r["incurred_loss"] for r in out] == [10.0, 5.0, 5.0, 0.0, 0.0, 0.0, 0.0]


POLICY = "policy_id int, date_souscription date, date_echeance date, prime_annuelle double, garantie_code string"


def test_earned_premium(frame):
    data = [
        (1, D(2019, 1, 1), D(2020, 1, 1), 365.0, "a"),    # before the window
        (2, D(2020, 12, 2), D(2021, 1, 31), 365.0, "a"),  # across its start: 30 days
        (3, D(2022, 1, 1), D(2023, 1, 1), 365.0, "a"),    # inside: 365 days
        (3, D(2022, 1, 1), D(2023, 1, 1), 365.0, "b"),    # second coverage of the same policy
        (4, D(2025, 1, 1), D(2026, 1, 1), 365.0, "a"),    # after
        (5, D(2021, 1, 1), D(2026, 1, 1), 365.0, "a"),    # sixty months: clipped to 1460 days
        (6, None, D(2021, 1, 11), 365.0, "a"),            # null start: window start
        (7, D(2024, 12, 21), None, 365.0, "a"),           # null end: window end
        (8, D(2022, 1, 1), D(2022, 1, 2), 100.0, "a"),    # 0.27397... -> 0.27
    ]
    out = premium.earned_premium(frame(data, POLICY))
    got = {r["policy_id"]: (r["days_covered"], r["earned_premium"]) for r in out.collect()}
    assert out.count() == 8
    assert got == {1: (0, 0.0), 2: (30, 30.0), 3: (365, 365.0), 4: (0, 0.0), 5: (1460, 1460.0), 6: (10, 10.0), 7: (10, 10.0), 8: (1, 0.27)}
    assert {r["policy_id"]: r["trimestre"] for r in out.collect()}[2] == "2020-Q4"


def test_quarters_add_up_to_the_earned_premium(frame):
    data = [(i, D(2021, 1 + i % 12, 1 + i), D(2022, 1 + (i * 5) % 12, 2 + i), 1000.0 + i / 7, "a") for i in range(20)]
    data.append((99, None, None, 100.0, "a"))
    df = frame(data, POLICY).withColumn("prime_annuelle", F.round("prime_annuelle", 2))
    whole = {r["policy_id"]: (r["days_covered"], round(r["earned_premium"], 2)) for r in premium.earned_premium(df).collect()}
    parts = premium.earned_premium_by_quarter(df).groupBy("policy_id").agg(F.sum("days_covered"), F.round(F.sum("earned_premium"), 2))
    assert {r[0]: (r[1], r[2]) for r in parts.collect()} == whole


KPI = "produit string, region_code string, canal_vente string, annee string, trimestre string, incurred_losses double, earned_premium double"


def test_running_sums_with_gap_and_year_change(frame):
    quarters = ["2021-Q1", "2021-Q2", "2021-Q4", "2022-Q1", "2022-Q2"]
    df = frame([("a", "1", "x", q[:4], q, 10.0 * (i + 1), 100.0) for i, q in enumerate(quarters)], KPI)
    got = {r["trimestre"]: r for r in kpis.with_ytd_and_rolling(df).collect()}
    assert [got[q]["ytd_incurred_losses"] for q in quarters] == [10, 30, 60, 40, 90]
    assert [got[q]["rolling_12m_incurred"] for q in quarters] == [10, 30, 60, 100, 140]
    exact = {r["trimestre"]: r["rolling_12m_incurred"] for r in kpis.with_ytd_and_rolling(df, calendar=True).collect()}
    assert [exact[q] for q in quarters] == [10, 30, 60, 90, 120]
    assert got["2022-Q2"]["ytd_loss_ratio"] == 45.0 and got["2021-Q1"]["rolling_12m_loss_ratio"] == 10.0


def test_join_drops_claim_cells_without_premium_and_null_keys(frame):
    dims = "produit string, region_code string, canal_vente string, annee string, trimestre string"
    prem = frame([("a", "1", "x", "2021", "q", 0.0), ("b", "1", "x", "2021", "q", 50.0), (None, "1", "x", "2021", "q", 50.0)], dims + ", earned_premium double")
    claims = frame([("a", "1", "x", "2021", "q", 5.0, 2, 1.0), ("z", "1", "x", "2021", "q", 5.0, 2, 1.0), (None, "1", "x", "2021", "q", 5.0, 2, 1.0)],
                   dims + ", incurred_losses double, nb_sinistres long, provisions_ouvertes double")
    got = rows(kpis.join_kpis(prem, claims).select("produit", "incurred_losses", "nb_sinistres", "loss_ratio"), F.col("produit").asc_nulls_first())
    assert got == [(None, 0.0, 0, 0.0), ("a", 5.0, 2, None), ("b", 0.0, 0, 0.0)]


def test_loss_ratio_classes(frame):
    losses = [59.99, 60.0, 80.0, 100.0, 150.0]
    df = frame([("a", "1", "x", "2021", f"2021-Q{i}", v, 100.0) for i, v in enumerate(losses)] + [("b", "1", "x", "2021", "2021-Q1", 5.0, 0.0)], KPI)
    got = [(r["produit"], r["loss_ratio_category"]) for r in kpis.loss_ratio_view(df).orderBy("produit", "trimestre").collect()]
    assert [c for _, c in got] == ["excellent", "bon", "acceptable", "dégradé", "critique", "critique"]


def test_churn(frame):
    as_of = F.lit(D(2024, 1, 1))
    clients = frame(
        [("k1", "particulier", "n", "1", "gold", D(2024, 1, 1)), ("k2", "particulier", "n", "1", "gold", D(1990, 1, 1)),
         ("k3", "particulier", "n", "1", "gold", None), ("k4", "particulier", "n", "1", "gold", D(2025, 1, 1))],
        "client_id string, client_type string, nom string, region_code string, segment string, date_creation date")
    policies = frame([("p1", "k1", "actif"), ("p1", "k1", "actif"), ("p2", "k2", "actif"), ("p3", "k2", "actif"), ("p4", "k3", "resilié")], "policy_id string, client_id string, statut string")
    claims = frame([("c1", "k1", "refuse"), ("c2", "k1", "clos")], "claim_id string, client_id string, statut string")
    payments = frame([("y1", "k1", "impaye"), ("y2", "k1", "impaye"), ("y3", "k2", "paye")], "payment_id string, client_id string, statut string")
    out = {r["client_id"]: r for r in churn.churn_scores(clients, policies, claims, payments, as_of).collect()}
    assert [out[k]["score_mono_contract"] for k in ("k1", "k2", "k3")] == [1.0, 0.0, 1.0]
    assert [out[k]["nb_contrats"] for k in ("k1", "k2", "k3")] == [1, 2, 0]
    assert [out[k]["score_seniority_inverse"] for k in ("k1", "k2", "k3")] == [1.0, 0.0, 0.0]
    assert out["k4"]["score_seniority_inverse"] > 1
    assert out["k1"]["score_unpaid"] == 1.0 and out["k2"]["nb_impayes"] == 0 and out["k3"]["nb_impayes"] is None
    assert out["k1"]["churn_score"] == 90.0 and out["k1"]["churn_segment"] == "critique"
    assert out["k2"]["churn_score"] == 0.0 and out["k2"]["churn_segment"] == "faible"


def test_hhi(frame):
    schema = "g string, v double"
    assert exposure.hhi(frame([], schema), "v", "g").first()[0] == 0.0
    assert exposure.hhi(frame([("a", 3.0)], schema), "v", "g").first()[0] == 10000.0
    df = frame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 1.0)], schema)
    assert {r["hhi_v"] for r in exposure.with_hhi(df, "v", "g").collect()} == {2500.0}


def test_portfolio_exposure(frame):
    policies = frame(
        [("p1", "1", "auto", "x", "actif", 100.0, 10.0, "a"), ("p1", "1", "auto", "x", "actif", 100.0, 10.0, "b"),
         ("p2", "2", "vie", "x", "actif", 300.0, 20.0, "a"), ("p3", "2", "vie", "x", "resilié", 900.0, 5.0, "a")],
        "policy_id string, region_code string, produit string, canal_vente string, statut string, prime_annuelle double, plafond_garantie double, garantie_code string")
    claims = frame([("c1", "1", 50.0, 40.0), ("c2", "1", 50.0, None)], "claim_id string, region_code string, montant_declare double, montant_indemnise double")
    regions = frame([("1", "Nord", "5", "6")], "code string, nom string, population string, densite string")
    out = {r["region_code"]: r for r in exposure.portfolio_exposure(policies, claims, regions).collect()}
    assert (out["1"]["nb_polices"], out["1"]["nom"], out["1"]["nb_sinistres"], out["1"]["sinistres_per_policy"]) == (1, "Nord", 2, 2.0)
    assert (out["2"]["nom"], out["2"]["nb_sinistres"], out["2"]["portfolio_hhi"]) == (None, 0, 6250.0)
    assert "nom" not in exposure.portfolio_exposure(policies, claims).columns
    risk = {r["produit"]: (r["market_share_pct"], r["hhi_category"]) for r in exposure.concentration(exposure.active_policies(policies)).collect()}
    assert risk == {"auto": (25.0, "peu_concentré"), "vie": (75.0, "concentré")}


def test_aging_summary(frame):
    data = [(i, "vol", "clos", "2024", "auto", 10.0, 5.0, d) for i, d in enumerate([1, 2, 3, 4, 100])]
    df = frame(data, "claim_id int, type_sinistre string, statut string, annee string, produit string, montant_declare double, montant_indemnise double, delai_traitement_jours int")
    df = df.withColumn("aging_bucket", F.when(F.col("delai_traitement_jours") <= 7, "0_7j").otherwise("90j_plus"))
    got = {r["aging_bucket"]: r for r in aging.aging_summary(df).collect()}
    assert (got["0_7j"]["delai_median_jours"], got["0_7j"]["delai_p90_jours"], got["0_7j"]["delai_moyen_jours"], got["0_7j"]["bucket_order"]) == (2, 4, 2.5, 1)
    assert got["90j_plus"]["bucket_order"] == 4
    assert {r["delai_median_jours"] for r in aging.aging_summary(df, ("aging_bucket",), exact=True).collect()} == {2.5, 100.0}


def test_latest_load_of_a_policy_stands_for_it(frame):
    from premia.operators.enrich import one_policy_per_id, with_policy

    schema = "policy_id int, statut string, produit string, prime_annuelle double, garantie_code string, ingestion_timestamp timestamp"
    from datetime import datetime

    df = frame([(1, "zz", "auto", 100.0, "a", datetime(2024, 1, 1)), (1, "actif", "vie", 90.0, "b", datetime(2024, 2, 1)),
                (1, "actif", "mrh", 80.0, "a", datetime(2024, 2, 1))], schema)
    assert [(r.statut, r.produit, r.prime_annuelle) for r in one_policy_per_id(df).collect()] == [("actif", "vie", 90.0)]
    claim = with_policy(frame([(7, 1)], "claim_id int, policy_id int"), df, ("produit",)).first()
    assert (claim.produit, claim.statut_police) == ("vie", "actif")


def test_exact_quantile_of_odd_values(frame):
    import math

    from premia.functions.quantile import exact_quantile

    inf, nan = math.inf, math.nan
    for values, p, want in (([*range(20), nan], 0.5, 9.5), ([1, inf], 0.5, inf), ([-inf, 1, 2, 3], 0.0, -inf), ([-inf, 1, 2, inf], 0.34, 1.02),
                            ([5], 0.99, 5.0), ([inf], 0.5, inf), ([nan], 0.5, None), ([], 0.5, None)):
        got = exact_quantile(frame([(float(v),) for v in values], "x double"), "x", p)
        assert got == want or abs(got - want) < 1e-9
