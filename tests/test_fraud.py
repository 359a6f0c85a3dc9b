import random
from datetime import date as D
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from premia.entities import FLAGS
from premia.operators import fraud
from tests.conftest import rows


def by_id(df, column):
    return {r["claim_id"]: r[column] for r in df.select("claim_id", column).collect()}


def test_early_claim(frame):
    start = D(2024, 1, 10)
    data = [(i, "p", start + timedelta(d)) for i, d in enumerate((0, 1, 2, -1))] + [(4, "q", start), (5, None, start)]
    claims = frame(data, "claim_id int, policy_id string, date_sinistre date")
    policies = frame([("p", start), ("p", start), ("q", None)], "policy_id string, date_souscription date")
    assert by_id(fraud.flag_early(claims, policies), "flag_early_claim") == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0}


def test_high_amount(frame):
    schema = "claim_id int, produit string, montant_declare double"
    df = frame([(1, "a", 100.0), (2, "a", 100.0), (3, "a", 1000.0), (4, None, 1e9), (5, "b", 7.0)], schema)
    assert by_id(fraud.flag_high_amount(df, 0.5), "flag_high_amount") == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0}
    df = frame([(1, "a", 100.0), (2, "a", 110.0), (3, "a", 90.0)], schema)
    assert set(by_id(fraud.flag_high_amount(df, 3.0), "flag_high_amount").values()) == {0}


def test_frequent_window_is_inclusive(frame):
    day = D(2023, 1, 1)
    data = [(1, "k", day), (2, "k", day), (3, "k", day + timedelta(365)), (4, "k", day + timedelta(366)), (5, None, day), (6, "k", None)]
    df = frame(data, "claim_id int, client_id string, date_sinistre date")
    counts = {r["date_sinistre"]: r["claims_in_window"] for r in fraud.claims_in_window(df).filter("client_id = 'k' and date_sinistre is not null").collect()}
    assert counts == {day: 2, day + timedelta(365): 3, day + timedelta(366): 2}
    assert by_id(fraud.flag_frequent(df, 3), "flag_frequent_claimant") == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0}


def test_address_cluster_boundaries(frame):
    day = D(2024, 1, 1)
    clients = frame([("a", "X"), ("b", "X"), ("c", None), ("d", "Y"), ("e", "Y"), ("f", None)], "client_id string, adresse string")
    data = [
        (1, "a", "auto", day), (2, "b", "vie", day + timedelta(30)),      # 30 days apart: both
        (3, "b", "sante", day + timedelta(61)),                           # 31 days after claim 2, 61 after claim 1
        (4, "c", "auto", day), (5, "f", "vie", day),                      # no address
        (6, "d", "auto", day), (7, "e", "auto", day), (8, "d", "vie", day + timedelta(400)),  # same product; same client
        (9, None, "auto", day), (10, "a", None, day), (11, "a", "mrh", None),
    ]
    claims = frame(data, "claim_id int, client_id string, produit string, date_sinistre date")
    got = by_id(fraud.flag_cluster(claims, clients), "flag_address_cluster")
    assert {k for k, v in got.items() if v} == {1, 2} and len(got) == 11


def brute_force(claims, address, days=30, back=365, count=3):
    """Flags by comparing every claim with every other."""
    frequent, cluster = {}, {}
    for i, c, p, d in claims:
        frequent[i] = int(sum(1 for _, c2, _, d2 in claims if c and c2 == c and d and d2 and 0 <= (d - d2).days <= back) >= count)
        cluster[i] = int(any(
            c and c2 and p and p2 and d and d2 and address.get(c) and address.get(c) == address.get(c2)
            and c != c2 and p != p2 and abs((d - d2).days) <= days
            for _, c2, p2, d2 in claims
        ))
    return frequent, cluster


@pytest.mark.parametrize("seed", range(4))
def test_window_forms_equal_brute_force(frame, seed):
    """Random claims with nulls; a third of them by one client, another third at one address."""
    rng = random.Random(seed)
    address = {f"k{i}": rng.choice(["A", "B", "C", None]) if i > 3 else "HOT" for i in range(14)}
    claims = []
    for i in range(400):
        who = "k0" if i % 3 == 0 else f"k{rng.randrange(4)}" if i % 3 == 1 else f"k{rng.randrange(14)}"
        claims.append((
            i,
            None if rng.random() < 0.05 else who,
            rng.choice(["auto", "vie", "sante", None]) if seed else "auto" if who in ("k0", "k1") else "vie",
            None if rng.random() < 0.05 else D(2020, 1, 1) + timedelta(rng.randrange(2500)),
        ))
    df = frame(claims, "claim_id int, client_id string, produit string, date_sinistre date").repartition(5)
    clients = frame(list(address.items()), "client_id string, adresse string")
    frequent, cluster = brute_force(claims, address, count=20)
    assert by_id(fraud.flag_frequent(df, 20), "flag_frequent_claimant") == frequent
    assert by_id(fraud.flag_cluster(df, clients), "flag_address_cluster") == cluster
    assert 0 < sum(frequent.values()) < 400 and 0 < sum(cluster.values()) < 400


def test_hot_client_and_address_are_reduced_before_the_window(spark):
    """A third of the rows on one client and address: the rows that reach the windows are days, not claims."""
    n = 60_000
    df = spark.range(n).select(
        F.col("id").alias("claim_id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("client_id"),
        F.element_at(F.array(F.lit("auto"), F.lit("vie")), (F.col("id") % 2 + 1).cast("int")).alias("produit"),
        F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 100).cast("int")).alias("date_sinistre"),
    )
    assert fraud.claims_in_window(df).filter("client_id = -1").count() == 100
    located = df.withColumn("adresse", F.when(F.col("claim_id") % 3 == 0, "HOT").otherwise("other"))
    assert fraud.address_neighbours(located).filter("adresse = 'HOT'").count() <= 200
    clients = df.select("client_id").distinct().withColumn("adresse", F.lit("HOT"))
    flagged = fraud.flag_cluster(fraud.flag_frequent(df, 1000), clients)
    got = flagged.agg(F.count("*"), F.sum("flag_frequent_claimant"), F.sum("flag_address_cluster")).first()
    # the hot client has 200 claims a day, so it is busy from its fifth day on
    assert got[0] == n and got[1] == n // 3 - 200 * 4 and got[2] == n


def test_late_declaration(frame):
    df = frame([(1, 10), (2, 200), (3, None), (4, 180)], "claim_id int, delai_declaration_jours int")
    assert by_id(fraud.flag_late(df), "flag_late_declaration") == {1: 0, 2: 1, 3: 0, 4: 0}


def test_score(frame):
    df = frame([(1, 1, 1, 1, 1), (0, 0, 0, 0, 0), (0, 1, 0, 0, 1)], ", ".join(f"{f} int" for f in FLAGS))
    got = rows(fraud.fraud_score(df).select("fraud_score", "fraud_flags", "is_fraud_suspected"), "fraud_score")
    assert got == [(0, [], False), (40, ["RULE_002", "RULE_005"], True), (100, list(FLAGS.values()), True)]


def test_visits_are_flagged_by_one_join(frame, spark):
    """Both rules of neighbours from the same visits, claims without product and repeated claims included; only the visits meet the claims again."""
    rng = random.Random(7)
    address = {f"k{i}": "HOT" if i < 3 else rng.choice(["A", "B", None]) for i in range(9)}
    claims = [
        (
            i, None if rng.random() < 0.05 else f"k{rng.randrange(9)}", rng.choice(["auto", "vie", "", None]),
            None if rng.random() < 0.05 else D(2020, 1, 1) + timedelta(rng.randrange(1200)),
        )
        for i in range(300)
    ]
    df = frame([*claims, claims[0]], "claim_id int, client_id string, produit string, date_sinistre date")
    clients = frame(list(address.items()), "client_id string, adresse string")
    cfg = fraud.FraudSettings(frequent_claimant_count=8)
    got = fraud.flag_neighbours(df, clients, cfg)
    apart = fraud.flag_cluster(fraud.flag_frequent(df, 8, cfg.frequent_claimant_window), clients, cfg.address_cluster_days)
    flags = [*df.columns, "flag_frequent_claimant", "flag_address_cluster"]
    assert rows(got.select(flags)) == rows(apart.select(flags)) and 0 < got.agg(F.sum("flag_frequent_claimant")).first()[0] < 301
    plan = fraud.flag_high_amount(got.withColumn("montant_declare", F.lit(1.0)))._jdf.queryExecution().optimizedPlan().toString()
    # the visits meet the claims once; the statistics of the products are broadcast
    assert plan.count("_claims#") and "strategy=broadcast" in plan


@pytest.mark.parametrize("seed", range(3))
def test_crowded_addresses_have_the_same_flags(frame, seed, monkeypatch):
    """Addresses of more clients than a task should hold are counted per day and product first: all, some or none of them, with the same flags."""
    rng = random.Random(seed)
    address = {f"k{i}": "HOT" if i < 5 else rng.choice(["A", "B", "", None]) for i in range(14)}
    claims = [
        (
            i, None if rng.random() < 0.05 else f"k{rng.randrange(16)}", rng.choice(["auto", "vie", "", None]),
            None if rng.random() < 0.05 else D(2020, 1, 1) + timedelta(rng.randrange(2500)),
        )
        for i in range(400)
    ]
    df = frame(claims, "claim_id int, client_id string, produit string, date_sinistre date").repartition(3)
    clients = frame([*address.items(), (None, "HOT"), (None, None), ("k1", "HOT")], "client_id string, adresse string")
    frequent, cluster = brute_force(claims, address, count=5, back=500)
    by_brute = {i: any(
        c and c2 and p is not None and p2 is not None and d and d2 and address.get(c) is not None and address.get(c) == address.get(c2)
        and c != c2 and p != p2 and abs((d - d2).days) <= 30 for _, c2, p2, d2 in claims
    ) for i, c, p, d in claims}
    for crowd in (0, 4, 1000):
        located = fraud.located_visits(df, clients, crowd)
        assert located.filter("_crowded").isEmpty() == (crowd == 1000)
        monkeypatch.setattr(fraud.located_visits, "__defaults__", (crowd,))
        got = fraud.flag_neighbours(df, clients, fraud.FraudSettings(frequent_claimant_count=5, frequent_claimant_window=500)).collect()
        assert {r["claim_id"]: r["flag_frequent_claimant"] for r in got} == frequent and len(got) == 400
        assert {r["claim_id"]: r["flag_address_cluster"] for r in got} == {i: int(v) for i, v in by_brute.items()}
        assert by_id(fraud.flag_cluster(df, clients), "flag_address_cluster") == {i: int(v) for i, v in by_brute.items()}
    assert 0 < sum(by_brute.values()) < 400
