"""Joins between the entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions import left_join
from premia.operators.dedup import latest_per_key, one_per_key

POLICY_COLUMNS = (
    "produit", "prime_annuelle", "prime_mensuelle", "date_souscription",
    "date_echeance", "canal_vente", "franchise", "plafond_garantie",
)
CLIENT_COLUMNS = ("client_type", "nom", "canal_acquisition", "segment")


#: What decides which row of a policy stands for it, where the table has it: the latest load, then the greatest coverage.
POLICY_ORDER = ("ingestion_timestamp", "garantie_code")


def one_policy_per_id(policies: DataFrame, columns: tuple | None = None) -> DataFrame:
    """One row per policy from a table with one row per coverage: that of the latest load. Give the columns
    that are wanted, and no other is read."""
    order = [c for c in POLICY_ORDER if c in policies.columns]
    wanted = columns or [c for c in policies.columns if not c.startswith("garantie_") and c != "policy_id"]
    ranked = policies.select("policy_id", *[F.col(c).alias(f"_by_{c}") for c in order], *wanted)
    best = latest_per_key(ranked, ["policy_id"], [f"_by_{c}" for c in order])
    return best.select([c for c in policies.columns if c == "policy_id" or c in wanted])


def with_policy(claims: DataFrame, policies: DataFrame, columns: tuple = POLICY_COLUMNS, dealt: bool = False) -> DataFrame:
    """Every claim with the columns of its policy, and whether the policy was found. Claims that all have a policy and are ``dealt``
    by it, so that a task holds all claims of its policies, are joined where they are."""
    policy = one_policy_per_id(policies, (*columns, "statut")).withColumnRenamed("statut", "statut_police")
    policy = policy.select("policy_id", *columns, "statut_police")
    joined = claims.join(policy, "policy_id", "left") if dealt else left_join(claims, policy, "policy_id", spread="claim_id")
    return joined.withColumn("has_valid_policy", F.col("produit").isNotNull())


def with_client(claims: DataFrame, clients: DataFrame, columns: tuple = CLIENT_COLUMNS) -> DataFrame:
    """Every claim with the columns of its client, and whether the client was found."""
    wanted = [F.col(c) for c in columns]
    wanted += [F.col("date_creation").alias("date_creation_client"), F.col("actif").alias("client_actif")]
    client = one_per_key(clients.select("client_id", *wanted), ["client_id"])
    return left_join(claims, client, "client_id", spread="claim_id").withColumn("has_valid_client", F.col("client_type").isNotNull())


def enrich_claims(claims: DataFrame, policies: DataFrame, clients: DataFrame, write: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Every claim with its policy and client columns, and whether each of the two was found.

    Catalyst takes a broadcast where a side is small; else AQE splits a policy or client that holds very
    many claims. The client comes first, as it has fewer columns for the second join to shuffle. ``write(df)`` writes a frame and reads it back: what one join
    shuffled need not be held during the next one.
    """
    both = with_policy(write(with_client(claims, clients)), policies)
    keys = ("client_id", "policy_id")
    own = [c for c in claims.columns if c not in keys]
    of_policy = [*POLICY_COLUMNS, "statut_police", "has_valid_policy"]
    return both.select(*keys, *own, *of_policy, *[c for c in both.columns if c not in (*keys, *own, *of_policy)])


def with_subscription_date(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Fetch ``date_souscription`` unless the claims already carry it."""
    if "date_souscription" in claims.columns:
        return claims
    dates = one_policy_per_id(policies, ("date_souscription",))
    return left_join(claims, dates, "policy_id", spread="claim_id")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent. Rows without a key need no join; the hash gives both sides a shuffle of
    their own, so that AQE can split a key with very many children."""
    keys = parent.select(key).withColumn("_hash", F.xxhash64(key))
    keyed = child.filter(F.col(key).isNotNull()).withColumn("_hash", F.xxhash64(key))
    return keyed.join(keys, [key, "_hash"], "left_anti").select(child.columns).unionByName(child.filter(F.col(key).isNull()))


def attach_label(
    df: DataFrame, dim: DataFrame, key: str = "region_code", code: str = "code", label: str = "nom", out: str = "region_nom"
) -> DataFrame:
    """Add the label of a code; a code without one keeps the code itself as label.

    Catalyst knows the file size of the dimension and broadcasts it below its threshold.
    """
    names = one_per_key(dim.select(F.trim(code).alias("_code"), F.col(label).alias("_label")), ["_code"])
    coded = df.withColumn("_code", F.trim(F.col(key).cast("string")))
    named = F.coalesce(F.col("_label"), F.col(key).cast("string"))
    return left_join(coded, names, "_code", spread=coded.columns[0]).withColumn(out, named).drop("_code", "_label")


def attach_columns(df: DataFrame, dim: DataFrame | None, key: str, columns: tuple) -> DataFrame:
    """Left join of a dimension with one row per key; skipped where the dimension is absent."""
    if dim is None:
        return df
    return df.join(dim.select(key, *columns), key, "left")
