"""Five fraud rules, the weighted score and the assessment table.

Two rules look at the neighbours of a claim: earlier claims of the same client, and claims at the same
address. Instead of joining claims with claims, both first count the claims per visit (client, day and product), combined map-side, sum these
counts over the days around by running sums, and join the few visits that matter back. A client with very many claims still has at most one
row per day and product in its window, and a running sum costs the same whatever the number of claims or products around. As a client has one address, visits
are dealt by address once for the sums of both rules; those of an address with very many clients are counted per day and product first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.entities import FLAGS
from premia.functions import clamp, slice_of
from premia.operators.dedup import one_per_key
from premia.operators.enrich import with_subscription_date
from premia.settings import FraudSettings

ASSESSMENT_COLUMNS = (
    "claim_id", "policy_id", "client_id", "produit", "date_sinistre", "montant_declare",
    *FLAGS, "fraud_score", "fraud_flags", "is_fraud_suspected",
)


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def flag_early(claims: DataFrame, policies: DataFrame | None = None, hours: float = 48) -> DataFrame:
    """Claim on or after the subscription date, by less than the given hours."""
    df = claims if policies is None else with_subscription_date(claims, policies)
    days = F.datediff(F.col("date_sinistre"), F.col("date_souscription"))
    return df.withColumn("flag_early_claim", _flag((days >= 0) & (days < hours / 24)))


def flag_high_amount(claims: DataFrame, n_stddev: float = 3.0, group: str = "produit") -> DataFrame:
    """Declared amount strictly above mean plus ``n_stddev`` sample deviations of its product.

    The statistics come from exact sums of cents and of their squares, so they do not depend on the order of tasks. They
    stay part of the plan and are broadcast, one row per product, so that no claim is shuffled for them.
    """
    cents = F.round(F.col("montant_declare") * 100).cast("decimal(19,0)")
    sums = (
        claims.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(cents).alias("_n"), F.sum(cents).cast("double").alias("_s"), F.sum((cents * cents).cast("decimal(38,0)")).alias("_q"))
    )
    spread = F.col("_q").cast("double") - F.col("_s") * F.col("_s") / F.col("_n")
    deviation = F.when(F.col("_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("_n") - 1))).otherwise(F.lit(0.0))
    stats = sums.filter("_n > 0").select(group, (F.col("_s") / F.col("_n") / 100).alias("_mean"), (deviation / 100).alias("_std"))
    limit = F.col("_mean") + n_stddev * F.col("_std")
    return (
        claims.join(F.broadcast(stats), group, "left")
        .select(*claims.columns, "_mean", "_std")
        .withColumn("flag_high_amount", _flag(F.col("montant_declare") > limit))
        .drop("_mean", "_std")
    )


def claims_in_window(claims: DataFrame, days: int = 365) -> DataFrame:
    """Claims of a client in the ``days`` up to and including each day on which it has one."""
    per_day = (
        claims.filter(F.col("client_id").isNotNull() & F.col("date_sinistre").isNotNull())
        .groupBy("client_id", "date_sinistre")
        .agg(F.count("*").alias("_n"))
    )
    look_back = Window.partitionBy("client_id").orderBy(F.unix_date("date_sinistre")).rangeBetween(-days, 0)
    return per_day.select("client_id", "date_sinistre", F.sum("_n").over(look_back).alias("claims_in_window"))


def join_by_visit(claims: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``claims`` with what was found by client and day. Claims without one of the keys match nothing and are spread by their id; the hash in the join
    gives the found rows a shuffle of their own, so that AQE can split a client's busy day."""
    own = slice_of(*keys)
    known = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(False)) for k in keys], F.lit(True))
    left = claims.withColumn("_hash", F.when(known, own).otherwise(slice_of("claim_id")))
    return left.join(found.withColumn("_hash", own), [*keys, "_hash"], "left").drop("_hash")


def flag_frequent(claims: DataFrame, count: int = 3, days: int = 365) -> DataFrame:
    """Client with at least ``count`` claims in the look-back window, this claim included."""
    busy = claims_in_window(claims, days).filter(F.col("claims_in_window") >= count).drop("claims_in_window")
    return (
        join_by_visit(claims, busy.withColumn("_busy", F.lit(True)), ["client_id", "date_sinistre"])
        .withColumn("flag_frequent_claimant", _flag(F.col("_busy") & F.col("claim_id").isNotNull()))
        .drop("_busy")
    )


VISIT = ("client_id", "date_sinistre", "produit")


def _around(value: str, before: int, after: int, *keys: str) -> Column:
    """Sum of a count over the days from ``before`` days back to ``after`` days on: the difference of two running sums, so that no frame is gone through again."""
    days = Window.partitionBy(*keys).orderBy(F.unix_date("date_sinistre"))
    upto, past = (F.sum(value).over(days.rangeBetween(Window.unboundedPreceding, last)) for last in (after, -before - 1))
    return upto - F.coalesce(past, F.lit(0))


#: Clients of an address up to which all its visits are summed in one task.
CROWD = 1000


def located_visits(claims: DataFrame, clients: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per client, day and product with a claim, with its claims, ``_one`` (1 if the product is known, else 0), ``adresse``, the first client of the
    client's address (itself without one), which is shorter than the address and as good to tell addresses apart, and ``_crowded`` for an address of more
    than ``crowd`` clients."""
    known = F.col("client_id").isNotNull() & F.col("date_sinistre").isNotNull()
    visits = claims.filter(known).groupBy(*VISIT).agg(F.count("*").alias("_claims"))
    homes = one_per_key(clients.select("client_id", "adresse").filter(F.col("client_id").isNotNull()), ["client_id"])
    at = Window.partitionBy("adresse", F.when(F.col("adresse").isNull(), F.col("client_id")))
    first, crowded = F.min("client_id").over(at), F.count("*").over(at) > crowd
    homes = homes.select("client_id", first.alias("adresse"), crowded.alias("_crowded"))
    # Made from the number of claims after the join, so that all readers of the visits need the same columns and share their shuffles.
    one = F.when(F.col("produit").isNotNull(), F.least("_claims", F.lit(1))).otherwise(F.lit(0))
    located = visits.join(homes, "client_id", "left").withColumn("_one", one)
    return located.withColumns({"adresse": F.coalesce("adresse", "client_id"), "_crowded": F.coalesce("_crowded", F.lit(False))})


def address_neighbours(located: DataFrame, days: int = 30) -> DataFrame:
    """Per address, day and product: ``others``, the visits for another product at the address within ``days``; only where there are any.

    Visits are counted per day and product before they are summed around the days: a window holds one number a day and product, whatever the number of
    visits.
    """
    visits = F.col("_one") if "_one" in located.columns else F.lit(1)
    dated = located.filter(F.col("adresse").isNotNull() & F.col("date_sinistre").isNotNull())
    of_product = dated.groupBy("adresse", "produit", "date_sinistre").agg(F.sum(visits).alias("_n"))
    others = _around("_n", days, days, "adresse") - _around("_n", days, days, "adresse", "produit")
    return of_product.select("adresse", "produit", "date_sinistre", others.alias("others")).filter(F.col("others") > 0)


def _recent(cfg: FraudSettings | None, *keys: str) -> dict[str, Column]:
    """Whether the client has enough claims in the look-back window, if that is asked for."""
    if cfg is None:
        return {}
    return {"_busy": _around("_claims", cfg.frequent_claimant_window, 0, *keys) >= cfg.frequent_claimant_count}


def clustered(located: DataFrame, days: int = 30, cfg: FraudSettings | None = None) -> DataFrame:
    """Visits with ``_clustered``: whether the address has more visits for other products around the visit than its own client has, and with ``cfg`` also
    ``_busy``. By counts, no visit meets another. All visits of an address are summed where they were dealt to; a crowded one has another way."""
    client, address = ("adresse", "client_id"), ("adresse",)  # a client has one address
    own = _around("_one", days, days, *client) - _around("_one", days, days, *client, "produit")
    others = _around("_one", days, days, *address) - _around("_one", days, days, *address, "produit")
    dealt = located.filter(~F.col("_crowded")).drop("_crowded").repartition("adresse")
    met = dealt.withColumns({"_own": own, "_others": others, **_recent(cfg, *client)})
    alone = met.withColumn("_clustered", F.col("produit").isNotNull() & (F.col("_others") > F.col("_own"))).drop("_own", "_others")
    return alone.unionByName(clustered_in_crowds(located.filter("_crowded").drop("_crowded"), days, cfg))


def clustered_in_crowds(located: DataFrame, days: int, cfg: FraudSettings | None) -> DataFrame:
    """As ``clustered``, for visits of addresses with very many clients: a client's visits are summed by client, those of the address per day and product."""
    own = _around("_one", days, days, "client_id") - _around("_one", days, days, "client_id", "produit")
    # There may be as many of both as visits, which is more than an estimate from compressed files says: neither this side nor the one in flag_neighbours is broadcast.
    met = located.withColumns({"_own": own, **_recent(cfg, "client_id")})
    met = met.join(address_neighbours(located, days).hint("merge"), ["adresse", "date_sinistre", "produit"], "left")
    return met.withColumn("_clustered", F.coalesce(F.col("others") > F.col("_own"), F.lit(False))).drop("_own", "others")


def flag_cluster(claims: DataFrame, clients: DataFrame, days: int = 30) -> DataFrame:
    """Another client claimed for another product at the same address at most ``days`` apart.

    The claims are reduced to visits, one row per client, day and product, and take the flag back by these three columns.
    """
    found = clustered(located_visits(claims, clients).filter(F.col("produit").isNotNull()), days).filter("_clustered").select(*VISIT, "_clustered")
    return join_by_visit(claims, found, list(VISIT)).withColumn("flag_address_cluster", _flag(F.col("_clustered"))).drop("_clustered")


def flag_neighbours(claims: DataFrame, clients: DataFrame, cfg: FraudSettings) -> DataFrame:
    """The flags of ``flag_frequent`` and ``flag_cluster`` from the same visits, taken back by one join."""
    visits = clustered(located_visits(claims, clients), cfg.address_cluster_days, cfg)
    found = visits.filter(F.col("_busy") | F.col("_clustered"))
    # A claim without product has a visit of its own for the frequent rule, so that the product is compared with nulls.
    found = found.select(*[F.col(c).alias(f"_{c}") for c in VISIT], "_busy", "_clustered", slice_of(*VISIT).alias("_found"))
    known = F.col("client_id").isNotNull() & F.col("date_sinistre").isNotNull()
    left = claims.withColumn("_hash", F.when(known, slice_of(*VISIT)).otherwise(slice_of("claim_id")))
    same = (F.col("client_id") == F.col("_client_id")) & (F.col("date_sinistre") == F.col("_date_sinistre"))
    same = same & F.col("produit").eqNullSafe(F.col("_produit")) & (F.col("_hash") == F.col("_found"))
    flags = {
        "flag_frequent_claimant": _flag(F.col("_busy") & F.col("claim_id").isNotNull()),
        "flag_address_cluster": _flag(F.col("_clustered")),
    }
    return left.join(found.hint("merge"), same, "left").withColumns(flags).select(*claims.columns, *flags)


def flag_late(claims: DataFrame, days: int = 180) -> DataFrame:
    """Declared strictly more than ``days`` after the event."""
    return claims.withColumn("flag_late_declaration", _flag(F.col("delai_declaration_jours") > days))


def fraud_score(df: DataFrame, weights: Mapping[str, int] | None = None) -> DataFrame:
    """Weighted sum of the flags in [0, 100], names of the rules that fired, and the suspicion."""
    weights = weights or FraudSettings().weights
    total = sum((F.col(flag) * weight for flag, weight in weights.items()), F.lit(0))
    fired = F.array_compact(F.array(*[F.when(F.col(flag) == 1, F.lit(rule)) for flag, rule in FLAGS.items()]))
    return df.withColumns({"fraud_score": clamp(total, 0, 100), "fraud_flags": fired}).withColumn(
        "is_fraud_suspected", F.col("fraud_score") > 0
    )


def assess(claims: DataFrame, policies: DataFrame, clients: DataFrame, cfg: FraudSettings | None = None) -> DataFrame:
    """All five rules and the score; one row per claim."""
    cfg = cfg or FraudSettings()
    df = flag_early(claims, policies, cfg.early_claim_hours)
    df = flag_high_amount(df, cfg.high_amount_stddev)
    df = flag_late(df, cfg.late_declaration_days)  # before the join back, so that a flag is shuffled and not the delay
    df = flag_neighbours(df, clients, cfg)
    return fraud_score(df, cfg.weights).select(*ASSESSMENT_COLUMNS)
