"""Incurred losses and earned premium."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions import cents, quarter_label
from premia.operators.enrich import one_policy_per_id

# Statuses whose paid amount, or whose provision, is the loss.
PAID_STATUS = ("clos",)
OPEN_STATUS = ("ouvert", "en_cours", "en_litige")


def incurred_loss(
    claims: DataFrame, paid_status: Sequence[str] = PAID_STATUS, open_status: Sequence[str] = OPEN_STATUS
) -> DataFrame:
    """Paid amount of a closed claim, provision of an open one, else 0."""
    paid = F.coalesce(F.col("montant_indemnise"), F.lit(0.0))
    reserved = F.coalesce(F.col("montant_provision"), F.lit(0.0))
    return claims.withColumn(
        "incurred_loss",
        F.when(F.col("statut").isin(*paid_status), paid)
        .when(F.col("statut").isin(*open_status), reserved)
        .otherwise(F.lit(0.0)),
    )


def _pro_rata(days: Column) -> Column:
    """Cents of annual premium earned over ``days``: exact up to the one rounding."""
    return F.round(cents("prime_annuelle") * days / 365)


def earned_premium(policies: DataFrame, window: tuple[str, str] = ("2021-01-01", "2024-12-31")) -> DataFrame:
    """Premium earned per policy inside an observation window, start included, end excluded.

    Year and quarter are those of subscription. A null start or end clips to the window, because
    ``greatest`` and ``least`` skip nulls.
    """
    low, high = (F.lit(d).cast("date") for d in window)
    days = F.greatest(
        F.datediff(F.least(F.col("date_echeance"), high), F.greatest(F.col("date_souscription"), low)), F.lit(0)
    )
    return (
        one_policy_per_id(policies)
        .withColumn("days_covered", days)
        .withColumns(
            {
                "earned_premium": _pro_rata(F.col("days_covered")) / 100,
                "annee": F.year("date_souscription").cast("string"),
                "trimestre": quarter_label("date_souscription"),
            }
        )
    )


def earned_premium_by_quarter(
    policies: DataFrame, window: tuple[str, str] = ("2021-01-01", "2024-12-31")
) -> DataFrame:
    """Premium earned per policy and calendar quarter of cover, so that losses of a quarter meet the
    premium of the same quarter. The quarters of a policy add up to its earned premium to the cent."""
    low, high = (F.lit(d).cast("date") for d in window)
    covered = (
        one_policy_per_id(policies)
        .withColumn("_from", F.greatest(F.col("date_souscription"), low))
        .withColumn("_to", F.least(F.col("date_echeance"), high))
        .filter(F.col("_to") > F.col("_from"))
    )
    quarters = F.sequence(
        F.trunc("_from", "quarter"), F.trunc(F.date_sub("_to", 1), "quarter"), F.expr("interval 3 months")
    )
    begin = F.greatest(F.datediff(F.col("_quarter"), F.col("_from")), F.lit(0))
    end = F.datediff(F.least(F.add_months("_quarter", 3), F.col("_to")), F.col("_from"))
    return (
        covered.withColumn("_quarter", F.explode(quarters))
        .withColumns(
            {
                "days_covered": end - begin,
                "earned_premium": (_pro_rata(end) - _pro_rata(begin)) / 100,
                "annee": F.year("_quarter").cast("string"),
                "trimestre": quarter_label("_quarter"),
            }
        )
        .drop("_from", "_to", "_quarter")
    )
