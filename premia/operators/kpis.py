"""Claims and premium indicators per cell and quarter, year-to-date and rolling ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.entities import CELL_DIMS, KPI_DIMS
from premia.functions import banded, cents, money_avg, money_sum, ratio_pct

# Loss-ratio classes with their upper bounds in percent.
LOSS_RATIO_BOUNDS = (60, 80, 100, 150)
LOSS_RATIO_LABELS = ("excellent", "bon", "acceptable", "dégradé", "critique")


def claims_kpis(claims: DataFrame, dims: Sequence[str] = KPI_DIMS) -> DataFrame:
    """Counts, sums, distinct clients, mean delay and refusals per cell."""
    return (
        claims.withColumn("annee", F.col("annee_sinistre"))
        .groupBy(*dims)
        .agg(
            F.count("claim_id").alias("nb_sinistres"),
            money_sum("incurred_loss").alias("incurred_losses"),
            money_sum("montant_declare").alias("montant_declare_total"),
            money_sum("montant_provision").alias("provisions_ouvertes"),
            F.count_distinct("client_id").alias("nb_clients_sinistres"),
            F.avg("delai_declaration_jours").alias("delai_moyen_declaration"),
            F.count_if(F.col("statut") == "refuse").alias("nb_refuses"),
        )
    )


def premium_kpis(premiums: DataFrame, dims: Sequence[str] = KPI_DIMS) -> DataFrame:
    """Earned and annual premium, distinct policies and mean premium per cell."""
    return premiums.groupBy(*dims).agg(
        money_sum("earned_premium").alias("earned_premium"),
        money_sum("prime_annuelle").alias("prime_annuelle_total"),
        F.count_distinct("policy_id").alias("nb_polices"),
        money_avg("prime_annuelle").alias("prime_moyenne"),
    )


def join_kpis(premiums: DataFrame, claims: DataFrame, dims: Sequence[str] = KPI_DIMS) -> DataFrame:
    """Premium cells with their claims and loss ratio. Claim cells without a premium cell drop out."""
    return (
        premiums.join(claims, list(dims), "left")
        .fillna(0, subset=["incurred_losses", "nb_sinistres", "provisions_ouvertes"])
        .withColumn("loss_ratio", ratio_pct("incurred_losses", "earned_premium"))
    )


def _running(df: DataFrame, measures: Mapping[str, str], frame) -> DataFrame:
    """Sums over a frame, in whole cents so that no frame accumulates rounding."""
    return df.withColumns({out: F.sum(cents(m)).over(frame) / F.lit(100.0) for out, m in measures.items()})


def year_to_date(
    df: DataFrame,
    measures: Mapping[str, str],
    dims: Sequence[str] = CELL_DIMS,
    year: str = "annee",
    order: str = "trimestre",
) -> DataFrame:
    """Running sums from the start of the year. ``measures`` maps output name to input column."""
    frame = (
        Window.partitionBy(*dims, year).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _running(df, measures, frame)


def rolling(
    df: DataFrame,
    measures: Mapping[str, str],
    dims: Sequence[str] = CELL_DIMS,
    order: str = "trimestre",
    size: int = 4,
    calendar: bool = False,
) -> DataFrame:
    """Sums over the last ``size`` quarters present, or over exact calendar quarters."""
    window = Window.partitionBy(*dims)
    if calendar:
        ordinal = F.substring(order, 1, 4).cast("int") * 4 + F.substring(order, 7, 1).cast("int")
        frame = window.orderBy(ordinal).rangeBetween(1 - size, Window.currentRow)
    else:
        frame = window.orderBy(order).rowsBetween(1 - size, Window.currentRow)
    return _running(df, measures, frame)


def with_ytd_and_rolling(kpis: DataFrame, calendar: bool = False) -> DataFrame:
    """Year-to-date and rolling twelve-month sums and loss ratios.

    Rolling comes first: its coarser partitioning also serves the year-to-date window, so the two share
    one shuffle. A partition holds one row per quarter of a cell, however many policies the cell has.
    """
    rolled = rolling(
        kpis,
        {"rolling_12m_incurred": "incurred_losses", "rolling_12m_premium": "earned_premium"},
        calendar=calendar,
    )
    ytd = year_to_date(
        rolled, {"ytd_incurred_losses": "incurred_losses", "ytd_earned_premium": "earned_premium"}
    )
    return ytd.withColumns(
        {
            "ytd_loss_ratio": ratio_pct("ytd_incurred_losses", "ytd_earned_premium"),
            "rolling_12m_loss_ratio": ratio_pct("rolling_12m_incurred", "rolling_12m_premium"),
        }
    )


def portfolio_kpis(claims: DataFrame, premiums: DataFrame) -> DataFrame:
    """Quarterly cells with year-to-date and rolling ratios."""
    return with_ytd_and_rolling(join_kpis(premium_kpis(premiums), claims_kpis(claims)))


def loss_ratio_view(kpis: DataFrame) -> DataFrame:
    """Loss ratio per quarter, year-to-date and rolling, with its class.

    A cell without premium has no ratio and falls into the last class.
    """
    base = kpis.drop("ytd_earned_premium", "ytd_incurred_losses", "rolling_12m_premium")
    out = rolling(base, {"rolling_12m_premium": "earned_premium", "rolling_12m_losses": "incurred_losses"})
    out = year_to_date(out, {"ytd_earned_premium": "earned_premium", "ytd_incurred_losses": "incurred_losses"})
    return out.withColumns(
        {
            "loss_ratio_pct": ratio_pct("incurred_losses", "earned_premium"),
            "loss_ratio_ytd_pct": ratio_pct("ytd_incurred_losses", "ytd_earned_premium"),
            "loss_ratio_rolling_12m_pct": ratio_pct("rolling_12m_losses", "rolling_12m_premium"),
        }
    ).withColumn(
        "loss_ratio_category", banded("loss_ratio_pct", LOSS_RATIO_BOUNDS, LOSS_RATIO_LABELS, inclusive=False)
    )
