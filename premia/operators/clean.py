"""Typing, trimming, defaults, dates and period columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from premia.functions import banded, parse_date, quarter_label

# Bucket labels with their upper bounds in days.
AGING_BOUNDS = (7, 30, 90)
AGING_LABELS = ("0_7j", "7_30j", "30_90j", "90j_plus")


def normalise(
    df: DataFrame,
    trim: Sequence[str] = (),
    lower: Sequence[str] = (),
    numeric: Sequence[str] = (),
    boolean: Sequence[str] = (),
    defaults: Mapping | None = None,
) -> DataFrame:
    """Trim, lower-case (and trim), cast, then fill nulls. Absent columns are left out.

    Text that is no number becomes null, and so does NaN, which would otherwise pass ``> 0``.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    new: dict[str, Column] = {}
    for c in df.columns:
        out = F.col(c)
        if c in lower and c in text:
            out = F.trim(F.lower(out))
        elif c in trim and c in text:
            out = F.trim(out)
        if c in numeric:
            out = out.try_cast("double")
            out = F.when(~F.isnan(out), out)
        elif c in boolean:
            out = out.try_cast("boolean")
        if defaults and c in defaults:
            out = F.coalesce(out, F.lit(defaults[c]))
        if c in (*trim, *lower, *numeric, *boolean) or (defaults and c in defaults):
            new[c] = out
    return df.withColumns(new) if new else df


def cast_claims(df: DataFrame) -> DataFrame:
    """Types and codes of raw claims."""
    return normalise(
        df,
        trim=("claim_id", "policy_id", "client_id", "region_code"),
        lower=("type_sinistre", "statut"),
        numeric=("montant_declare", "montant_provision", "montant_indemnise"),
        boolean=("is_fraud_injected",),
    )


def cast_payments(df: DataFrame) -> DataFrame:
    return normalise(df, trim=("payment_id", "claim_id", "policy_id", "client_id"), lower=("statut",), numeric=("montant",))


def normalise_policies(df: DataFrame) -> DataFrame:
    """Codes and defaults of policies with one row per coverage."""
    return normalise(
        df,
        trim=("policy_id", "client_id", "region_code", "garantie_libelle"),
        lower=("produit", "statut", "canal_vente", "garantie_code"),
        defaults={
            "garantie_code": "inconnu",
            "garantie_libelle": "Non renseigné",
            "garantie_incluse": False,
            "franchise": 0.0,
        },
    )


def clean_claims(df: DataFrame) -> DataFrame:
    return normalise(
        df,
        trim=("description",),
        lower=("statut", "type_sinistre"),
        defaults={
            "montant_declare": 0.0,
            "montant_provision": 0.0,
            "montant_indemnise": 0.0,
            "description": "",
            "statut": "inconnu",
            "type_sinistre": "inconnu",
        },
    )


def clean_policies(df: DataFrame) -> DataFrame:
    """Defaults of policies; a missing monthly premium is a twelfth of the annual one."""
    df = normalise(
        df,
        lower=("statut", "produit"),
        defaults={"prime_annuelle": 0.0, "franchise": 0.0, "statut": "inconnu", "produit": "inconnu"},
    )
    return df.withColumn("prime_mensuelle", F.coalesce(F.col("prime_mensuelle"), F.col("prime_annuelle") / 12))


def explode_struct(df: DataFrame, array_col: str, prefix: str, fields: Sequence[str]) -> DataFrame:
    """One row per array element with flat ``prefix_field`` columns; rows with no element are kept."""
    rest = [c for c in df.columns if c != array_col]
    flat = df.select(*rest, F.explode_outer(array_col).alias("_element"))
    return flat.select(*rest, *[F.col("_element").getField(f).alias(f"{prefix}_{f}") for f in fields])


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text dates in any known format to DATE. Absent columns are ignored."""
    present = {c: parse_date(c) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def day_gap(df: DataFrame, start: str, end: str, out: str, negative: str = "null") -> DataFrame:
    """Days from ``start`` to ``end``; a negative gap becomes null, zero, or is kept."""
    days = F.datediff(F.col(end), F.col(start))
    if negative == "null":
        days = F.when(days >= 0, days)
    elif negative == "zero":
        days = F.greatest(days, F.lit(0))
    elif negative != "keep":
        raise ValueError(f"negative must be null, zero or keep, not {negative!r}")
    return df.withColumn(out, days)


def declaration_delay(df: DataFrame) -> DataFrame:
    return day_gap(df, "date_sinistre", "date_declaration", "delai_declaration_jours")


def with_period(df: DataFrame, date: str = "date_sinistre") -> DataFrame:
    """Year, two-digit month and ``YYYY-Qn`` quarter as text."""
    return df.withColumns(
        {
            "annee_sinistre": F.year(date).cast("string"),
            "mois_sinistre": F.lpad(F.month(date).cast("string"), 2, "0"),
            "trimestre": quarter_label(date),
        }
    )


def processing_delay(
    df: DataFrame,
    as_of: Column,
    closed: str = "date_cloture",
    declared: str = "date_declaration",
    out: str = "delai_traitement_jours",
) -> DataFrame:
    """Days from declaration to closing, or to ``as_of`` while open; never negative.

    A missing declaration date gives 0, because ``greatest`` skips nulls.
    """
    days = F.datediff(F.coalesce(F.col(closed), as_of), F.col(declared))
    return df.withColumn(out, F.greatest(days, F.lit(0)))


def aging_bucket(days: str = "delai_traitement_jours") -> Column:
    return banded(days, AGING_BOUNDS, AGING_LABELS)


def aging_order(days: str = "delai_traitement_jours") -> Column:
    return banded(days, AGING_BOUNDS, (1, 2, 3, 4))
