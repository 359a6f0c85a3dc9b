"""Thresholds and weights, passed to operators as plain values; environment variables override them."""

from __future__ import annotations

import json
import os
from dataclasses import MISSING, dataclass, field, fields


@dataclass(frozen=True)
class FraudSettings:
    """Thresholds and weights of the five fraud rules. The defaults are fixed values."""

    early_claim_hours: int = 48
    high_amount_stddev: float = 3.0
    frequent_claimant_count: int = 3
    frequent_claimant_window: int = 365
    address_cluster_days: int = 30
    late_declaration_days: int = 180
    weights: dict = field(
        default_factory=lambda: {
            "flag_early_claim": 25,
            "flag_high_amount": 30,
            "flag_frequent_claimant": 20,
            "flag_address_cluster": 15,
            "flag_late_declaration": 10,
        }
    )


@dataclass(frozen=True)
class ChurnSettings:
    """Weights of the four churn components. The defaults are fixed values."""

    w_seniority: float = 0.30
    w_unpaid: float = 0.30
    w_refused: float = 0.20
    w_mono: float = 0.20
    max_seniority_years: int = 10


@dataclass(frozen=True)
class QualitySettings:
    """Bounds used by the data-quality suites. The defaults are fixed values."""

    max_null_rate: float = 0.02
    claim_date_min: str = "2020-01-01"
    claim_date_max: str = "2025-12-31"
    max_loss_ratio: float = 3.0


@dataclass(frozen=True)
class RetentionSettings:
    """Years that a layer's rows are kept. The defaults are fixed values."""

    bronze: int = 7
    silver: int = 5
    gold: int = 3
    archive: int = 10


@dataclass(frozen=True)
class LakeSettings:
    """Where the layers live and how the tables are partitioned."""

    root: str = "lake"
    bronze_partitions: tuple = ("batch_id", "annee_ingestion", "mois_ingestion")
    silver_partitions: tuple = ("annee_sinistre", "mois_sinistre")
    gold_partitions: tuple = ("annee", "trimestre", "produit")


def _parsed(text: str, default):
    """``text`` as a value of the default's type. Lists are separated by commas; weights are a JSON object, or ``name=value`` pairs separated
    by commas, and replace the defaults of the names they give."""
    if isinstance(default, dict):
        given = json.loads(text) if text.lstrip().startswith("{") else dict(p.split("=", 1) for p in text.split(",") if p.strip())
        given = {k.strip(): v for k, v in given.items()}
        unknown = sorted(set(given) - set(default))
        if unknown:
            raise ValueError(f"unknown names {unknown}; known: {sorted(default)}")
        return default | {k: type(default[k])(v) for k, v in given.items()}
    if isinstance(default, tuple):
        return tuple(x.strip() for x in text.split(",") if x.strip())
    return type(default)(text)


def from_environment(cls, prefix: str, environ=os.environ):
    """Build a settings object, reading ``PREFIX_FIELD`` for every field that is set."""
    given = {}
    for f in fields(cls):
        text = environ.get(f"{prefix}_{f.name}".upper())
        if text is not None:
            try:
                given[f.name] = _parsed(text, f.default if f.default is not MISSING else f.default_factory())
            except ValueError as e:
                raise ValueError(f"{prefix}_{f.name}".upper() + f": {e}") from None
    return cls(**given)
