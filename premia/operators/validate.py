"""Row rules, split into valid and rejected rows, schema comparison, volumetry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from premia.entities import ALLOWED, CONFLICTS, CORRUPT, POSITIVE, REQUIRED

REASON = "schema_validation_failed"
#: The one rule that a record breaks which could not be read.
MALFORMED = "malformed_record"


class SchemaError(Exception):
    """The columns of a frame are not the expected ones."""


@dataclass(frozen=True)
class RowRules:
    """Required columns, allowed values and columns that must be positive."""

    required: Sequence[str]
    allowed: Mapping[str, Sequence] = field(default_factory=dict)
    positive: Sequence[str] = POSITIVE

    def broken(self, columns: Sequence[str]) -> Column:
        """Array of the names of the rules a row breaks, in rule order."""
        checks = [(f"{c}_missing", F.col(c).isNotNull()) for c in self.required]
        checks += [(f"{c}_not_allowed", F.col(c).isin(*v)) for c, v in self.allowed.items() if c in columns]
        for c in self.positive:
            if c in columns:
                amount = F.col(c)
                checks.append((f"{c}_not_positive", (amount > 0) & ~F.isnan(amount.cast("double"))))
        # A rule whose outcome is unknown (a null value) counts as broken.
        known = [(name, F.coalesce(ok, F.lit(False))) for name, ok in checks]
        names = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in known]))
        # Most rows break none, and need no list to be filtered.
        none = F.array_compact(F.array(F.lit(None).cast("string")))
        return F.when(reduce(and_, [ok for _, ok in known], F.lit(True)), none).otherwise(names)


def rules_for(entity: str) -> RowRules:
    if entity not in REQUIRED:
        raise ValueError(f"unknown entity {entity!r}; known: {sorted(REQUIRED)}")
    return RowRules(REQUIRED[entity], ALLOWED.get(entity, {}))


def require_columns(df: DataFrame, columns: Sequence[str], entity: str = "") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise SchemaError(f"[{entity}] missing columns: {missing}")


def mark_rows(df: DataFrame, rules: RowRules) -> DataFrame:
    """Add ``_rejection_rules``: the broken rules, empty on a valid row.

    A record that the reader could not take apart breaks the one rule ``malformed_record``; one with mere type conflicts is judged by
    the columns that could be read.
    """
    require_columns(df, rules.required)
    broken = rules.broken(df.columns)
    if CORRUPT in df.columns:
        malformed = F.col(CORRUPT).isNotNull()
        if CONFLICTS in df.columns:
            malformed = malformed & (F.size(CONFLICTS) == 0)
        broken = F.when(malformed, F.array(F.lit(MALFORMED))).otherwise(broken)
    return df.withColumn("_rejection_rules", broken)


def with_rejection(rejected: DataFrame, batch_id: str, now) -> DataFrame:
    """Marked rows with reason, time and batch of their rejection."""
    return rejected.withColumns(
        {
            "_rejection_reason": F.lit(REASON),
            "_rejected_at": F.lit(now).cast("timestamp"),
            "_batch_id": F.lit(batch_id),
        }
    )


def split_rows(df: DataFrame, rules: RowRules, batch_id: str, now) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they came, and rejected rows with reason, rules, time and batch."""
    marked = mark_rows(df, rules)
    valid = marked.filter(F.size("_rejection_rules") == 0).drop("_rejection_rules")
    rejected = with_rejection(marked.filter(F.size("_rejection_rules") > 0), batch_id, now)
    return valid, rejected


def volumetry(df: DataFrame, rules: RowRules) -> DataFrame:
    """One row: rows in, valid, rejected. One pass."""
    broken = F.size("_rejection_rules") > 0
    return mark_rows(df, rules).agg(
        F.count("*").alias("n_in"), F.count_if(~broken).alias("n_valid"), F.count_if(broken).alias("n_rejected")
    )


def compare_schema(df: DataFrame, expected: StructType) -> list[str]:
    """Missing, unexpected and mistyped columns, as sorted messages; empty if equal."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    out = [f"missing column: {c}" for c in sorted(want.keys() - have.keys())]
    out += [f"unexpected column: {c}" for c in sorted(have.keys() - want.keys())]
    out += [
        f"wrong type: {c} is {have[c].simpleString()}, not {want[c].simpleString()}"
        for c in sorted(have.keys() & want.keys())
        if have[c] != want[c]
    ]
    return out


def require_same_types(df: DataFrame, table: StructType, entity: str = "") -> None:
    """A batch may add columns to its table, but neither lack one nor change a type."""
    problems = [p for p in compare_schema(df, table) if not p.startswith("unexpected column")]
    if problems:
        raise SchemaError(f"[{entity}] " + "; ".join(problems))


def require_schema(df: DataFrame, expected: StructType, entity: str = "") -> None:
    problems = compare_schema(df, expected)
    if problems:
        raise SchemaError(f"[{entity}] " + "; ".join(problems))
