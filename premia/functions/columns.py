"""Column expressions shared by the operators. All of them stay inside Spark's code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date formats in the order they are tried.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount) -> Column:
    """Amount as whole cents. Integer sums do not depend on the order in which tasks finish."""
    return F.round(_col(amount) * 100).cast("bigint")


def money_sum(amount) -> Column:
    return F.sum(cents(amount)) / F.lit(100.0)


def money_avg(amount) -> Column:
    return F.try_divide(money_sum(amount), F.count(_col(amount)))


def ratio_pct(num, den, digits: int = 4) -> Column:
    """``num / den`` in percent; null unless the denominator is positive."""
    return F.when(_col(den) > 0, F.round(_col(num) / _col(den) * 100, digits))


def banded(value, bounds: Sequence, labels: Sequence, inclusive: bool = True) -> Column:
    """Label by ascending upper bounds. A null value falls through to the last label."""
    value = _col(value)
    out = None
    for bound, label in zip(bounds, labels[:-1], strict=True):
        hit = value <= bound if inclusive else value < bound
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def clamp(value, low, high) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), _col(value)))


def parse_date(value, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that matches wins; a value that matches none becomes null."""
    return F.coalesce(*[F.try_to_date(_col(value), f) for f in formats])


def quarter_label(date) -> Column:
    """``YYYY-Qn``; sorts as text."""
    return F.concat(F.year(_col(date)).cast("string"), F.lit("-Q"), F.quarter(_col(date)).cast("string"))
