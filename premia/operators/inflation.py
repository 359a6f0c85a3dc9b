"""Amounts in the money of one month, by a monthly price series with gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.columns import _col


def month_number(date: Column | str) -> Column:
    """Months since year 0."""
    return F.year(_col(date)) * 12 + F.month(_col(date)) - 1


def price_index(series: DataFrame, year: str = "annee", month: str = "mois", rate: str = "taux_mensuel_pct") -> DataFrame:
    """``month`` (a number) and ``index``: the product of the monthly rates in percent up to and including the month.

    A month without a number, or without a rate, is left out; of a month that occurs twice the greatest rate counts. The series has one row a
    month, some hundreds: it is one window, whatever the number of claims.
    """
    number = F.col(year).try_cast("int") * 12 + F.col(month).try_cast("int") - 1
    known = series.select(number.alias("month"), F.col(rate).try_cast("double").alias("_rate")).dropna()
    known = known.groupBy("month").agg(F.max("_rate").alias("_rate"))
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Rates below -100 % have no logarithm; there are none.
    return known.select("month", F.exp(F.sum(F.log1p(F.col("_rate") / 100)).over(upto)).alias("index"))


def filled(index: DataFrame) -> DataFrame:
    """The index for every month from the first to the last; a month without a value has the last known one."""
    ends = index.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = ends.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("month"))
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return months.join(index, "month", "left").select("month", F.last("index", ignorenulls=True).over(before).alias("index"))


def constant_money(
    df: DataFrame, index: DataFrame, amount: str = "montant_declare", date: str = "date_sinistre", base: str | None = None, out: str = "montant_constant"
) -> DataFrame:
    """``df`` with the amount in the money of the month ``base`` (a date; by default the last month of the index).

    The value of a month is that of the last month of the index at or before it: the as-of join is an equality join by month to the filled
    index, with months behind its end moved to the end. An amount without a date, or from before the index, is null. The index is as small as the
    number of months, and Catalyst broadcasts it by its size.
    """
    dense = filled(index)
    last = index.agg(F.max("month")).scalar()
    at = last if base is None else F.least(month_number(F.lit(base).cast("date")), last)
    target = dense.agg(F.max(F.when(F.col("month") == at, F.col("index")))).scalar() if base else index.agg(F.max_by("index", "month")).scalar()
    month = month_number(date)
    rows = df.withColumn("_month", F.when(month > last, last).otherwise(month))
    joined = rows.join(dense.select(F.col("month").alias("_month"), F.col("index").alias("_index")), "_month", "left")
    return joined.withColumn(out, F.round(F.col(amount) * target / F.col("_index"), 2)).drop("_month", "_index")
