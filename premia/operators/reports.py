"""Report tables: frequencies, rates, cross-tabs, histograms, null rates, table metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.entities import FLAGS
from premia.functions import money_avg, money_sum
from premia.operators.dedup import top_per_group
from premia.operators.enrich import attach_label

# Score bands of the quality report, with empty bands shown.
BANDS = ("0", "1-25", "26-50", "51-75", "76-100")
# Labels of the bands where only bands that occur are listed.
NAMED_BANDS = ("0 (aucun)", "1-25 (faible)", "26-50 (moyen)", "51-75 (élevé)", "76-100 (critique)")
# Right-closed histogram bins, the lowest bound included in the first.
SCORE_BINS = ("0-25 (low)", "26-50 (medium)", "51-75 (high)", "76-100 (critical)")


def slice_claims(
    df: DataFrame,
    products: Sequence[str] | None = None,
    statuses: Sequence[str] | None = None,
    years: tuple[int, int] | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Rows inside every selection given; a null never matches."""
    for column, chosen in (("produit", products), ("statut", statuses), ("region_code", regions)):
        if chosen is not None:
            df = df.filter(F.col(column).isin(*chosen))
    if years is not None:
        df = df.filter(F.year("date_sinistre").between(*years))
    return df


def choices(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.select(column).dropna().distinct().orderBy(column)


def fraud_in_slice(fraud: DataFrame, claims: DataFrame) -> DataFrame:
    """Assessments of the claims in a slice."""
    return fraud.join(claims.select("claim_id"), "claim_id", "left_semi")


def with_claim_region(fraud: DataFrame, claims: DataFrame) -> DataFrame:
    """Assessments of the claims in a slice, with the region of the claim (one row per claim)."""
    region = claims.groupBy("claim_id").agg(
        F.min("region_code").alias("region_code"), F.min("region_nom").alias("region_nom")
    )
    return fraud.join(region, "claim_id", "inner")


def headline(claims: DataFrame, fraud: DataFrame, all_claims: DataFrame) -> DataFrame:
    """One row: claims, policies, suspected rate, mean amount and delay, paid over declared.

    The paid rate is taken over all claims, not over the slice.
    """
    suspected = fraud.agg(F.avg(F.col("is_fraud_suspected").cast("int")) * 100).scalar()
    paid = all_claims.agg(
        F.when(money_sum("montant_declare") > 0, money_sum("montant_indemnise") / money_sum("montant_declare") * 100).otherwise(0.0)
    ).scalar()
    return claims.agg(
        F.count("*").alias("n_claims"),
        F.count_distinct("policy_id").alias("n_policies"),
        money_avg("montant_declare").alias("avg_amount"),
        F.avg("delai_declaration_jours").alias("avg_delay"),
    ).withColumns({"suspected_rate_pct": F.coalesce(suspected, F.lit(0.0)), "paid_rate_pct": paid})


def global_kpis(claims: DataFrame, policies: DataFrame, clients: DataFrame, fraud: DataFrame) -> DataFrame:
    """One row of counts, rates and means over the whole tables."""
    n = {
        "n_policies": policies.agg(F.count_distinct("policy_id")).scalar(),
        "n_clients": clients.agg(F.count("*")).scalar(),
        "n_suspected": fraud.agg(F.count_if("is_fraud_suspected")).scalar(),
        "fraud_rate_pct": fraud.agg(
            F.round(F.coalesce(F.try_divide(F.count_if("is_fraud_suspected") * 100.0, F.count("*")), F.lit(0.0)), 2)
        ).scalar(),
    }
    declared = money_sum("montant_declare")
    return claims.agg(
        F.count("*").alias("n_claims"),
        F.round(
            F.coalesce(money_sum("montant_indemnise"), F.lit(0.0))
            / F.coalesce(F.nullif(declared, F.lit(0.0)), F.lit(1.0)) * 100,
            2,
        ).alias("paid_rate_pct"),
        F.round(money_avg("montant_declare"), 2).alias("avg_amount"),
        F.round(F.avg("delai_declaration_jours"), 1).alias("avg_delay"),
    ).withColumns(n)


def frequency(df: DataFrame, column: str, out: str = "nb") -> DataFrame:
    """Count per value, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias(out)).orderBy(F.desc(out), column)


def by_group(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column], order: str, descending: bool = True) -> DataFrame:
    """Measures per group, ordered by one of them; groups with a null key are left out."""
    out = df.dropna(subset=list(dims)).groupBy(*dims).agg(*[m.alias(name) for name, m in measures.items()])
    return out.orderBy(F.desc(order) if descending else F.asc(order), *dims)


def rate_by(df: DataFrame, dim: str, predicate: Column, out: str = "rate", descending: bool = True) -> DataFrame:
    """Total, hits and percentage of rows for which the predicate holds, per group."""
    hits = F.count_if(predicate)
    return by_group(
        df, [dim], {"total": F.count("*"), "hits": hits, out: hits / F.count("*") * 100}, out, descending
    )


def paid_rate_by(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Paid over declared amount per group, in percent; groups that declared nothing are left out."""
    out = df.dropna(subset=list(dims)).groupBy(*dims).agg(
        money_sum("montant_indemnise").alias("indemnise"), money_sum("montant_declare").alias("declare")
    )
    rate = F.try_divide("indemnise", "declare") * 100
    return out.withColumn("rate", rate).dropna(subset=["rate"]).orderBy(F.desc("rate"), *dims)


def indemnification(claims: DataFrame) -> DataFrame:
    """Paid over declared amount per product as a ratio, null products included."""
    return (
        claims.groupBy("produit")
        .agg(money_sum("montant_indemnise").alias("indemn"), money_sum("montant_declare").alias("declar"))
        .withColumn("lr", F.try_divide("indemn", "declar"))
        .orderBy(F.desc("lr"))
    )


def trend(df: DataFrame, date: str = "date_sinistre") -> DataFrame:
    """Claims and amount per month."""
    month = F.date_format(date, "yyyy-MM")
    return (
        df.filter(F.col(date).isNotNull())
        .groupBy(month.alias("month"))
        .agg(F.count("claim_id").alias("nb"), money_sum("montant_declare").alias("amount"))
        .orderBy("month")
    )


def score_bands(df: DataFrame, score: str = "fraud_score") -> DataFrame:
    """Count and percentage of scores per band, empty bands included; no rows for an empty table."""
    s = F.col(score)
    inside = (s == 0, (s > 0) & (s <= 25), (s > 25) & (s <= 50), (s > 50) & (s <= 75), s > 75)
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(c).alias(f"_{i}") for i, c in enumerate(inside)])
    rows = [F.struct(F.lit(b).alias("bucket"), F.col(f"_{i}").alias("count")) for i, b in enumerate(BANDS)]
    return (
        counts.filter(F.col("_n") > 0)
        .select("_n", F.explode(F.array(*rows)).alias("r"))
        .select("r.bucket", "r.count", (F.col("r.count") / F.col("_n") * 100).alias("pct"))
    )


def named_bands(df: DataFrame, score: str = "fraud_score") -> DataFrame:
    """Count of scores per band that occurs."""
    s = F.col(score)
    band = F.when(s == 0, NAMED_BANDS[0]).when(s <= 25, NAMED_BANDS[1]).when(s <= 50, NAMED_BANDS[2])
    band = band.when(s <= 75, NAMED_BANDS[3]).otherwise(NAMED_BANDS[4])
    return df.groupBy(band.alias("score_bin")).agg(F.count("*").alias("nb")).orderBy("score_bin")


def score_histogram(df: DataFrame, score: str = "fraud_score") -> DataFrame:
    """Count of scores per right-closed bin; 0 falls into the first; empty bins are shown."""
    s = F.col(score)
    inside = (s.between(0, 25), (s > 25) & (s <= 50), (s > 50) & (s <= 75), (s > 75) & (s <= 100))
    counts = df.agg(*[F.count_if(c).alias(f"_{i}") for i, c in enumerate(inside)])
    rows = [F.struct(F.lit(b).alias("score_bin"), F.col(f"_{i}").alias("nb")) for i, b in enumerate(SCORE_BINS)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.score_bin", "r.nb")


def trigger_totals(df: DataFrame, flags: Sequence[str] = tuple(FLAGS)) -> DataFrame:
    """How often each rule fired, most frequent first."""
    return (
        df.agg(*[F.sum(f).cast("bigint").alias(f) for f in flags])
        .unpivot([], list(flags), "rule", "triggers")
        .orderBy(F.desc("triggers"), "rule")
    )


OTHER = "autres"


def crosstab(
    df: DataFrame, rows: str, columns: str, values: Sequence[str] | None, measure: Column, fill=None
) -> DataFrame:
    """Measure per row and column value. Give the column values where they are known: without them
    Spark first runs a job to list them. All other values are measured together in the column ``autres``."""
    known = df.dropna(subset=[rows, columns])
    if values:
        values = [*values, OTHER]
        label = F.when(F.col(columns).isin(values[:-1]), F.col(columns)).otherwise(F.lit(OTHER))
        out = known.withColumn("_label", label).groupBy(rows).pivot("_label", values).agg(measure)
    else:
        out = known.groupBy(rows).pivot(columns).agg(measure)
    return out if fill is None else out.fillna(fill)


def histogram(
    df: DataFrame, column: str = "montant_declare", group: str = "produit", below: float | None = None, bins: int = 60
) -> DataFrame:
    """Counts of values (of those under ``below``) in equal-width bins, per group."""
    kept = df if below is None else df.filter(F.col(column) < below)
    low, high = kept.agg(F.min(column), F.max(column)).first()
    width = (high - low) / bins if low is not None and high > low else 1.0
    slot = F.least(F.lit(bins - 1), F.floor((F.col(column) - F.lit(low)) / F.lit(width)))
    return kept.dropna(subset=[group, column]).groupBy(group, slot.cast("int").alias("bin")).agg(F.count("*").alias("nb"))


def kpi_listing(kpis: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells with region name, channel, policies, claims, loss ratio to 3 digits and mean delay."""
    named = attach_label(kpis, regions)
    return named.select(
        F.col("region_nom").alias("region"),
        F.col("canal_vente").alias("channel"),
        F.col("nb_polices").alias("policies"),
        F.col("nb_sinistres").alias("claims"),
        F.round("loss_ratio", 3).alias("loss_ratio"),
        F.col("delai_moyen_declaration").alias("avg_filing_delay_d"),
    )


def dominant_type(claims: DataFrame, region: str = "region_nom") -> DataFrame:
    """Claim type with the largest amount per region."""
    sums = (
        claims.dropna(subset=[region, "type_sinistre"])
        .groupBy(region, "type_sinistre")
        .agg(money_sum("montant_declare").alias("amount"), F.count("claim_id").alias("claims"))
    )
    return (
        top_per_group(sums, [region], "amount", ["type_sinistre"])
        .withColumnRenamed("type_sinistre", "dominant_risk")
        .orderBy(F.desc("amount"), region)
    )


def five_numbers(df: DataFrame, group: str = "churn_segment", column: str = "churn_score") -> DataFrame:
    """Minimum, quartiles and maximum per group.

    Meant for scores: a score in [0, 100] with two digits has at most 10,001 distinct values, which
    bounds the buffer of the exact quantiles.
    """
    q = F.percentile(column, F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    names = ("minimum", "q1", "median", "q3", "maximum")
    return (
        df.dropna(subset=[group]).groupBy(group).agg(q.alias("_q")).select(group, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    )


def churn_headline(churn: DataFrame) -> DataFrame:
    """One row: scored clients, mean score, critical clients and their share."""
    critical = F.count_if(F.col("churn_segment") == "critique")
    return churn.agg(
        F.count("*").alias("n_clients"),
        F.coalesce(F.avg("churn_score"), F.lit(0.0)).alias("avg_score"),
        critical.alias("n_critical"),
        F.try_divide(critical * 100.0, F.count("*")).alias("pct_critical"),
    )


def null_rates(tables: Mapping[tuple[str, str], tuple[DataFrame | None, Sequence[str]]]) -> DataFrame:
    """Null percentage per layer, table and column. Absent tables and columns are skipped."""
    out = None
    for (layer, table), (df, columns) in tables.items():
        present = [] if df is None else [c for c in columns if c in df.columns]
        if not present:
            continue
        pct = [
            F.round(F.coalesce(F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count("*")), F.lit(0.0)), 4).alias(c)
            for c in present
        ]
        part = (
            df.agg(*pct)
            .unpivot([], present, "column", "null_rate_pct")
            .select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), "column", "null_rate_pct")
        )
        out = part if out is None else out.unionByName(part)
    return out


def duplicate_counts(tables: Mapping[str, tuple[DataFrame | None, str]]) -> DataFrame:
    """Rows, distinct keys and duplicates per table; null counts as one key."""
    out = None
    for table, (df, key) in tables.items():
        if df is None:
            continue
        distinct = F.count_distinct(key) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0))
        part = df.agg(F.count("*").alias("total"), F.coalesce(distinct, F.lit(0)).alias("distinct")).select(
            F.lit(table).alias("table"), "total", "distinct", (F.col("total") - F.col("distinct")).alias("duplicates")
        )
        out = part if out is None else out.unionByName(part)
    return out


def table_metrics(tables: Mapping[str, tuple[DataFrame | None, Mapping[str, Column]]]) -> DataFrame:
    """Row count and extra aggregates per table as (table, metric, value). Absent tables are skipped."""
    out = None
    for table, (df, extras) in tables.items():
        if df is None:
            continue
        measures = {"row_count": F.count("*"), **extras}
        part = (
            df.agg(*[m.cast("double").alias(name) for name, m in measures.items()])
            .unpivot([], list(measures), "metric", "value")
            .select(F.lit(table).alias("table"), "metric", "value")
        )
        out = part if out is None else out.unionByName(part)
    return out


def summarise_steps(steps: DataFrame) -> DataFrame:
    """Total duration, rows out, rejected rows and rejection percentage per run."""
    out, rejected = (F.coalesce(F.sum(c), F.lit(0)) for c in ("nb_out", "nb_rejected"))
    return steps.groupBy("run_id").agg(
        F.round(F.sum("duration_sec"), 2).alias("total_duration_sec"),
        out.alias("total_records_out"),
        rejected.alias("total_rejected"),
        F.round(rejected / F.greatest(out, F.lit(1)) * 100, 4).alias("rejection_rate_pct"),
    )


def latest_run(summaries: DataFrame) -> DataFrame:
    """Summary row of the greatest run id."""
    return summaries.orderBy(F.desc("run_id")).limit(1)


def preview(df: DataFrame, order_by: str, k: int = 20) -> DataFrame:
    """The k rows with the greatest value of one column."""
    return df.orderBy(F.desc(order_by), *[c for c in df.columns if c != order_by]).limit(k)
