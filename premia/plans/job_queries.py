"""The jobs and what they leave behind, as queries: each one makes its files or its lake from the driver tables and returns what is found there."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.operators import aging, clean, inflation, reports, sketches, validate
from premia.plans import medallion, raw_files, runs, upkeep
from premia.plans.raw_files import FRAUD, NOW, messy, shared_folder, write_raw_files, written
from premia.settings import QualitySettings
from premia.sources import driver_tables as d
from premia.sources import readers, sinks

JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LAKE_QUALITY = QualitySettings(claim_date_min="1996-01-01", claim_date_max="2001-12-31")


def query(fn):
    JOB_QUERIES[fn.__name__] = fn
    return fn


def _lake(spark: SparkSession, batch: str = "b1", now: datetime = NOW) -> medallion.Lake:
    return medallion.Lake(shared_folder(spark), now, batch, window=d.WINDOW, fraud=FRAUD, quality=LAKE_QUALITY)


_MADE: dict[tuple[str, str], medallion.Lake] = {}


def whole_lake(spark: SparkSession, sf: str) -> medallion.Lake:
    """A lake made by all jobs from the driver tables, ingested twice; made once per application and kept for the queries that only read it."""
    made = (spark.sparkContext.applicationId, sf)
    if made not in _MADE:
        lake = _lake(spark)
        raw = write_raw_files(spark, sf, lake.root)
        runs.run_all(spark, raw, lake)
        medallion.ingest_claims(spark, raw["claims"], lake)
        medallion.ingest_policies(spark, raw["policies"], lake)
        medallion.export_tables(spark, lake, f"{lake.root}/exports")
        _MADE[made] = lake
    return _MADE[made]


# Raw files -----------------------------------------------------------------------------------------


@query
def s1_claims_by_header(spark, sf):
    """Files of two column orders, matched by their own headers."""
    lake = _lake(spark)
    medallion.ingest_claims(spark, raw_files.write_mixed_claims(spark, sf, lake.root), lake)
    return lake.read(spark, "bronze", "claims").select("claim_id", "client_id", "statut", "montant_declare", "date_sinistre", "remarque")


@query
def s1_broken_records(spark, sf):
    """Broken lines in the rejects, with their text."""
    lake = _lake(spark)
    medallion.ingest_claims(spark, raw_files.write_mixed_claims(spark, sf, lake.root), lake)
    rejects = lake.read(spark, "dead_letter_queue", "claims")
    return rejects.select(F.col("_corrupt_record").alias("record"), F.array_join("_rejection_rules", ",").alias("rules"), "_batch_id")


@query
def s2_policies_by_variant(spark, sf):
    """Objects with a field too many or an optional one of the wrong type: kept, with what did not fit beside."""
    lake = _lake(spark)
    medallion.ingest_policies(spark, raw_files.write_odd_policies(spark, sf, lake.root), lake)
    rows = lake.read(spark, "bronze", "policies")
    return rows.select("policy_id", "prime_annuelle", "franchise", "garantie_code", "garantie_plafond", F.col("_rescued").alias("rescued"))


@query
def s2_broken_objects(spark, sf):
    """Objects that break off, or lack a required value for its type: rejected with their text and the paths that did not fit."""
    lake = _lake(spark)
    medallion.ingest_policies(spark, raw_files.write_odd_policies(spark, sf, lake.root), lake)
    rejects = lake.read(spark, "dead_letter_queue", "policies")
    return rejects.select(
        F.col("_corrupt_record").alias("record"), F.array_join("_rejection_rules", ",").alias("rules"), F.array_join("_type_conflicts", ",").alias("paths")
    )


@query
def v1_schema_messages(spark, sf):
    """What the checks of columns, entities and types say about four frames; one of them is as expected."""
    claims = clean.cast_claims(messy(spark, sf))
    expected = T.StructType([f for f in claims.schema.fields if f.name in ("claim_id", "montant_declare")] + [T.StructField("devise", T.StringType())])

    def said(check: Callable[[], object]) -> str:
        try:
            check()
        except (validate.SchemaError, ValueError) as e:
            return str(e)
        return "ok"

    rules = validate.rules_for("claims")
    found = {
        "missing columns": said(lambda: validate.require_columns(claims.drop("statut", "client_id"), rules.required, "claims")),
        "unknown entity": said(lambda: validate.rules_for("boats")),
        "drifted types": said(lambda: validate.require_same_types(claims.withColumn("montant_declare", F.lit("x")), expected, "claims")),
        "as expected": said(lambda: validate.require_columns(claims, rules.required, "claims")),
    }
    n = claims.agg(F.count("*").alias("rows"))
    messages = F.explode(F.array(*[F.struct(F.lit(k).alias("case"), F.lit(v).alias("message")) for k, v in found.items()]))
    return n.select("rows", messages.alias("m")).select("m.case", "m.message", "rows")


# Runs ----------------------------------------------------------------------------------------------


@query
def m5_run_steps(spark, sf):
    """Steps of two runs, the first of which was repeated: its rows were replaced."""
    lake = _lake(spark)
    raw = write_raw_files(spark, sf, lake.root)
    for batch in ("b1", "b2", "b1"):
        runs.run_all(spark, raw, replace(lake, batch_id=batch), only=("claims", "policies"))
    return runs.steps(spark, lake).select("run_id", "position", "step", "status", "nb_in", "nb_out", "nb_rejected")


@query
def m5_run_summary(spark, sf):
    """Rows out, rejects and rejection rate of the recorded run of all jobs; the duration is left out, as it differs from run to run."""
    return runs.latest_summary(spark, whole_lake(spark, sf)).drop("total_duration_sec")


@query
def q22_lake_checks(spark, sf):
    """The Bronze and Silver suites over the lake, as recorded; the Gold suite is recorded too."""
    return runs.quality_run(spark, whole_lake(spark, sf)).filter(F.col("suite") != "gold").withColumn("observed", F.round("observed", 9))


@query
def m4_lake_tables(spark, sf):
    """Measures of the lake's tables, as recorded; those of fraud and churn have queries of their own."""
    return runs.table_run(spark, whole_lake(spark, sf)).filter(F.col("metric").isin("row_count", "injected_fraud_count"))


@query
def m1_lake_nulls(spark, sf):
    return runs.report_run(spark, whole_lake(spark, sf))[0].filter(F.col("table") != "churn_scores")


@query
def m1_lake_duplicates(spark, sf):
    return runs.report_run(spark, whole_lake(spark, sf))[1]


@query
def k8_exports(spark, sf):
    """Columns, rows and a content sum of the exported tables, as read back."""
    lake = whole_lake(spark, sf)
    parts = None
    for name, key in {"claims": "claim_id", "fraud_assessment": "claim_id", "portfolio_kpis": "nb_polices", "churn_scores": "client_id"}.items():
        df = spark.read.parquet(f"{lake.root}/exports/{name}")
        part = df.agg(F.count("*").alias("rows"), F.sum(F.col(key).cast("bigint")).alias("key_sum"))
        part = part.select(F.lit(name).alias("table"), F.lit(",".join(df.columns)).alias("columns"), "rows", "key_sum")
        parts = part if parts is None else parts.unionByName(part)
    return parts


# Upkeep --------------------------------------------------------------------------------------------


def _named(column: str, letter: str = ""):
    return F.concat(F.lit(letter), F.col(column).cast("string")).alias(column)


#: First letters of identifiers where claims, policies and clients must not share numbers.
LETTERS = {"claim_id": "S", "policy_id": "P", "client_id": "K"}


def _silver_claims(spark, sf, lake, letters=None):
    claims = d.insured_claims(spark, sf).select(
        *[_named(c, (letters or {}).get(c, "")) for c in LETTERS], "statut", "type_sinistre", "date_sinistre",
        "date_declaration", "montant_declare", "annee_sinistre", "mois_sinistre",
    )
    lake.write(claims, "silver", "claims", lake.layout.silver_partitions)
    return upkeep.Table("silver", "claims", lake.layout.silver_partitions, "date_sinistre")


@query
def x3_erase_closure(spark, sf):
    """A few clients erased with their policies, claims and payments, also from the rejects: rows and key sums of what is left."""
    lake = _lake(spark)
    _silver_claims(spark, sf, lake, LETTERS)
    policies, clients, payments = d.policies(spark, sf), d.clients(spark, sf), d.payments(spark, sf)
    lake.write(policies.select(_named("policy_id", "P"), _named("client_id", "K")), "silver", "policies")
    lake.write(clients.select(_named("client_id", "K"), "nom"), "silver", "clients")
    lake.write(payments.select(_named("payment_id", "Y"), _named("client_id", "K")), "bronze", "payments")
    odd = lake.read(spark, "silver", "claims").filter(F.substring("claim_id", 2, 20).cast("bigint") % 97 == 0)
    broken = odd.select(*[F.lit(None).cast("string").alias(c) for c in LETTERS], F.concat_ws(",", "claim_id", "policy_id").alias("_corrupt_record"), "annee_sinistre")
    rejects = odd.select(*LETTERS, F.lit(None).cast("string").alias("_corrupt_record"), "annee_sinistre").unionAll(broken)
    lake.write(rejects.withColumnRenamed("annee_sinistre", "_batch_id"), "dead_letter_queue", "claims", ("_batch_id",))
    upkeep.erase_clients(spark, lake, clients.filter(F.col("client_id") % 500 == 7).select(_named("client_id", "K")))
    word = F.coalesce(F.col("claim_id"), F.substring_index("_corrupt_record", ",", 1))
    keys = {
        ("silver", "claims"): F.col("claim_id"), ("silver", "policies"): F.col("policy_id"), ("silver", "clients"): F.col("client_id"),
        ("bronze", "payments"): F.col("payment_id"), ("dead_letter_queue", "claims"): word,
    }
    return reports.table_metrics({
        f"{layer}.{name}": (lake.read(spark, layer, name), {"key_sum": F.sum(F.substring(key, 2, 20).cast("bigint"))})
        for (layer, name), key in keys.items()
    })


@query
def x4_correct_partitions(spark, sf):
    """Corrections that close claims and move them to another month, applied twice."""
    lake = _lake(spark)
    table = _silver_claims(spark, sf, lake)
    fixed = written(lake.read(spark, "silver", "claims").filter(F.col("policy_id").cast("bigint") % 200 == 0), "fixed")
    fixed = fixed.withColumns({
        "statut": F.lit("clos"), "date_sinistre": F.date_add("date_sinistre", 400), "date_declaration": F.date_add("date_declaration", 500),
    })
    fixed = clean.with_period(fixed).drop("trimestre")
    for _ in range(2):
        upkeep.correct(spark, lake, table, fixed, ["claim_id"], ["date_declaration"])
    return lake.read(spark, "silver", "claims").select("claim_id", "statut", "date_sinistre", "annee_sinistre", "mois_sinistre")


@query
def x5_expire(spark, sf):
    """Silver claims after the retention job: whole months dropped, the month of the limit cut by day."""
    lake = _lake(spark, now=datetime(2002, 3, 15))
    _silver_claims(spark, sf, lake)
    upkeep.expire(spark, lake)
    return lake.read(spark, "silver", "claims").select("claim_id", "date_sinistre")


# Series and sketches -------------------------------------------------------------------------------


def price_series(spark, sf):
    """A monthly series with gaps, from the number of policies subscribed in a month."""
    month = d.policies(spark, sf, region=False).groupBy(F.year("date_souscription").alias("annee"), F.month("date_souscription").alias("mois"))
    rates = month.agg((F.count("*") % 40 / 100.0).alias("taux_mensuel_pct"))
    return rates.filter((F.col("annee") * 12 + F.col("mois") - 1) % 5 != 0)


@query
def s9_constant_money(spark, sf):
    """Declared amounts in the money of the last month of the series."""
    index = written(inflation.price_index(price_series(spark, sf)), "index")
    out = inflation.constant_money(d.claim_lines(spark, sf), index)
    return out.select("claim_id", F.round("montant_constant", 1).alias("montant_constant"))


CELLS = ("type_sinistre", "statut")


def _delays(spark, sf):
    return aging.aging_detail(d.silver_claims(spark, sf), d.as_of())


@query
def a12_exact_cells(spark, sf):
    """Median and 90th percentile of all cells at once, by narrowing brackets."""
    named = {"median": 0.5, "p90": 0.9}
    found = sketches.exact_cell_quantiles(_delays(spark, sf), CELLS, "delai_traitement_jours", named, lambda df: written(df, "cells"))
    return found.select(*CELLS, *[F.round(c, 6).alias(c) for c in named])


@query
def a12_merged_sketches(spark, sf):
    """Sketches of two batches, kept as a table and merged: whether the ranks of their median and 90th percentile are within the stated error."""
    delays = _delays(spark, sf).select(*CELLS, "delai_traitement_jours", (F.col("claim_id") % 2).alias("batch"))
    kept = written(sketches.quantile_sketches(delays, [*CELLS, "batch"], "delai_traitement_jours"), "sketches")
    found = written(sketches.quantiles_of(sketches.merge_quantiles(kept, CELLS), CELLS, {"median": 0.5, "p90": 0.9}), "quantiles")
    rows = delays.join(found.select(*CELLS, "median", "p90"), list(CELLS))

    def within(name: str, p: float):
        below = F.count_if(F.col("delai_traitement_jours") < F.col(name)) / F.count("*")
        upto = F.count_if(F.col("delai_traitement_jours") <= F.col(name)) / F.count("*")
        # Twice the error of one sketch: two were merged, and the rank is asked of each.
        return ((below <= p + 2 * sketches.rank_error()) & (upto >= p - 2 * sketches.rank_error())).alias(f"{name}_within")

    return rows.groupBy(*CELLS).agg(F.count("*").alias("nb"), within("median", 0.5), within("p90", 0.9))


@query
def a14_key_sets(spark, sf):
    """Keys of Bronze and Silver claims from the sketches of their batches: whether counts and overlap are within four standard errors."""
    bronze = messy(spark, sf).select(F.trim("claim_id").alias("claim_id"), (F.col("policy_id").cast("bigint") % 2).alias("batch"), "statut")
    silver = bronze.filter(F.col("statut").isNotNull())
    kept = {n: written(sketches.key_sketch(df, "claim_id", "batch"), n) for n, df in (("bronze", bronze), ("silver", silver))}
    merged = {n: sketches.merge_keys(df) for n, df in kept.items()}
    found = sketches.overlap(merged["bronze"], merged["silver"])
    exact = bronze.agg(F.count("*").alias("n_left"), F.count("statut").alias("n_both"))
    both = found.withColumns({"_all": exact.select("n_left").scalar(), "_some": exact.select("n_both").scalar()})
    near = lambda estimate, true: F.abs(F.col(estimate) - true) <= sketches.SIGMAS * sketches.set_error() * F.col("_all")
    return both.select(
        F.col("_all").alias("n_bronze"), F.col("_some").alias("n_silver"), near("n_left", F.col("_all")).alias("bronze_within"),
        near("n_right", F.col("_some")).alias("silver_within"), near("n_both", F.col("_some")).alias("both_within"),
        near("n_left_only", F.col("_all") - F.col("_some")).alias("lost_within"),
    )


@query
def a14_duplicates(spark, sf):
    """Surplus rows of order lines by order (many) and by line (none): the first is decided by sketches, the second is counted."""
    lines = d.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("policy"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), (F.col("l_orderkey") % 3).alias("batch")
    )
    out = None
    for key in ("policy", "line"):
        kept = written(sketches.key_sketch(lines, key, "batch"), key)
        row = sketches.duplicates(lines, key, kept).select(F.lit(key).alias("key"), "passed")
        out = row if out is None else out.unionByName(row)
    return out


# The whole round trip ------------------------------------------------------------------------------


def _euros(column: str):
    return F.coalesce(F.round(F.col(column) * 100).cast("bigint").cast("string"), F.lit("-"))


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit("-"))


def content(*columns):
    """A sum over the rows that their order does not change: 24 bits of a digest of each."""
    return F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 6), 16, 10).cast("bigint"))


CONTENT = {
    "bronze.claims": (("claim_id", "policy_id", "client_id", "statut", "type_sinistre", "description", "date_sinistre", "batch_id"), ("montant_declare", "montant_indemnise")),
    "bronze.policies": (("policy_id", "garantie_code", "produit", "garantie_incluse"), ("prime_annuelle", "garantie_plafond")),
    "bronze.clients": (("client_id", "client_type", "nom", "segment", "date_creation"), ()),
    "bronze.payments": (("payment_id", "client_id", "statut", "date_paiement"), ()),
    "dead_letter_queue.claims": (("claim_id", "statut", "type_sinistre"), ("montant_declare",)),
    "silver.claims": (("claim_id", "statut", "type_sinistre", "date_sinistre", "delai_declaration_jours", "annee_sinistre", "mois_sinistre", "produit"), ("montant_provision",)),
    "silver.policies": (("policy_id", "garantie_code", "date_souscription"), ("prime_mensuelle",)),
    "silver.clients": (("client_id", "region_code"), ()),
    "gold.portfolio_kpis": (("produit", "region_code", "canal_vente", "annee", "trimestre", "nb_polices", "nb_sinistres"), ("earned_premium", "incurred_losses")),
    "gold.earned_premium": (("policy_id", "annee"), ("earned_premium",)),
    "gold.fraud_assessment": (("claim_id", "produit", "date_sinistre", "flag_early_claim", "flag_late_declaration"), ("montant_declare",)),
    "gold.loss_ratio": (("produit", "trimestre"), ()),
    "gold.churn_scores": (("client_id", "segment"), ()),
    "gold.claims_aging_detail": (("claim_id", "delai_traitement_jours", "aging_bucket"), ()),
    "gold.claims_aging_summary": (("type_sinistre", "aging_bucket", "statut", "annee", "produit", "nb_sinistres"), ()),
    "gold.portfolio_exposure": (("region_code", "produit", "canal_vente", "nb_polices", "nom"), ("prime_totale",)),
    "gold.concentration_risk": (("produit",), ("prime_totale_produit",)),
}


@query
def s_k_roundtrip(spark, sf):
    """Raw files through all jobs, the ingestion repeated: rows and content of all tables."""
    lake = whole_lake(spark, sf)
    return reports.table_metrics({
        name: (lake.read(spark, *name.split(".")), {"content": content(*[_text(c) for c in texts], *[_euros(c) for c in amounts])})
        for name, (texts, amounts) in CONTENT.items()
    })
