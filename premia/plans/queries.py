"""Every operator as a query over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.entities import CLAIM_TYPES, PRODUCTS
from premia.functions import exact_quantile, money_avg, money_sum
from premia.operators import aging, churn, clean, dedup, enrich, expectations, exposure, fraud, kpis, premium, privacy
from premia.operators import reports, validate
from premia.plans.job_queries import JOB_QUERIES
from premia.plans.raw_files import FRAUD, NOW, QUALITY, coverages, messy, written
from premia.sources import driver_tables as d
from premia.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Composed inputs -----------------------------------------------------------------------------------


def _premiums(spark, sf):
    return premium.earned_premium(d.policies(spark, sf), d.WINDOW)


def _losses(spark, sf):
    return premium.incurred_loss(d.insured_claims(spark, sf))


def _kpis(spark, sf):
    return kpis.portfolio_kpis(_losses(spark, sf), _premiums(spark, sf))


def _quarterly(spark, sf):
    return kpis.join_kpis(kpis.premium_kpis(_premiums(spark, sf)), kpis.claims_kpis(_losses(spark, sf)))


#: Columns of insured claims that the fraud rules read.
ASSESSED = ("claim_id", "policy_id", "client_id", "produit", "date_sinistre", "date_souscription", "montant_declare", "delai_declaration_jours")


def _assessed(spark, sf, *more, shared=False):
    """Insured claims as the fraud rules read them. The rules read them several times, from the same shuffles of lines and policies. ``shared``
    keeps all columns in the shuffle of the lines, so that a reader of other claims in the query shares it."""
    return d.insured_claims(spark, sf, region=False, declared=not more and not shared).select(*ASSESSED, *more)


def _assess(spark, sf, claims):
    return fraud.assess(claims, d.policies(spark, sf, region=False), d.clients(spark, sf), FRAUD)


def _fraud(spark, sf, shared=False):
    return _assess(spark, sf, _assessed(spark, sf, shared=shared))


def _churn(spark, sf):
    return churn.churn_scores(
        d.clients(spark, sf), d.policies(spark, sf, region=False), d.client_claims(spark, sf), d.payments(spark, sf), d.as_of()
    )


def _named(spark, sf):
    """Silver claims with region name."""
    return enrich.attach_label(d.insured_claims(spark, sf), d.regions(spark, sf))


def _claims_named(spark, sf):
    """Claims with region name, without policy and client columns."""
    return enrich.attach_label(d.timed(d.claims(spark, sf)), d.regions(spark, sf))


def _flat_coverages(spark, sf):
    return clean.explode_struct(coverages(spark, sf), "garanties", "garantie", ("code", "plafond", "incluse"))


# Keys, cleaning, dates -----------------------------------------------------------------------------


@query
def w1_dedup_latest(spark, sf):
    rows = d.table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return dedup.latest_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def j8_one_per_key(spark, sf):
    return enrich.one_policy_per_id(_flat_coverages(spark, sf)).select("policy_id", "client_id", "produit", "prime_annuelle")


@query
def p1_normalise_codes(spark, sf):
    return clean.clean_claims(clean.cast_claims(messy(spark, sf))).drop("date_sinistre", "date_declaration")


@query
def p2_explode_outer(spark, sf):
    flat = _flat_coverages(spark, sf).withColumn("garantie_libelle", F.lit(None).cast("string"))
    return clean.normalise_policies(flat).select(
        "policy_id", "produit", "franchise", "garantie_code", "garantie_libelle", "garantie_plafond", "garantie_incluse"
    )


@query
def p5_clean_policies(spark, sf):
    return clean.clean_policies(d.policies(spark, sf, region=False)).select(
        "policy_id", "statut", "produit", "prime_annuelle", "prime_mensuelle", "franchise"
    )


@query
def p6_parse_dates(spark, sf):
    day, style = F.col("date_sinistre"), F.col("claim_id") % 6
    text = F.when(style == 5, F.lit("junk"))
    for i, fmt in enumerate(("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")):
        text = text.when(style == i, F.date_format(day, fmt))
    rendered = d.claim_lines(spark, sf).select("claim_id", text.alias("date_texte"))
    return clean.parse_dates(rendered.withColumn("date_sinistre", F.col("date_texte")), ["date_sinistre", "absente"])


@query
def p7_declaration_delay(spark, sf):
    return clean.declaration_delay(d.claim_lines(spark, sf)).select("claim_id", "delai_declaration_jours")


@query
def p8_period_columns(spark, sf):
    return clean.with_period(d.claim_lines(spark, sf)).select("claim_id", "annee_sinistre", "mois_sinistre", "trimestre")


@query
def p11_incurred_loss(spark, sf):
    return premium.incurred_loss(d.claim_lines(spark, sf)).select("claim_id", "statut", "incurred_loss")


@query
def p12_earned_premium(spark, sf):
    return _premiums(spark, sf).select(
        "policy_id", "produit", "days_covered", "earned_premium", "annee", "trimestre", "region_code", "canal_vente"
    )


@query
def p12_earned_by_quarter(spark, sf):
    return premium.earned_premium_by_quarter(d.policies(spark, sf), d.WINDOW).select(
        "policy_id", "annee", "trimestre", "days_covered", "earned_premium"
    )


@query
def p16_processing_delay(spark, sf):
    return clean.processing_delay(d.claim_lines(spark, sf), d.as_of()).select("claim_id", "delai_traitement_jours")


@query
def p17_aging_bucket(spark, sf):
    return clean.processing_delay(d.claim_lines(spark, sf), d.as_of()).select(
        "claim_id", clean.aging_bucket().alias("aging_bucket"), clean.aging_order().alias("bucket_order")
    )


# Validation ----------------------------------------------------------------------------------------


def _split(spark, sf):
    return validate.split_rows(clean.cast_claims(messy(spark, sf)), validate.rules_for("claims"), "b1", NOW)


@query
def v5_valid_rows(spark, sf):
    return _split(spark, sf)[0].select("claim_id", "statut", "type_sinistre", "montant_declare")


@query
def v5_rejected_rows(spark, sf):
    rules = F.array_join(F.array_sort("_rejection_rules"), ",").alias("rules")
    return _split(spark, sf)[1].select("claim_id", rules, "_rejection_reason", "_batch_id")


@query
def v9_volumetry(spark, sf):
    return validate.volumetry(clean.cast_claims(messy(spark, sf)), validate.rules_for("claims"))


# Joins ---------------------------------------------------------------------------------------------


@query
def j1_enriched_claims(spark, sf):
    """Against policies subscribed by the end of the window and active clients, so that orphans occur."""
    book = d.policies(spark, sf, region=False).filter(F.col("date_souscription") <= d.WINDOW[1])
    known = d.clients(spark, sf).filter("actif")
    return enrich.enrich_claims(d.client_claims(spark, sf), book, known).select(
        "claim_id", "policy_id", "client_id", "produit", "canal_vente", "statut_police", "prime_annuelle",
        "client_type", "segment", "client_actif", "has_valid_policy", "has_valid_client",
    )


@query
def j10_region_label(spark, sf):
    return enrich.attach_label(d.clients(spark, sf), d.regions(spark, sf)).select("client_id", "region_code", "region_nom")


@query
def j12_orphans(spark, sf):
    return enrich.orphans(d.client_claims(spark, sf), exposure.active_policies(d.policies(spark, sf, region=False)), "policy_id").select(
        "claim_id", "policy_id"
    )


@query
def j13_semi_filter(spark, sf):
    late = fraud.flag_late(d.timed(d.claims(spark, sf)), FRAUD.late_declaration_days).select("claim_id", "flag_late_declaration")
    chosen = reports.slice_claims(_named(spark, sf), ("auto", "vie"), ("clos", "refuse"), (1997, 1999), ("0", "1", "2"))
    return reports.with_claim_region(reports.fraud_in_slice(late, chosen), chosen)


# Indicators ----------------------------------------------------------------------------------------


@query
def a1_claims_kpis(spark, sf):
    return kpis.claims_kpis(_losses(spark, sf))


@query
def a2_premium_kpis(spark, sf):
    return kpis.premium_kpis(_premiums(spark, sf))


@query
def a3_amount_statistics(spark, sf):
    return d.insured_claims(spark, sf, region=False).groupBy("produit").agg(
        F.round(money_avg("montant_declare"), 4).alias("mean_montant"),
        F.round(F.stddev_samp("montant_declare"), 4).alias("std_montant"),
    )


@query
def g2_portfolio_kpis(spark, sf):
    return _kpis(spark, sf)


@query
def g3_loss_ratio(spark, sf):
    return kpis.loss_ratio_view(_quarterly(spark, sf))


@query
def w3_rolling_calendar(spark, sf):
    measures = {"rolling_12m_incurred": "incurred_losses", "rolling_12m_premium": "earned_premium"}
    return kpis.rolling(_quarterly(spark, sf), measures, calendar=True).select(
        "produit", "region_code", "canal_vente", "annee", "trimestre", *measures
    )


@query
def j7_occurrence_period(spark, sf):
    """Loss ratio with the premium of the same quarter under the losses."""
    earned = premium.earned_premium_by_quarter(d.policies(spark, sf), d.WINDOW)
    joined = kpis.join_kpis(kpis.premium_kpis(earned), kpis.claims_kpis(_losses(spark, sf)))
    return joined.select(
        "produit", "region_code", "canal_vente", "annee", "trimestre", "earned_premium", "incurred_losses", "loss_ratio"
    )


# Fraud ---------------------------------------------------------------------------------------------


@query
def r1_early_claim(spark, sf):
    return fraud.flag_early(d.claim_lines(spark, sf), d.policies(spark, sf, region=False), FRAUD.early_claim_hours).select(
        "claim_id", "date_souscription", "flag_early_claim"
    )


@query
def r2_high_amount(spark, sf):
    return fraud.flag_high_amount(d.insured_claims(spark, sf, region=False), FRAUD.high_amount_stddev).select("claim_id", "flag_high_amount")


@query
def r3_frequent_claimant(spark, sf):
    return fraud.flag_frequent(d.client_claims(spark, sf), FRAUD.frequent_claimant_count, FRAUD.frequent_claimant_window).select(
        "claim_id", "flag_frequent_claimant"
    )


@query
def r4_address_cluster(spark, sf):
    return fraud.flag_cluster(_assessed(spark, sf), d.clients(spark, sf), FRAUD.address_cluster_days).select(
        "claim_id", "flag_address_cluster"
    )


@query
def r5_late_declaration(spark, sf):
    return fraud.flag_late(d.timed(d.claim_lines(spark, sf)), FRAUD.late_declaration_days).select("claim_id", "flag_late_declaration")


@query
def r6_fraud_score(spark, sf):
    return _fraud(spark, sf).withColumn("fraud_flags", F.array_join("fraud_flags", ","))


@query
def r7_suspects_by_product(spark, sf):
    return _fraud(spark, sf).groupBy("produit").agg(
        F.count("*").alias("nb"), F.count_if("is_fraud_suspected").alias("nb_suspects")
    )


# Churn ---------------------------------------------------------------------------------------------


@query
def c1_seniority(spark, sf):
    return churn.measured(d.clients(spark, sf), d.as_of()).select("client_id", "anciennete_annees", "score_seniority_inverse")


@query
def c2_unpaid(spark, sf):
    unpaid = churn.event_share(d.payments(spark, sf), "impaye")
    return churn.measured(d.clients(spark, sf), d.as_of(), unpaid=unpaid).select("client_id", "score_unpaid", "nb_impayes")


@query
def c3_refused(spark, sf):
    refused = churn.event_share(d.client_claims(spark, sf), "refuse")
    return churn.measured(d.clients(spark, sf), d.as_of(), refused=refused).select("client_id", "score_refused", "nb_refuses")


@query
def c4_mono_contract(spark, sf):
    contracts = churn.active_contracts(d.policies(spark, sf, region=False))
    return churn.measured(d.clients(spark, sf), d.as_of(), contracts=contracts).select("client_id", "nb_contrats", "score_mono_contract")


@query
def c5_churn_scores(spark, sf):
    return _churn(spark, sf)


# Exposure and aging --------------------------------------------------------------------------------


@query
def a7_exposure(spark, sf):
    return exposure.exposure(exposure.active_policies(d.policies(spark, sf)))


@query
def a8_concentration(spark, sf):
    return exposure.concentration(exposure.active_policies(d.policies(spark, sf, region=False))).withColumn(
        "hhi_component", F.round("hhi_component", 6)
    )


@query
def a10_hhi(spark, sf):
    return exposure.hhi(d.policies(spark, sf), "prime_annuelle", "region_code")


@query
def a10_hhi_on_rows(spark, sf):
    return exposure.with_hhi(d.policies(spark, sf, region=False), "prime_annuelle", "canal_vente").select("policy_id", "hhi_prime_annuelle")


@query
def a11_claims_by_region(spark, sf):
    return exposure.claims_by_region(d.claims(spark, sf))


@query
def g5_portfolio_exposure(spark, sf):
    regions = d.regions(spark, sf).withColumns({"population": F.length("nom"), "densite": F.ascii("nom")})
    return exposure.portfolio_exposure(d.policies(spark, sf), d.claims(spark, sf), regions)


@query
def g4_aging_detail(spark, sf):
    return aging.aging_detail(d.timed(d.claim_lines(spark, sf)), d.as_of()).select(
        "claim_id", "type_sinistre", "statut", "annee", "delai_traitement_jours", "aging_bucket"
    )


@query
def g4_aging_summary(spark, sf):
    return aging.aging_summary(aging.aging_detail(d.insured_claims(spark, sf, region=False), d.as_of()))


@query
def a12_exact_quantiles(spark, sf):
    detail = aging.aging_detail(d.timed(d.claim_lines(spark, sf)), d.as_of())
    out = aging.aging_summary(detail, ("type_sinistre", "aging_bucket"), exact=True)
    return out.withColumns({c: F.round(c, 6) for c in ("delai_median_jours", "delai_p90_jours")})


# Data quality --------------------------------------------------------------------------------------


@query
def q_bronze_suite(spark, sf):
    stamped = sinks.with_ingestion_metadata(d.claims(spark, sf), "driver", "b1", "lineitem.parquet", NOW)
    return expectations.bronze_suite(stamped, d.policies(spark, sf), QUALITY)


@query
def q_silver_suite(spark, sf):
    return expectations.silver_suite(
        d.insured_claims(spark, sf), d.policies(spark, sf), d.clients(spark, sf), _quarterly(spark, sf), d.as_of()
    )


@query
def q_gold_suite(spark, sf):
    out = expectations.gold_suite(
        _premiums(spark, sf), _quarterly(spark, sf), _fraud(spark, sf, shared=True), _churn(spark, sf), d.policies(spark, sf)
    )
    return out.withColumn("observed", F.round("observed", 9))


@query
def q21_declarative(spark, sf):
    text_dates = d.claims(spark, sf).withColumn("date_sinistre", F.col("date_sinistre").cast("string"))
    return expectations.run_suite(text_dates, expectations.declared_checks(expectations.CLAIMS_SUITE))


@query
def q23_anomalies(spark, sf):
    raw_delay = clean.day_gap(
        d.insured_claims(spark, sf, region=False), "date_sinistre", "date_declaration", "delai_declaration_jours", negative="keep"
    )
    return expectations.anomalies(raw_delay)


# Monitoring ----------------------------------------------------------------------------------------


@query
def m1_null_rates(spark, sf):
    bronze, silver, gold = clean.cast_claims(messy(spark, sf)), d.timed(d.claims(spark, sf)), _fraud(spark, sf, shared=True)
    return reports.null_rates(
        {
            ("bronze", "claims"): (bronze, ("claim_id", "policy_id", "client_id", "montant_declare", "statut")),
            ("silver", "claims"): (silver, ("claim_id", "date_sinistre", "date_cloture", "delai_declaration_jours")),
            ("gold", "fraud_assessment"): (gold, ("claim_id", "fraud_score")),
            ("gold", "absent"): (None, ("claim_id",)),
        }
    )


@query
def m1_duplicates(spark, sf):
    lines = d.table(spark, sf, "lineitem").withColumn("claim_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return reports.duplicate_counts(
        {
            "bronze/claims": (lines, "claim_id"),
            "silver/claims": (d.claims(spark, sf), "claim_id"),
            "silver/clients": (d.clients(spark, sf), "client_id"),
        }
    )


@query
def m2_score_bands(spark, sf):
    return reports.score_bands(_fraud(spark, sf))


@query
def m2_named_bands(spark, sf):
    return reports.named_bands(_fraud(spark, sf))


@query
def m3_indemnification(spark, sf):
    return reports.indemnification(d.insured_claims(spark, sf, region=False))


@query
def m4_table_metrics(spark, sf):
    suspects = F.count_if("is_fraud_suspected")
    segments = {f"churn_{s}": F.count_if(F.col("churn_segment") == s) for s in ("faible", "moyen", "élevé", "critique")}
    fraud_extras = {
        "fraud_suspected_count": suspects,
        "fraud_rate_pct": F.round(suspects / F.greatest(F.count("*"), F.lit(1)) * 100, 4),
    }
    return reports.table_metrics(
        {
            "silver_claims": (d.claims(spark, sf), {"injected_fraud_count": F.count_if(F.col("statut") == "refuse")}),
            "silver_clients": (d.clients(spark, sf), {}),
            "silver_policies": (d.policies(spark, sf), {}),
            "gold_portfolio_kpis": (_quarterly(spark, sf), {}),
            "gold_fraud_assessment": (_fraud(spark, sf, shared=True), fraud_extras),
            "gold_churn_scores": (_churn(spark, sf), segments),
            "gold_absent": (None, {}),
        }
    )


def _steps(spark, sf):
    """Events as pipeline steps: one run per day."""
    return d.table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.col("event_type").alias("step"),
        F.col("value").alias("duration_sec"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("nb_out"),
        F.when(F.col("event_type") == "error", F.col("user_id")).alias("nb_rejected"),
    )


@query
def m5_step_summary(spark, sf):
    return reports.summarise_steps(_steps(spark, sf))


@query
def m6_latest_run(spark, sf):
    return reports.latest_run(reports.summarise_steps(_steps(spark, sf)))


@query
def m7_global_kpis(spark, sf):
    return reports.global_kpis(d.timed(d.claims(spark, sf)), d.policies(spark, sf), d.clients(spark, sf), _fraud(spark, sf, shared=True))


# Dashboard -----------------------------------------------------------------------------------------


@query
def b1_slice(spark, sf):
    chosen = reports.slice_claims(d.insured_claims(spark, sf), ("auto", "sante"), ("clos", "ouvert"), (1996, 1999), ("0", "2", "4"))
    return chosen.select("claim_id", "produit", "statut", "region_code", "date_sinistre")


@query
def b1_choices(spark, sf):
    return reports.choices(d.insured_claims(spark, sf, region=False), "produit")


@query
def b2_headline(spark, sf):
    silver = written(_assessed(spark, sf, "montant_indemnise"), "assessed")  # its readers filter by other columns and would shuffle the lines each
    chosen = reports.slice_claims(silver, years=(1996, 1999))
    return reports.headline(chosen, reports.fraud_in_slice(_assess(spark, sf, silver), chosen), silver)


@query
def b3_frequency_status(spark, sf):
    return reports.frequency(d.claim_lines(spark, sf), "statut")


@query
def b4_claims_by_region(spark, sf):
    measures = {"nb": F.count("*"), "avg_amount": money_avg("montant_declare")}
    return reports.by_group(_claims_named(spark, sf), ["region_nom"], measures, "nb", descending=False)


@query
def b5_monthly_trend(spark, sf):
    return reports.trend(d.claim_lines(spark, sf))


@query
def b6_score_histogram(spark, sf):
    return reports.score_histogram(_fraud(spark, sf))


@query
def b7_rate_by_product(spark, sf):
    return reports.rate_by(_fraud(spark, sf), "produit", F.col("is_fraud_suspected"))


@query
def b8_score_by_region(spark, sf):
    assessed = written(_assessed(spark, sf), "assessed")  # the join by claim filters one of its readers, which would shuffle the lines once more
    scored = reports.with_claim_region(_assess(spark, sf, assessed), _claims_named(spark, sf))
    return reports.by_group(scored, ["region_nom"], {"avg_score": F.avg("fraud_score")}, "avg_score", descending=False)


@query
def b9_trigger_totals(spark, sf):
    return reports.trigger_totals(_fraud(spark, sf))


@query
def b10_paid_rate_by_product(spark, sf):
    return reports.paid_rate_by(d.insured_claims(spark, sf, region=False), ["produit"])


@query
def b11_amount_by_type(spark, sf):
    measures = {"avg_amount": money_avg("montant_declare"), "nb": F.count("claim_id")}
    return reports.by_group(d.claim_lines(spark, sf), ["type_sinistre"], measures, "avg_amount")


@query
def b12_loss_ratio_by_region(spark, sf):
    named = enrich.attach_label(_quarterly(spark, sf), d.regions(spark, sf))
    return reports.by_group(named, ["region_nom"], {"avg_lr": F.round(F.avg("loss_ratio"), 6)}, "avg_lr", descending=False)


@query
def b13_crosstab_product(spark, sf):
    return reports.crosstab(_named(spark, sf), "region_nom", "produit", PRODUCTS, F.count("claim_id"), fill=0)


@query
def b14_crosstab_type_amount(spark, sf):
    claims = _claims_named(spark, sf)
    return reports.crosstab(claims, "region_nom", "type_sinistre", CLAIM_TYPES, money_sum("montant_declare"), fill=0.0)


@query
def b14_crosstab_type_count(spark, sf):
    claims = _claims_named(spark, sf)
    return reports.crosstab(claims, "region_nom", "type_sinistre", CLAIM_TYPES, F.count("claim_id"), fill=0)


@query
def b15_crosstab_premium(spark, sf):
    return reports.crosstab(_named(spark, sf), "region_nom", "produit", PRODUCTS, money_sum("prime_annuelle"), fill=0.0)


@query
def b15_crosstab_paid_rate(spark, sf):
    rate = F.round(F.try_divide(money_sum("montant_indemnise"), money_sum("montant_declare")) * 100, 1)
    return reports.crosstab(_named(spark, sf), "region_nom", "produit", PRODUCTS, rate)


@query
def b16_histogram(spark, sf):
    """Sixty bins under the 99th percentile of the declared amount, by product."""
    amounts = written(d.insured_claims(spark, sf, region=False).select("produit", "montant_declare"), "amounts")  # read several times
    return reports.histogram(amounts, below=exact_quantile(amounts, "montant_declare", 0.99))


@query
def b17_kpi_listing(spark, sf):
    return reports.kpi_listing(_quarterly(spark, sf), d.regions(spark, sf))


@query
def b18_region_order(spark, sf):
    claims = _claims_named(spark, sf)
    return reports.by_group(claims, ["region_nom"], {"total_amount": money_sum("montant_declare")}, "total_amount", descending=False)


@query
def b19_dominant_type(spark, sf):
    return reports.dominant_type(_claims_named(spark, sf))


@query
def b20_churn_headline(spark, sf):
    return reports.churn_headline(_churn(spark, sf)).withColumn("avg_score", F.round("avg_score", 6))


@query
def b20_churn_by_segment(spark, sf):
    return reports.frequency(_churn(spark, sf), "churn_segment")


@query
def b20_score_by_client_segment(spark, sf):
    return reports.by_group(_churn(spark, sf), ["segment"], {"avg_score": F.round(F.avg("churn_score"), 6)}, "avg_score")


@query
def b21_critical_by_region(spark, sf):
    named = enrich.attach_label(_churn(spark, sf), d.regions(spark, sf))
    return reports.rate_by(named, "region_nom", F.col("churn_segment") == "critique", "pct_critical", descending=False)


@query
def b22_five_numbers(spark, sf):
    return reports.five_numbers(_churn(spark, sf)).withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query
def b_preview_exposure(spark, sf):
    """Twenty cells with the largest exposure: a top-k report."""
    return reports.preview(exposure.exposure(exposure.active_policies(d.policies(spark, sf))), "exposition_max", 20)


# Privacy and upkeep --------------------------------------------------------------------------------


@query
def x1_pseudonymise(spark, sf):
    named = d.clients(spark, sf).select("client_id", F.col("client_id").alias("pseudonym"), "segment")
    return privacy.pseudonymise(named, ["pseudonym"], b"a key that only a test may know")


@query
def x2_mask(spark, sf):
    return privacy.mask(d.claim_lines(spark, sf).select("claim_id", "statut", "montant_declare"), ["montant_declare"], "dev")


@query
def x3_erase(spark, sf):
    gone = d.clients(spark, sf).filter(~F.col("actif"))
    return privacy.erase(d.client_claims(spark, sf), gone).select("claim_id", "client_id")


@query
def x4_upsert(spark, sf):
    """Corrections: a refused claim is reopened with a later date."""
    current = d.claim_lines(spark, sf).select("claim_id", "statut", "montant_declare", "date_declaration")
    fixed = current.filter(F.col("statut") == "refuse").withColumns(
        {"statut": F.lit("ouvert"), "date_declaration": F.date_add("date_declaration", 30)}
    )
    return privacy.upsert(current, fixed, ["claim_id"], ["date_declaration"])


@query
def x5_retain(spark, sf):
    return privacy.retain(d.claim_lines(spark, sf), "date_sinistre", 5, d.as_of()).select("claim_id", "date_sinistre")


QUERIES |= JOB_QUERIES
