"""The entities as the raw files that the jobs read, and a lake made from them by all jobs."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.entities import CLAIMS_RAW
from premia.settings import FraudSettings, QualitySettings
from premia.sources import driver_tables as d
from premia.sources import readers, sinks

# Thresholds under which both outcomes of every rule occur on the driver tables.
FRAUD = FraudSettings(high_amount_stddev=1.5, frequent_claimant_count=8)
QUALITY = QualitySettings(claim_date_min="1996-01-01", claim_date_max="2001-12-31")
NOW = datetime(2002, 1, 1)


def messy(spark, sf):
    """Claims as a careless source would send them: padded upper-case codes, missing values, amounts as
    text that is sometimes no number."""
    status, kind = F.col("statut"), F.col("type_sinistre")
    number = F.format_string("%.2f", F.col("montant_declare"))
    return d.claims(spark, sf).select(
        F.concat(F.lit(" "), F.col("claim_id").cast("string"), F.lit(" ")).alias("claim_id"),
        F.col("policy_id").cast("string").alias("policy_id"),
        F.col("client_id").cast("string").alias("client_id"),
        F.when(kind != "vol", F.concat(F.lit("  "), F.upper(status), F.lit(" "))).alias("statut"),
        F.when(status != "refuse", F.upper(kind)).alias("type_sinistre"),
        F.when(kind == "deces", "n/a").when(kind == "optique", "NaN").when(kind == "incendie", "0").otherwise(number).alias("montant_declare"),
        F.when(kind != "dentaire", number).alias("montant_provision"),
        F.when(status == "clos", number).alias("montant_indemnise"),
        "region_code",
        F.col("date_sinistre").cast("string").alias("date_sinistre"),
        F.col("date_declaration").cast("string").alias("date_declaration"),
        F.when(kind == "bris_glace", F.lit(None)).otherwise(F.concat(F.lit(" "), kind)).alias("description"),
        F.when(status == "ouvert", "true").when(status == "clos", "maybe").otherwise("false").alias("is_fraud_injected"),
    )


def coverages(spark, sf):
    """Policies with none to three coverages each."""
    number = F.col("policy_id") % 4
    covers = F.transform(
        F.sequence(F.lit(1).cast("bigint"), number),
        lambda i: F.struct(
            F.concat(F.lit("C"), i.cast("string")).alias("code"),
            (F.col("prime_annuelle") * i).alias("plafond"),
            (i % 2 == 1).alias("incluse"),
        ),
    )
    return d.policies(spark, sf).withColumn("garanties", F.when(number > 0, covers))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares; a temporary one only where none is set and all tasks run on this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{shared}/premia-{datetime.now():%Y%m%d%H%M%S%f}" if shared else tempfile.mkdtemp(prefix="premia-")


#: Text files are compressed, quickly, and hold a bounded number of records, as such a file is read by one task: some 10 to 50 MB of text.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 125_000}


def write_raw_files(spark: SparkSession, sf: str, root: str) -> dict[str, str]:
    """The entities as the raw files the jobs read: CSV, JSON Lines, Parquet. Texts are compressed."""
    with sinks.session_settings(spark, sinks.TIDY):
        return _write_raw_files(spark, sf, root)


def _write_raw_files(spark: SparkSession, sf: str, root: str) -> dict[str, str]:
    paths = {n: f"{root}/raw/{n}" for n in ("claims", "policies", "clients", "payments", "regions")}
    claims = messy(spark, sf).withColumns({"date_cloture": F.lit(None).cast("string"), "fraud_rule_injected": F.lit(None).cast("string")})
    claims.write.options(**PACKED).csv(paths["claims"], header=True, escape='"')
    policies = coverages(spark, sf)
    text = ("policy_id", "client_id", "date_souscription", "date_echeance")
    policies.withColumns({c: F.col(c).cast("string") for c in text}).write.options(**PACKED).json(paths["policies"])
    clients = d.clients(spark, sf)
    clients.withColumn("client_id", F.col("client_id").cast("string")).write.parquet(paths["clients"])
    payments = d.payments(spark, sf).withColumns(
        {c: F.lit(None).cast("string") for c in ("claim_id", "policy_id", "devise", "mode_paiement", "reference_banque", "motif_impaye")}
    )
    order = [f.name for f in readers.PAYMENTS_RAW.fields]
    payments.select(order).write.options(**PACKED).csv(paths["payments"], header=True)
    regions = d.regions(spark, sf).withColumns({"population": F.lit("1"), "densite": F.lit("1")})
    regions.write.csv(paths["regions"], header=True)
    return paths


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written below the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_lines(lines: DataFrame, header: Sequence[str], path: str) -> None:
    """Text lines as CSV files, each with the given header, without any quoting."""
    lines.toDF(",".join(header)).write.option("sep", "\u0001").option("quote", "\u0002").csv(path, header=True)


def write_mixed_claims(spark: SparkSession, sf: str, root: str) -> str:
    """Claims in files of two layouts, one with an own column, and lines that break off after two fields."""
    money = F.format_string("%.2f", F.col("montant_declare"))
    rows = d.claims(spark, sf).select(
        *[F.col(c).cast("string").alias(c) for c in ("claim_id", "policy_id", "client_id", "type_sinistre", "date_sinistre", "date_declaration")],
        money.alias("montant_declare"), "statut", "region_code", F.col("claim_id").alias("_n"), F.col("policy_id").alias("_p"),
    )
    plain = CLAIMS_RAW.names
    turned = ["remarque", *reversed(plain)]
    fields = {c: F.coalesce(F.col(c) if c in rows.columns else F.lit(""), F.lit("")) for c in plain}
    whole = rows.filter("_n % 3 <> 0").select(F.concat_ws(",", *fields.values()).alias("line"))
    broken = rows.filter("_p % 50 = 0").select(F.concat_ws(",", "claim_id", "policy_id").alias("line"))
    write_lines(whole.unionAll(broken), plain, f"{root}/mixed/a")
    fields["remarque"] = F.concat(F.lit("r"), "claim_id")
    write_lines(rows.filter("_n % 3 = 0").select(F.concat_ws(",", *[fields[c] for c in turned])), turned, f"{root}/mixed/b")
    return f"{root}/mixed/*"


def write_odd_policies(spark: SparkSession, sf: str, root: str) -> str:
    """Policies as JSON lines with a field that the schema lacks; some break off, some have text where a number belongs."""
    key, price = F.col("policy_id"), F.floor("prime_annuelle").cast("string")

    def text(name: str, value) -> list:
        return [F.lit(f'"{name}":"'), value, F.lit('",')]

    parts = [F.lit("{")]
    for c in ("policy_id", "client_id", "produit", "date_souscription", "date_echeance", "canal_vente", "statut"):
        parts += text(c, F.col(c).cast("string"))
    parts += [F.lit('"prime_annuelle":'), F.when(key % 11 == 0, F.lit('"abc"')).otherwise(price)]
    parts += [F.lit(',"franchise":'), F.when(key % 13 == 0, F.lit('"n/a"')).otherwise((key % 4).cast("string"))]
    parts += [F.lit(',"garanties":[{"code":"C1","plafond":'), price, F.lit('}],"origine":"web"'), F.when(key % 7 == 0, F.lit("")).otherwise(F.lit("}"))]
    d.policies(spark, sf, region=False).select(F.concat(*parts).alias("value")).write.text(f"{root}/odd")
    return f"{root}/odd"
