"""Insurance entities as views of TPC-H-like tables, so that every operator runs on those tables.

Amounts are taken through whole cents and codes through integer arithmetic, so that any engine computes
the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from premia.entities import CHANNELS, CLAIM_TYPES, CLIENT_TYPES, PRODUCTS
from premia.functions import cents
from premia.operators.clean import declaration_delay, with_period
from premia.operators.dedup import latest_per_key
from premia.operators.enrich import POLICY_COLUMNS, with_client, with_policy

# Observation window of earned premium and reference day of the driver tables.
WINDOW = ("1996-01-01", "2000-12-31")
AS_OF_DAY = "2002-01-01"


def as_of() -> Column:
    return F.lit(AS_OF_DAY).cast("date")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def pick(values: tuple, index: Column) -> Column:
    """Element of a code list by a zero-based index."""
    return F.element_at(F.split(F.lit(",".join(values)), ","), (index + 1).cast("int"))


def _customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _customer_region(spark, sf_dir).select(
        key.alias("client_id"),
        pick(CLIENT_TYPES, key % 3).alias("client_type"),
        F.col("c_name").alias("nom"),
        F.lower("c_mktsegment").alias("segment"),
        F.col("n_regionkey").cast("string").alias("region_code"),
        F.floor(key / 2).cast("string").alias("adresse"),
        F.date_add(F.lit("1990-01-01").cast("date"), ((key * 37) % 3650).cast("int")).alias("date_creation"),
        pick(CHANNELS, key % 5).alias("canal_acquisition"),
        (key % 10 != 0).alias("actif"),
    )


def policies(spark: SparkSession, sf_dir: str, region: bool = True) -> DataFrame:
    """Orders as policies. ``region`` is the one column that needs the customers."""
    key, price = F.col("o_orderkey"), cents("o_totalprice")
    start = F.col("o_orderdate").cast("date")
    status = F.when(F.col("o_orderstatus") == "O", "actif").when(F.col("o_orderstatus") == "F", "resilié")
    orders = table(spark, sf_dir, "orders")
    if region:
        home = _customer_region(spark, sf_dir).select("c_custkey", F.col("n_regionkey").cast("string").alias("region_code"))
        orders = orders.join(home, F.col("o_custkey") == F.col("c_custkey"), "left")
    return orders.select(
        key.alias("policy_id"),
        F.col("o_custkey").alias("client_id"),
        pick(PRODUCTS, F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("produit"),
        start.alias("date_souscription"),
        F.date_add(start, (365 * (1 + key % 5)).cast("int")).alias("date_echeance"),
        (F.floor(price / 2) / 100.0).alias("prime_annuelle"),
        F.when(key % 4 != 0, F.floor(price / 24) / 100.0).alias("prime_mensuelle"),
        pick(CHANNELS, key % 5).alias("canal_vente"),
        status.otherwise("suspendu").alias("statut"),
        *(["region_code"] if region else []),
        F.when(key % 6 != 0, (key % 4) * 100.0).alias("franchise"),
        (price / 10.0).alias("plafond_garantie"),
    )


def lineitems(spark: SparkSession, sf_dir: str, of_orders: bool | None = None, wanted: Sequence[str] | None = None) -> DataFrame:
    """One row per order line: the latest shipment, ties by the columns that claims use.

    With ``of_orders`` only the lines of an order, dealt by it, so that this aggregate, a join with the order and all readers in a query share one shuffle of
    the lines. A task then holds whole orders. With False only the lines without one. Columns behind the last one ``wanted`` are not read.
    """
    used = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
    )
    if of_orders is not None:
        used = used.filter("l_orderkey IS NOT NULL").repartition("l_orderkey") if of_orders else used.filter("l_orderkey IS NULL")
    return latest_per_key(used, ["l_orderkey", "l_linenumber"], ["l_shipdate"], wanted)


#: Columns of an order line behind those of a claim that dates and the declared amount are made of.
DECLARED = ("l_shipdate", "l_partkey", "l_extendedprice")


def claim_lines(spark: SparkSession, sf_dir: str, of_orders: bool | None = None, declared: bool = False) -> DataFrame:
    """Claims without their client and region, which the order line does not carry. With ``declared`` only what is known at the declaration: keys, the two
    first dates and the declared amount."""
    price = cents("l_extendedprice")
    event = F.col("l_shipdate").cast("date")
    declared_on = F.date_add(event, (F.col("l_partkey") % 300 - 10).cast("int"))
    code = F.concat("l_returnflag", "l_linestatus")
    discount = F.round(F.col("l_discount") * 100).cast("bigint")
    keys = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim_id"), F.col("l_orderkey").alias("policy_id")
    if declared:
        amount = F.col("l_extendedprice").alias("montant_declare")
        return lineitems(spark, sf_dir, of_orders, DECLARED).select(*keys, event.alias("date_sinistre"), declared_on.alias("date_declaration"), amount)
    return lineitems(spark, sf_dir, of_orders).select(
        *keys,
        pick(CLAIM_TYPES, F.col("l_partkey") % 12).alias("type_sinistre"),
        event.alias("date_sinistre"),
        declared_on.alias("date_declaration"),
        F.when(F.col("l_suppkey") % 3 != 0, F.date_add(declared_on, (F.col("l_suppkey") % 180).cast("int"))).alias("date_cloture"),
        F.col("l_extendedprice").alias("montant_declare"),
        (F.floor(price * 8 / 10) / 100.0).alias("montant_provision"),
        (F.floor(price * (100 - discount) / 100) / 100.0).alias("montant_indemnise"),
        F.when(code == "NF", "refuse")
        .when(code.isin("RF", "RO"), "clos")
        .when(code == "AO", "ouvert")
        .when(code == "AF", "en_cours")
        .otherwise("en_litige")
        .alias("statut"),
    )


def _joined(
    spark: SparkSession, sf_dir: str, join: Callable[[DataFrame], DataFrame], prepare: Callable[[DataFrame], DataFrame] = lambda lines: lines,
    declared: bool = False,
) -> DataFrame:
    """Prepared claims, joined with their orders where their lines were dealt by order. Lines without an order match none: they are added with nulls, so that
    they do not meet in one task."""
    of_orders, others = (prepare(claim_lines(spark, sf_dir, of, declared)) for of in (True, False))
    return join(of_orders).unionByName(others, allowMissingColumns=True)


def client_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with the client of their order."""
    owner = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("policy_id"), F.col("o_custkey").alias("client_id"))
    return _joined(spark, sf_dir, lambda lines: lines.join(owner, "policy_id", "left"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with client and region."""
    owner = policies(spark, sf_dir).select("policy_id", "client_id", "region_code")
    return _joined(spark, sf_dir, lambda lines: lines.join(owner, "policy_id", "left"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("payment_id"),
        F.col("user_id").alias("client_id"),
        F.col("ts").cast("date").alias("date_paiement"),
        F.col("value").alias("montant"),
        F.when(kind == "purchase", "paye")
        .when(kind == "error", "impaye")
        .when(kind == "signup", "rembourse")
        .otherwise("en_cours")
        .alias("statut"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("code"), F.initcap("r_name").alias("nom")
    )


def timed(claims: DataFrame) -> DataFrame:
    """Claims with declaration delay and period columns."""
    return with_period(declaration_delay(claims))


def insured_claims(spark: SparkSession, sf_dir: str, region: bool = True, declared: bool = False) -> DataFrame:
    """Claims with delay, period, client, region and the columns of their policy: one join serves both. ``declared`` as in ``claim_lines``."""
    book = policies(spark, sf_dir, region)
    columns = (*POLICY_COLUMNS, "client_id", "region_code") if region else (*POLICY_COLUMNS, "client_id")
    joined = _joined(spark, sf_dir, lambda lines: with_policy(lines, book, columns, dealt=True), timed, declared)
    return joined.withColumn("has_valid_policy", F.col("produit").isNotNull())


def silver_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with delay, period, policy and client columns."""
    return with_client(insured_claims(spark, sf_dir), clients(spark, sf_dir))
