"""Claims and policies made from order lines and orders."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from premia.operators.dedup import latest_per_key
from premia.operators.enrich import one_policy_per_id
from premia.plans.queries import QUERIES
from premia.sources import driver_tables as d
from tests.conftest import rows

LINE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp"
)
ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Lines that come twice, have no order or an unknown one; orders that come twice or have no client."""
    rng, root, day = random.Random(3), str(tmp_path_factory.mktemp("tables")), datetime(1996, 5, 1)
    when = lambda: day + timedelta(rng.randrange(900))
    lines = [
        (None if rng.random() < 0.1 else rng.randrange(70), rng.randrange(99), rng.randrange(9), rng.randrange(1, 5), float(rng.randrange(9, 9999)), 0.05,
         rng.choice("RAN"), rng.choice("OF"), when())
        for _ in range(600)
    ]
    orders = [(i % 60, None if i % 13 == 0 else i % 20, rng.choice("OFP"), float(rng.randrange(9, 9999)), when(), f"{i % 5 + 1}-X") for i in range(66)]
    made = {
        "lineitem": spark.createDataFrame(lines, LINE), "orders": spark.createDataFrame(orders, ORDER),
        "customer": spark.range(19).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(0).alias("c_nationkey"), F.lit("S").alias("c_mktsegment")),
        "nation": spark.createDataFrame([(0, "N", 2)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_lines_without_an_order_keep_their_claims(spark, tables):
    lines = latest_per_key(d.table(spark, tables, "lineitem").drop("x"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    insured = d.insured_claims(spark, tables)
    assert insured.count() == lines.count() and insured.filter("policy_id IS NULL").count() == 4
    book = one_policy_per_id(d.policies(spark, tables)).select("policy_id", F.col("client_id").alias("k"), F.col("produit").alias("p"), F.col("region_code").alias("r"))
    want = d.timed(d.claim_lines(spark, tables)).join(book, "policy_id", "left").select("policy_id", "claim_id", "date_sinistre", "delai_declaration_jours", "k", "p", "r")
    found = insured.select("policy_id", "claim_id", "date_sinistre", "delai_declaration_jours", "client_id", "produit", "region_code")
    assert sorted(map(repr, rows(found))) == sorted(map(repr, rows(want)))
    assert insured.filter("has_valid_policy <> (produit IS NOT NULL) OR has_valid_policy IS NULL").isEmpty()
    # an order that comes twice doubles its claims where orders are not reduced
    owner = d.policies(spark, tables).select("policy_id", "client_id", "region_code")
    want = d.claim_lines(spark, tables).join(owner, "policy_id", "left")
    assert sorted(map(repr, rows(d.claims(spark, tables).select(want.columns)))) == sorted(map(repr, rows(want)))
    assert sorted(map(repr, rows(d.client_claims(spark, tables)))) == sorted(map(repr, rows(want.select(d.client_claims(spark, tables).columns))))


@pytest.mark.parametrize("name", ["r6_fraud_score", "m2_score_bands"])
def test_lines_are_shuffled_once_for_all_readers(spark, tables, name):
    """The claims meet their policies in the one shuffle by order, which all rules share."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, tables)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line for line in plan.split("\n") if " Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
    # beside it only the lines without an order, by their number
    assert sorted("l_linenumber#" in line for line in moved if "(l_orderkey#" in line) == [False, True]
    assert sum("(policy_id#" in line for line in moved) == 1  # the policies, and no claims


def test_declared_claims_leave_out_what_decides_nothing(spark, tables, tmp_path):
    """Columns that only tell apart lines with equal dates and amounts are not shuffled, and the claims are the same; ties by supplier still count."""
    day = datetime(1997, 5, 1)
    rng = random.Random(11)
    lines = [
        (rng.choice([None, 1, 2, 3]), rng.choice([None, 5, 6]), rng.choice([None, 7, 8]), rng.randrange(1, 3), rng.choice([None, 10.0, 20.0]),
         rng.choice([None, 0.01, 0.02]), rng.choice("RAN"), rng.choice("OF"), rng.choice([None, day, day + timedelta(1)]))
        for _ in range(200)
    ]
    spark.createDataFrame(lines, LINE).repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    for sf in (str(tmp_path), tables):
        slim = d.claim_lines(spark, sf, declared=True)
        assert rows(slim) == rows(d.claim_lines(spark, sf).select(slim.columns)) and slim.count() > 5
    plan = QUERIES["m2_score_bands"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" in plan and not {"l_discount", "l_returnflag", "l_linestatus"} & set(plan.replace("#", " ").replace("[", " ").replace(",", " ").split())


@pytest.mark.parametrize("name", ["b9_trigger_totals", "m2_named_bands", "m2_score_bands", "r7_suspects_by_product"])
def test_visits_are_dealt_by_address_once(spark, tables, name):
    """Visits of addresses that are not crowded meet in one shuffle for the sums of both rules: it took five before."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum("REPARTITION_BY_COL" in line and "(adresse#" in line for line in plan.split("\n")) == 1
