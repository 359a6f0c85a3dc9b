"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from premia.plans.queries import QUERIES  # noqa: E402
from premia.session import get_session  # noqa: E402

HEADLINE = (
    "w1_dedup_latest", "j1_enriched_claims", "v9_volumetry", "a1_claims_kpis", "g2_portfolio_kpis", "g3_loss_ratio",
    "r2_high_amount", "r3_frequent_claimant", "r4_address_cluster", "r6_fraud_score", "c5_churn_scores",
    "g4_aging_summary", "g5_portfolio_exposure", "q_silver_suite", "b13_crosstab_product", "b16_histogram",
)


def run(name, spark, sf_dir) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM
    first = {n: run(n, spark, sf_dir) for n in names}
    warm = {n: run(n, spark, sf_dir) for n in names}
    print(
        json.dumps(
            {
                "metric": "total warm seconds of headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
