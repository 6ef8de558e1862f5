"""Benchmark: reporting views over the published gold star.

Runs the pipeline once from ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1),
then each query 1 + 5 times on ``local[$BENCH_CPUS]`` over the tables that it
published and reports the warm median.  Prints one JSON line; ``value`` is the sum of the five view
medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lodestar.operators import quality  # noqa: E402
from lodestar.operators import upsert as upsert_ops  # noqa: E402
from lodestar.plans import named, views  # noqa: E402
from lodestar.plans.pipeline import run_pipeline  # noqa: E402
from lodestar.plans.star import read_release, star_from_tables  # noqa: E402
from lodestar.session import local_session, scratch_root  # noqa: E402
from lodestar.sources import store  # noqa: E402
from lodestar.sources.tables import bronze_tables  # noqa: E402

VIEWS = ("executive_kpis", "monthly_sales", "yoy_growth", "customer_ltv", "category_freight")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def timed(fn, runs=RUNS):
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 4)


def run_df(make):
    return lambda: make().write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus != "*" else 8,
                          app_name="lodestar-bench")
    # What the pipeline publishes is what the views are timed on.
    t0 = time.perf_counter()
    bronze = bronze_tables(spark, sf_dir, renumber=True)
    bronze["order_items"] = store.stage(bronze["order_items"], "items")
    run_pipeline(spark, bronze, "bench_gold", scratch_root(spark))
    etl = round(time.perf_counter() - t0, 3)
    g = read_release(spark, "bench_gold")

    q = {}
    # The floor: one scan of the fact and one small aggregate, beside the views in the same run.
    q["floor_scan"] = timed(run_df(lambda: g.fact.agg(F.sum("freight_value"))))
    q["floor_group"] = timed(run_df(lambda: g.fact.groupBy("order_date_sk").agg(F.sum("freight_value"))))
    q["executive_kpis"] = timed(run_df(lambda: views.executive_kpis(g.fact)))
    q["monthly_sales"] = timed(run_df(lambda: views.monthly_sales(g.fact, g.dim_date)))
    q["yoy_growth"] = timed(run_df(lambda: views.yoy_growth(g.fact, g.dim_date)))
    q["customer_ltv"] = timed(run_df(lambda: views.customer_ltv(g.fact)))
    q["category_freight"] = timed(run_df(lambda: views.category_freight(g.fact, g.dim_product)))
    headline = round(sum(q[v] for v in VIEWS), 4)

    q["executive_kpis_split"] = timed(run_df(lambda: views.executive_kpis(g.fact, strategy="split")))
    q["executive_kpis_expand"] = timed(run_df(lambda: views.executive_kpis(g.fact, strategy="expand")))
    q["monthly_trends"] = timed(run_df(lambda: named.monthly_trends(g, 12)))
    q["top_customers"] = timed(run_df(lambda: named.top_customers(g, 50)))
    q["quality_gate"] = timed(lambda: quality.standard_suite(
        g.fact, g.dim_customer, g.dim_product, g.dim_date).ledger().collect(), runs=3)

    # Upsert cost by share of touched rows: restate one month, or the last
    # ~1.5 years, by a full rewrite and by touched month partitions.
    fact = g.fact.withColumn("order_month", (F.col("order_date_sk") / 100).cast("int"))
    keys, root = ["order_id", "order_item_id"], scratch_root(spark)
    busiest = fact.groupBy("order_month").count().orderBy(F.desc("count"), "order_month").first()[0]
    shares = {"1month": fact.where(F.col("order_month") == busiest),
              "18months": fact.where(F.col("order_date_sk") >= 20000101)}
    upsert_ops.upsert(fact, "bench_whole", keys, root)
    upsert_ops.upsert_partitioned(fact, "bench_parts", keys, "order_month", root)
    total = fact.count()
    for label, part in shares.items():
        updates = part.withColumn("sales_amount", (F.col("sales_amount") * 0.9).cast("decimal(18,2)"))
        q[f"upsert_share_{label}"] = round(part.count() / total, 4)
        q[f"upsert_whole_{label}"] = timed(lambda u=updates: upsert_ops.upsert(u, "bench_whole", keys, root), runs=3)
        q[f"upsert_partitioned_{label}"] = timed(
            lambda u=updates: upsert_ops.upsert_partitioned(u, "bench_parts", keys, "order_month"), runs=3)

    # The five views end to end from the raw tables (star built lazily each run).
    if os.environ.get("BENCH_E2E", "1") == "1":
        def e2e(make):
            return run_df(lambda: make(star_from_tables(spark, sf_dir)))
        q["e2e_executive_kpis"] = timed(e2e(lambda s: views.executive_kpis(s.fact)), runs=3)
        q["e2e_monthly_sales"] = timed(e2e(lambda s: views.monthly_sales(s.fact, s.dim_date)), runs=3)
        q["e2e_yoy_growth"] = timed(e2e(lambda s: views.yoy_growth(s.fact, s.dim_date)), runs=3)
        q["e2e_customer_ltv"] = timed(e2e(lambda s: views.customer_ltv(s.fact)), runs=3)
        q["e2e_category_freight"] = timed(e2e(lambda s: views.category_freight(s.fact, s.dim_product)), runs=3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "views_warm_median_sum", "value": headline, "unit": "sec",
                      "queries": q, "etl_sec": etl, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
