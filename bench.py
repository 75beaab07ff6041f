"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Protocol: one warm-up run per query, then the median of ``BENCH_RUNS``
(default 3) timed runs, each fully materialised through the ``noop`` sink.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierline.session import get_spark  # noqa: E402


def headline(spark, d):
    from pyspark.sql import functions as F
    from tierline.operators.dedup import dedup_latest
    from tierline.operators.layout import zorder
    from tierline.operators.merge import snapshot_diff, upsert
    from tierline.operators import monitoring as M
    from tierline.plans import products as P
    from tierline.plans import views as V
    from tierline.plans.q_io import _updates
    from tierline.plans.q_products import AS_OF

    def sales(status=None):
        return V.sales(spark, d, status=status)

    return {
        "category_monthly_report": lambda: P.category_monthly_report(sales("COMPLETED"), V.products(spark, d)),
        "daily_sales": lambda: P.daily_sales(V.orders_hdr(spark, d, status="COMPLETED")),
        "product_performance": lambda: P.product_performance(sales("COMPLETED"), V.products(spark, d)),
        "category_performance": lambda: P.category_performance(sales("COMPLETED"), V.products(spark, d)),
        "customer_segments": lambda: P.segment_customers(P.customer_patterns(sales(), as_of=AS_OF)),
        "daily_category_sales": lambda: P.daily_category_sales(sales("COMPLETED"), V.products(spark, d)),
        "dedup_latest": lambda: dedup_latest(V.table(spark, d, "lineitem"),
                                             ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]),
        "upsert": lambda: upsert(V.table(spark, d, "customer"), _updates(spark, d), ["c_custkey"]),
        "snapshot_diff": lambda: snapshot_diff(V.table(spark, d, "customer"),
                                               upsert(V.table(spark, d, "customer"), _updates(spark, d),
                                                      ["c_custkey"]), ["c_custkey"]),
        "zorder": lambda: zorder(V.table(spark, d, "lineitem"), ["l_shipdate", "l_partkey"]),
        "failure_alerts": lambda: M.failure_alerts(V.log(spark, d)),
        "job_performance": lambda: M.job_performance(V.log(spark, d).withColumn("ok", ~F.col("failure"))),
    }


def run_once(build) -> float:
    t0 = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    # Two waves of shuffle tasks per stage on a single machine (evens out
    # stragglers); on a cluster tierline.session.size_shuffle sizes by bytes.
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = get_spark("tierline-bench", master=f"local[{cpus}]", shuffle_partitions=parts,
                      conf={"spark.driver.memory": "16g"})
    results = {}
    for name, build in headline(spark, sf_dir).items():
        if only and name not in only:
            continue
        run_once(build)                                   # warm-up
        results[name] = round(statistics.median(run_once(build) for _ in range(runs)), 3)
        print(f"# {name}: {results[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": float(sf) if sf else None,
                      "cpus": cpus, "runs": runs, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
