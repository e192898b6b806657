"""Benchmark: build the warehouse from testdata, then time the headline
queries on the materialised gold layer.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Prints ONE JSON line:
{"metric": "...", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``pipeline`` = raw -> silver -> gold written to Parquet; every other key =
a full evaluation of the query (``noop`` sink, all rows produced) over the
BENCH_RUNS times, median reported (the first pipeline run is the cold one).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "view_revenue_summary", "view_kpi_overview", "view_daily_revenue", "view_product_performance",
    "view_category_performance", "view_store_performance", "view_inventory_snapshot",
    "view_inventory_turnover", "view_returns_summary", "sq1_monthly_net_revenue",
    "sq2_revenue_by_channel", "sq3_top10_products", "sq4_below_safety_stock",
    "sq5_return_rate_by_channel", "m_inventory_change", "b01_net_revenue_rollup",
    "b06_price_volume_mix", "b07_mom_yoy_contribution", "b14_stockout_trend",
    "b21_return_rate_slices", "fk_audit", "grain_audit_facts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="ledgerlake-bench-")

    from ledgerlake.session import get_session

    spark = get_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus * 2,
        extra={
            "spark.driver.memory": "16g",
            "spark.local.dir": scratch,
            "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        },
    )
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    from ledgerlake.operators import quality
    from ledgerlake.plans import metrics, questions, views
    from ledgerlake.plans.warehouse import GOLD_TABLES, Warehouse

    fns = {**views.VIEWS, **metrics.METRICS, **questions.QUESTIONS}
    fns["fk_audit"] = lambda w: quality.fk_audit({t: w.gold(t) for t in GOLD_TABLES})
    fns["grain_audit_facts"] = lambda w: quality.grain_audit({t: w.gold(t) for t in GOLD_TABLES}, quality.FACT_GRAINS)

    timings: dict[str, float] = {}
    samples = []
    for i in range(runs):
        t0 = time.time()
        built = Warehouse.from_testdata(spark, sf_dir).materialize(os.path.join(scratch, f"warehouse-{i}"))
        samples.append(time.time() - t0)
    timings["pipeline"] = round(statistics.median(samples), 3)

    for name in HEADLINE:
        samples = []
        for _ in range(runs):
            t = time.time()
            fns[name](built).write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t)
        timings[name] = round(statistics.median(samples), 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "pipeline_plus_headline_queries_total_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "pyspark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
