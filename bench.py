"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to run a subset).  Panel queries run at grain C
Each query is executed in full with a ``noop`` write (no collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from unitcast import config  # noqa: E402
from unitcast.operators import panel  # noqa: E402
from unitcast.plans import QUERIES  # noqa: E402
from unitcast.plans import panelq, pipelines  # noqa: E402
from unitcast.sources import tpch  # noqa: E402


def panel_c(fn, reuse=False):
    def run(spark, sf_dir):
        return fn(panelq.full_panel(spark, sf_dir, "C", materialized=reuse), spark, sf_dir)
    return run


HEADLINE = {
    "monthly_sales": QUERIES["monthly_sales"],
    "panel_lags": panel_c(lambda p, s, d: panel.add_lags(p, "item_cnt_month", config.COUNT_LAGS)),
    "price_trend": lambda s, d: pipelines.price_trend_table(tpch.sales_grain(s, d, "C"), tpch.request(s, d, "C")),
    "item_recency": panel_c(lambda p, s, d: panel.item_recency(p), reuse=True),
    "tfidf_documents": QUERIES["tfidf_documents"],
    "gbt_es_predictions": QUERIES["gbt_es_predictions"],
    "forest_predictions": QUERIES["forest_predictions"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    log_dir = os.environ.get("BENCH_EVENTLOG")   # optional: stage times via tools/stage_times.py
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = config.local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="unitcast-bench",
                                 extra_conf=extra)
    # JVM warm-up on generated rows (no test data read), outside the timings.
    spark.range(100_000).selectExpr("sum(id) AS s").collect()
    times: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
