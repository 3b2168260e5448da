"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import platform
import time

import pyspark

from larder.plans.catalog import QUERIES
from larder.session import build_session

HEADLINE = [
    "profile_describe",
    "distinct_counts",
    "waste_rate_by_product",
    "top_products",
    "shelf_life_by_product",
    "month_seasonality",
    "supplier_performance",
    "daily_stats",
    "moving_avg",
    "dense_daily_regressors",
    "holidays",
    "future_frame",
    "standardized_regressors",
    "forecast_native",
    "forecast_moving_average",
    "forecast_metrics",
    "model_comparison",
    "forecast_28d",
    "forecast_ridge",
    "model_presets",
    "order_recommendation",
    "waste_risk",
    "product_summary",
    "forecast_export",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else None)
    spark.sparkContext.setLogLevel("ERROR")
    # A real query, so that the first one timed does not carry the session's start.
    QUERIES["daily_stats"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "spark": pyspark.__version__,
        "python": platform.python_version(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
