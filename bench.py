"""Seconds per query: one warm-up, then the median of a few runs, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from queries import registry  # noqa: E402
from seriesloom.session import drop_stages  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
BUDGET = float(os.environ.get("BENCH_BUDGET_SEC", "900"))
# One query per kind of work; BENCH_QUERIES=all times every registered one.
HEADLINE = [
    "csv_roundtrip", "tagged_union", "hourly_grid", "calendar_spine", "missing_by_day",
    "interpolate_time", "interpolate_time_chunked", "backfill", "grid_repair", "clock_lag",
    "clock_lag_chunked", "lag_fanout", "offday_run_length", "daily_rollup", "daily_to_hourly_asof",
    "daily_lag", "moving_average_trend", "ridge_gram", "weighted_median",
    "weighted_median_rowwise", "hourly_profile", "hourly_trend", "rmsle", "prediction_table",
    "prediction_full_outer", "forecast_submission", "stack_ridge", "cv_summary",
    "lag_correlation", "daily_trend_gp", "daily_trend_forest", "residual_forest", "residual_gbt",
    "residual_adaboost",
]
_asked = os.environ.get("BENCH_QUERIES", "")
ONLY = list(registry.QUERIES) if _asked == "all" else [n for n in _asked.split(",") if n] or HEADLINE


def run(spark: SparkSession, name: str) -> float:
    start = time.time()
    registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    took = time.time() - start
    drop_stages(spark)
    return took


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    began = time.time()
    seconds: dict[str, float] = {}
    skipped: list[str] = []
    run(spark, "tagged_union")  # JVM warm-up, not recorded
    for name in ONLY:
        if time.time() - began > BUDGET:
            skipped.append(name)
            continue
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    if skipped:
        result["skipped"] = skipped
    print(json.dumps(result))


if __name__ == "__main__":
    main()
