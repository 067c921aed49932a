"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's full plan is executed with the ``noop`` sink (all rows are
produced, nothing is collected); the time of a second, warm run is kept.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridelake.queries import REGISTRY  # noqa: E402
from ridelake.session import build_session  # noqa: E402

HEADLINE = [
    "bronze_to_silver", "silver_audit", "trips_by_hour", "trips_by_zone", "monthly_trend", "fares_by_zone",
    "vehicle_comparison", "duration_distance", "rule_profile", "rule_cascade", "layer_audit",
    "zone_features", "airport_features", "daily_series", "train_test_split_time", "zone_report",
    "dim_calendar", "dim_holidays", "ingest_summary", "forecast_metrics", "demand_forecast",
    "model_comparison", "silver_roundtrip", "scan_trips",
    "kmeans_elbow", "zone_clusters", "cluster_profile", "incremental_silver", "gold_job_hourly", "silver_job_audit",
    "forecast_export", "scan_drift",
]


def run(spark, name, sf_dir) -> float:
    fn, _ = REGISTRY[name]
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def run_jobs(spark, sf_dir) -> dict[str, float]:
    """End-to-end jobs, timed apart from the query sum: bronze → silver (write + audit from
    row counts) and silver → gold (one silver scan, every gold table written)."""
    from ridelake.plans import gold_job, silver_job
    from ridelake.queries import bronze_files
    from ridelake.session import scratch_path
    folders = bronze_files(spark, sf_dir, True)
    out = {}
    for attempt in ("cold", "warm"):
        root = scratch_path(spark, f"bench-jobs-{attempt}")
        t0 = time.perf_counter()
        silver_job.run(spark, folders, f"{root}/silver", f"{root}/audit", "bench").count()
        t1 = time.perf_counter()
        gold_job.run(spark, f"{root}/silver", f"{root}/gold")
        t2 = time.perf_counter()
        out = {"silver_job": round(t1 - t0, 3), "gold_job": round(t2 - t1, 3)}
    return out  # warm run kept


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = [n for n in HEADLINE if n in REGISTRY]
    from ridelake.queries import bronze_files
    for multi in (False, True):  # bronze input is stored data: write it before timing
        bronze_files(spark, sf_dir, multi)
    for n in names[:3]:  # JVM / codegen warm-up
        run(spark, n, sf_dir)
    times, cold = {}, {}
    for n in names:
        cold[n] = round(run(spark, n, sf_dir), 3)  # first run: includes code generation
        times[n] = round(run(spark, n, sf_dir), 3)  # kept: warm run
    jobs = run_jobs(spark, sf_dir)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": int(cpus), "cold_value": round(sum(cold.values()), 3), "jobs": jobs}))
    spark.stop()


if __name__ == "__main__":
    main()
