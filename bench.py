"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf 0.1), ``BENCH_CPUS`` the local
cores, ``BENCH_RUNS`` the timed runs per query after one warm-up.
"""

import json
import os
import statistics
import time

from checks import QUERIES
from skylag.session import local_session

HEADLINE = [
    "weather_hourly", "join_dep_weather", "corr_matrix_dep", "feature_stats_dep", "forecast_by_stage",
    "delay_by_origin", "profile_table", "box_origin_dep", "jsd_numeric", "ffill_bfill", "stream_weather",
    "linear_baseline_dep",
]


def seconds(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, "bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times = {}
    for name in only or HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
