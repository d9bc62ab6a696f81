"""Time the headline queries: one warm-up, then the median of three runs each. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from decisionkit import plans
from decisionkit.session import local_session

HEADLINE = [
    "flagship_threshold_choice",
    "src2_snapshot_fingerprint",
    "con15_quality_report",
    "spl1_stratified_split",
    "spl1_large_frame",
    "jn2_as_of_join",
    "agg3_exact_quantiles",
    "enc6_ordered_target_statistic",
    "enc6_large_frame",
    "evl7_large_frame",
    "evl9_large_frame",
    "evl12_capacity_policy",
    "evl23_bootstrap_interval",
    "cal1_quantile_reliability",
    "drf1_large_frame",
    "inf1_guarded_scoring",
    "mdl2_logistic_regression",
    "jn5_nearest_neighbours",
    "str2_volume_monitor",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(spark, fn, sf_dir: str) -> float:
    begun = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, app="decisionkit-bench")
    registered, seconds = plans.queries(), {}
    for name in only or HEADLINE:
        fn = registered[name]
        timed(spark, fn, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, fn, sf_dir) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
