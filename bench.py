"""Benchmark: wall time of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (the whole plan runs, nothing is
collected), warm (one untimed run first), median of $BENCH_REPEATS runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskspark.plans.queries import all_queries  # noqa: E402
from riskspark.session import local_session  # noqa: E402

HEADLINE = [
    "rate_by_two_keys", "join_breakdown", "quartiles_by_outcome", "ratio_to_group_mean", "density_by_class",
    "roc_auc", "avg_precision", "best_threshold", "pr_curve", "capture_topx", "lift_gains",
    "fairness_audit", "drift_report", "drift_by_period", "bottom_quartile", "stratified_split",
    "rule_contributions", "rule_distribution", "roi_scenarios", "clean_lineitem",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16)
    qs = all_queries()
    chosen = [n for n in (names.split(",") if names else HEADLINE) if n in qs]
    times = {}
    for name in chosen:
        try:
            run(qs[name](spark, sf_dir))  # warm-up
            runs = []
            for _ in range(repeats):
                t0 = time.perf_counter()
                run(qs[name](spark, sf_dir))
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001
            print(f"# {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "repeats": repeats, "spark": spark.version}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
