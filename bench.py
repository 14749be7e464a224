"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's full plan is executed with the ``noop`` sink (every row is
produced, nothing is collected). Every query except the model
searches runs twice: ``queries`` holds the faster (warm: JIT-compiled, file
listing cached) run, ``cold`` the first. The three churn grid searches (RF,
LR, GBT: the reference's grids, 2 folds, 4 fits in parallel) are the
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "churn_user_bins", "host_state", "process_context", "cohort_hourly_rates", "plays_of_churned",
    "describe", "null_counts", "clean_demographics", "prepare_census", "symmetric_difference",
    "best_by", "tokenize", "bag_of_words", "tf_idf", "roc_points", "area_under_roc", "sample_exact",
    "stream_window_counts", "process_clusters", "churn_rf_search", "churn_lr_search", "churn_gbt_search",
]
# model searches are long and dominated by fitting: one run each
ONCE = {"process_clusters", "churn_rf_search", "churn_lr_search", "churn_gbt_search"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.plans.registry import queries
    from tidemark.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    q = queries()
    # warm-up: JVM, codegen caches, file listing
    q["churn_user_bins"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 if name in ONCE else 2):
            t0 = time.time()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.time() - t0, 3))
        cold[name], times[name] = runs[0], min(runs)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_headline_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "cold_value": round(sum(cold.values()), 3), "cold": cold}))


if __name__ == "__main__":
    main()
