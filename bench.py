"""Time the registered queries and print one JSON line.

Settings from the environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_QUERIES (comma list, or "all").
Each query runs twice and the second run counts: the first one pays for class loading and code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from daypanel.plans.queries import QUERIES
from daypanel.session import local_session

HEADLINE = [
    "top_drugs", "spine", "line_spine", "patient_static", "static_imputation", "signal_readings", "clean_values",
    "line_clean_values", "group_mean_fill", "line_group_mean_fill", "daily_signal_mean", "wide_panel",
    "line_wide_panel", "dataset", "line_admission_days", "drug_multihot", "onehot_static", "knn_impute",
    "next_day_labels", "sequences", "pad_truncate", "metric_jaccard", "metric_lrap", "metric_micro_f1", "score_gru",
]


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "8g"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            frame = QUERIES[name](spark, sf_dir)
            built = time.perf_counter() - start
            times.append(built + run(frame))
        seconds[name] = round(times[-1], 3)
        print(f"{name} {times[0]:.2f} {times[1]:.2f} (build {built:.2f})", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "total seconds, warm",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
