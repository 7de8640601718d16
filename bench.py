"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3; one warm-up run before).
Each run writes the query result to the ``noop`` sink, so the whole
plan executes without collecting rows to the driver."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recflow.plans.queries import QUERIES  # noqa: E402
from recflow.session import build_session, released  # noqa: E402

HEADLINE = ["traj_build", "cf_similarity", "cf_recommend", "ope_summary", "eval_ranking",
            "backtest_curve"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="recflow-bench")
    times = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            with released(spark):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i > 0:
                    samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
