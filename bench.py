"""Benchmark the headline queries.

Runs each query of the catalogue subset below on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one
JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is forced end to end with the ``noop`` sink (no collect), after one
untimed query that starts the JVM's and the workers' code.  Queries share the
session's materialised intermediates, as in a pipeline run, so the first one
that needs an intermediate pays for it; ``BENCH_COLD=1`` forgets them before
every query, and ``BENCH_REPEAT=3`` reports the median of three runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "block_accounts",
    "block_installments",
    "feature_store",
    "screening_report",
    "split_metrics",
    "lift_table",
    "strategy_scenarios",
    "cost_curve",
    "amount_cost_curve",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from riskfold.plans.catalog import QUERIES
    from riskfold.plans.q_screen import release
    from riskfold.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "8")), app="riskfold-bench")
    repeat, cold = int(os.environ.get("BENCH_REPEAT", "1")), os.environ.get("BENCH_COLD") == "1"

    def run(name: str) -> float:
        if cold or repeat > 1:
            release()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("raw_table_profile")
    times: dict[str, float] = {}
    for name in names:
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
