"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed three times; the median is
reported. Execution is forced with the ``noop`` sink, so the whole plan runs
but nothing is collected to the driver. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordstar.plans.queries import QUERIES  # noqa: E402
from ordstar.session import build_session  # noqa: E402

HEADLINE = [
    "json_flatten", "explode_cross", "pseudo_names", "tokenize_ids", "coerce_numeric",
    "sample_head", "dim_product", "fact_full_key", "fanout_audit", "kpi_volume",
    "kpi_traceability", "kpi_buyers",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    timings = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up
        timings[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(reps)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "reps": reps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
