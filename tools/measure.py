"""
warm-up), output rows, shuffle bytes written and task time — the last two
read from Spark's event log, written to a fresh scratch folder (no UI).

usage: python tools/measure.py [sf_dir] [name ...]   → markdown table on stdout
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from ordstar.plans.queries import QUERIES  # noqa: E402
from ordstar.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="ordstar-events-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    secs, out_rows = {}, {}
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for i in range(3):
            sc.setJobGroup(f"{name}#{i}", name)
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        sc.setJobGroup(f"{name}#rows", name)
        out_rows[name] = QUERIES[name](spark, sf_dir).count()
        secs[name] = statistics.median(runs)
    spark.stop()

    stage_group: dict[int, str] = {}
    shuffle: dict[str, int] = {}
    task_ms: dict[str, int] = {}
    for path in sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)):
        if not os.path.basename(path).startswith("events_"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"), "")
                    if not g.endswith("#0"):
                        continue  # one timed run per query
                    m = ev.get("Task Metrics") or {}
                    w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    shuffle[g[:-2]] = shuffle.get(g[:-2], 0) + w
                    task_ms[g[:-2]] = task_ms.get(g[:-2], 0) + m.get("Executor Run Time", 0)
    print(f"sf dir `{sf_dir}`, local[8], median of 3 after one warm-up\n")
    print("| query | seconds | output rows | shuffle written (MB) | task time (s) |")
    print("| --- | ---: | ---: | ---: | ---: |")
    for n in names:
        print(f"| {n} | {secs[n]:.2f} | {out_rows[n]:,} | {shuffle.get(n, 0) / 1e6:.1f} | {task_ms.get(n, 0) / 1e3:.1f} |")
    print(f"| **total** | **{sum(secs.values()):.2f}** | | {sum(shuffle.values()) / 1e6:.1f} | |")


if __name__ == "__main__":
    main()
