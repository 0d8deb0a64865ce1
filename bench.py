"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, executing the whole plan into Spark's ``noop`` sink
(nothing is collected), and prints one JSON line with the median of
``$BENCH_RUNS`` warm runs per query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adspend.session import build_session  # noqa: E402
from adspend.testkit.registry import QUERIES  # noqa: E402

HEADLINE = [
    "customer_day_snapshot",        # Q-29
    "net_income_expanded",          # Q-23
    "agent_rollup",                 # Q-33 wide
    "agent_rollup_long",            # Q-33 long
    "settlement_apportion_daily",   # Q-35
    "spend_by_entity",              # Q-19..22
    "hourly_report",                # AGG-13
    "channel_upsert",               # Q-34
    "settlement_first_per_group",   # Q-28 + WIN-5
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    # one warm-up of the JVM and the readers
    run(QUERIES["daily_report"](spark, sf_dir))
    out = {}
    for name in names:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "median_wall_time_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
