"""Time the registered queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated names, default all),
BENCH_RUNS (default 1; the least time counts). Every query writes all its rows to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.queries import all_queries
from tidemark.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus), memory="12g")
    known = all_queries()
    for name in ("p4_status_normalise", "a3_outcome_counts"):  # start the JVM and the workers
        known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in wanted or known:
        times = []
        for _ in range(runs):
            begun = time.perf_counter()
            known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        took[name] = round(min(times), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(f"{name:32s} {took[name]:8.3f}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took}
    print(json.dumps({**line, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))


main()
