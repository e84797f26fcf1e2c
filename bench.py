"""Time the headline queries and print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  A few warm-up queries run
first (on sf0.001 by default) so JVM start-up and JIT are not charged to
the first query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendspark.plans import catalogue  # noqa: E402
from trendspark.session import get_session  # noqa: E402

# Every registered query (the catalogue order): each operator group is timed.
HEADLINE = list(catalogue.QUERIES)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    # Warm-up, not timed: class loading and JIT of the JVM paths the queries
    # share (text functions, hash joins, aggregates), on the smallest tables.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for q in ("mention_stats", "star_daily", "first_wins"):
        catalogue.QUERIES[q](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, []
    for name in names:
        t0 = time.perf_counter()
        try:
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as err:  # record and go on: one failure must not hide the rest
            times[name] = None
            failed.append(name)
            print(f"{name} failed: {str(err)[:300]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "total_headline_seconds",
           "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
