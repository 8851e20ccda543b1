"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print one JSON line.

Each query runs once to warm up and then ``$BENCH_RUNS`` times (3 by default); the median of a full result write to the
noop sink counts. Table and stream queries time their job too: their inputs are written by the same clock.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablekeep.plans import catalog  # noqa: E402
from tablekeep.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "sum_by_key",
    "count_by_key",
    "indicator_ratio",
    "anti_not_in",
    "union_distinct",
    "merge_counts",
    "upsert_rewrite",
    "upsert_merge",
    "convert_format",
    "compact_files",
    "stream_ingest_append",
    "stream_upsert",
    "end_to_end",
)


def run_once(spark, key: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "bench", {"spark.ui.showConsoleProgress": "false"})
    found = {}
    for key in HEADLINE:
        run_once(spark, key)
        found[key] = round(statistics.median(run_once(spark, key) for _ in range(RUNS)), 3)
        print(key, found[key], file=sys.stderr, flush=True)
    total = round(sum(found.values()), 3)
    sf = float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"))
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": found, "sf": sf}))


if __name__ == "__main__":
    main()
