"""

    python tests/baseline_probe.py [sf_dir]

Job and table keys are timed with the write of their input table; stream keys only from start to end of their run.
"""

import json
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tablekeep.operators import matching  # noqa: E402
from tablekeep.plans import catalog, jobs  # noqa: E402
from tablekeep.session import Workspace, local_session  # noqa: E402
from tablekeep.sources import landing  # noqa: E402
from tablekeep.streaming import ingest  # noqa: E402

SF_DIR = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
RUNS = 5


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def query(key):
    return lambda spark: (None, lambda _: noop(catalog.QUERIES[key](spark, SF_DIR)))


def shuffled_anti(spark):
    orders = catalog.table(spark, SF_DIR, "orders")
    urgent = orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'O'")

    def run(_):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        noop(matching.anti_not_in(orders, urgent, "o_orderkey", broadcast_limit=0))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    return None, run


def landed(ws, df):
    landing.land_increment(ws.spark, jobs.write_json(df, ws.path("source")), ws.path("raw"), "first")


def stream_append(spark):
    events = catalog.table(spark, SF_DIR, "events")

    def prepare():
        ws = Workspace(spark)
        landed(ws, events)
        return ws

    return prepare, lambda ws: ingest.ingest_append(
        spark, ws.path("raw"), ws.table("bronze"), ws.path("cp"), events.schema
    )


def stream_upsert(spark):
    orders = catalog.table(spark, SF_DIR, "orders")

    def prepare():
        ws = Workspace(spark)
        landed(ws, catalog.order_increment(orders))
        catalog.saved(ws, "live", orders)
        return ws

    return prepare, lambda ws: ingest.ingest_upsert(
        spark, ws.path("raw"), ws.table("live"), ws.path("cp"), orders.schema, "o_orderkey", ["o_orderdate"]
    )


MEASURED = {
    "sum_by_key": query("sum_by_key"),
    "count_by_key": query("count_by_key"),
    "indicator_ratio": query("indicator_ratio"),
    "anti_not_in, broadcast": query("anti_not_in"),
    "anti_not_in, shuffle": shuffled_anti,
    "union_distinct": query("union_distinct"),
    "merge_counts": query("merge_counts"),
    "upsert_rewrite": query("upsert_rewrite"),
    "upsert_merge": query("upsert_merge"),
    "convert_format": query("convert_format"),
    "compact_files": query("compact_files"),
    "stream_ingest_append": stream_append,
    "stream_upsert": stream_upsert,
    "end_to_end": query("end_to_end"),
}


def shuffle_bytes(log_dir: str, spans: dict) -> dict:
    """Bytes written to shuffles by tasks that ended within each span."""
    out = dict.fromkeys(spans, 0)
    for path in Path(log_dir).rglob("events*"):
        for line in path.open():
            if '"SparkListenerTaskEnd"' not in line:
                continue
            event = json.loads(line)
            end = event["Task Info"]["Finish Time"] / 1000
            written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            for key, (a, b) in spans.items():
                if a <= end <= b:
                    out[key] += written
    return out


def main():
    logs = tempfile.mkdtemp(prefix="tablekeep-events-")
    spark = local_session(8, conf={"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": "file:" + logs})
    seconds, spans = {}, {}
    for key, case in MEASURED.items():
        prepare, run = case(spark)
        times = []
        for _ in range(RUNS + 1):
            ws = prepare() if prepare else None
            start = time.time()
            run(ws)
            times.append(time.time() - start)
            spans[key] = (start, time.time())
        seconds[key] = statistics.median(times[1:])
        print(f"{key:28s} {seconds[key]:6.2f} s", flush=True)
    spark.stop()
    for key, moved in shuffle_bytes(logs, spans).items():
        print(f"| `{key}` | {seconds[key]:.2f} | {moved / 1e6:.2f} |")


if __name__ == "__main__":
    main()
