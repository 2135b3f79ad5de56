"""Time the registered queries on one machine; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores, ``BENCH_QUERIES`` a list of queries,
``BENCH_SECONDS`` how long to go on: queries that were not reached by then are named under ``not_run``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rtdw.plans.queries import QUERIES
from rtdw.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SECONDS = float(os.environ.get("BENCH_SECONDS", "1400"))
# A query that takes less is run three times more, and the median counts.
SHORT = 4.0
# Streams write their input, run micro-batches and read back: one timed run each.
STREAMS = {
    "q_topic_source", "q_topic_sink", "q_window_sink", "q_watermark_late", "q_restart",
    "q_fact_job", "q_dim_job", "q_comment_job", "q_ods_job", "q_visitor_stream", "q_traffic_job", "q_config_route_late", "q_dead_counts",
}


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    timed(spark, "q_kw_window")
    seconds, not_run, start = {}, [], time.perf_counter()
    for name in names:
        if time.perf_counter() - start > SECONDS:
            not_run.append(name)
            continue
        seconds[name] = timed(spark, name)
        if name not in STREAMS and seconds[name] < SHORT:
            seconds[name] = statistics.median(timed(spark, name) for _ in range(3))
        seconds[name] = round(seconds[name], 3)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    result = {"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec"}
    print(json.dumps({**result, "queries": seconds, "not_run": not_run, "sf": float(scale) if scale[:1].isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
