"""Time the headline queries: one JSON line on stdout.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.
The record files are written before the clock starts: a user of the engine has
them already. Every query is run once to warm up and then timed; a stream is
timed from a fresh checkpoint to its end.
"""

from __future__ import annotations

import json
import os
import sys
import time

from namepulse.plans import catalogue, feed
from namepulse.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "daily_topk",
    "daily_topk_of_records",
    "daily_topk_nested",
    "daily_histogram_map",
    "global_topk",
    "rejected_lines",
    "spread_timestamps",
    "running_count",
    "last_hour_exact",
    "last_hour_sweep",
    "sliding_hour",
    "stream_names",
    "stream_top100",
    "stream_sliding_hour",
    "stream_window_topk",
    "stream_last_hour_sweep",
    "stream_last_hour_processor",
)
# Runs of these are kept for the other queries of a catalogue; time a new one.
KEPT_RUNS = ("updates", "live", "swept")


def run(spark, name: str) -> float:
    feed.forget(spark, SF_DIR, *KEPT_RUNS)
    start = time.perf_counter()
    catalogue.queries()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    start = time.perf_counter()
    feed.feed_files(spark, SF_DIR)
    feed.segment_files(spark, SF_DIR)
    feed.record_stream_files(spark, SF_DIR)
    for name in ("event_type", "user_id"):
        feed.event_stream_files(spark, SF_DIR, name)
    setup = time.perf_counter() - start
    seconds = {}
    for name in HEADLINE:
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "setup_sec": round(setup, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
