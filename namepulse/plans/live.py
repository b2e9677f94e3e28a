"""The streaming jobs: raw records in, live top list out.

A job is two queries with a table of updates between them: one counts names,
the other keeps the list. Snapshots and changes of the list are tables under
``<root>/top``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from namepulse.operators.unpack import stream_names
from namepulse.sources.stream import update_stream
from namepulse.streaming.counts import count_updates
from namepulse.streaming.run import run_to_end, start
from namepulse.streaming.sweep import last_hour_updates, swept_counts
from namepulse.streaming.top import live_top


def running_updates(records: DataFrame, root: str) -> DataStreamWriter:
    """Updates of the count of every name ever seen in raw ``records``."""
    return count_updates(stream_names(records), f"{root}/updates")


def last_hour_of_records(
    records: DataFrame, root: str, lateness: str = "1 hour"
) -> DataStreamWriter:
    """Updates of the swept last-hour count of every name in raw ``records``."""
    names = stream_names(records).select("name", F.col("timestamp").alias("ts"))
    return last_hour_updates(swept_counts(names, lateness), f"{root}/updates")


def start_top(
    spark: SparkSession, updates: DataStreamWriter, root: str, every: str = "1 second"
) -> list[StreamingQuery]:
    """Start both queries of a job, a micro-batch ``every`` so often."""
    return [
        start(spark, updates, f"{root}/checkpoint/updates", every),
        start(spark, _top(spark, root), f"{root}/checkpoint/top", every),
    ]


def catch_up_top(spark: SparkSession, updates: DataStreamWriter, root: str) -> None:
    """Run both queries of a job over what is there now, then stop."""
    run_to_end(spark, updates, f"{root}/checkpoint/updates")
    run_to_end(spark, _top(spark, root), f"{root}/checkpoint/top")


def _top(spark: SparkSession, root: str) -> DataStreamWriter:
    return live_top(update_stream(spark, f"{root}/updates/batch=*"), f"{root}/top")
