"""Replaying segments as a stream: an event time and a send second per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namepulse.functions.fields import record_key
from namepulse.functions.timegrid import replay_second, segment_start, spread_time
from namepulse.schema import FIRST_RECORD_KEY, SEGMENT_MINUTES
from namepulse.sources.segments import segment_splits


def spread_timestamps(lines: DataFrame) -> DataFrame:
    """Spread each segment's lines evenly over its fifteen minutes.

    Takes :func:`segment_lines`; gives ``segment``, ``value``, ``position``
    (from 0 in the segment), ``segment_lines`` and ``event_ms``. The segment
    starts at the minute its first record's id names.
    """
    splits = segment_splits(lines).drop("segment")
    position = F.col("read_id") - F.col("first_read_id") + F.col("lines_before")
    return (
        lines.join(splits, ["path", "block"])
        .withColumn("position", position)
        .select(
            "segment",
            "value",
            "position",
            "segment_lines",
            spread_time(
                segment_start(F.col("first_minute")), F.col("position"), F.col("segment_lines")
            ).alias("event_ms"),
        )
    )


def replay_records(spread: DataFrame, seconds: int = SEGMENT_MINUTES * 60) -> DataFrame:
    """What the producer sends: (key, value, timestamp, send_second).

    ``send_second`` counts from the start of the replay of a segment that has
    ``seconds`` to go out.
    """
    return spread.select(
        "segment",
        record_key(F.col("value")).alias("key"),
        "value",
        F.timestamp_millis("event_ms").alias("timestamp"),
        replay_second(
            F.col("position"), F.col("segment_lines"), F.lit(seconds).cast("bigint")
        ).alias("send_second"),
    )


def replay_messages(replayed: DataFrame) -> DataFrame:
    """Rows for a Kafka sink: key, value and the event time as a header, which
    is where ``kafka_records`` looks for it."""
    event_ms = F.unix_millis("timestamp").cast("string")
    header = F.struct(F.lit("event_ms").alias("key"), F.encode(event_ms, "UTF-8").alias("value"))
    return replayed.select("key", "value", F.array(header).alias("headers"))


def send_to_kafka(replayed: DataFrame, servers: str, topic: str) -> None:
    """Send a replay to a topic; needs the Kafka connector on the classpath."""
    (
        replay_messages(replayed)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )


def last_key(records: DataFrame, offset: str, *by: str) -> DataFrame:
    """Key of the record with the largest offset, per ``by`` or overall; the
    feed's first key where there is no record."""
    found = F.coalesce(F.max_by("key", offset), F.lit(FIRST_RECORD_KEY)).alias("last_key")
    return records.groupBy(*by).agg(found)
