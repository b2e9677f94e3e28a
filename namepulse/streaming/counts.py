"""Counts kept by native streaming aggregation, and the update topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from namepulse import schema as S
from namepulse.functions.codec import encode_count
from namepulse.operators.histogram import daily_topk
from namepulse.operators.live import name_counts
from namepulse.streaming.run import batch_folder


def count_updates(records: DataFrame, root: str) -> DataStreamWriter:
    """Running count per name, written as a table of updates under ``root``.

    A micro-batch adds one row per name it changed: key (the name), value (the
    count as eight bytes) and seq (rising with the batch).
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.select(
            F.col("name").alias("key"),
            encode_count(F.col("count")).alias("value"),
            F.lit(batch_id).cast("bigint").alias("seq"),
        ).write.mode("overwrite").parquet(batch_folder(root, batch_id))

    return name_counts(records).writeStream.outputMode("update").foreachBatch(body)


def count_updates_to_kafka(records: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """The same to a Kafka topic; needs the Kafka connector on the classpath."""
    updates = name_counts(records).select(
        F.col("name").alias("key"), encode_count(F.col("count")).alias("value")
    )
    return (
        updates.writeStream.outputMode("update")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )


def sliding_hour_stream(records: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """(window_start, window_end, name, n) of each hour, every fifteen minutes.

    Append output gives a window once, when the watermark has passed its end.
    """
    return (
        records.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 hour", f"{S.SEGMENT_MINUTES} minutes"), "name")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "name",
            "n",
        )
    )


def swept_windows(
    records: DataFrame, lateness: str = "1 hour", phase_minutes: int = 0
) -> DataFrame:
    """(name, at_us, here, remaining, lost): the swept last-hour counter as a
    window aggregate, for update or append output.

    A row tells, for the sweep at ``at_us`` and the hour after it: ``lost``
    records that the sweep drops, ``remaining`` ones that it leaves, and those
    ``here`` since. The counter shows ``remaining`` right after the sweep and
    ``remaining + here`` at the end. A record is known to be dropped two sweeps
    on as soon as it arrives, so rows for sweeps to come are there in advance
    and no timer is needed; and the counts combine before the shuffle.
    """
    framed = records.withWatermark("ts", lateness).select(
        "name", "ts", F.window("ts", "3 hours", "1 hour", f"{phase_minutes} minutes").alias("frame")
    )
    sweep = F.col("frame.start") + F.expr("INTERVAL 2 HOURS")
    hour_before = F.col("frame.start") + F.expr("INTERVAL 1 HOUR")
    ts = F.col("ts")
    return (
        framed.groupBy("frame", "name")
        .agg(
            F.count_if(ts >= sweep).alias("here"),
            F.count_if((ts >= hour_before) & (ts < sweep)).alias("remaining"),
            F.count_if(ts < hour_before).alias("lost"),
        )
        .select("name", F.unix_micros(sweep).alias("at_us"), "here", "remaining", "lost")
    )


def window_topk_stream(
    records: DataFrame, lateness: str = "1 hour", k: int = S.DAILY_TOP, shards: int = 8
) -> DataFrame:
    """(window_end, rn, name, n): the ``k`` largest names of each closed hour, as
    one chain of streaming aggregates for append output.

    Counts per window and name, then the best of each shard of a window's names,
    then the best of all. A shard's names are gathered before they are cut, so
    ``shards`` bounds what one group holds.
    """
    shard = F.pmod(F.xxhash64("name"), F.lit(shards))
    entry = F.struct((-F.col("n")).alias("minus"), "name")
    first = lambda entries: F.slice(F.array_sort(entries), 1, k)
    best = (
        records.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 hour", f"{S.SEGMENT_MINUTES} minutes"), "name")
        .agg(F.count("*").alias("n"))
        .groupBy("window", shard.alias("shard"))
        .agg(first(F.collect_list(entry)).alias("best"))
        .groupBy("window")
        .agg(first(F.flatten(F.collect_list("best"))).alias("best"))
    )
    placed = best.select("window.end", F.posexplode("best").alias("place", "entry"))
    return placed.select(
        F.col("end").alias("window_end"),
        (F.col("place") + 1).cast("bigint").alias("rn"),
        "entry.name",
        (-F.col("entry.minus")).alias("n"),
    )


def window_topk(windows: DataFrame, root: str, k: int = S.DAILY_TOP) -> DataStreamWriter:
    """The ``k`` largest names of each closed window, to a table under ``root``.

    A window's rows all close in one micro-batch, so ranking inside the batch
    is final; the ranking cuts each window to ``k`` per task before it shuffles.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        closed = batch.select(
            F.col("window_end").alias("date"),
            F.col("name").alias("word"),
            F.col("n").alias("total"),
        )
        daily_topk(closed, k).withColumnsRenamed(
            {"date": "window_end", "word": "name", "total": "n"}
        ).write.mode("overwrite").parquet(batch_folder(root, batch_id))

    return windows.writeStream.outputMode("append").foreachBatch(body)
