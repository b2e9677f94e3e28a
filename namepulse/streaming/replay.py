"""The replay as a job: a clock stream meets a schedule of what each second sends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from namepulse.functions.timegrid import segment_start
from namepulse.sources.stream import RECORD_STREAM_DDL
from namepulse.streaming.run import batch_folder

_DAY = 86_400
SCHEDULE_DDL = f"{RECORD_STREAM_DDL}, second bigint, day bigint"


def write_schedule(replayed: DataFrame, path: str) -> None:
    """Write :func:`~namepulse.operators.replay.replay_records` as a table by second.

    ``second`` is in epoch seconds: the start of the segment's quarter hour and
    the second within it that sends the record. Days are folders, and rows lie
    by second in them, so a second's records are found without reading the rest.
    """
    start = F.unix_seconds(segment_start(F.col("segment")))
    timed = replayed.select(
        "key", "value", "timestamp", (start + F.col("send_second")).alias("second")
    )
    day = F.call_function("div", F.col("second"), F.lit(_DAY)).alias("day")
    placed = timed.select("*", day).repartitionByRange("second").sortWithinPartitions("second")
    placed.write.partitionBy("day").parquet(path)


def wall_seconds(spark: SparkSession) -> DataFrame:
    """A clock stream (value): seconds since the stream first began, real time.
    A stream that was stopped catches up with the seconds it has missed."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select("value")


def stepped_seconds(spark: SparkSession, step: int) -> DataFrame:
    """A clock stream (value) that goes on by ``step`` seconds a micro-batch,
    for a replay faster than real time."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", step)
        .load()
        .select("value")
    )


def paced_replay(seconds: DataFrame, schedule: str, root: str, first_second: int) -> DataStreamWriter:
    """Send each record of ``schedule`` in its second, as a table under ``root``
    that :func:`~namepulse.sources.stream.record_stream` reads.

    The clock ``seconds`` counts from ``first_second``. A micro-batch sends what
    its seconds hold, to a folder of its own, so one that runs again after a
    restart sends nothing twice.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        low, high = batch.agg(F.min("value"), F.max("value")).first()
        if low is None:
            return
        low, high = low + first_second, high + first_second
        due = batch.sparkSession.read.schema(SCHEDULE_DDL).parquet(schedule)
        due = due.where(F.col("day").between(low // _DAY, high // _DAY))
        due.where(F.col("second").between(low, high)).select("key", "value", "timestamp").write.mode(
            "overwrite"
        ).parquet(batch_folder(root, batch_id))

    return seconds.writeStream.foreachBatch(body)
