"""Streaming sources: raw records and count updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse.functions.codec import decode_count

RECORD_STREAM_DDL = "key string, value string, timestamp timestamp"
UPDATE_STREAM_DDL = "key string, value binary, seq bigint"


def record_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Raw records (key, line, event time) from a folder of Parquet files."""
    return _files(spark, path, RECORD_STREAM_DDL, files_per_trigger)


def update_stream(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    since: str | None = None,
) -> DataFrame:
    """Count updates (name, count, seq) from a folder of Parquet files.

    ``since`` skips files written before that time: a new reader that starts
    at the end rather than at the beginning.
    """
    updates = _files(spark, path, UPDATE_STREAM_DDL, files_per_trigger)
    if since is not None:
        updates = updates.where(
            F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp")
        )
    return decode_updates(updates)


def decode_updates(updates: DataFrame) -> DataFrame:
    return updates.select(
        F.col("key").alias("name"), decode_count(F.col("value")).alias("count"), "seq"
    )


def kafka_records(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Raw records from a Kafka topic; needs the Kafka connector on the classpath.

    The event time rides in a header named ``event_ms`` where there is one,
    because Spark's Kafka sink cannot set a message's own timestamp.
    """
    return from_messages(_kafka(spark, servers, topic, {"includeHeaders": "true", **options}))


def from_messages(messages: DataFrame) -> DataFrame:
    sent = F.filter("headers", lambda h: h["key"] == "event_ms")
    millis = F.get(sent, F.lit(0))["value"].cast("string").try_cast("bigint")
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.coalesce(F.timestamp_millis(millis), F.col("timestamp")).alias("timestamp"),
    )


def kafka_updates(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Count updates from a Kafka topic, from the latest offset on by default."""
    first = {"startingOffsets": "latest", "includeHeaders": "true"}
    return from_update_messages(_kafka(spark, servers, topic, {**first, **options}))


def from_update_messages(messages: DataFrame) -> DataFrame:
    """(name, count, seq): ``seq`` from its header where there is one, else the offset."""
    sent = F.filter("headers", lambda h: h["key"] == "seq")
    seq = F.coalesce(decode_count(F.get(sent, F.lit(0))["value"]), F.col("offset"))
    return decode_updates(
        messages.select(F.col("key").cast("string").alias("key"), "value", seq.alias("seq"))
    )


def _files(spark, path, ddl, files_per_trigger):
    reader = spark.readStream.schema(ddl)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _kafka(spark, servers, topic, options):
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
