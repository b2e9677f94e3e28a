"""Starting streaming queries, and reading what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from namepulse.session import ROCKSDB, settings

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start(
    spark: SparkSession, writer: DataStreamWriter, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start a query: every ``every`` (such as ``"15 minutes"``), or, without
    it, over what is there now and then stop. State is durable either way.

    ``spark`` is the session of the stream's frame. The active session may be
    another one, such as a micro-batch's, and its settings would not count.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with settings(spark, STATE_SETTINGS):
        return writer.start()


def run_to_end(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    query = start(spark, writer, checkpoint)
    query.awaitTermination()
    return query


def batch_folder(root: str, batch_id: int) -> str:
    """Where a micro-batch writes. A batch that runs again after a failure
    overwrites the same folder, so nothing is written twice."""
    return f"{root}/batch={batch_id}"


def write_batches(df: DataFrame, root: str) -> DataStreamWriter:
    """Write every micro-batch of ``df`` to its own folder under ``root``."""

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(root, batch_id))

    return df.writeStream.foreachBatch(body)
