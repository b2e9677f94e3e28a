"""The live top list as a stream: a snapshot table and a feed of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from namepulse import schema as S
from namepulse.operators.live import (
    delta_json,
    name_counts,
    top_names,
    topk_delta,
)
from namepulse.streaming.run import batch_folder
from namepulse.streaming.shortlist import LIST_DDL, SHARDS, shard_lists

ENTRY_DDL = "name string, count bigint"
SNAPSHOT_DDL = "batch bigint, top array<struct<name: string, count: bigint>>"
SLOTS = 16


def live_top(
    updates: DataFrame, root: str, k: int = S.LIVE_TOP, shards: int = SHARDS
) -> DataStreamWriter:
    """Top list over a stream of count updates (name, count, seq).

    Counts may fall, and then a name long silent can come back into the list.
    Names are kept in shards, each with a short list of its best
    (:func:`shard_lists`), so a trigger touches the names it changes and the
    lists of their shards; the top list is merged from all lists, ``k`` names a
    shard. The newest lists are a table beside the snapshots.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        # Written first: what follows reads it more than once, and state must be gone through once.
        changed = f"{root}/changed/slot={batch_id % SLOTS}"
        batch.write.mode("overwrite").parquet(changed)
        new = batch.sparkSession.read.schema(LIST_DDL).parquet(changed)
        lists = _shard_lists(batch.sparkSession, root, batch_id - 1).join(
            new.select("shard"), "shard", "left_anti"
        )
        lists.unionByName(new).withColumn("batch", F.lit(batch_id).cast("bigint")).coalesce(
            1
        ).write.mode("overwrite").parquet(_lists_slot(root, batch_id))
        entries = _shard_lists(batch.sparkSession, root, batch_id).select(
            F.inline(F.arrays_zip(F.col("names").alias("name"), F.col("counts").alias("count")))
        )
        _publish(top_names(entries, k), root, batch_id)

    return shard_lists(updates, k, shards).writeStream.outputMode("update").foreachBatch(body)


def _lists_slot(root: str, batch_id: int) -> str:
    return f"{root}/lists/slot={batch_id % SLOTS}"


def _shard_lists(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The shards' lists after a recent micro-batch; empty before the first."""
    if batch_id < 0:
        return spark.range(0).select(
            F.lit(None).cast("int").alias("shard"),
            F.lit(None).cast("array<string>").alias("names"),
            F.lit(None).cast("array<bigint>").alias("counts"),
        )
    lists = spark.read.schema(f"{LIST_DDL}, batch bigint").parquet(_lists_slot(root, batch_id))
    return lists.where(F.col("batch") == batch_id).drop("batch")


def top_from_state(
    spark: SparkSession, checkpoint: str, k: int = S.LIVE_TOP, shards: bool = True
) -> DataFrame:
    """The top list as the durable state of a stopped query has it, read as a
    table: of :func:`live_top`, or of :func:`rising_top` where ``shards`` is
    off. Needs neither snapshots nor updates."""
    state = spark.read.format("statestore")
    if not shards:
        counts = state.load(checkpoint).select(
            "key.name", F.col("value.*")
        ).toDF("name", "count")
        return top_names(counts, k)
    counts = state.option("stateVarName", "counts").load(checkpoint)
    stored = F.col("user_map_key.name")
    name = F.when(stored != "", F.substring(stored, 2, 1 << 30))
    return top_names(counts.select(name.alias("name"), F.col("user_map_value.count").alias("count")), k)


def rebuild_snapshot(spark: SparkSession, root: str, top: DataFrame, batch_id: int) -> None:
    """Write ``top`` as the list after a micro-batch, as if the snapshot had never been lost."""
    _write_snapshot(top, root, batch_id)


def rising_top(records: DataFrame, root: str, k: int = S.LIVE_TOP) -> DataStreamWriter:
    """Top list of running counts over a stream of (name, ...).

    A running count never falls, so a name that has not changed cannot enter
    the list. The new list comes from the list before it and the ``k`` largest
    of the changed counts; of two counts for one name the larger is the newer.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        before = read_snapshot(batch.sparkSession, root, batch_id - 1)
        merged = before.unionByName(top_names(batch, k)).groupBy("name").agg(
            F.max("count").alias("count")
        )
        _publish(top_names(merged, k), root, batch_id)

    return name_counts(records).writeStream.outputMode("update").foreachBatch(body)


def read_snapshot(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The list after a recent micro-batch; empty before the first."""
    if batch_id < 0:
        # Not createDataFrame, which would make a micro-batch's session the active one.
        return spark.range(0).select(
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("bigint").alias("count")
        )
    snapshot = spark.read.schema(SNAPSHOT_DDL).parquet(_slot(root, batch_id))
    return snapshot.where(F.col("batch") == batch_id).select(F.inline("top"))


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """What a new reader gets: the list as of the newest micro-batch. A slot
    that is being rewritten is passed over; it holds the oldest list."""
    snapshots = (
        spark.read.schema(SNAPSHOT_DDL)
        .option("ignoreMissingFiles", "true")
        .parquet(f"{root}/snapshot/slot=*")
    )
    return snapshots.agg(F.max_by("top", "batch").alias("top")).select(F.inline("top"))


def read_deltas(spark: SparkSession, root: str) -> DataFrame:
    """(batch, name, count) of every change so far; count 0 is "gone"."""
    return spark.read.schema(ENTRY_DDL + ", batch bigint").parquet(f"{root}/delta")


def read_messages(spark: SparkSession, root: str) -> DataFrame:
    """(batch, message): the JSON message of every micro-batch that changed."""
    return delta_json(read_deltas(spark, root), "batch").select("batch", "message")


def _publish(top: DataFrame, root: str, batch_id: int) -> None:
    """Write a micro-batch's list and what changed since the one before.

    Lists go round a fixed number of slots, one row each (a list is short, and
    an empty one is a row too). The slot before is left alone, so a micro-batch
    that runs again finds what it found the first time.
    """
    spark = top.sparkSession
    _write_snapshot(top, root, batch_id)
    change = topk_delta(
        read_snapshot(spark, root, batch_id - 1), read_snapshot(spark, root, batch_id)
    )
    # At most two lists long: one small file.
    change.coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{root}/delta", batch_id))


def _write_snapshot(top: DataFrame, root: str, batch_id: int) -> None:
    entries = F.collect_list(F.struct("name", "count")).alias("top")
    top.agg(entries).select(F.lit(batch_id).cast("bigint").alias("batch"), "top").write.mode(
        "overwrite"
    ).parquet(_slot(root, batch_id))


def _slot(root: str, batch_id: int) -> str:
    return f"{root}/snapshot/slot={batch_id % SLOTS}"
