"""The live top list: its rows, its minimum, and what changed between two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namepulse.schema import LIVE_TOP


def name_counts(records: DataFrame) -> DataFrame:
    """(name, count). Batch or stream."""
    return records.groupBy("name").agg(F.count("*").alias("count"))


def latest_per_name(updates: DataFrame) -> DataFrame:
    """(name, count) after all updates (name, count, seq): the last one wins.
    Batch or stream."""
    return updates.groupBy("name").agg(F.max_by("count", "seq").alias("count"))


def top_names(counts: DataFrame, k: int = LIVE_TOP) -> DataFrame:
    """The ``k`` names with the largest counts, ties by name; gone names never."""
    return counts.where("count > 0").orderBy(F.desc("count"), "name").limit(k)


def topk_minimum(top: DataFrame) -> DataFrame:
    """One row: the entry that a newcomer has to beat, and how many there are."""
    return top.agg(
        F.min_by("name", F.struct("count", "name")).alias("name"),
        F.min("count").alias("count"),
        F.count("*").alias("size"),
    )


def topk_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(name, count) of what changed between two top lists; count 0 is "gone"."""
    old = before.select(F.col("name").alias("_name"), F.col("count").alias("_old"))
    new = after.select("name", F.col("count").alias("_new"))
    # A NULL name is a name: where the new list has the row, its name counts.
    name = F.when(F.col("_new").isNull(), F.col("_name")).otherwise(F.col("name"))
    return (
        old.join(new, F.col("_name").eqNullSafe(F.col("name")), "full_outer")
        .where(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(name.alias("name"), F.coalesce("_new", F.lit(0)).alias("count"))
    )


def delta_json(delta: DataFrame, *by: str) -> DataFrame:
    """One JSON array of ``{"name":..,"count":..}`` per ``by`` (or overall), in
    name order; no row at all where nothing changed.

    A delta holds at most twice the length of the top list.
    """
    changes = F.array_sort(F.collect_list(F.struct("name", "count")))
    return (
        delta.groupBy(*by)
        .agg(F.to_json(changes).alias("message"), F.count("*").alias("changes"))
        .where("changes > 0")
    )
