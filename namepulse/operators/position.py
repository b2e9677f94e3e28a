"""The place of every row within its key, however large the key's group is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namepulse.session import settle


def position_within(
    df: DataFrame,
    key: list[str],
    order: list[str],
    out: str,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: 1, 2, 3 ... by ``order`` within each ``key``. Ties take any
    order. ``per_key`` holds further columns by key to add to the rows.

    Keys of every size go the same way: range-partition on (key, order), which
    cuts a key over as many partitions as it needs. The row id in the sorted
    partition gives the place in the cut, and a table of cuts (one row per key
    and partition) gives the rows in front of it. The sorted rows are settled,
    so that both see the same cuts.
    """
    sort = key + order + ["_tie"]
    placed = settle(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .drop("_tie")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_cut", F.shiftright("_row", 33)),
        "placed",
    )
    earlier = (
        Window.partitionBy(*key).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    )
    cuts = (
        placed.groupBy(*key, "_cut")
        .agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    if per_key is not None:
        cuts = match_keys(cuts, per_key, key, "left")
    place = F.col("_row") - F.col("_first") + F.col("_before") + 1
    return (
        match_keys(placed, cuts, key + ["_cut"], "left")
        .withColumn(out, place)
        .drop("_row", "_cut", "_first", "_before")
    )


def match_keys(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join on ``key`` with NULL equal to NULL; the key columns come once."""
    theirs = {name: f"_right_{name}" for name in key}
    right = right.withColumnsRenamed(theirs)
    same = reduce(
        lambda a, b: a & b, [F.col(mine).eqNullSafe(F.col(their)) for mine, their in theirs.items()]
    )
    return left.join(right, same, how).drop(*theirs.values())
