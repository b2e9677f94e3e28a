"""Segments: which exist, which are new, and their lines in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namepulse.functions.codec import clean_utf8
from namepulse.sources.batch import raw_lines


def new_segments(candidates: DataFrame, present: DataFrame, fed: DataFrame) -> DataFrame:
    """Candidate segments that still need work.

    ``to_fetch`` marks those not ``present`` yet; ``to_feed`` those past the last
    one ``fed``, which are the only ones that may go into the stream in order. A
    segment may be present and not fed.
    """
    last = fed.agg(F.max("segment")).scalar()
    here = present.select("segment", F.lit(True).alias("present")).distinct()
    return (
        candidates.select("segment")
        .distinct()
        .join(here, "segment", "left")
        .select(
            "segment",
            F.col("present").isNull().alias("to_fetch"),
            (F.col("segment") > F.coalesce(last, F.lit(""))).alias("to_feed"),
        )
        .where("to_fetch OR to_feed")
    )


def segment_lines(spark: SparkSession, paths, segment_pattern: str) -> DataFrame:
    """Lines with the segment they belong to and where they were read.

    ``segment_pattern`` takes the segment's name out of the file path, so a
    segment may be one file or a folder of files named in order. Columns:
    ``value``, ``segment``, ``path``, ``block`` (offset of the input split) and
    ``read_id``, which rises by one from line to line of a split. Malformed
    bytes are dropped.
    """
    return raw_lines(spark, paths).select(
        clean_utf8(F.col("value")).alias("value"),
        F.regexp_extract("_metadata.file_path", segment_pattern, 1).alias("segment"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("read_id"),
    )


def segment_splits(lines: DataFrame) -> DataFrame:
    """One row per input split: its first read id, the lines before it in its
    segment, the lines of the whole segment, and the minute its first id names.

    The table grows with the number of splits, not of lines. The minute is
    picked as a number, which keeps the count over the lines a hash aggregate.
    """
    minute = F.substring("value", 1, 12).try_cast("bigint")
    splits = lines.groupBy("segment", "path", "block").agg(
        F.count("*").alias("n"),
        F.min("read_id").alias("first_read_id"),
        F.min_by(minute, "read_id").alias("minute"),
    )
    in_order = Window.partitionBy("segment").orderBy("path", "block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return splits.select(
        "segment",
        "path",
        "block",
        "first_read_id",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before"),
        F.sum("n").over(whole).alias("segment_lines"),
        F.first("minute").over(whole).cast("string").alias("first_minute"),
    )
