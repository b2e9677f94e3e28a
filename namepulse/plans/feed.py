"""The given tables as a feed: raw lines, segment files and event streams.

A line packs one row of ``lineitem`` joined to ``part``; its flaws follow from
``l_linenumber``, so that every rule about bad input has rows to act on:

1  three names                     5  exactly 24 fields, one name
2  three names and a stopped one   6  no names, or 23 fields where returned
3  three names, trailing ``;;``    7  month 13
4  an empty entry between two names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse import schema as S
from namepulse.functions.timegrid import quarter_floor, segment_name
from namepulse.session import new_folder
from namepulse.sources.batch import scan_lines

# Stop list of the catalogue: the standing one and two part names.
FEED_STOP = (*S.STOP_NAMES, "small ring", "hot gear")
STREAM_SLICES = (None, "2024-01-11", "2024-01-21", None)
SEGMENT_PATTERN = r"/segment=([^/]+)/"

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as raw lines, scanned from its files."""
    return scan_lines(spark, feed_files(spark, sf_dir))


def pack_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, shipped): the feed as raw lines, and the day to file them under."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    n = F.col("l_linenumber")
    entry = lambda name, offset: F.concat(name, F.lit(f",{offset}"))
    stamp = F.date_format("l_shipdate", S.RECORD_TIME_FORMAT)
    # One select per step: Spark then works each expression out once a row.
    joined = items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        n.alias("n"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_shipdate").alias("shipped"),
        (F.col("l_orderkey") * 8 + n).alias("sequence"),
        stamp.alias("stamp"),
        entry(F.col("p_name"), 1).alias("first"),
        entry(F.col("p_brand"), 2).alias("second"),
        entry(F.col("p_type"), 3).alias("third"),
    )
    n, stamp = F.col("n"), F.col("stamp")
    tail = (
        F.when(n == 2, F.lit("Read Full,9")).when(n == 3, F.lit(";")).otherwise(F.lit(None))
    )
    names = (
        F.when(n == 4, F.concat_ws(";", "first", F.lit(""), "second"))
        .when(n == 5, F.col("first"))
        .when(n == 6, F.lit(""))
        .otherwise(F.concat_ws(";", "first", "second", "third", tail))
    )
    flawed = F.concat(F.substring(stamp, 1, 4), F.lit("13"), F.substring(stamp, 7, 8))
    packed = joined.select(
        "shipped",
        F.when(n == 5, 24)
        .when((n == 6) & F.col("returned"), 23)
        .otherwise(S.N_FIELDS)
        .alias("fields"),
        pack_line(
            F.concat_ws("-", stamp, "sequence"), F.when(n == 7, flawed).otherwise(stamp), names
        ).alias("line"),
    )
    return packed.select(
        F.call_function(
            "substring_index", "line", F.lit(S.FIELD_SEPARATOR), F.col("fields")
        ).alias("value"),
        "shipped",
    )


def pack_line(record_id: Column, stamp: Column, names: Column) -> Column:
    """A 27-field line; the fields nothing reads are empty."""
    fields = [F.lit("")] * S.N_FIELDS
    fields[S.ID_FIELD], fields[S.DATE_FIELD], fields[S.NAMES_FIELD] = record_id, stamp, names
    return F.concat_ws(S.FIELD_SEPARATOR, *fields)


def feed_files(spark: SparkSession, sf_dir: str) -> str:
    """The feed as text files in year and month folders; the folder above."""

    def write(path: str) -> None:
        months = pack_feed(spark, sf_dir).select(
            "value",
            F.date_format("shipped", "yyyy").alias("year"),
            F.date_format("shipped", "yyyyMM").alias("month"),
        )
        # Rebalancing keeps files near one size: a large month is split.
        months.hint("rebalance", "month").write.partitionBy("year", "month").text(path)

    return once(spark, sf_dir, "feed", write)


def event_records(spark: SparkSession, sf_dir: str, name: str = "event_type") -> DataFrame:
    """(id, ts, name) from ``events``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col(name).cast("string").alias("name"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, ts, event_id): each event as a raw line naming its user and type."""
    ts = F.col("ts").cast("timestamp")
    stamp = F.date_format(ts, S.RECORD_TIME_FORMAT)
    names = F.concat(F.col("user_id"), F.lit(",0;"), F.col("event_type"), F.lit(",1"))
    return table(spark, sf_dir, "events").select(
        pack_line(F.concat_ws("-", stamp, "event_id"), stamp, names).alias("value"),
        ts.alias("ts"),
        "event_id",
    )


def segment_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as one folder of lines per segment, in ``event_id`` order."""

    def write(path: str) -> None:
        order = ["day", "hour", "segment", "event_id"]
        (
            event_lines(spark, sf_dir)
            .select(
                "value",
                F.date_format("ts", "yyyyMMdd").alias("day"),
                F.date_format("ts", "HH").alias("hour"),
                segment_name(quarter_floor(F.col("ts"))).alias("segment"),
                "event_id",
            )
            .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
            .sortWithinPartitions(*order)
            .drop("event_id")
            .write.partitionBy("day", "hour", "segment")
            .text(path)
        )

    return once(spark, sf_dir, "segments", write)


def event_stream_files(spark: SparkSession, sf_dir: str, name: str = "event_type") -> tuple[str, int]:
    """(folder, files per slice): (id, ts, name) in three slices in time order.

    Every slice has the same number of files, and a slice is written after the
    one before it, so a stream that takes that many files a trigger takes one
    slice a trigger.
    """
    path = once(
        spark, sf_dir, f"stream-{name}", lambda p: _slices(event_records(spark, sf_dir, name), p)
    )
    return path, _files_per_slice(spark, path)


def record_stream_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """(folder, files per slice): the same slices as raw (key, value, timestamp)."""

    def write(path: str) -> None:
        records = event_lines(spark, sf_dir).select(
            F.split_part("value", F.lit(S.FIELD_SEPARATOR), F.lit(1)).alias("key"),
            "value",
            F.col("ts").alias("timestamp"),
        )
        _slices(records.withColumn("ts", F.col("timestamp")), path, drop="ts")

    path = once(spark, sf_dir, "stream-lines", write)
    return path, _files_per_slice(spark, path)


def _slices(df: DataFrame, path: str, drop: str | None = None) -> None:
    files = df.sparkSession.sparkContext.defaultParallelism
    for low, high in zip(STREAM_SLICES, STREAM_SLICES[1:]):
        part = df
        if low is not None:
            part = part.where(F.col("ts") >= F.lit(low).cast("timestamp"))
        if high is not None:
            part = part.where(F.col("ts") < F.lit(high).cast("timestamp"))
        if drop is not None:
            part = part.drop(drop)
        part.repartition(files).write.mode("append").parquet(path)


def _files_per_slice(spark: SparkSession, path: str) -> int:
    files, slices = len(spark.read.parquet(path).inputFiles()), len(STREAM_SLICES) - 1
    if files % slices:
        raise ValueError(f"{files} files do not make {slices} equal slices in {path}")
    return files // slices


def once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Write a table once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = new_folder(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def forget(spark: SparkSession, sf_dir: str, *labels: str) -> None:
    """Let the next use of these tables write them anew."""
    for label in labels:
        _written.pop((spark.sparkContext.applicationId, sf_dir, label), None)
