"""From raw lines to one row per name. All of it runs on batch and stream alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namepulse import schema as S
from namepulse.functions.fields import field, record_time, split_line
from namepulse.functions.names import entry_name, name_entries, not_stopped


def read_fields(lines: DataFrame, *carry: str) -> DataFrame:
    """The three fields in use: ``id``, ``raw_date`` and ``names``. ``carry``
    names columns to keep.

    ``names`` is NULL on a line with too few fields, and a date that is not one
    is NULL further on. Nothing filters here: a filter on a piece of the line
    would be moved down to the scan and cut the line up once more per
    condition. The unusable lines go when their (absent) names are exploded.
    """
    parts = split_line(F.col("value"), S.NAMES_FIELD + 1)
    return lines.select(*carry, parts.alias("_parts")).select(
        *carry,
        field(F.col("_parts"), S.ID_FIELD).alias("id"),
        field(F.col("_parts"), S.DATE_FIELD).alias("raw_date"),
        field(F.col("_parts"), S.NAMES_FIELD).alias("names"),
    )


def keep_lines(read: DataFrame, condition: Column) -> DataFrame:
    """The rows of :func:`read_fields` that meet ``condition``.

    No or one row comes out of each, and no filter is left that would move to
    the scan and cut the line again.
    """
    row = F.struct(*read.columns)
    return read.select(F.inline(F.when(condition, F.array(row))))


def dated_names(lines: DataFrame, *carry: str) -> DataFrame:
    """(id, date, names) of every line; ``names`` is NULL where the line has no
    date or too few fields."""
    dated = read_fields(lines, *carry).select(
        *carry, "id", record_time(F.col("raw_date")).cast("date").alias("date"), "names"
    )
    return dated.withColumn("names", F.when(F.col("date").isNotNull(), F.col("names")))


def dated_names_of_records(records: DataFrame) -> DataFrame:
    """The same from typed records; the reader then parses two columns only."""
    return records.where(F.col("allNames").isNotNull() & F.col("date").isNotNull()).select(
        "id", F.col("date").cast("date").alias("date"), F.col("allNames").alias("names")
    )


def explode_names(
    packed: DataFrame,
    stop: Sequence[str] | DataFrame = S.STOP_NAMES,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per name: every column but ``names``, plus ``word``."""
    kept = [name for name in packed.columns if name != "names"]
    words = packed.select(
        *kept, F.explode(name_entries(F.col("names"), keep_empty)).alias("_entry")
    ).select(*kept, entry_name(F.col("_entry")).alias("word"))
    return drop_stopped(words, stop)


def drop_stopped(words: DataFrame, stop: Sequence[str] | DataFrame) -> DataFrame:
    """Drop stopped words; a stop list too long to spell out comes as a table
    with a ``word`` column and is joined."""
    if isinstance(stop, DataFrame):
        return words.join(stop.select("word"), "word", "left_anti")
    return words.where(not_stopped(F.col("word"), stop))


def names_by_day(
    lines: DataFrame,
    stop: Sequence[str] | DataFrame = S.STOP_NAMES,
    keep_empty: bool = False,
) -> DataFrame:
    """Lines to (id, date, word), one row per counted name."""
    return explode_names(dated_names(lines), stop, keep_empty)


def stream_names(
    records: DataFrame, stop: Sequence[str] | DataFrame = S.STOP_NAMES
) -> DataFrame:
    """Raw stream records to (timestamp, id, name); event time is the record's
    own, so no date is parsed."""
    packed = read_fields(records, "timestamp").drop("raw_date")
    return explode_names(packed, stop).withColumnRenamed("word", "name")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that count for nothing, each with the first reason why."""
    parts = F.split(F.col("value"), S.FIELD_SEPARATOR, S.NAMES_FIELD + 2)
    cut = lines.select("value", parts.alias("_parts"))
    names = field(F.col("_parts"), S.NAMES_FIELD)
    reason = (
        F.when(F.size("_parts") <= S.NAMES_FIELD, "short_line")
        .when(names.rlike(f"^{S.ENTRY_SEPARATOR}*$"), "no_names")
        .when(record_time(field(F.col("_parts"), S.DATE_FIELD)).isNull(), "bad_date")
    )
    # No filter on a piece of the line, which would cut it again: no or one row comes out of each.
    row = F.struct("value", reason.alias("reason"))
    return cut.select(F.inline(F.when(reason.isNotNull(), F.array(row))))
