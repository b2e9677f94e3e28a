"""Fields of a raw line and the values inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from namepulse import schema as S


def split_line(value: Column, needed: int | None = None) -> Column:
    """All tab-separated fields, trailing empty ones included.

    With ``needed`` the first ``needed`` fields are cut off exactly and the
    rest of the line stays in one last piece, which is cheaper on wide lines.
    """
    return F.split(value, S.FIELD_SEPARATOR, -1 if needed is None else needed + 1)


def field(parts: Column, position: int) -> Column:
    return F.get(parts, F.lit(position))


def record_key(value: Column) -> Column:
    return F.split_part(value, F.lit(S.FIELD_SEPARATOR), F.lit(1))


def record_time(text: Column) -> Column:
    """The record's time, or NULL where the text is not one."""
    return F.try_to_timestamp(text, F.lit(S.RECORD_TIME_FORMAT))


def day_text(when: Column) -> Column:
    return F.date_format(when, S.DAY_FORMAT)


def parse_record_id(record_id: Column) -> Column:
    """``<time>-<sequence>`` as a struct of two longs, (0, 0) when malformed."""
    pattern = r"^([+]?\d+)-([+]?\d+)-*$"
    stamp, number = (
        F.regexp_extract(record_id, pattern, group).try_cast("bigint") for group in (1, 2)
    )
    usable = stamp.isNotNull() & number.isNotNull()
    return F.struct(
        F.when(usable, stamp).otherwise(F.lit(0).cast("bigint")).alias("stamp"),
        F.when(usable, number).otherwise(F.lit(0).cast("bigint")).alias("number"),
    )


def pseudo_key(name: Column, when: Column) -> Column:
    """A (name, event time) key; a struct, so names may hold any character."""
    return F.struct(name.alias("name"), F.unix_millis(when).alias("ts_ms"))


def pseudo_key_text(key: Column) -> Column:
    return F.concat_ws(S.ENTRY_SEPARATOR, key["name"], key["ts_ms"].cast("string"))


def parse_pseudo_key(text: Column) -> Column:
    """Inverse of :func:`pseudo_key_text`; the time is what follows the last separator."""
    return F.struct(
        F.regexp_extract(text, r"(?s)^(.*);(-?\d+)$", 1).alias("name"),
        F.regexp_extract(text, r"(?s)^(.*);(-?\d+)$", 2).try_cast("bigint").alias("ts_ms"),
    )
