"""The 15-minute segment grid, and the pacing of a replay along it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from namepulse import schema as S

_MILLIS = S.SEGMENT_MINUTES * 60 * 1000


def quarter_floor(when: Column) -> Column:
    """Start of the segment that ``when`` lies in."""
    return F.timestamp_millis(_floor_millis(when))


def quarter_next(when: Column) -> Column:
    """First segment start strictly after ``when``."""
    return F.timestamp_millis(_floor_millis(when) + F.lit(_MILLIS))


def _floor_millis(when: Column) -> Column:
    millis = F.unix_millis(when)
    return millis - F.pmod(millis, F.lit(_MILLIS))


def segment_start(record_id: Column) -> Column:
    """Minute in UTC named by the first twelve digits of a record id, seconds zero."""
    minute = F.concat(F.substring(record_id, 1, 12), F.lit("+00:00"))
    return F.try_to_timestamp(minute, F.lit(S.SEGMENT_TIME_FORMAT + "XXX"))


def segment_name(start: Column) -> Column:
    """The segment's file name, in UTC whatever the session's zone: seconds from the epoch on a time without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    since = F.make_dt_interval(secs=F.unix_seconds(start).cast("decimal(18,6)"))
    digits = F.regexp_replace((epoch + since).cast("string"), "[^0-9]", "")
    return F.concat(F.substring(digits, 1, len(S.SEGMENT_TIME_FORMAT)), F.lit(S.SEGMENT_SUFFIX))


def segment_list(now: Column, minutes: int = S.LOOKBACK_MINUTES) -> Column:
    """Names of the finished segments of the last ``minutes``, oldest first."""
    first = quarter_floor(now) - F.expr(f"INTERVAL {minutes} MINUTES")
    last = quarter_floor(now) - F.expr(f"INTERVAL {S.SEGMENT_MINUTES} MINUTES")
    if minutes < S.SEGMENT_MINUTES:
        return F.array().cast("array<string>")
    starts = F.sequence(first, last, F.expr(f"INTERVAL {S.SEGMENT_MINUTES} MINUTES"))
    return F.transform(starts, segment_name)


def seconds_left(now: Column) -> Column:
    """Whole seconds to the next segment start, at least one."""
    left = F.unix_millis(quarter_next(now)) - F.unix_millis(now)
    return F.greatest(_div(left, F.lit(1000)), F.lit(1).cast("bigint"))


def replay_rate(queued: Column, now: Column) -> Column:
    """Records to send in the second that starts at ``now``."""
    return _div(queued, seconds_left(now))


def replay_second(position: Column, queued: Column, seconds: Column) -> Column:
    """Which second (from 0) sends the record at ``position`` (from 0).

    Every second sends (records left) div (seconds left). That drains a queue
    of ``a * seconds + b`` records by sending ``a`` a second until ``b``
    seconds are left, and ``a + 1`` a second from there on, so the second of a
    record follows from its position alone.
    """
    base, rest = _div(queued, seconds), F.pmod(queued, seconds)
    slow_seconds = seconds - rest
    slow_records = base * slow_seconds
    return F.when(
        position < slow_records, _div(position, F.greatest(base, F.lit(1)))
    ).otherwise(slow_seconds + _div(position - slow_records, base + F.lit(1)))


def spread_time(start: Column, position: Column, total: Column) -> Column:
    """Event time (epoch ms) of the record at ``position`` (from 0) of ``total``."""
    return F.unix_millis(start) + position * _div(F.lit(_MILLIS), total)


def _div(left: Column, right: Column) -> Column:
    return F.call_function("div", left, right)
