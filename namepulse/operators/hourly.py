"""Counts per name over time, in batch. Input rows are (name, ts, id).

``ts`` is a TIMESTAMP. The two forms of "the last hour" differ: the exact one
looks back sixty minutes from each record; the sweep form is what a counter
gives that is swept once an hour of everything older than an hour, so it holds
the current hour so far and all of the hour before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namepulse.operators.position import match_keys, position_within

_HOUR_US = 3_600_000_000
_MINUTE_US = 60_000_000
_SECOND_US = 1_000_000
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def hour_start_us(ts: Column, phase_minutes: int = 0) -> Column:
    """Start of the sweep interval of ``ts`` in epoch microseconds."""
    shift = phase_minutes * _MINUTE_US
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros - F.lit(shift), F.lit(_HOUR_US))


def count_by_name_ts(records: DataFrame) -> DataFrame:
    """(name, ts, n): records per name and event time."""
    return records.groupBy("name", "ts").agg(F.count("*").alias("n"))


def running_count(records: DataFrame) -> DataFrame:
    """Every record with its name's count so far, itself included."""
    return position_within(records, ["name"], ["ts", "id"], "running_count")


def last_hour_exact(records: DataFrame) -> DataFrame:
    """(name, ts, n, last_hour): for each event time of a name, the records at
    it and those in the hour up to and including it.

    The hour's count is the running total at ``ts`` less the running total just
    before ``ts`` minus an hour, with probes placed an hour back. (A sliding
    RANGE frame would add up the whole hour again for every row.)

    A running total is that of the earlier hours, plus the earlier seconds of
    the hour, plus what came so far in the second. Records combine per event
    time before the shuffle, so the clock bounds each pass, not the name's
    popularity: the ticks of a second, the seconds of an hour, the hours of a
    name.
    """
    steps = (
        _adds_and_probes(count_by_name_ts(records))
        .withColumn("second", _piece("at", _SECOND_US))
        .withColumn("hour", _piece("at", _HOUR_US))
    )
    seconds = steps.groupBy("name", "hour", "second").agg(F.sum("step").alias("_steps"))
    hours = seconds.groupBy("name", "hour").agg(F.sum("_steps").alias("_hour_steps"))
    hours = hours.select("name", "hour", _earlier("_hour_steps", "hour", "name").alias("_hours"))
    before = match_keys(
        seconds.withColumn("_seconds", _earlier("_steps", "second", "name", "hour")),
        hours,
        ["name", "hour"],
        "inner",
    ).select("name", "second", (F.col("_hours") + F.col("_seconds")).alias("_before"))
    so_far = Window.partitionBy("name", "second").orderBy("at", "kind").rowsBetween(*_UP_TO_HERE)
    return _last_hour(
        steps.withColumn("_so_far", F.sum("step").over(so_far))
        .transform(match_keys, before, ["name", "second"], "inner")
        .withColumn("_total", F.col("_so_far") + F.col("_before"))
    )


def _piece(at: str, length_us: int) -> Column:
    return F.col(at) - F.pmod(at, F.lit(length_us))


def _earlier(what: str, order: str, *key: str) -> Column:
    """The sum of ``what`` over the key's rows ahead of this one."""
    ahead = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(what).over(ahead), F.lit(0))


def _adds_and_probes(counts: DataFrame) -> DataFrame:
    """Two steps per count: the count itself at its time (kind 1), and a probe
    that adds nothing an hour earlier (kind 0), ahead of any count there."""
    add = F.struct(F.col("of").alias("at"), F.lit(1).alias("kind"), F.col("n").alias("step"))
    probe = F.struct(
        (F.col("of") - _HOUR_US).alias("at"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias("step"),
    )
    return counts.withColumn("of", F.unix_micros("ts")).select(
        "name", "of", F.inline(F.array(add, probe))
    )


def _last_hour(totals: DataFrame) -> DataFrame:
    """Pair each count with its probe."""
    return (
        totals.groupBy("name", "of")
        .agg(
            F.sum("step").alias("n"),
            F.max(F.when(F.col("kind") == 1, F.col("_total"))).alias("_upto"),
            F.max(F.when(F.col("kind") == 0, F.col("_total"))).alias("_before_hour"),
        )
        .select(
            "name",
            F.timestamp_micros("of").alias("ts"),
            "n",
            (F.col("_upto") - F.col("_before_hour")).alias("last_hour"),
        )
    )


def hour_counts(records: DataFrame, phase_minutes: int = 0) -> DataFrame:
    """(name, hour_us, n): records per name and sweep interval."""
    return (
        records.select("name", hour_start_us(F.col("ts"), phase_minutes).alias("hour_us"))
        .groupBy("name", "hour_us")
        .agg(F.count("*").alias("n"))
    )


def last_hour_sweep(records: DataFrame, phase_minutes: int = 0) -> DataFrame:
    """Every record with the count a swept counter shows right after it: the
    name's records of this sweep interval so far, and all of the one before."""
    staged = records.withColumn("hour_us", hour_start_us(F.col("ts"), phase_minutes))
    previous = hour_counts(records, phase_minutes).select(
        "name", (F.col("hour_us") + _HOUR_US).alias("hour_us"), F.col("n").alias("_previous")
    )
    placed = position_within(
        staged,
        ["name", "hour_us"],
        ["ts", "id"],
        "_place",
        per_key=previous,
    )
    return placed.withColumn(
        "last_hour", F.col("_place") + F.coalesce("_previous", F.lit(0))
    ).drop("_place", "_previous", "hour_us")


def last_hour_by_interval(records: DataFrame, phase_minutes: int = 0) -> DataFrame:
    """(name, hour_us, last_hour): the swept count after a name's last record
    of each interval it occurs in."""
    counts = hour_counts(records, phase_minutes)
    return _with_neighbour(counts, -_HOUR_US).select(
        "name", "hour_us", (F.col("n") + F.col("_other")).alias("last_hour")
    )


def sweep_updates(records: DataFrame, phase_minutes: int = 0) -> DataFrame:
    """(name, sweep_us, remaining): what each sweep reports, namely the names
    that lose records to it and the count each has left."""
    counts = hour_counts(records, phase_minutes)
    return _with_neighbour(counts, _HOUR_US).select(
        "name",
        (F.col("hour_us") + 2 * _HOUR_US).alias("sweep_us"),
        F.col("_other").alias("remaining"),
    )


def _with_neighbour(counts: DataFrame, distance: int) -> DataFrame:
    """Add ``_other``: the name's count ``distance`` away, 0 where none."""
    other = counts.select(
        "name", (F.col("hour_us") - distance).alias("hour_us"), F.col("n").alias("_other")
    )
    return match_keys(counts, other, ["name", "hour_us"], "left").withColumn(
        "_other", F.coalesce("_other", F.lit(0))
    )


def expired_entries(counts: DataFrame, swept_at: Column) -> DataFrame:
    """Entries of :func:`count_by_name_ts` that a sweep at ``swept_at`` drops:
    strictly more than an hour old."""
    return counts.where(F.col("ts") < swept_at - F.expr("INTERVAL 1 HOUR"))


def tumbling_quarter(records: DataFrame) -> DataFrame:
    """(window_start, name, n) per fifteen-minute segment. Batch or stream."""
    return (
        records.groupBy(F.window("ts", "15 minutes"), "name")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "name", "n")
    )


def sliding_hour(records: DataFrame) -> DataFrame:
    """(window_start, window_end, name, n) per hour, sliding by fifteen minutes.

    Counts fifteen-minute pieces first and adds each piece to the four hours
    that hold it, so the fourfold copy is of pieces, not of records.
    """
    pieces = tumbling_quarter(records)
    starts = F.sequence(
        F.col("window_start") - F.expr("INTERVAL 45 MINUTES"),
        F.col("window_start"),
        F.expr("INTERVAL 15 MINUTES"),
    )
    return (
        pieces.select(F.explode(starts).alias("window_start"), "name", "n")
        .groupBy("window_start", "name")
        .agg(F.sum("n").alias("n"))
        .select(
            "window_start",
            (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
            "name",
            "n",
        )
    )
