"""Counts over time against record-by-record simulation."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namepulse.operators import hourly
from namepulse.operators.position import position_within

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
HOUR = dt.timedelta(hours=1)
DDL = "id bigint, ts timestamp, name string"


def random_records(seed, n=400, minutes=400, hot="hot"):
    """A third of the rows has one name; many share an event time."""
    rng = random.Random(seed)
    return [
        (
            i,
            START + dt.timedelta(minutes=rng.randint(0, minutes)),
            hot if rng.random() < 1 / 3 else rng.choice("abcdefgh"),
        )
        for i in range(n)
    ]


def frame(spark, records):
    return spark.createDataFrame(records, DDL).repartition(5)


def simulate_sweep(records, phase=0):
    """Counter swept on the hour (plus ``phase``) of all older than an hour."""
    ordered = sorted(records, key=lambda r: (r[1], r[0]))
    sweep = START + dt.timedelta(minutes=phase)
    held, after, reports = {}, {}, []
    for record_id, ts, name in ordered:
        while sweep <= ts:
            for key, entries in held.items():
                kept = [t for t in entries if not sweep - t > HOUR]
                if len(kept) < len(entries):
                    reports.append((key, sweep, len(kept)))
                held[key] = kept
            sweep += HOUR
        held.setdefault(name, []).append(ts)
        after[record_id] = len(held[name])
    return after, reports


def micros(ts):
    return round(ts.timestamp() * 1_000_000)


@pytest.mark.parametrize("phase", [0, 25])
def test_sweep_equals_simulation(spark, phase):
    # The sweep's own boundary: nothing falls exactly an hour before a sweep.
    records = [(i, ts + dt.timedelta(seconds=7), name) for i, ts, name in random_records(phase)]
    after, reports = simulate_sweep(records, phase)
    counted = hourly.last_hour_sweep(frame(spark, records), phase)
    assert {r.id: r.last_hour for r in counted.collect()} == after
    last = max(ts for _, ts, _ in records)
    updates = hourly.sweep_updates(frame(spark, records), phase).where(
        F.col("sweep_us") <= micros(last)
    )
    assert sorted(map(tuple, updates.collect())) == sorted(
        (name, micros(sweep), n) for name, sweep, n in reports
    )


def test_last_hour_counts_equal_times_and_the_hour_edge(spark):
    records = random_records(3)
    expected = {}
    for _, ts, name in records:
        mine = [t for _, t, other in records if other == name]
        expected[name, ts] = (mine.count(ts), sum(ts - HOUR <= t <= ts for t in mine))
    rows = hourly.last_hour_exact(frame(spark, records)).select(
        "name", F.unix_micros("ts").alias("us"), "n", "last_hour"
    )
    assert {(r.name, r.us): (r.n, r.last_hour) for r in rows.collect()} == {
        (name, micros(ts)): value for (name, ts), value in expected.items()
    }


def test_running_count_of_a_hot_name(spark):
    records = random_records(4)
    rows = hourly.running_count(frame(spark, records)).collect()
    by_name = {}
    for row in sorted(rows, key=lambda r: (r.ts, r.id)):
        by_name.setdefault(row.name, []).append(row.running_count)
    assert sum(map(len, by_name.values())) == len(records)
    assert all(counts == list(range(1, len(counts) + 1)) for counts in by_name.values())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(0, 2)),
        min_size=1,
        max_size=60,
    )
)
def test_positions_with_copies_and_null_keys(spark, rows):
    df = spark.createDataFrame(rows, "key string, at int, payload int").repartition(3)
    result = position_within(df, ["key"], ["at"], "place").collect()
    assert sorted(map(repr, ((r.key, r.at, r.payload) for r in result))) == sorted(map(repr, rows))
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in result if r.key == key), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, len(mine) + 1))
        assert [r.at for r in mine] == sorted(r.at for r in mine)


def test_large_keys_are_cut_up(spark):
    """No task of the sorted table holds a hot key whole."""
    rows = [(i, START, "hot") for i in range(3000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = position_within(frame(spark, rows), ["name"], ["ts", "id"], "place")
        cuts = df.inputFiles()
        places = sorted(r.place for r in df.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert places == list(range(1, 3001))
    assert len([path for path in cuts if "placed-" in path]) >= 4


def test_sliding_hour_equals_four_quarters(spark):
    records = random_records(5)
    windows = hourly.sliding_hour(frame(spark, records)).select(
        F.unix_micros("window_start").alias("s"), "name", "n"
    )
    native = (
        frame(spark, records)
        .groupBy(F.window("ts", "1 hour", "15 minutes").alias("w"), "name")
        .count()
        .select(F.unix_micros("w.start"), "name", "count")
    )
    assert sorted(map(tuple, windows.collect())) == sorted(map(tuple, native.collect()))


def test_expired_is_strictly_older(spark):
    rows = [(1, START, "edge"), (2, START - dt.timedelta(microseconds=1), "old")]
    entries = hourly.count_by_name_ts(frame(spark, rows))
    swept_at = F.lit("2024-01-01 01:00:00").cast("timestamp")
    assert [r.name for r in hourly.expired_entries(entries, swept_at).collect()] == ["old"]
