"""NULL names count like any other, and the segment grid is in UTC under any session zone."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from namepulse.functions import timegrid
from namepulse.operators import hourly, live, unpack
from namepulse.session import settings


def records(spark, name):
    times = [datetime(2024, 1, 1, 10, m) for m in (0, 5, 5, 50)] + [datetime(2024, 1, 1, 11, 20)]
    rows = [(i, name, t) for i, t in enumerate(times)] + [(9, "other", times[0])]
    return spark.createDataFrame(rows, "id long, name string, ts timestamp")


def test_last_hour_of_a_null_name(spark):
    counts = [
        sorted(tuple(r)[1:] for r in hourly.last_hour_exact(records(spark, name)).collect())
        for name in (None, "real")
    ]
    assert counts[0] == counts[1] and len(counts[0]) == 5


def test_sweeps_of_a_null_name(spark):
    for operator in (hourly.last_hour_by_interval, hourly.sweep_updates):
        null, real = (sorted(tuple(r)[1:] for r in operator(records(spark, n)).collect()) for n in (None, "real"))
        assert null == real


def test_an_unchanged_null_name_is_no_change(spark):
    before = spark.createDataFrame([(None, 3), ("a", 2)], "name string, count long")
    after = spark.createDataFrame([(None, 3), ("b", 2)], "name string, count long")
    assert sorted(map(tuple, live.topk_delta(before, after).collect())) == [("a", 0), ("b", 2)]
    gone = live.topk_delta(before, after.where("name IS NOT NULL"))
    assert (None, 0) in set(map(tuple, gone.collect()))


def test_segments_are_in_utc(spark):
    with settings(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        row = spark.range(1).select(
            F.unix_millis(timegrid.segment_start(F.lit("20150218230000-1"))).alias("start"),
            timegrid.segment_name(F.timestamp_millis(F.lit(1425796200000))).alias("name"),
            timegrid.segment_list(F.timestamp_millis(F.lit(1424300400000 + 60_000))).alias("names"),
        ).first()
    assert row.start == 1424300400000
    assert row.name.startswith("201503080630")  # 02:30 that day does not exist in New York
    assert [n[:12] for n in row.names] == ["201502182200", "201502182215", "201502182230", "201502182245"]


def test_separators_only_are_rejected(spark):
    line = "\t".join(["20150218230000-1", "20150218230000", *[""] * 21, ";;"])
    assert [r.reason for r in unpack.rejected_lines(spark.createDataFrame([(line,)], "value string")).collect()] == ["no_names"]
