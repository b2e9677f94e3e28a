"""Grid and pacing expressions against plain arithmetic."""

import datetime as dt
import random

from pyspark.sql import functions as F

from namepulse.functions import codec, fields, timegrid
from namepulse.operators import replay
from namepulse.sources import segments
from tests.lines import line


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def at(text):
    return F.lit(text).cast("timestamp")


def test_segments_of_the_last_hour(spark):
    row = one(
        spark,
        hour=timegrid.segment_list(at("2015-03-01 00:07:59")),
        quarter=timegrid.segment_list(at("2015-03-01 00:15:00"), 15),
        none=timegrid.segment_list(at("2015-03-01 00:15:00"), 10),
    )
    assert row.hour == [
        f"{stamp}00.gkg.csv" for stamp in ("201502282300", "201502282315", "201502282330", "201502282345")
    ]
    assert row.quarter == ["20150301000000.gkg.csv"]
    assert row.none == []


def test_next_quarter_is_strictly_later(spark):
    for now, after in [("00:00:00", "00:15:00"), ("00:14:59.9", "00:15:00"), ("23:45:00", "00:00:00")]:
        row = one(spark, t=timegrid.quarter_next(at(f"2020-01-01 {now}")))
        assert row.t.strftime("%H:%M:%S") == after


def test_seconds_left_is_at_least_one(spark):
    row = one(
        spark,
        a=timegrid.seconds_left(at("2020-01-01 00:14:59.9")),
        b=timegrid.seconds_left(at("2020-01-01 00:00:00.5")),
        c=timegrid.replay_rate(F.lit(10_000).cast("bigint"), at("2020-01-01 00:00:00")),
    )
    assert (row.a, row.b, row.c) == (1, 899, 11)


def sent_by_second(queued, seconds):
    seconds_of = []
    for second in range(seconds):
        sends = (queued - len(seconds_of)) // (seconds - second)
        seconds_of += [second] * sends
    return seconds_of


def test_replay_second_equals_draining_a_queue(spark):
    rng = random.Random(7)
    cases = [(rng.randint(1, 400), rng.randint(1, 60)) for _ in range(40)] + [(5, 900), (900, 900)]
    rows = spark.createDataFrame(cases, "queued bigint, seconds bigint").distinct()
    placed = rows.select(
        "queued", "seconds", F.explode(F.sequence(F.lit(0), F.col("queued") - 1)).alias("i")
    ).select(
        "queued", "seconds", "i",
        timegrid.replay_second(F.col("i"), F.col("queued"), F.col("seconds")).alias("s"),
    )
    got = {}
    for row in placed.orderBy("i").collect():
        got.setdefault((row.queued, row.seconds), []).append(row.s)
    assert got == {case: sent_by_second(*case) for case in set(cases)}


def test_spread_over_split_files_keeps_line_order(spark, folder):
    names = {"20200101000000": 700, "20200101001500": 3}
    for stamp, n in names.items():
        with open(f"{folder}/{stamp}.gkg.csv", "w") as out:
            out.writelines(line("N,1", stamp, record_id=f"{stamp}-{i}") + "\n" for i in range(n))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = segments.segment_lines(spark, folder, r"/(\d{14})\.gkg\.csv")
        assert lines.select("path", "block").distinct().count() > 3
        rows = replay.spread_timestamps(lines).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for stamp, n in names.items():
        start = dt.datetime.strptime(stamp, "%Y%m%d%H%M%S").replace(tzinfo=dt.timezone.utc)
        mine = sorted((r.position, r.value.split("\t")[0], r.event_ms) for r in rows if r.segment == stamp)
        step = 900_000 // n
        assert mine == [
            (i, f"{stamp}-{i}", int(start.timestamp() * 1000) + i * step) for i in range(n)
        ]


def test_record_ids(spark):
    ids = ["20150218230000-12", "7-8-", "-5-6", "1-2-3", "x-1", "", "+1-2", "99999999999999999999-1"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r.id: tuple(r.p) for r in rows.select("id", fields.parse_record_id(F.col("id")).alias("p")).collect()}
    assert got == {
        "20150218230000-12": (20150218230000, 12), "7-8-": (7, 8), "-5-6": (0, 0), "1-2-3": (0, 0),
        "x-1": (0, 0), "": (0, 0), "+1-2": (1, 2), "99999999999999999999-1": (0, 0),
    }


def test_counts_as_bytes(spark):
    values = [0, 1, 255, 256, 2**40 + 7, 2**63 - 1, -1]
    rows = spark.createDataFrame([(v,) for v in values], "n bigint")
    coded = rows.select("n", codec.encode_count(F.col("n")).alias("b"))
    back = coded.select("n", "b", codec.decode_count(F.col("b")).alias("m")).collect()
    assert all(bytes(r.b) == r.n.to_bytes(8, "big", signed=True) and r.m == r.n for r in back)


def test_last_key_of_nothing_is_the_first_key(spark):
    empty = spark.createDataFrame([], "key string, offset bigint")
    assert replay.last_key(empty, "offset").first().last_key == "20150218230000-0"


def test_pseudo_key_survives_separators_in_names(spark):
    key = fields.pseudo_key(F.lit("a;b;12"), at("2020-01-01 00:00:00.5"))
    text = fields.pseudo_key_text(key)
    row = one(spark, text=text, back=fields.parse_pseudo_key(text))
    assert row.text == "a;b;12;1577836800500"
    assert (row.back.name, row.back.ts_ms) == ("a;b;12", 1577836800500)


def test_nothing_seen_means_all_segments_are_new(spark):
    candidates = spark.createDataFrame([("b",), ("a",), ("a",)], "segment string")
    none = candidates.where("false")
    rows = segments.new_segments(candidates, none, none).collect()
    assert sorted(map(tuple, rows)) == [("a", True, True), ("b", True, True)]


def test_segments_fetched_and_not_fed(spark):
    candidates = spark.createDataFrame([(s,) for s in "abcd"], "segment string")
    rows = segments.new_segments(candidates, candidates.where("segment <> 'b' AND segment <> 'd'"), candidates.where("segment = 'b'"))
    assert sorted(map(tuple, rows.collect())) == [("b", True, False), ("c", False, True), ("d", True, True)]


def test_segment_lines_drop_malformed_bytes(spark, folder):
    with open(f"{folder}/20200101000000.gkg.csv", "wb") as out:
        out.write(b"a\xffb\nc\n")
    lines = segments.segment_lines(spark, folder, r"/(\d{14})\.gkg\.csv").collect()
    assert [(r.value, r.segment) for r in sorted(lines, key=lambda r: r.read_id)] == [("ab", "20200101000000"), ("c", "20200101000000")]
