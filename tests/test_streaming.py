"""Streams against their batch twins, restarts included."""

import datetime as dt
import json
import os
import random
import shutil
import time

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from namepulse.operators import histogram, hourly, live, replay, unpack
from namepulse.plans import daily
from namepulse.plans import live as live_plan
from namepulse.session import ROCKSDB
from namepulse.sources import stream
from namepulse.streaming import counts, shortlist, sweep, top, wallclock
from namepulse.streaming import records as per_record
from namepulse.streaming import replay as paced
from namepulse.streaming.run import run_to_end, write_batches
from tests.lines import LINES, line

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
RECORD_DDL = "id bigint, ts timestamp, name string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def records_between(first, last, seed, n=150):
    rng = random.Random(seed)
    return [
        (
            seed * 1000 + i,
            START + dt.timedelta(hours=first, seconds=rng.randint(0, (last - first) * 3600 - 1)),
            rng.choice(["hot", "hot", "a", "b", "c", f"rare{seed}"]),
        )
        for i in range(n)
    ]


SLICES = [records_between(0, 3, 1), records_between(3, 6, 2), records_between(6, 9, 3)]


def add(spark, folder, rows, ddl=RECORD_DDL):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(folder)


def read(spark, folder, ddl=RECORD_DDL):
    return spark.readStream.schema(ddl).parquet(folder)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_names_on_a_stream_equal_names_in_batch(spark, folder):
    ddl = stream.RECORD_STREAM_DDL
    rows = [(name, text, START) for name, text in LINES.items() if name != "bad_date"]
    add(spark, f"{folder}/in", rows, ddl)
    names = unpack.stream_names(stream.record_stream(spark, f"{folder}/in"))
    run_to_end(spark, write_batches(names, f"{folder}/out"), f"{folder}/ck")
    written = spark.read.parquet(f"{folder}/out").select("id", "name")
    batch = unpack.names_by_day(spark.read.parquet(f"{folder}/in"))
    assert rows_of(written) == rows_of(batch.select("id", "word"))


def test_sliding_hour_equals_batch_across_restarts(spark, folder):
    for rows in SLICES:
        add(spark, f"{folder}/in", rows)
        windows = counts.sliding_hour_stream(read(spark, f"{folder}/in"), "1 minute")
        run_to_end(spark, write_batches(windows, f"{folder}/out").outputMode("append"), f"{folder}/ck")
    everything = spark.read.parquet(f"{folder}/in")
    last = everything.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=1)
    closed = hourly.sliding_hour(everything).where(F.col("window_end") <= F.lit(last))
    written = spark.read.parquet(f"{folder}/out").drop("batch")
    assert rows_of(written) == rows_of(closed.select(*written.columns))


@pytest.mark.parametrize("phase", [0, 25])
def test_swept_counts_equal_batch_across_restarts(spark, folder, phase):
    for rows in SLICES:
        add(spark, f"{folder}/in", rows)
        swept = sweep.swept_counts(read(spark, f"{folder}/in"), "10 minutes", phase)
        run_to_end(spark, write_batches(swept, f"{folder}/out").outputMode("update"), f"{folder}/ck")
    everything = spark.read.parquet(f"{folder}/in")
    written = spark.read.schema(sweep.OUTPUT_DDL + ", batch bigint").parquet(f"{folder}/out")
    latest = (
        written.where("kind = 'count'")
        .groupBy("name", "at_us")
        .agg(F.max_by("last_hour", "batch"))
    )
    assert rows_of(latest) == rows_of(hourly.last_hour_by_interval(everything, phase))
    # Silent names are swept too, up to the watermark.
    reached = everything.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    due = hourly.sweep_updates(everything, phase).where(
        F.col("sweep_us") <= F.unix_micros(F.lit(reached))
    )
    reported = written.where("kind = 'sweep'").select("name", "at_us", "last_hour")
    assert rows_of(reported) == rows_of(due)
    assert any("rare1" in row for row in rows_of(reported))


@pytest.mark.parametrize("phase", [0, 25])
def test_swept_windows_equal_batch_when_closed(spark, folder, phase):
    for rows in SLICES:
        add(spark, f"{folder}/in", rows)
        windows = counts.swept_windows(read(spark, f"{folder}/in"), "10 minutes", phase)
        run_to_end(spark, write_batches(windows, f"{folder}/out").outputMode("append"), f"{folder}/ck")
    everything = spark.read.parquet(f"{folder}/in")
    reached = everything.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10, hours=1)
    closed = F.unix_micros(F.lit(reached))
    written = spark.read.parquet(f"{folder}/out")
    counted = hourly.last_hour_by_interval(everything, phase).where(F.col("hour_us") <= closed)
    assert rows_of(written.where("here > 0").selectExpr("name", "at_us", "here + remaining")) == rows_of(counted)
    reports = hourly.sweep_updates(everything, phase).where(F.col("sweep_us") <= closed)
    assert rows_of(written.where("lost > 0").select("name", "at_us", "remaining")) == rows_of(reports)


def test_late_records_count_until_swept(spark, folder):
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    batches = [[(1, at(70), "a"), (2, at(130), "a")], [(3, at(80), "a")]]
    for rows in batches:
        add(spark, f"{folder}/in", rows)
        swept = sweep.swept_counts(read(spark, f"{folder}/in"), "1 hour")
        run_to_end(spark, write_batches(swept, f"{folder}/out").outputMode("update"), f"{folder}/ck")
    written = spark.read.schema(sweep.OUTPUT_DDL + ", batch bigint").parquet(f"{folder}/out")
    last = written.where("kind = 'count'").groupBy("at_us").agg(F.max_by("last_hour", "batch"))
    hour = 3_600_000_000
    start = int(START.timestamp()) * 1_000_000
    assert sorted(map(tuple, last.collect())) == [(start + hour, 2), (start + 2 * hour, 3)]


def test_a_batch_that_runs_again_changes_nothing(spark, folder):
    for rows in SLICES[:2]:
        add(spark, f"{folder}/in", rows)
        run_to_end(
            spark, counts.count_updates(read(spark, f"{folder}/in"), f"{folder}/out"), f"{folder}/ck"
        )
    before = rows_of(spark.read.parquet(f"{folder}/out"))
    os.remove(f"{folder}/ck/commits/1")
    crc = f"{folder}/ck/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run_to_end(spark, counts.count_updates(read(spark, f"{folder}/in"), f"{folder}/out"), f"{folder}/ck")
    assert rows_of(spark.read.parquet(f"{folder}/out")) == before
    updates = stream.decode_updates(spark.read.parquet(f"{folder}/out"))
    assert rows_of(live.latest_per_name(updates)) == rows_of(
        live.name_counts(spark.read.parquet(f"{folder}/in"))
    )


def changes(seed, batches=4, names=12, k=5):
    """Counts that rise and fall, and the top lists after each batch."""
    rng, counts_now, seq = random.Random(seed), {}, 0
    for _ in range(batches):
        rows = []
        for _ in range(15):
            name = f"n{rng.randint(0, names)}"
            counts_now[name] = rng.randint(0, 30)
            rows.append((name, counts_now[name], seq))
            seq += 1
        ranked = sorted(((n, c) for n, c in counts_now.items() if c), key=lambda e: (-e[1], e[0]))
        yield rows, ranked[:k]


def test_live_top_follows_falling_counts(spark, folder):
    ddl, before = "name string, count bigint, seq bigint", {}
    for number, (rows, expected) in enumerate(changes(5)):
        add(spark, f"{folder}/in", rows, ddl)
        run_to_end(spark, top.live_top(read(spark, f"{folder}/in", ddl), f"{folder}/top", 5), f"{folder}/ck")
        assert rows_of(top.read_latest_snapshot(spark, f"{folder}/top")) == rows_of(
            spark.createDataFrame(expected, "name string, count bigint")
        )
        now = dict(expected)
        delta = {n: now.get(n, 0) for n in {*now, *before} if now.get(n) != before.get(n)}
        written = top.read_deltas(spark, f"{folder}/top").where(F.col("batch") == number)
        assert {r["name"]: r["count"] for r in written.collect()} == delta
        before = now
    assert top.read_messages(spark, f"{folder}/top").count() == number + 1


def test_the_list_comes_back_from_state_alone(spark, folder):
    ddl = "name string, count bigint, seq bigint"
    for rows, expected in changes(6):
        add(spark, f"{folder}/in", [*rows, (None, 3, rows[-1][2])], ddl)
        run_to_end(spark, top.live_top(read(spark, f"{folder}/in", ddl), f"{folder}/top", 5, 3), f"{folder}/ck")
    listed = rows_of(top.read_latest_snapshot(spark, f"{folder}/top"))
    shutil.rmtree(f"{folder}/top/snapshot")
    found = top.top_from_state(spark, f"{folder}/ck", 5)
    assert rows_of(found) == listed
    top.rebuild_snapshot(spark, f"{folder}/top", found, 3)
    assert rows_of(top.read_latest_snapshot(spark, f"{folder}/top")) == listed
    assert state_provider(f"{folder}/ck") == ROCKSDB
    add(spark, f"{folder}/in2", SLICES[0])
    run_to_end(spark, top.rising_top(read(spark, f"{folder}/in2"), f"{folder}/top2", 3), f"{folder}/ck2")
    assert rows_of(top.top_from_state(spark, f"{folder}/ck2", 3, shards=False)) == rows_of(
        top.read_latest_snapshot(spark, f"{folder}/top2")
    )
    assert state_provider(f"{folder}/ck2") == ROCKSDB


class Cell:
    """A value or a map of state in memory, with a count of the times it was gone through."""

    def __init__(self):
        self.value, self.map, self.scans = None, {}, 0

    exists = lambda self: self.value is not None
    get = lambda self: self.value
    update = lambda self, value: setattr(self, "value", value)
    containsKey = lambda self, key: key in self.map
    getValue = lambda self, key: self.map.get(key)
    updateValue = lambda self, key, value: self.map.__setitem__(key, value)
    removeKey = lambda self, key: self.map.pop(key, None)

    def iterator(self):
        self.scans += 1
        return iter(list(self.map.items()))


class Handle:
    def __init__(self):
        self.cells, self.timers = {}, set()

    def getMapState(self, name, *schemas, **ttl):
        return self.cells.setdefault(name, Cell())

    getValueState = getMapState

    def registerTimer(self, at_ms):
        self.timers.add(at_ms)


def test_short_lists_are_exact_and_seldom_gone_through():
    rng = random.Random(9)
    handle, k = Handle(), 5
    lists = shortlist.ShortList(k)
    lists.init(handle)
    now, shown, seq = {}, [], 0
    for step in range(600):
        rows = []
        for _ in range(rng.randint(1, 4)):
            name = rng.choice([None, *(f"n{i}" for i in range(60))])
            now[name] = rng.choice([0, rng.randint(0, 40), now.get(name, 0) + 1])
            rows.append((name, now[name], seq))
            seq += 1
        for out in lists.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["name", "count", "seq"])]), None):
            shown = list(zip(out["names"][0], out["counts"][0]))
        best = sorted(((n, c) for n, c in now.items() if c), key=lambda e: (-e[1], e[0] is not None, e[0] or ""))
        assert shown == best[:k]
    assert handle.cells["counts"].scans < 200


def test_an_update_out_of_order_is_passed_over():
    lists = shortlist.ShortList(2)
    lists.init(Handle())
    send = lambda *rows: [list(zip(o["names"][0], o["counts"][0])) for o in lists.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["name", "count", "seq"])]), None)]
    assert send(("a", 5, 10), ("a", 4, 9)) == [[("a", 5)]]
    assert send(("a", 7, 8)) == []
    assert send(("a", 0, 11)) == [[]]


def test_snapshots_go_round_their_slots(spark, folder, monkeypatch):
    monkeypatch.setattr(top, "SLOTS", 2)
    entry = lambda rows: spark.createDataFrame(rows, top.ENTRY_DDL)
    lists = [[("a", 1)], [("a", 2), ("b", 1)], []]
    for number, rows in enumerate(lists):
        for _ in range(2):  # the second run of a micro-batch changes nothing
            top._publish(entry(rows), folder, number)
            assert rows_of(top.read_latest_snapshot(spark, folder)) == rows_of(entry(rows))
    assert len(os.listdir(f"{folder}/snapshot")) == 2
    assert rows_of(top.read_deltas(spark, folder).select("batch", "name", "count")) == [
        "(0, 'a', 1)", "(1, 'a', 2)", "(1, 'b', 1)", "(2, 'a', 0)", "(2, 'b', 0)"
    ]


def test_rising_top_equals_batch(spark, folder):
    for rows in SLICES:
        add(spark, f"{folder}/in", rows)
        run_to_end(spark, top.rising_top(read(spark, f"{folder}/in"), f"{folder}/top", 3), f"{folder}/ck")
        so_far = spark.read.parquet(f"{folder}/in")
        assert rows_of(top.read_latest_snapshot(spark, f"{folder}/top")) == rows_of(
            live.top_names(live.name_counts(so_far), 3)
        )


def test_window_topk_equals_batch(spark, folder):
    for rows in SLICES:
        add(spark, f"{folder}/in", rows)
        windows = counts.sliding_hour_stream(read(spark, f"{folder}/in"), "1 minute")
        run_to_end(spark, counts.window_topk(windows, f"{folder}/out", 2), f"{folder}/ck")
    everything = spark.read.parquet(f"{folder}/in")
    last = everything.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=1)
    closed = hourly.sliding_hour(everything).where(F.col("window_end") <= F.lit(last))
    ranked = histogram.daily_topk(
        closed.select(F.col("window_end").alias("date"), F.col("name").alias("word"), F.col("n").alias("total")), 2
    )
    written = spark.read.parquet(f"{folder}/out").select("window_end", "rn", "name", "n")
    assert rows_of(written) == rows_of(ranked)


def raw_records(rows):
    return [(f"{i}", line(f"{name},1", record_id=f"{i}"), ts) for i, ts, name in rows]


def test_running_top_job_catches_up(spark, folder):
    for rows in SLICES[:2]:
        add(spark, f"{folder}/in", raw_records(rows), stream.RECORD_STREAM_DDL)
        records = stream.record_stream(spark, f"{folder}/in")
        updates = live_plan.running_updates(records, f"{folder}/job")
        live_plan.catch_up_top(spark, updates, f"{folder}/job")
    names = spark.createDataFrame(SLICES[0] + SLICES[1], RECORD_DDL)
    assert rows_of(top.read_latest_snapshot(spark, f"{folder}/job/top")) == rows_of(
        live.top_names(live.name_counts(names))
    )


def test_last_hour_top_job_forgets_silent_names(spark, folder):
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    slices = [
        [(1, at(10), "early"), (2, at(20), "early"), (3, at(50), "steady")],
        [(4, at(130), "steady"), (5, at(140), "late"), (6, at(190), "late")],
        [(7, at(250), "late")],
    ]
    expected = [
        {"early": 2, "steady": 1},
        {"steady": 1, "late": 2},
        {"late": 2},
    ]
    for rows, names in zip(slices, expected):
        add(spark, f"{folder}/in", raw_records(rows), stream.RECORD_STREAM_DDL)
        records = stream.record_stream(spark, f"{folder}/in")
        updates = live_plan.last_hour_of_records(records, f"{folder}/job", "10 minutes")
        live_plan.catch_up_top(spark, updates, f"{folder}/job")
        got = {r["name"]: r["count"] for r in top.read_latest_snapshot(spark, f"{folder}/job/top").collect()}
        assert got == names


def test_running_top_job_runs_live(spark, folder):
    add(spark, f"{folder}/in", raw_records(SLICES[0]), stream.RECORD_STREAM_DDL)
    records = stream.record_stream(spark, f"{folder}/in")
    updates = live_plan.running_updates(records, f"{folder}/job")
    queries = live_plan.start_top(spark, updates, f"{folder}/job")
    try:
        expected = rows_of(
            live.top_names(live.name_counts(spark.createDataFrame(SLICES[0], RECORD_DDL)))
        )
        for _ in range(60):
            time.sleep(1)
            assert all(query.exception() is None for query in queries)
            if os.path.exists(f"{folder}/job/top/delta/batch=0/_SUCCESS"):
                break
        assert rows_of(top.read_latest_snapshot(spark, f"{folder}/job/top")) == expected
    finally:
        for query in queries:
            query.stop()


def test_new_reader_can_start_at_the_end(spark, folder):
    updates = lambda name: [(name, (7).to_bytes(8, "big"), 0)]
    add(spark, f"{folder}/in", updates("old"), stream.UPDATE_STREAM_DDL)
    time.sleep(1.1)
    since = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    add(spark, f"{folder}/in", updates("new"), stream.UPDATE_STREAM_DDL)
    decoded = stream.update_stream(spark, f"{folder}/in", since=since)
    run_to_end(spark, write_batches(decoded, f"{folder}/out"), f"{folder}/ck")
    assert [tuple(r)[:3] for r in spark.read.parquet(f"{folder}/out").collect()] == [("new", 7, 0)]


def test_kafka_source_asks_for_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        stream.kafka_records(spark, "host:9092", "topic")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        stream.kafka_updates(spark, "host:9092", "topic")


def test_event_time_travels_in_a_message_header(spark):
    sent = replay.replay_messages(spark.createDataFrame([("k", "v", START)], stream.RECORD_STREAM_DDL))
    arrived = START + dt.timedelta(hours=5)
    received = sent.select(
        F.encode("key", "UTF-8").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        F.lit(arrived).alias("timestamp"),
        "headers",
    )
    bare = received.withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>"))
    times = lambda df: [(r.key, r.value, r.us) for r in stream.from_messages(df).select("key", "value", F.unix_micros("timestamp").alias("us")).collect()]
    micros = lambda when: int(when.timestamp() * 1_000_000)
    assert times(received) == [("k", "v", micros(START))]
    assert times(bare) == [("k", "v", micros(arrived))]


def state_provider(checkpoint):
    """The provider a query's first micro-batch was planned with."""
    with open(f"{checkpoint}/offsets/0") as offsets:
        conf = json.loads(offsets.read().split("\n")[1])["conf"]
    return conf["spark.sql.streaming.stateStore.providerClass"]


def test_a_stream_after_another_keeps_durable_state(spark, folder):
    add(spark, f"{folder}/in", SLICES[0])
    records = read(spark, f"{folder}/in")
    run_to_end(spark, top.rising_top(records, f"{folder}/top", 3), f"{folder}/ck-top")
    swept = sweep.swept_counts(records, "10 minutes")
    run_to_end(spark, write_batches(swept, f"{folder}/out").outputMode("update"), f"{folder}/ck")
    assert state_provider(f"{folder}/ck-top") == ROCKSDB
    assert state_provider(f"{folder}/ck") == ROCKSDB


class Now:
    """Timer values at a moment of the test's clock."""

    def __init__(self, ms):
        self.ms = ms

    getCurrentProcessingTimeInMs = lambda self: self.ms


def swept_by_the_wall(rows, phase, clock=wallclock.Clock(), history=()):
    """What the processor puts out for one name's (arrival ms, hour_us), timers fired as they fall due."""
    processor, handle = wallclock.WallSweep(clock, phase), Handle()
    processor.init(handle)
    out, now = [], 0

    def fire(until):
        while handle.timers and min(handle.timers) <= until:
            at = min(handle.timers)
            handle.timers.remove(at)
            out.extend(processor.handleExpiredTimer(("a",), Now(at), None))

    if history:
        frame = pd.DataFrame(history, columns=["hour_us", "n"])
        processor.handleInitialState(("a",), frame, Now(rows[0][0]))
    for arrival, hour in rows:
        fire(arrival)
        frame = pd.DataFrame({"name": ["a"], "hour_us": [hour]})
        out.extend(processor.handleInputRows(("a",), iter([frame]), Now(arrival)))
    fire(1 << 62)
    return pd.concat(out), handle


@pytest.mark.parametrize("phase", [0, 25])
def test_the_wall_clock_sweeps_as_the_batch_form_does(spark, phase):
    times = sorted(ts for _, ts, _ in SLICES[0] + SLICES[2])
    hour = lambda ts: (int(ts.timestamp() * 1000) - phase * 60_000) // 3_600_000 * 3_600_000_000 + phase * 60_000_000
    rows = [(int(ts.timestamp() * 1000), hour(ts)) for ts in times]
    records = spark.createDataFrame([(i, ts, "a") for i, ts in enumerate(times)], RECORD_DDL)
    got, handle = swept_by_the_wall(rows, phase)
    swept = got[got.kind == "sweep"]
    assert sorted(zip(swept.at_us, swept.last_hour)) == sorted(
        map(tuple, hourly.sweep_updates(records, phase).select("sweep_us", "remaining").collect())
    )
    # Right after each record the counter shows what the batch form says of it.
    counted = hourly.last_hour_sweep(records, phase).orderBy("ts", "id").select("last_hour").collect()
    assert got[got.kind == "count"].last_hour.tolist() == [r[0] for r in counted]
    assert not handle.timers and not handle.cells["hours"].map
    # A faster clock that shows the same hours puts out the same.
    start = rows[0][0]
    fast = wallclock.Clock(start, 0, 60)
    again, _ = swept_by_the_wall([(-(-(ms - start) // 60), h) for ms, h in rows], phase, fast)
    columns = ["kind", "changed", "last_hour"]
    assert again[columns].values.tolist() == got[columns].values.tolist()


def test_a_wall_clock_begun_from_history(spark):
    cut = START + dt.timedelta(hours=2)
    times = sorted(ts for _, ts, _ in SLICES[0])
    hour = lambda ts: int(ts.timestamp()) // 3600 * 3_600_000_000
    rows = [(int(ts.timestamp() * 1000), hour(ts)) for ts in times]
    whole, _ = swept_by_the_wall(rows, 0)
    records = spark.createDataFrame([(i, ts, "a") for i, ts in enumerate(times)], RECORD_DDL)
    history = [(r.hour_us, r.n) for r in sweep.kept_at(records, F.lit(cut)).collect()]
    later, _ = swept_by_the_wall([r for r in rows if r[0] >= cut.timestamp() * 1000], 0, history=history)
    after = whole[whole.at_us > cut.timestamp() * 1_000_000]
    assert later.values.tolist() == after.values.tolist()


def test_a_stream_begun_from_history_equals_one_from_the_start(spark, folder):
    add(spark, f"{folder}/before", SLICES[0])
    cut = F.lit(START + dt.timedelta(hours=3))
    history = sweep.kept_at(spark.read.parquet(f"{folder}/before"), cut)
    for rows in SLICES[1:]:
        add(spark, f"{folder}/in", rows)
        swept = sweep.swept_counts(read(spark, f"{folder}/in"), "10 minutes", history=history)
        run_to_end(spark, write_batches(swept, f"{folder}/out").outputMode("update"), f"{folder}/ck")
    everything = spark.createDataFrame(sum(SLICES, []), RECORD_DDL)
    cut_us = int((START + dt.timedelta(hours=3)).timestamp()) * 1_000_000
    written = spark.read.schema(sweep.OUTPUT_DDL + ", batch bigint").parquet(f"{folder}/out")
    latest = written.where("kind = 'count'").groupBy("name", "at_us").agg(F.max_by("last_hour", "batch"))
    assert rows_of(latest) == rows_of(hourly.last_hour_by_interval(everything).where(F.col("hour_us") >= cut_us))
    reached = everything.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    due = hourly.sweep_updates(everything).where(
        (F.col("sweep_us") > cut_us) & (F.col("sweep_us") <= F.unix_micros(F.lit(reached)))
    )
    reported = written.where("kind = 'sweep'").select("name", "at_us", "last_hour")
    assert rows_of(reported) == rows_of(due)
    assert any("rare1" in row for row in rows_of(reported))


def test_every_record_has_its_running_count(spark, folder):
    for rows in SLICES:
        add(spark, f"{folder}/in", [*rows, (rows[0][0] + 500, rows[0][1], None)])
        run_to_end(spark, per_record.record_updates(read(spark, f"{folder}/in"), f"{folder}/out"), f"{folder}/ck")
    written = spark.read.schema(f"{per_record.UPDATE_DDL}, batch bigint").parquet(f"{folder}/out")
    batch = hourly.running_count(spark.read.parquet(f"{folder}/in"))
    assert written.select("batch").distinct().count() == 3
    assert rows_of(written.select("id", "name", "running_count")) == rows_of(batch.select("id", "name", "running_count"))


def test_window_topk_as_one_chain_equals_batch(spark, folder):
    for rows in SLICES:
        add(spark, f"{folder}/in", [*rows, (0, rows[0][1], None)])
        ranked = counts.window_topk_stream(read(spark, f"{folder}/in"), "1 minute", 2, shards=3)
        run_to_end(spark, write_batches(ranked, f"{folder}/out").outputMode("append"), f"{folder}/ck")
    everything = spark.read.parquet(f"{folder}/in")
    last = everything.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=1)
    closed = hourly.sliding_hour(everything).where(F.col("window_end") <= F.lit(last))
    best = histogram.daily_topk(
        closed.select(F.col("window_end").alias("date"), F.col("name").alias("word"), F.col("n").alias("total")), 2
    )
    written = spark.read.parquet(f"{folder}/out").select("window_end", "rn", "name", "n")
    assert rows_of(written) == rows_of(best)


def test_a_paced_replay_sends_each_line_in_its_second_once(spark, folder):
    rows = [
        (segment, f"{segment[:14]}-{i}", f"line {i}", START, second)
        for segment in ("20240101000000.gkg.csv", "20240101001500.gkg.csv")
        for i, second in enumerate([0, 0, 1, 450, 899])
    ]
    ddl = "segment string, key string, value string, timestamp timestamp, send_second bigint"
    replayed = spark.createDataFrame(rows, ddl)
    paced.write_schedule(replayed, f"{folder}/schedule")
    first = int(START.timestamp())
    for number in range(3):
        clock = paced.stepped_seconds(spark, 700)
        run_to_end(spark, paced.paced_replay(clock, f"{folder}/schedule", f"{folder}/out", first), f"{folder}/ck")
        if number == 1:
            # The second micro-batch runs again.
            os.remove(f"{folder}/ck/commits/1")
            if os.path.exists(f"{folder}/ck/commits/.1.crc"):
                os.remove(f"{folder}/ck/commits/.1.crc")
            clock = paced.stepped_seconds(spark, 700)
            run_to_end(spark, paced.paced_replay(clock, f"{folder}/schedule", f"{folder}/out", first), f"{folder}/ck")
    sent = spark.read.schema(f"{stream.RECORD_STREAM_DDL}, batch bigint").parquet(f"{folder}/out")
    offset = {"20240101000000": 0, "20240101001500": 900}
    expected = [(key, (offset[segment[:14]] + second) // 700) for segment, key, _, _, second in rows]
    assert sorted(map(tuple, sent.select("key", "batch").collect())) == sorted(e for e in expected if e[1] < 4)


def test_the_order_of_swept_counts_travels_in_a_header(spark):
    updates = spark.createDataFrame([("a", (7).to_bytes(8, "big"), 12)], stream.UPDATE_STREAM_DDL)
    messages = sweep.update_messages(updates).select(
        F.encode("key", "UTF-8").alias("key"), "value", "headers", F.lit(3).cast("bigint").alias("offset")
    )
    read_back = lambda df: [tuple(r) for r in stream.from_update_messages(df).collect()]
    assert read_back(messages) == [("a", 7, 12)]
    bare = messages.withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>"))
    assert read_back(bare) == [("a", 7, 3)]


def test_a_day_that_is_written_again_leaves_the_others(spark, folder):
    ranked = lambda rows: spark.createDataFrame(rows, "date date, rn bigint, word string, total bigint")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    daily.write_days(ranked([(one, 1, "a", 5), (two, 1, "b", 6)]), f"{folder}/days")
    before = {f: os.stat(f"{folder}/days/day=2024-01-02/{f}").st_mtime_ns for f in os.listdir(f"{folder}/days/day=2024-01-02")}
    for total in (8, 9):
        daily.write_days(ranked([(one, 1, "a", total)]), f"{folder}/days")
        written = spark.read.json(f"{folder}/days").select("data", F.inline("result"))
        assert sorted(map(tuple, written.select("data", "topic", "count").collect())) == [("2024-01-01", "a", total), ("2024-01-02", "b", 6)]
    assert before == {f: os.stat(f"{folder}/days/day=2024-01-02/{f}").st_mtime_ns for f in os.listdir(f"{folder}/days/day=2024-01-02")}
