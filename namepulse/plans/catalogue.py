"""Every query over the given tables, by name.

Times leave as text or as epoch microseconds (``*_us``), so that they compare
equal whatever the session's time zone.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse import schema as S
from namepulse.functions import codec, fields, timegrid
from namepulse.functions import names as packed
from namepulse.operators import histogram, hourly, live, replay, unpack
from namepulse.plans import daily, feed
from namepulse.session import new_folder, settings
from namepulse.sources import batch, segments, stream
from namepulse.streaming import counts, sweep, top, wallclock
from namepulse.streaming import records as per_record
from namepulse.streaming import replay as paced
from namepulse.streaming.run import run_to_end, start, write_batches

Query = Callable[[SparkSession, str], DataFrame]

LATENESS = "1 hour"
_queries: dict[str, Query] = {}


def queries() -> dict[str, Query]:
    return dict(_queries)


def query(build: Query) -> Query:
    """Register ``build`` under its own name, in a UTC session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    _queries[build.__name__] = run
    return run


def clock(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd HH:mm:ss")


# Scans


@query
def scan_records(spark, sf_dir):
    records = batch.scan_records(spark, feed.feed_files(spark, sf_dir))
    day = F.coalesce(fields.day_text(F.col("date")), F.lit("no date"))
    return records.groupBy(day.alias("date")).agg(
        F.count("*").alias("records"), F.count("allNames").alias("with_names")
    )


@query
def scan_lines(spark, sf_dir):
    lines = batch.scan_lines(spark, feed.feed_files(spark, sf_dir))
    day = F.substring(fields.record_key(F.col("value")), 1, 8)
    return lines.groupBy(day.alias("day")).agg(
        F.count("*").alias("lines"),
        F.sum(F.size(fields.split_line(F.col("value"))).cast("bigint")).alias("fields"),
    )


@query
def scan_multi_path(spark, sf_dir):
    root = feed.feed_files(spark, sf_dir)
    # A year, three years, nine single months, three single months, two years.
    globs = (
        "year=1995",
        "year=199[6-8]",
        "year=1999/month=19990[1-9]",
        "year=1999/month=19991[0-2]",
        "year=200[01]/month=*",
    )
    records = batch.scan_records(spark, [f"{root}/{glob}" for glob in globs])
    month = F.regexp_extract("_metadata.file_path", r"/month=(\d+)/", 1)
    return records.groupBy(month.alias("month")).agg(F.count("*").alias("records"))


@query
def scan_index(spark, sf_dir):
    root = feed.feed_files(spark, sf_dir)
    months = spark.range(1, 10).select(
        F.concat(F.lit(f"{root}/year=1999/month=19990"), F.col("id").cast("string")).alias("path")
    )
    index = new_folder(spark, "index")
    months.coalesce(1).write.option("encoding", "UTF-16").csv(index)
    records = batch.scan_index(spark, f"{index}/part-*")
    month = F.regexp_extract("_metadata.file_path", r"/month=(\d+)/", 1)
    return records.groupBy(month.alias("month")).agg(F.count("*").alias("records"))


@query
def clean_utf8(spark, sf_dir):
    text = F.col("text")
    half = F.call_function("div", F.length(text), F.lit(2)).cast("int")
    part = lambda start, length: F.encode(F.substr(text, start, length), "UTF-8")
    raw = F.concat(
        F.unhex(F.lit("80")),
        part(F.lit(1), half),
        F.unhex(F.lit("E282")),
        part(half + 1, F.length(text)),
        F.unhex(F.lit("FF")),
    )
    cleaned = codec.clean_utf8(raw.cast("string"))
    documents = feed.table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("text"))
    return documents.select(
        "doc_id",
        F.md5(F.encode("text", "UTF-8")).alias("digest"),
        F.length("text").cast("bigint").alias("chars"),
    )


# Fields and filters of raw lines


@query
def split_fields(spark, sf_dir):
    parts = fields.split_line(F.col("value"))
    lines = feed.feed_lines(spark, sf_dir).select(parts.alias("parts"))
    return lines.select(
        fields.field(F.col("parts"), S.ID_FIELD).alias("id"),
        F.size("parts").cast("bigint").alias("fields"),
        fields.field(F.col("parts"), S.DATE_FIELD).alias("raw_date"),
        F.coalesce(fields.field(F.col("parts"), S.NAMES_FIELD), F.lit("none")).alias("names"),
    )


@query
def filter_field_count(spark, sf_dir):
    read = unpack.read_fields(feed.feed_lines(spark, sf_dir))
    return unpack.keep_lines(read, F.col("names").isNotNull()).select("id", "names")


@query
def filter_names_present(spark, sf_dir):
    read = unpack.read_fields(feed.feed_lines(spark, sf_dir))
    return unpack.keep_lines(read, packed.has_names(F.col("names"))).select("id", "names")


@query
def parse_date(spark, sf_dir):
    when = fields.record_time(F.col("raw_date"))
    read = unpack.keep_lines(
        unpack.read_fields(feed.feed_lines(spark, sf_dir)), F.col("names").isNotNull()
    )
    return read.select("id", F.coalesce(fields.day_text(when), F.lit("not a date")).alias("day"))


@query
def rejected_lines(spark, sf_dir):
    return unpack.rejected_lines(feed.feed_lines(spark, sf_dir)).select(
        fields.record_key(F.col("value")).alias("id"), "reason"
    )


@query
def parse_record_id(spark, sf_dir):
    events = feed.table(spark, sf_dir, "events")
    stamp = F.date_format(F.col("ts").cast("timestamp"), S.RECORD_TIME_FORMAT)
    kind = F.col("event_type")
    record_id = (
        F.when(kind == "error", F.concat_ws("_", stamp, "event_id"))
        .when(kind == "signup", F.concat_ws("-", stamp, "event_id", F.lit("0")))
        .otherwise(F.concat_ws("-", stamp, "event_id"))
    )
    parsed = events.select("event_id", fields.parse_record_id(record_id).alias("parsed"))
    return parsed.select("event_id", "parsed.stamp", "parsed.number")


@query
def pseudo_key(spark, sf_dir):
    keyed = feed.event_records(spark, sf_dir).select(
        F.col("id").alias("event_id"),
        fields.pseudo_key(F.col("name"), F.col("ts")).alias("key"),
    )
    text = keyed.select("event_id", fields.pseudo_key_text(F.col("key")).alias("key_text"))
    back = fields.parse_pseudo_key(F.col("key_text"))
    return text.select("event_id", "key_text", back["name"].alias("name"), back["ts_ms"].alias("ts_ms"))


@query
def project_ops(spark, sf_dir):
    renamed = (
        unpack.dated_names(feed.feed_lines(spark, sf_dir))
        .select("date", F.explode(packed.name_entries(F.col("names"))).alias("entry"))
        .withColumnsRenamed({"date": "day", "entry": "topic"})
    )
    return (
        renamed.withColumn("word", packed.entry_name(F.col("topic")))
        .withColumn("offset", F.split_part("topic", F.lit(S.OFFSET_SEPARATOR), F.lit(2)))
        .withColumn("one", F.lit(1))
        .drop("topic")
        .groupBy(fields.day_text(F.col("day")).alias("day"), "word", "offset")
        .agg(F.sum("one").alias("total"))
    )


# Names and daily histograms


def _words(spark, sf_dir, **options):
    return unpack.names_by_day(feed.feed_lines(spark, sf_dir), **options)


def _feed_counts(spark, sf_dir):
    return histogram.daily_counts(_words(spark, sf_dir, stop=feed.FEED_STOP))


def _feed_topk(spark, sf_dir):
    return daily.top_names_of_lines(feed.feed_lines(spark, sf_dir), stop=feed.FEED_STOP)


def _by_day(counts):
    return counts.withColumn("date", fields.day_text(F.col("date")))


@query
def explode_names(spark, sf_dir):
    return _words(spark, sf_dir, stop=()).select("id", "word")


@query
def explode_names_keep_empty(spark, sf_dir):
    words = _words(spark, sf_dir, stop=(), keep_empty=True)
    return _by_day(histogram.daily_counts(words))


@query
def filter_stoplist(spark, sf_dir):
    words = _words(spark, sf_dir, stop=feed.FEED_STOP)
    return words.groupBy("word").agg(F.count("*").alias("total"))


@query
def filter_stoplist_table(spark, sf_dir):
    small = feed.table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_name").alias("word"))
    words = _words(spark, sf_dir, stop=small)
    return words.groupBy("word").agg(F.count("*").alias("total"))


@query
def daily_counts(spark, sf_dir):
    return _by_day(_feed_counts(spark, sf_dir))


@query
def daily_histogram_map(spark, sf_dir):
    maps = histogram.daily_histogram_maps(_feed_counts(spark, sf_dir))
    return _by_day(maps.select("date", F.explode("histogram").alias("word", "total")))


@query
def daily_topk(spark, sf_dir):
    return _by_day(_feed_topk(spark, sf_dir))


@query
def daily_topk_of_records(spark, sf_dir):
    records = batch.scan_records(spark, feed.feed_files(spark, sf_dir))
    return _by_day(daily.top_names_of_records(records, stop=feed.FEED_STOP))


@query
def daily_topk_in_rounds(spark, sf_dir):
    lines = feed.feed_lines(spark, sf_dir)
    return _by_day(daily.top_names_of_lines(lines, stop=feed.FEED_STOP, rounds=True))


def _positions(array):
    return F.posexplode(array).alias("pos", "topic")


@query
def daily_topk_array(spark, sf_dir):
    arrays = histogram.topk_array(_feed_topk(spark, sf_dir))
    flat = arrays.select("date", _positions("topics"))
    return _by_day(
        flat.select("date", F.col("pos").cast("bigint").alias("pos"), "topic.word", "topic.total")
    )


@query
def daily_topk_padded(spark, sf_dir):
    # Few days have fewer than ten names; twenty places leave some empty.
    arrays = histogram.topk_array_padded(_feed_topk(spark, sf_dir), 2 * S.DAILY_TOP)
    flat = arrays.select("date", _positions("topics"))
    return _by_day(
        flat.select(
            "date",
            F.col("pos").cast("bigint").alias("pos"),
            F.coalesce("topic.word", F.lit("(none)")).alias("word"),
            F.coalesce("topic.total", F.lit(-1)).alias("total"),
        )
    )


def _nested(rows):
    flat = rows.select("data", F.posexplode("result").alias("pos", "entry"))
    return flat.select(
        "data", F.col("pos").cast("bigint").alias("pos"), "entry.topic", "entry.count"
    )


@query
def daily_topk_nested(spark, sf_dir):
    return _nested(histogram.topk_nested(_feed_topk(spark, sf_dir)))


@query
def daily_topk_json(spark, sf_dir):
    path = new_folder(spark, "daily-json")
    daily.write_json(_feed_topk(spark, sf_dir), path)
    ddl = "data string, result array<struct<topic: string, count: bigint>>"
    return _nested(spark.read.schema(ddl).json(path))


@query
def daily_topk_by_day(spark, sf_dir):
    """All days of the events, then one of them again from its own lines."""
    lines, path = feed.event_lines(spark, sf_dir), new_folder(spark, "daily-days")
    for part in (lines, lines.where("cast(ts AS date) = DATE '2024-01-15'")):
        daily.write_days(daily.top_names_of_lines(part.select("value")), path)
    ddl = "data string, result array<struct<topic: string, count: bigint>>"
    return _nested(spark.read.schema(ddl).json(path))


@query
def global_topk(spark, sf_dir):
    return _by_day(histogram.global_topk(_feed_counts(spark, sf_dir)))


# The segment grid and the replay


def _event_times(spark, sf_dir):
    return feed.event_records(spark, sf_dir).select(F.col("id").alias("event_id"), "ts")


@query
def segment_list(spark, sf_dir):
    names = timegrid.segment_list(F.col("ts"))
    return _event_times(spark, sf_dir).select("event_id", F.explode(names).alias("segment"))


@query
def segments_new(spark, sf_dir):
    events = feed.event_records(spark, sf_dir)
    filed = events.withColumn("segment", timegrid.segment_name(timegrid.quarter_floor(F.col("ts"))))
    present = filed.where("name = 'click' AND ts < TIMESTAMP '2024-01-15'").select("segment")
    fed = filed.where("ts < TIMESTAMP '2024-01-10'").select("segment")
    return segments.new_segments(filed, present, fed)


@query
def quarter_floor(spark, sf_dir):
    return _event_times(spark, sf_dir).select(
        "event_id", clock(timegrid.quarter_floor(F.col("ts"))).alias("quarter")
    )


@query
def quarter_next(spark, sf_dir):
    return _event_times(spark, sf_dir).select(
        "event_id", clock(timegrid.quarter_next(F.col("ts"))).alias("quarter")
    )


@query
def segment_start(spark, sf_dir):
    return feed.event_lines(spark, sf_dir).select(
        "event_id",
        clock(timegrid.segment_start(fields.record_key(F.col("value")))).alias("start"),
    )


def _spread(spark, sf_dir):
    root = feed.segment_files(spark, sf_dir)
    return replay.spread_timestamps(
        segments.segment_lines(spark, root, feed.SEGMENT_PATTERN)
    )


@query
def spread_timestamps(spark, sf_dir):
    return _spread(spark, sf_dir).select(
        "segment", fields.record_key(F.col("value")).alias("key"), "position", "event_ms"
    )


@query
def replay_records(spark, sf_dir):
    path = new_folder(spark, "replay")
    replay.replay_records(_spread(spark, sf_dir)).write.parquet(path)
    sent = spark.read.parquet(path)
    return sent.select(
        "key",
        F.size(fields.split_line(F.col("value"))).cast("bigint").alias("fields"),
        F.unix_millis("timestamp").alias("event_ms"),
        "send_second",
    )


@query
def replay_rate(spark, sf_dir):
    queues = (
        _event_times(spark, sf_dir)
        .groupBy(timegrid.quarter_floor(F.col("ts")).alias("quarter"))
        .agg(F.count("*").alias("queued"), F.min("ts").alias("now"))
    )
    return queues.select(
        clock(F.col("quarter")).alias("quarter"),
        "queued",
        timegrid.seconds_left(F.col("now")).alias("seconds"),
        timegrid.replay_rate(F.col("queued"), F.col("now")).alias("rate"),
    )


@query
def last_key(spark, sf_dir):
    topics = feed.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        F.concat_ws(
            "-", F.date_format(F.col("ts").cast("timestamp"), S.RECORD_TIME_FORMAT), "event_id"
        ).alias("key"),
        F.col("event_id").alias("offset"),
    )
    return replay.last_key(topics, "offset", "topic")


# Counts over time, in batch


@query
def count_by_name_ts(spark, sf_dir):
    by_minute = feed.event_records(spark, sf_dir).withColumn("ts", F.date_trunc("minute", "ts"))
    counted = hourly.count_by_name_ts(by_minute)
    return counted.select("name", F.unix_micros("ts").alias("ts_us"), "n")


@query
def running_count(spark, sf_dir):
    counted = hourly.running_count(feed.event_records(spark, sf_dir))
    return counted.select(F.col("id").alias("event_id"), "name", "running_count")


@query
def running_count_of_large_names(spark, sf_dir):
    # One name for all records: it is cut over all tasks.
    records = feed.event_records(spark, sf_dir).withColumn("name", F.lit("all"))
    counted = hourly.running_count(records)
    return counted.select(F.col("id").alias("event_id"), "name", "running_count")


@query
def latest_per_name(spark, sf_dir):
    updates = hourly.running_count(feed.event_records(spark, sf_dir, "user_id"))
    return live.latest_per_name(
        updates.select("name", F.col("running_count").alias("count"), F.col("id").alias("seq"))
    )


@query
def last_hour_exact(spark, sf_dir):
    counted = hourly.last_hour_exact(feed.event_records(spark, sf_dir))
    return counted.select("name", F.unix_micros("ts").alias("ts_us"), "n", "last_hour")


@query
def last_hour_exact_of_large_names(spark, sf_dir):
    by_minute = feed.event_records(spark, sf_dir).withColumn("ts", F.date_trunc("minute", "ts"))
    counted = hourly.last_hour_exact(by_minute)
    return counted.select("name", F.unix_micros("ts").alias("ts_us"), "n", "last_hour")


@query
def last_hour_sweep(spark, sf_dir):
    counted = hourly.last_hour_sweep(feed.event_records(spark, sf_dir))
    return counted.select(F.col("id").alias("event_id"), "name", "last_hour")


@query
def last_hour_sweep_phase(spark, sf_dir):
    records = feed.event_records(spark, sf_dir)
    counted = hourly.last_hour_sweep(records, phase_minutes=25)
    return counted.select(F.col("id").alias("event_id"), "name", "last_hour")


@query
def last_hour_by_interval(spark, sf_dir):
    return hourly.last_hour_by_interval(feed.event_records(spark, sf_dir))


@query
def sweep_updates(spark, sf_dir):
    return hourly.sweep_updates(feed.event_records(spark, sf_dir))


@query
def expired_entries(spark, sf_dir):
    entries = hourly.count_by_name_ts(feed.event_records(spark, sf_dir))
    swept_at = F.lit("2024-01-15 00:00:00").cast("timestamp")
    expired = hourly.expired_entries(entries, swept_at)
    return expired.select("name", F.unix_micros("ts").alias("ts_us"), "n")


@query
def tumbling_quarter(spark, sf_dir):
    windows = hourly.tumbling_quarter(feed.event_records(spark, sf_dir))
    return windows.withColumn("window_start", clock(F.col("window_start")))


def _clock_windows(windows):
    return windows.withColumns(
        {name: clock(F.col(name)) for name in ("window_start", "window_end")}
    )


@query
def sliding_hour(spark, sf_dir):
    return _clock_windows(hourly.sliding_hour(feed.event_records(spark, sf_dir)))


# Top lists, in batch


@query
def topk_minimum(spark, sf_dir):
    names = feed.event_records(spark, sf_dir, "user_id")
    return live.topk_minimum(live.top_names(live.name_counts(names)))


@query
def topk_delta_of_tables(spark, sf_dir):
    names = feed.event_records(spark, sf_dir, "user_id")
    early = names.where("ts < TIMESTAMP '2024-01-10'")
    return live.topk_delta(
        live.top_names(live.name_counts(early)), live.top_names(live.name_counts(names))
    )


# Streams


def _event_stream(spark, sf_dir, name="event_type"):
    path, files = feed.event_stream_files(spark, sf_dir, name)
    ddl = "id bigint, ts timestamp, name string"
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", files).parquet(path)


def _line_stream(spark, sf_dir):
    return stream.record_stream(spark, *feed.record_stream_files(spark, sf_dir))


def _run_to_end(spark, writer, checkpoint):
    """Run a stream to its end with one state partition per core. (Batch sizes
    its partitions as it goes; a stream keeps the number it starts with.)"""
    cores = str(spark.sparkContext.defaultParallelism)
    with settings(spark, {"spark.sql.shuffle.partitions": cores}):
        run_to_end(spark, writer, checkpoint)


def _run(spark, label, build):
    """The folder a stream has written; ``build`` gets it and gives the stream."""
    root = new_folder(spark, label)
    _run_to_end(spark, build(root), f"{root}-checkpoint")
    return root


def _written(spark, root, ddl):
    return spark.read.schema(f"{ddl}, batch bigint").parquet(root)


@query
def stream_scan(spark, sf_dir):
    root = _run(
        spark, "stream-scan", lambda out: write_batches(_line_stream(spark, sf_dir), out)
    )
    records = _written(spark, root, stream.RECORD_STREAM_DDL)
    return records.groupBy(F.substring("key", 1, 8).alias("day"), "batch").agg(
        F.count("*").alias("records"),
        F.sum(F.unix_micros("timestamp") % 1000000).alias("micros"),
    )


@query
def stream_names(spark, sf_dir):
    names = unpack.stream_names(_line_stream(spark, sf_dir), stop=("error",))
    root = _run(spark, "stream-names", lambda out: write_batches(names, out))
    written = _written(spark, root, "timestamp timestamp, id string, name string")
    return written.select("id", "name", F.unix_micros("timestamp").alias("ts_us"))


def _updates(spark, sf_dir):
    """The update topic of events by user, written by one stream run."""

    def write(root):
        records = _event_stream(spark, sf_dir, "user_id")
        _run_to_end(spark, counts.count_updates(records, root), f"{root}-checkpoint")

    return feed.once(spark, sf_dir, "updates", write)


def _live(spark, sf_dir):
    """Snapshots and changes of the live list over that topic.

    The topic's folder holds a file or more for each micro-batch, in order;
    the list is brought up to date after each of them.
    """

    def write(root):
        for number in range(3):
            updates = stream.update_stream(spark, f"{_updates(spark, sf_dir)}/batch=[0-{number}]")
            _run_to_end(spark, top.live_top(updates, root), f"{root}-checkpoint")

    return feed.once(spark, sf_dir, "live", write)


@query
def stream_count_update(spark, sf_dir):
    updates = spark.read.schema(stream.UPDATE_STREAM_DDL).parquet(_updates(spark, sf_dir))
    return live.latest_per_name(stream.decode_updates(updates))


@query
def changelog_decode(spark, sf_dir):
    updates = stream.update_stream(spark, _updates(spark, sf_dir))
    root = _run(spark, "decoded", lambda out: write_batches(updates, out))
    return _written(spark, root, "name string, count bigint, seq bigint").drop("batch")


@query
def topk_snapshot(spark, sf_dir):
    return top.read_latest_snapshot(spark, _live(spark, sf_dir))


@query
def topk_from_state(spark, sf_dir):
    return top.top_from_state(spark, f"{_live(spark, sf_dir)}-checkpoint")


@query
def changelog_from_latest(spark, sf_dir):
    """A reader that begins after the second of three batches."""
    folder = new_folder(spark, "late-reader")
    since = None
    for number in range(3):
        if number == 2:
            # File times are in whole seconds in some stores.
            time.sleep(1.1)
            since = spark.sql("SELECT cast(current_timestamp() AS string)").first()[0]
        part = spark.read.schema(stream.UPDATE_STREAM_DDL).parquet(f"{_updates(spark, sf_dir)}/batch={number}")
        part.write.mode("append").parquet(folder)
    updates = stream.update_stream(spark, folder, since=since)
    root = _run(spark, "from-latest", lambda out: write_batches(updates, out))
    return _written(spark, root, "name string, count bigint, seq bigint").drop("batch")


@query
def topk_delta(spark, sf_dir):
    return top.read_deltas(spark, _live(spark, sf_dir))


@query
def delta_json(spark, sf_dir):
    return top.read_messages(spark, _live(spark, sf_dir))


@query
def stream_top100(spark, sf_dir):
    records = _event_stream(spark, sf_dir, "user_id")
    root = _run(spark, "rising", lambda out: top.rising_top(records, out))
    return top.read_latest_snapshot(spark, root)


@query
def stream_sliding_hour(spark, sf_dir):
    windows = counts.sliding_hour_stream(_event_stream(spark, sf_dir), LATENESS)
    root = _run(
        spark, "sliding", lambda out: write_batches(windows, out).outputMode("append")
    )
    ddl = "window_start timestamp, window_end timestamp, name string, n bigint"
    return _clock_windows(_written(spark, root, ddl).drop("batch"))


@query
def stream_window_topk(spark, sf_dir):
    windows = counts.sliding_hour_stream(_event_stream(spark, sf_dir, "user_id"), LATENESS)
    root = _run(spark, "window-topk", lambda out: counts.window_topk(windows, out))
    ddl = "window_end timestamp, rn bigint, name string, n bigint"
    ranked = _written(spark, root, ddl).drop("batch")
    return ranked.withColumn("window_end", clock(F.col("window_end")))


@query
def stream_window_topk_chained(spark, sf_dir):
    ranked = counts.window_topk_stream(_event_stream(spark, sf_dir, "user_id"), LATENESS)
    root = _run(
        spark, "window-topk-chain", lambda out: write_batches(ranked, out).outputMode("append")
    )
    ddl = "window_end timestamp, rn bigint, name string, n bigint"
    return _written(spark, root, ddl).drop("batch").withColumn("window_end", clock(F.col("window_end")))


@query
def stream_running_count(spark, sf_dir):
    root = _run(spark, "running", lambda out: per_record.record_updates(_event_stream(spark, sf_dir), out))
    counted = _written(spark, root, per_record.UPDATE_DDL)
    return counted.select(F.col("id").alias("event_id"), "name", "running_count")


@query
def stream_replay(spark, sf_dir):
    """Thirty days of segments, ten days a micro-batch, the stream restarted after each."""
    schedule, root = new_folder(spark, "schedule"), new_folder(spark, "replayed")
    paced.write_schedule(replay.replay_records(_spread(spark, sf_dir)), schedule)
    first = spark.read.parquet(schedule).agg(F.min("second")).first()[0]
    first -= first % (S.SEGMENT_MINUTES * 60)
    for _ in range(3):
        clock_stream = paced.stepped_seconds(spark, 10 * 86_400)
        _run_to_end(spark, paced.paced_replay(clock_stream, schedule, root, first), f"{root}-checkpoint")
    sent = _written(spark, root, stream.RECORD_STREAM_DDL)
    return sent.select("key", F.unix_millis("timestamp").alias("event_ms"), F.col("batch").alias("part"))


@query
def stream_wall_sweep(spark, sf_dir):
    """All records at once, then sweeps by a clock that shows an hour a second, until none is left."""
    source = _event_stream(spark, sf_dir).select("name", "ts")
    newest = feed.event_records(spark, sf_dir).agg(F.max("ts").alias("ts")).select(F.unix_millis("ts"))
    wall = wallclock.Clock(newest.first()[0], int(time.time() * 1000), speed=3600)
    root = new_folder(spark, "wall")
    writer = write_batches(wallclock.wall_swept_counts(source, wall), root).outputMode("update")
    found = lambda: _written(spark, root, wallclock.OUTPUT_DDL)
    with settings(spark, {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}):
        query = start(spark, writer, f"{root}-checkpoint", every="1 second")
    total = feed.event_records(spark, sf_dir).count()
    try:
        # The clock never stands still, so there is no end to wait for but the last sweep.
        for _ in range(60):
            time.sleep(1)
            if query.lastProgress and query.lastProgress.batchId > 0:
                if found().where("kind = 'sweep'").agg(F.sum("changed")).first()[0] == total:
                    break
    finally:
        query.stop()
    here = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("changed")))
    # In a micro-batch records come before sweeps.
    last = F.max_by("last_hour", F.struct("batch", F.col("kind") == "sweep"))
    return found().groupBy("name").agg(here("count").alias("counted"), here("sweep").alias("swept"), last.alias("last_hour"))


@query
def stream_sweep_from_history(spark, sf_dir):
    """The processor over all but the first ten days, begun from batch counts of those."""
    cut = F.lit("2024-01-11").cast("timestamp")
    history = sweep.kept_at(feed.event_records(spark, sf_dir), cut)
    later = _event_stream(spark, sf_dir).where(F.col("ts") >= cut).select("name", "ts")
    swept = sweep.swept_counts(later, LATENESS, history=history)
    root = _run(spark, "from-history", lambda out: write_batches(swept, out).outputMode("update"))
    counted = _written(spark, root, sweep.OUTPUT_DDL).where("kind = 'count'")
    return counted.groupBy("name", F.col("at_us").alias("hour_us")).agg(
        F.max_by("last_hour", "batch").alias("last_hour")
    )


@query
def stream_last_hour_sweep(spark, sf_dir):
    windows = counts.swept_windows(_event_stream(spark, sf_dir), LATENESS)
    root = _run(
        spark, "swept-windows", lambda out: write_batches(windows, out).outputMode("update")
    )
    ddl = "name string, at_us bigint, here bigint, remaining bigint, lost bigint"
    newest = F.max_by(F.struct("here", "remaining"), "batch").alias("newest")
    final = _written(spark, root, ddl).groupBy("name", "at_us").agg(newest)
    return final.where("newest.here > 0").select(
        "name",
        F.col("at_us").alias("hour_us"),
        (F.col("newest.here") + F.col("newest.remaining")).alias("last_hour"),
    )


def _swept(spark, sf_dir):
    """What the stateful processor put out over events by type."""

    def write(root):
        records = _event_stream(spark, sf_dir).select("name", "ts")
        writer = write_batches(sweep.swept_counts(records, LATENESS), root).outputMode("update")
        _run_to_end(spark, writer, f"{root}-checkpoint")

    return _written(spark, feed.once(spark, sf_dir, "swept", write), sweep.OUTPUT_DDL)


@query
def stream_last_hour_processor(spark, sf_dir):
    counted = _swept(spark, sf_dir).where("kind = 'count'")
    return counted.groupBy("name", F.col("at_us").alias("hour_us")).agg(
        F.max_by("last_hour", "batch").alias("last_hour")
    )


@query
def stream_sweep_updates(spark, sf_dir):
    swept = _swept(spark, sf_dir).where("kind = 'sweep'")
    return swept.select(
        "name", F.col("at_us").alias("sweep_us"), F.col("last_hour").alias("remaining")
    )


@query
def stream_last_hour_top(spark, sf_dir):
    records = _event_stream(spark, sf_dir, "user_id").select("name", "ts")
    swept = sweep.swept_counts(records, LATENESS)
    updates = _run(spark, "last-hour", lambda out: sweep.last_hour_updates(swept, out))
    decoded = stream.update_stream(spark, updates)
    return top.read_latest_snapshot(
        spark, _run(spark, "last-hour-top", lambda out: top.live_top(decoded, out))
    )
