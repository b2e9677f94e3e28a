"""The last-hour counter that is swept once an hour, as keyed streaming state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from namepulse.functions.codec import encode_count
from namepulse.operators.hourly import hour_counts, hour_start_us
from namepulse.streaming.run import batch_folder

# Send this module's code to the Python workers along with the query, so that
# they run it without the package being installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HOUR_US = 3_600_000_000
OUTPUT_DDL = "name string, kind string, at_us bigint, last_hour bigint"


def swept_counts(
    records: DataFrame,
    lateness: str = "1 hour",
    phase_minutes: int = 0,
    history: DataFrame | None = None,
) -> DataFrame:
    """Stream of (name, kind, at_us, last_hour) from a stream of (name, ts).

    ``kind`` is ``count`` for the count after a micro-batch, once per name and
    sweep interval it touched (``at_us`` is the interval's start), or ``sweep``
    for what a sweep at ``at_us`` left of a name that lost records to it; a name
    that stays silent is reported too. A sweep fires when the watermark, which
    trails the newest record by ``lateness``, reaches it.

    Each task adds up its records per (name, event time) before the shuffle.
    Records of different times stay apart, so each meets the watermark by its
    own time, however the rows fall into batches.

    ``history`` holds the counts (name, hour_us, n) that a new stream begins
    from, such as :func:`kept_at` gives; then nothing is put out for them before
    records or sweeps change them. A restarted stream has its state.
    """
    pieces = (
        records.select(
            "name", hour_start_us(F.col("ts"), phase_minutes).alias("hour_us"), "ts"
        )
        .mapInArrow(_add_up, "name string, hour_us bigint, n bigint, ts timestamp")
        .withWatermark("ts", lateness)
    )
    return pieces.groupBy("name").transformWithStateInPandas(
        statefulProcessor=SweptHours(),
        outputStructType=OUTPUT_DDL,
        outputMode="Update",
        timeMode="EventTime",
        initialState=None if history is None else history.select("name", "hour_us", "n").groupBy("name"),
    )


def kept_at(records: DataFrame, until: Column, phase_minutes: int = 0) -> DataFrame:
    """(name, hour_us, n): what a swept counter holds of batch ``records`` at a time."""
    counts = hour_counts(records.where(F.col("ts") < until), phase_minutes)
    return counts.where(F.col("hour_us") + 2 * _HOUR_US > F.unix_micros(until))


def last_hour_updates(swept: DataFrame, root: str) -> DataStreamWriter:
    """Write :func:`swept_counts` as a table of updates (key, value, seq).

    ``seq`` puts a name's rows in event order: by minute, a sweep before the
    counts of the interval it opens, and then by micro-batch. The row with the
    largest ``seq`` is the name's count now.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        updates = _as_updates(batch, batch_id)
        updates.write.mode("overwrite").parquet(batch_folder(root, batch_id))

    return swept.writeStream.outputMode("update").foreachBatch(body)


def last_hour_updates_to_kafka(swept: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """The same to a Kafka topic; needs the Kafka connector on the classpath.

    ``seq`` travels as a header, so that a reader can tell which of a name's
    updates is the newest, whatever order they are read in.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        (
            update_messages(_as_updates(batch, batch_id))
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("includeHeaders", "true")
            .save()
        )

    return swept.writeStream.outputMode("update").foreachBatch(body)


def update_messages(updates: DataFrame) -> DataFrame:
    """Rows for a Kafka sink from (key, value, seq): the last as a header of eight bytes."""
    header = F.struct(F.lit("seq").alias("key"), encode_count(F.col("seq")).alias("value"))
    return updates.select("key", "value", F.array(header).alias("headers"))


def _as_updates(swept: DataFrame, batch_id: int) -> DataFrame:
    minutes = F.call_function("div", F.col("at_us"), F.lit(60_000_000))
    place = minutes * 2 + F.when(F.col("kind") == "count", 1).otherwise(0)
    return swept.select(
        F.col("name").alias("key"),
        encode_count(F.col("last_hour")).alias("value"),
        (F.shiftleft(place, 36) + F.lit(batch_id)).alias("seq"),
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = (
            pa.Table.from_batches([batch])
            .group_by(["name", "hour_us", "ts"])
            .aggregate([([], "count_all")])
            .select(["name", "hour_us", "count_all", "ts"])
            .rename_columns(["name", "hour_us", "n", "ts"])
        )
        yield from sums.to_batches()


class SweptHours(StatefulProcessor):
    """Per name: its records in each sweep interval not yet swept away.

    The state is one short list, read and written once per micro-batch. One
    timer per name is enough: when it fires, every sweep that is due runs.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "hours array<bigint>, counts array<bigint>")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._save(dict(zip(initialState["hour_us"].tolist(), initialState["n"].tolist())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self._load()
        touched = set()
        for part in rows:
            for hour, n in zip(part["hour_us"].tolist(), part["n"].tolist()):
                kept[hour] = kept.get(hour, 0) + n
                touched.add(hour)
        self._save(kept)
        # A late record also raises the count of the interval after its own.
        shown = sorted(touched | {hour + _HOUR_US for hour in touched if hour + _HOUR_US in kept})
        counts = [kept[hour] + kept.get(hour - _HOUR_US, 0) for hour in shown]
        yield _output(key[0], "count", shown, counts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept = self._load()
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        due = sorted(hour for hour in kept if hour + 2 * _HOUR_US <= reached)
        remaining = [kept.get(hour + _HOUR_US, 0) for hour in due]
        for hour in due:
            del kept[hour]
        self._save(kept)
        yield _output(key[0], "sweep", [hour + 2 * _HOUR_US for hour in due], remaining)

    def close(self) -> None:
        pass

    def _load(self) -> dict[int, int]:
        if not self.kept.exists():
            return {}
        hours, counts = self.kept.get()
        return dict(zip(hours, counts))

    def _save(self, kept: dict[int, int]) -> None:
        if not kept:
            self.kept.clear()
            return
        hours = sorted(kept)
        self.kept.update((hours, [kept[hour] for hour in hours]))
        self.handle.registerTimer((hours[0] + 2 * _HOUR_US) // 1000)


def _output(name: str, kind: str, at: list[int], last_hour: list[int]) -> pd.DataFrame:
    return pd.DataFrame({"name": name, "kind": kind, "at_us": at, "last_hour": last_hour})
