"""The last-hour counter swept by the clock on the wall, whether or not records come."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from namepulse.operators.hourly import hour_start_us

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HOUR_MS = 3_600_000
OUTPUT_DDL = "name string, kind string, at_us bigint, changed bigint, last_hour bigint"


@dataclass(frozen=True)
class Clock:
    """What the wall shows: ``shown_ms`` at the moment ``real_ms``, and ``speed`` times as fast since.

    The standing clock is real time. A replay shows the hours of its records,
    and may run faster than they did.
    """

    shown_ms: int = 0
    real_ms: int = 0
    speed: int = 1

    def now(self, real_ms: int) -> int:
        return self.shown_ms + (real_ms - self.real_ms) * self.speed

    def when(self, shown_ms: int) -> int:
        """The first real millisecond at which the clock shows this."""
        return self.real_ms + -(-(shown_ms - self.shown_ms) // self.speed)


def wall_swept_counts(
    records: DataFrame,
    clock: Clock = Clock(),
    phase_minutes: int = 0,
    history: DataFrame | None = None,
) -> DataFrame:
    """Stream of (name, kind, at_us, changed, last_hour) from a stream of (name, ts).

    ``count`` rows come once per name and micro-batch with records: ``changed``
    records were added, and ``last_hour`` is the name's count now. ``sweep``
    rows come when a sweep takes records away: every hour by ``clock``, each
    name drops its records from more than an hour before; one that is silent is
    swept too. Late records count until the next sweep. Where sweeps were
    missed, the last that is due stands for all.

    ``history`` holds batch counts (name, hour_us, n), as
    :func:`~namepulse.operators.hourly.hour_counts` gives them, that a new
    stream begins from. A restarted stream has its state and passes them over.
    """
    hours = records.select("name", hour_start_us(F.col("ts"), phase_minutes).alias("hour_us"))
    return hours.groupBy("name").transformWithStateInPandas(
        statefulProcessor=WallSweep(clock, phase_minutes),
        outputStructType=OUTPUT_DDL,
        outputMode="Update",
        timeMode="ProcessingTime",
        initialState=None if history is None else history.select("name", "hour_us", "n").groupBy("name"),
    )


class WallSweep(StatefulProcessor):
    """Per name: a map from hour to records, and a timer for the next sweep.

    A record's hour is gone at most three hours after it was written, and one
    that a lost timer leaves behind goes by its time to live.
    """

    def __init__(self, clock: Clock, phase_minutes: int = 0):
        self.clock, self.phase_ms = clock, phase_minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        alive = max(60_000, 6 * _HOUR_MS // self.clock.speed)
        self.hours = handle.getMapState("hours", "hour bigint", "n bigint", alive)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._add(zip(initialState["hour_us"].tolist(), initialState["n"].tolist()))
        self._set_timer(self._now(timerValues))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added: dict[int, int] = {}
        for part in rows:
            for hour, n in part["hour_us"].value_counts().items():
                added[int(hour)] = added.get(int(hour), 0) + int(n)
        self._add(added.items())
        now = self._now(timerValues)
        self._set_timer(now)
        yield _row(key[0], "count", now, sum(added.values()), sum(self._kept().values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        sweep = self._next(now) - _HOUR_MS
        kept = self._kept()
        gone = [hour for hour in kept if hour // 1000 + 2 * _HOUR_MS <= sweep]
        for hour in gone:
            self.hours.removeKey((hour,))
        if len(gone) < len(kept):
            self._set_timer(now)
        if gone:
            lost = sum(kept[hour] for hour in gone)
            yield _row(key[0], "sweep", sweep, lost, sum(kept.values()) - lost)

    def close(self) -> None:
        pass

    def _now(self, timerValues) -> int:
        return self.clock.now(timerValues.getCurrentProcessingTimeInMs())

    def _next(self, now_ms: int) -> int:
        """The first sweep after this moment."""
        return now_ms - (now_ms - self.phase_ms) % _HOUR_MS + _HOUR_MS

    def _set_timer(self, now_ms: int) -> None:
        self.handle.registerTimer(self.clock.when(self._next(now_ms)))

    def _add(self, counts) -> None:
        for hour, n in counts:
            old = self.hours.getValue((hour,)) if self.hours.containsKey((hour,)) else (0,)
            self.hours.updateValue((hour,), (old[0] + n,))

    def _kept(self) -> dict[int, int]:
        return {hour[0]: n[0] for hour, n in self.hours.iterator()}


def _row(name: str | None, kind: str, at_ms: int, changed: int, last_hour: int) -> pd.DataFrame:
    return pd.DataFrame(
        {"name": [name], "kind": [kind], "at_us": [at_ms * 1000], "changed": [changed], "last_hour": [last_hour]}
    )
