"""The live list as keyed state: shards of names, each with a short list of its best."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 16
LIST_DDL = "shard int, names array<string>, counts array<bigint>"


def shard_lists(updates: DataFrame, k: int, shards: int = SHARDS) -> DataFrame:
    """Stream of (shard, names, counts): the ``k`` best names of each shard whose
    list a micro-batch of updates (name, count, seq) has changed.

    The best names of all are among those of the shards. ``shards`` is fixed by
    the checkpoint.
    """
    shard = F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int")
    return (
        updates.select(shard.alias("shard"), "name", "count", "seq")
        .groupBy("shard")
        .transformWithStateInPandas(
            statefulProcessor=ShortList(k),
            outputStructType=LIST_DDL,
            outputMode="Update",
            timeMode="None",
        )
    )


class ShortList(StatefulProcessor):
    """Per shard: the latest count of each name, and a list of the best ``k`` to ``2 k``.

    With the list goes a bound: no name outside it ranks before the bound. An
    update touches its own name and the list. A name that falls behind the bound
    leaves the list; a name ahead of it enters. Only when fewer than ``k`` names
    are left ahead of the bound are the shard's names gone through, so ``k``
    names or more have fallen, or are new, between two such times.
    """

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "name string", "count bigint, seq bigint")
        self.best = handle.getValueState(
            "best", "names array<string>, counts array<bigint>, bound array<string>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest: dict[str, tuple[int, int]] = {}
        for part in rows:
            for name, count, seq in zip(part["name"].tolist(), part["count"].tolist(), part["seq"].tolist()):
                name = _stored(name)
                if name not in newest or newest[name][1] <= seq:
                    newest[name] = (count, seq)
        kept, bound = self._load()
        shown = self._shown(kept)
        for name, (count, seq) in newest.items():
            old = self.counts.getValue((name,)) if self.counts.containsKey((name,)) else None
            if old is not None and old[1] > seq:
                continue
            self.counts.updateValue((name,), (count, seq))
            kept.pop(name, None)
            if count > 0 and (bound is None or _rank(name, count) < bound):
                kept[name] = count
        if bound is not None and len(kept) < self.k:
            kept, bound = self._refill()
        elif len(kept) > 2 * self.k:
            kept, bound = self._cut(kept.items())
        self.best.update((list(kept), list(kept.values()), _written(bound)))
        now = self._shown(kept)
        if now != shown:
            names, counts = [_read(n) for n, _ in now], [c for _, c in now]
            yield pd.DataFrame({"shard": [key[0]], "names": [names], "counts": [counts]})

    def close(self) -> None:
        pass

    def _load(self) -> tuple[dict[str, int], tuple | None]:
        if not self.best.exists():
            return {}, None
        names, counts, bound = self.best.get()
        rank = (-int(bound[0]), bound[1]) if len(bound) else None
        return dict(zip(list(names), [int(c) for c in counts])), rank

    def _shown(self, kept: dict[str, int]) -> list[tuple[str, int]]:
        return heapq.nsmallest(self.k, kept.items(), key=lambda e: _rank(*e))

    def _refill(self) -> tuple[dict[str, int], tuple | None]:
        return self._cut((name[0], value[0]) for name, value in self.counts.iterator() if value[0] > 0)

    def _cut(self, entries) -> tuple[dict[str, int], tuple | None]:
        """The best names, half as many again as are shown, and the first one that is left out."""
        room = self.k + (self.k + 1) // 2
        best = heapq.nsmallest(room + 1, entries, key=lambda e: _rank(*e))
        return dict(best[:room]), _rank(*best[room]) if len(best) > room else None


# A name of state is never NULL: NULL is the empty text, which sorts first, and others are marked.


def _stored(name: str | None) -> str:
    return "" if name is None else f"={name}"


def _read(name: str) -> str | None:
    return name[1:] if name else None


def _rank(name: str, count: int) -> tuple[int, str]:
    return (-count, name)


def _written(bound: tuple | None) -> list[str]:
    return [] if bound is None else [str(-bound[0]), bound[1]]
