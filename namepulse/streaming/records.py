"""One update per record: the running count of its name, on a stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from namepulse.operators.position import position_within
from namepulse.streaming.run import batch_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPDATE_DDL = "id bigint, ts timestamp, name string, running_count bigint"


def record_updates(records: DataFrame, root: str) -> DataStreamWriter:
    """Write, for every record (id, ts, name), its name's count right after it.

    The state holds each name's count before a micro-batch and hands it on with
    the batch's records, a few at a time; their order within the batch, by time
    and id, is found by range partitioning, which spreads a hot name.
    """
    counted = records.select("id", "ts", "name").groupBy("name").transformWithStateInPandas(
        statefulProcessor=CountBefore(),
        outputStructType="id bigint, ts timestamp, name string, before bigint",
        outputMode="Update",
        timeMode="None",
    )

    def body(batch: DataFrame, batch_id: int) -> None:
        placed = position_within(batch, ["name"], ["ts", "id"], "place")
        placed.select(
            "id", "ts", "name", (F.col("before") + F.col("place")).alias("running_count")
        ).write.mode("overwrite").parquet(batch_folder(root, batch_id))

    return counted.writeStream.outputMode("update").foreachBatch(body)


class CountBefore(StatefulProcessor):
    """Per name: how many records there were. Rows pass with the count before their batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = int(self.count.get()[0]) if self.count.exists() else 0
        n = before
        for part in rows:
            n += len(part)
            yield part[["id", "ts", "name"]].assign(before=before)
        self.count.update((n,))

    def close(self) -> None:
        pass
