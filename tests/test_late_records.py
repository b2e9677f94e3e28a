"""A late record's fate follows from its time, not from the rows it travels with."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from namepulse.session import settings
from namepulse.streaming.sweep import swept_counts

MINUTES = [[30], [40], [10, 50]]


@pytest.mark.parametrize("rows_per_batch", [1, 10_000])
def test_late_records_and_arrow_batches(spark, folder, rows_per_batch):
    start = dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc)
    for minutes in MINUTES:
        rows = [("a", start + dt.timedelta(minutes=m)) for m in minutes]
        spark.createDataFrame(rows, "name string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    records = spark.readStream.schema("name string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    sink = f"late_{rows_per_batch}"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_per_batch), "spark.sql.streaming.stateStore.providerClass": rocks}):
        query = (
            swept_counts(records, "0 seconds")
            .writeStream.outputMode("update")
            .format("memory")
            .queryName(sink)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    counts = spark.table(sink).where(F.col("kind") == "count").collect()
    # A micro-batch tests against the watermark of the one before it: 10:30 for the record of 10:10.
    assert sorted(r.last_hour for r in counts) == [1, 2, 3]
