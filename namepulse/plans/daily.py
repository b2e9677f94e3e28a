"""The batch job: files in, the top names of each day out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse import schema as S
from namepulse.operators import histogram, threshold, unpack
from namepulse.sources.batch import scan_lines, scan_records


def top_names_of_lines(
    lines: DataFrame,
    k: int = S.DAILY_TOP,
    stop: Sequence[str] | DataFrame = S.STOP_NAMES,
    keep_empty: bool = False,
    rounds: bool = False,
) -> DataFrame:
    """(date, rn, word, total) from raw lines."""
    return _top(unpack.names_by_day(lines, stop, keep_empty), k, rounds)


def top_names_of_records(
    records: DataFrame,
    k: int = S.DAILY_TOP,
    stop: Sequence[str] | DataFrame = S.STOP_NAMES,
    rounds: bool = False,
) -> DataFrame:
    """(date, rn, word, total) from typed records."""
    return _top(unpack.explode_names(unpack.dated_names_of_records(records), stop), k, rounds)


def _top(words: DataFrame, k: int, rounds: bool) -> DataFrame:
    if rounds:
        return threshold.daily_topk_in_rounds(words, k)
    return histogram.daily_topk(histogram.daily_counts(words), k)


def write_json(ranked: DataFrame, path: str) -> None:
    """One JSON object a day, straight from the executors."""
    histogram.topk_nested(ranked).write.mode("overwrite").json(path)


def write_days(ranked: DataFrame, path: str) -> None:
    """One JSON object a day in a folder of that day. Only the days in ``ranked``
    are replaced; a job that runs again over one day leaves the others alone."""
    nested = histogram.topk_nested(ranked).withColumn("day", F.col("data"))
    (
        nested.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .json(path)
    )


def show_top(ranked: DataFrame, rows: int = 20) -> None:
    """Print the first days, untruncated. For interactive use."""
    histogram.topk_array(ranked).orderBy("date").show(rows, truncate=False)


def run(
    spark: SparkSession,
    paths: str | Sequence[str],
    output: str,
    rejects: str | None = None,
    typed: bool = False,
    by_day: bool = False,
    rounds: bool = False,
) -> None:
    """Scan ``paths``, write the daily top names as JSON to ``output`` and,
    where asked for, the lines that counted for nothing to ``rejects``. With
    ``by_day`` only the days that ``paths`` hold are replaced in ``output``; with ``rounds``
    the top is found by thresholds, for vocabularies too large to shuffle."""
    if typed:
        ranked = top_names_of_records(scan_records(spark, paths), rounds=rounds)
    else:
        ranked = top_names_of_lines(scan_lines(spark, paths), rounds=rounds)
    (write_days if by_day else write_json)(ranked, output)
    if rejects is not None:
        unpack.rejected_lines(scan_lines(spark, paths)).write.mode("overwrite").parquet(rejects)
