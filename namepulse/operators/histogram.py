"""Counts per day and name, and the top of each day in every output shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namepulse import schema as S
from namepulse.functions.arrays import first_n_padded
from namepulse.functions.fields import day_text


def daily_counts(words: DataFrame) -> DataFrame:
    """(date, word, total). Counts combine before the shuffle, so neither a
    busy day nor a popular name lands on one task."""
    return words.groupBy("date", "word").agg(F.count("*").alias("total"))


def daily_topk(counts: DataFrame, k: int = S.DAILY_TOP) -> DataFrame:
    """(date, rn, word, total): the ``k`` largest of each day, ties by word.

    Each task cuts a day to ``k`` rows before the shuffle by day, so the task
    that ranks a day sees at most ``k`` rows from every other task.
    """
    rank = Window.partitionBy("date").orderBy(F.desc("total"), F.asc("word"))
    return (
        counts.withColumn("rn", F.row_number().over(rank))
        .where(F.col("rn") <= k)
        .select("date", F.col("rn").cast("bigint").alias("rn"), "word", "total")
    )


def global_topk(counts: DataFrame, k: int = S.DAILY_TOP) -> DataFrame:
    """The ``k`` largest (date, word) counts of all."""
    return counts.orderBy(F.desc("total"), "date", "word").limit(k)


def topk_array(ranked: DataFrame) -> DataFrame:
    """(date, topics): one row a day with its ranked names in order."""
    entries = F.array_sort(F.collect_list(F.struct("rn", "word", "total")))
    return (
        ranked.groupBy("date")
        .agg(entries.alias("_ranked"))
        .select("date", F.transform("_ranked", _word_total).alias("topics"))
    )


def topk_array_padded(ranked: DataFrame, k: int = S.DAILY_TOP) -> DataFrame:
    """As :func:`topk_array`, with NULL entries up to exactly ``k``."""
    return topk_array(ranked).withColumn("topics", first_n_padded(F.col("topics"), k))


def topk_nested(ranked: DataFrame) -> DataFrame:
    """(data, result[topic, count]) with the day as text."""
    entry = lambda e: F.struct(e["word"].alias("topic"), e["total"].alias("count"))
    return topk_array(ranked).select(
        day_text(F.col("date")).alias("data"), F.transform("topics", entry).alias("result")
    )


def daily_histogram_maps(counts: DataFrame, parts: int = 1) -> DataFrame:
    """(date, part, histogram): each day's counts as a map from word to total.

    One map a day unless ``parts`` asks for more: words are then dealt by hash,
    so that a vocabulary too large for one row comes in ``parts`` maps. The maps
    of a day share no word; together they are its whole histogram.
    """
    entries = F.collect_list(F.struct("word", "total"))
    return (
        counts.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)))
        .groupBy("date", "part")
        .agg(F.map_from_entries(entries).alias("histogram"))
        .select("date", "part", "histogram")
    )


def _word_total(entry: Column) -> Column:
    return F.struct(entry["word"].alias("word"), entry["total"].alias("total"))
