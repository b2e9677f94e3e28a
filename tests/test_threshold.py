"""The top of each day by thresholds: the same rows, few names shuffled."""

import pytest
from pyspark.sql import functions as F

from namepulse.operators import threshold
from namepulse.operators.histogram import daily_counts, daily_topk

SCHEMA = "date date, word string"


def ranked(rows):
    return sorted(tuple(r) for r in rows.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Four days of 60,000 names in a vocabulary of 20,000; the first day has three times as many."""
    ids = spark.range(0, 240_000, numPartitions=6).withColumn("u", F.rand(7))
    day = F.expr("date_add(DATE '2015-02-18', greatest(0, cast(id % 6 AS int) - 2))")
    rank = F.floor(F.pow(F.lit(20_000.0), F.col("u")))
    # Random numbers are drawn once: the table is written before it is read again.
    rows = ids.select(day.alias("date"), F.concat(F.lit("n"), rank.cast("string")).alias("word"))
    return threshold.settle(rows, "skewed-words")


def test_equals_the_ranking_of_all_counts(skewed):
    plain = ranked(daily_topk(daily_counts(skewed), 10))
    for cells, first in ((4096, 8), (4096, 1), (64, 1), (1, 1)):
        assert ranked(threshold.daily_topk_in_rounds(skewed, 10, cells, first)) == plain


def test_few_names_are_counted(skewed):
    loads = threshold.cell_loads(skewed, 4096)
    heavy = threshold.heaviest(loads, 80)
    first = threshold.counts_of(skewed, heavy, 4096)
    rest = threshold.reaching(loads, heavy, daily_topk(first, 10))
    counted = first.count() + threshold.counts_of(skewed, rest, 4096).count()
    assert counted < 0.1 * daily_counts(skewed).count()


def test_asked_cells_reach_the_scan_before_the_shuffle(skewed):
    heavy = threshold.settle(threshold.heaviest(threshold.cell_loads(skewed, 4096), 80), "heavy")
    plan = threshold.counts_of(skewed, heavy, 4096)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_ties_nulls_and_small_days(spark):
    rows = [("2015-02-18", w) for w in "baacbddee"] + [("2015-02-19", None), ("2015-02-19", ""), (None, "x")]
    words = spark.createDataFrame(rows, "date string, word string").withColumn("date", F.to_date("date"))
    for k in (1, 2, 3, 10):
        plain = daily_topk(daily_counts(words), k).collect()
        for cells in (1, 3, 1 << 16):
            found = threshold.daily_topk_in_rounds(words, k, cells, 1).collect()
            assert sorted(map(str, found)) == sorted(map(str, plain))


def test_empty_table(spark):
    assert threshold.daily_topk_in_rounds(spark.createDataFrame([], SCHEMA)).count() == 0
