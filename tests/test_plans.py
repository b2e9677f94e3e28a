"""The physical plans that the queries are meant to get."""

import re

import pytest

from namepulse.operators import histogram, hourly, unpack
from namepulse.plans import catalogue, daily, feed
from namepulse.sources.batch import scan_lines, scan_records

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_split_once(spark):
    plan = physical(unpack.names_by_day(scan_lines(spark, feed.feed_files(spark, SF_DIR))))
    assert len(re.findall(r", \t, -?\d+\)", plan)) == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_typed_scan_reads_two_columns(spark):
    records = scan_records(spark, feed.feed_files(spark, SF_DIR))
    plan = physical(daily.top_names_of_records(records))
    assert "ReadSchema: struct<date:timestamp,allNames:string>" in plan
    assert "PushedFilters: [IsNotNull(allNames), IsNotNull(date)]" in plan


def test_daily_top_cuts_before_it_shuffles_by_day(spark):
    lines = scan_lines(spark, feed.feed_files(spark, SF_DIR))
    plan = physical(daily.top_names_of_lines(lines))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "rangepartitioning" not in plan
    final, exchange, partial = (
        plan.index("row_number(), 10, Final"),
        plan.index("Exchange hashpartitioning(date"),
        plan.index("row_number(), 10, Partial"),
    )
    assert final < exchange < partial
    assert "partial_count(1)" in plan


def test_arrays_add_no_shuffle_to_the_ranking(spark):
    lines = scan_lines(spark, feed.feed_files(spark, SF_DIR))
    plan = physical(histogram.topk_nested(daily.top_names_of_lines(lines)))
    assert plan.count("Exchange hashpartitioning") == 2


def test_global_top_sorts_no_more_than_it_keeps(spark):
    lines = scan_lines(spark, feed.feed_files(spark, SF_DIR))
    counts = histogram.daily_counts(unpack.names_by_day(lines))
    plan = physical(histogram.global_topk(counts))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_sliding_hour_copies_pieces_not_records(spark):
    plan = physical(hourly.sliding_hour(feed.event_records(spark, SF_DIR)))
    assert plan.index("Generate explode(sequence") < plan.rindex("HashAggregate")
    assert "Expand" not in plan


def test_last_hour_combines_before_it_shuffles(spark):
    plan = physical(hourly.last_hour_exact(feed.event_records(spark, SF_DIR)))
    assert "partial_count(1)" in plan and "rangepartitioning" not in plan
    assert "Exchange SinglePartition" not in plan


def test_histogram_maps_need_no_window(spark):
    lines = scan_lines(spark, feed.feed_files(spark, SF_DIR))
    maps = histogram.daily_histogram_maps(histogram.daily_counts(unpack.names_by_day(lines)))
    assert "Window" not in physical(maps)
    assert maps.groupBy("date").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("name", ["filter_field_count", "filter_names_present", "parse_date"])
def test_filters_on_pieces_cut_a_line_once(spark, name):
    assert physical(catalogue.queries()[name](spark, SF_DIR)).count("split(") == 1
