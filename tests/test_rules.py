"""The rules about input, on hand-written lines with hand-counted answers."""

import pytest

from namepulse.operators import histogram, unpack
from namepulse.plans import daily
from namepulse.sources.batch import paths_from_index, scan_index, scan_lines, scan_records
from tests.lines import DAILY, DAILY_KEEP_EMPTY, LINES, frame, line


def counted(words):
    rows = histogram.daily_counts(words).collect()
    return {(str(row.date), row.word): row.total for row in rows}


def test_daily_counts(spark):
    assert counted(unpack.names_by_day(frame(spark))) == DAILY


def test_daily_counts_keep_empty(spark):
    assert counted(unpack.names_by_day(frame(spark), keep_empty=True)) == DAILY_KEEP_EMPTY


def test_typed_scan_counts_the_same(spark, folder):
    frame(spark).write.text(f"{folder}/lines")
    records = scan_records(spark, f"{folder}/lines")
    types = [kind for _, kind in records.dtypes]
    assert types == ["string", "timestamp", "int"] + ["string"] * 24
    assert (records.columns[0], records.columns[23]) == ("id", "allNames")
    words = unpack.explode_names(unpack.dated_names_of_records(records))
    assert counted(words) == DAILY


@pytest.mark.parametrize(
    ("names", "reason"),
    [(("short",), "short_line"), (("no_names", "separators"), "no_names"), (("bad_date",), "bad_date")],
)
def test_rejected(spark, names, reason):
    found = unpack.rejected_lines(frame(spark)).where(f"reason = '{reason}'").collect()
    assert sorted(map(tuple, found)) == sorted((LINES[name], reason) for name in names)


def test_only_four_are_rejected(spark):
    assert unpack.rejected_lines(frame(spark)).count() == 4


def test_stop_table_equals_stop_list(spark):
    packed = unpack.dated_names(frame(spark))
    stop = spark.createDataFrame([("Cy Dow",), ("Bob Ray",)], "word string")
    by_table = unpack.explode_names(packed, stop)
    by_list = unpack.explode_names(packed, ("Cy Dow", "Bob Ray"))
    assert counted(by_table) == counted(by_list)


def test_ranked_ties_by_word(spark):
    rows = daily.top_names_of_lines(frame(spark), k=2).orderBy("date", "rn").collect()
    assert [(str(r.date), r.rn, r.word, r.total) for r in rows] == [
        ("2015-02-18", 1, "Ann Lee", 3),
        ("2015-02-18", 2, "Bob Ray", 2),
        ("2015-02-19", 1, "", 1),
        ("2015-02-19", 2, '"Dee" Poe', 1),
    ]


def test_arrays_padded_and_not(spark):
    ranked = daily.top_names_of_lines(frame(spark))
    assert {len(row.topics) for row in histogram.topk_array(ranked).collect()} == {4}
    padded = histogram.topk_array_padded(ranked).collect()
    assert {len(row.topics) for row in padded} == {10}
    assert all(row.topics[4:] == [None] * 6 for row in padded)
    assert all(None not in row.topics[:4] for row in padded)


def test_histogram_maps_of_a_day(spark):
    counts = histogram.daily_counts(unpack.names_by_day(frame(spark)))
    for parts in (1, 3):
        maps = histogram.daily_histogram_maps(counts, parts).collect()
        assert len({(row.date, row.part) for row in maps}) == len(maps)
        assert parts > 1 or len({row.date for row in maps}) == len(maps)
        merged = {(str(r.date), w): n for r in maps for w, n in r.histogram.items()}
        assert merged == DAILY


def test_job_writes_json_and_rejects(spark, folder):
    frame(spark).write.text(f"{folder}/in")
    for typed in (False, True):
        daily.run(spark, f"{folder}/in", f"{folder}/out", f"{folder}/rejects", typed=typed)
        days = {row["data"]: row["result"] for row in spark.read.json(f"{folder}/out").collect()}
        assert [(e["topic"], e["count"]) for e in days["2015-02-18"]] == [
            ("Ann Lee", 3), ("Bob Ray", 2), ("", 1), ("Cy Dow", 1)
        ]
        assert spark.read.parquet(f"{folder}/rejects").count() == 4


def test_scan_paths_from_utf16_index(spark, folder):
    for day in ("a", "b"):
        spark.createDataFrame([(line("X,1"),)], "value string").write.text(f"{folder}/{day}")
    with open(f"{folder}/index.txt", "w", encoding="utf-16") as out:
        out.write(f"{folder}/a\r\n{folder}/b\r\n")
    assert paths_from_index(spark, f"{folder}/index.txt") == [f"{folder}/a", f"{folder}/b"]
    assert scan_index(spark, f"{folder}/index.txt").count() == 2


def test_lines_keep_malformed_bytes_until_cleaned(spark, folder):
    from pyspark.sql import functions as F

    from namepulse.functions.codec import clean_utf8

    with open(f"{folder}/raw.txt", "wb") as out:
        out.write(b"a\xffb\nok \xef\xbf\xbd \x1a0 \x1a1\nmixed \xef\xbf\xbd\xf0\x9f \x1a1\xc3\n")
    cleaned = scan_lines(spark, f"{folder}/raw.txt").select(clean_utf8(F.col("value")).alias("v"))
    assert sorted(row.v for row in cleaned.collect()) == sorted(
        ["ab", "ok � \x1a0 \x1a1", "mixed � \x1a1"]
    )
