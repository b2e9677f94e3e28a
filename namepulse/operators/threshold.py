"""The exact top of each day without a shuffle of all its names.

A vocabulary of millions a day goes through a shuffle to give ten rows. Here
names fall into cells by hash first, and only the cells' loads are shuffled:
the number of cells bounds what a task sends for a day. A load is an upper
bound for every name in its cell. The names of each day's heaviest cells are
counted; the ``k``-th of them is a lower bound for the day. Names of other
cells whose load reaches that bound are counted in a second round, and no
others can be in the top. The result equals that of ranking all counts.

The input is read three times, so this pays where the vocabulary is large, not
where reading is dear. The cells that a round asks for are a written table;
Spark broadcasts it while it is small and joins by a shuffle otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from namepulse import schema as S
from namepulse.operators.histogram import daily_counts, daily_topk
from namepulse.session import settle

CELLS = 1 << 16
#: Cells counted in the first round, as a multiple of ``k``.
FIRST = 8


def cell_loads(words: DataFrame, cells: int = CELLS) -> DataFrame:
    """(date, cell, load): how many names of a day fall into each cell."""
    return in_cells(words, cells).groupBy("date", "cell").agg(F.count("*").alias("load"))


def in_cells(words: DataFrame, cells: int) -> DataFrame:
    return words.select("date", "word", F.pmod(F.xxhash64("word"), F.lit(cells)).alias("cell"))


def heaviest(loads: DataFrame, n: int) -> DataFrame:
    """(date, cell, load): the ``n`` heaviest cells of each day."""
    rank = Window.partitionBy("date").orderBy(F.desc("load"), "cell")
    return loads.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= n).drop("place")


def reaching(loads: DataFrame, counted: DataFrame, best: DataFrame) -> DataFrame:
    """(date, cell, load): cells not yet counted that may hold one of a day's top."""
    least = best.groupBy("date").agg(F.min("total").alias("least"))
    left = loads.join(counted, _same(loads, counted), "left_anti")
    return left.join(least, left["date"].eqNullSafe(least["date"]) & (F.col("load") >= F.col("least")), "left_semi")


def counts_of(words: DataFrame, wanted: DataFrame, cells: int = CELLS) -> DataFrame:
    """(date, word, total) of the names that fall into the ``wanted`` cells."""
    placed = in_cells(words, cells)
    return daily_counts(placed.join(wanted, _same(placed, wanted), "left_semi"))


def daily_topk_in_rounds(
    words: DataFrame, k: int = S.DAILY_TOP, cells: int = CELLS, first: int = FIRST
) -> DataFrame:
    """(date, rn, word, total): as ``daily_topk(daily_counts(words), k)``, row for row."""
    loads = settle(cell_loads(words, cells), "cell-loads")
    heavy = settle(heaviest(loads, first * k), "cells-heavy")
    best = settle(daily_topk(counts_of(words, heavy, cells), k), "cells-best")
    rest = settle(reaching(loads, heavy, best), "cells-rest")
    more = counts_of(words, rest, cells)
    return daily_topk(best.select("date", "word", "total").union(more), k)


def _same(a: DataFrame, b: DataFrame):
    return a["date"].eqNullSafe(b["date"]) & (a["cell"] == b["cell"])
