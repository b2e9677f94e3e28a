"""The packed name list: ``name,offset;name,offset;...``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from namepulse import schema as S


def name_entries(names: Column, keep_empty: bool = False) -> Column:
    """Entries of a packed list as an array.

    Trailing separators add nothing unless ``keep_empty``; an empty entry
    between two others always counts. An empty list has no entries, and a list
    of separators only has none either (or, with ``keep_empty``, one empty
    entry more than it has separators).
    """
    separator = F.lit(S.ENTRY_SEPARATOR)
    present = names if keep_empty else F.rtrim(names, separator)
    return F.when(present != "", F.split(present, separator))


def entry_name(entry: Column) -> Column:
    return F.substring_index(entry, S.OFFSET_SEPARATOR, 1)


def has_names(names: Column) -> Column:
    return names.isNotNull() & (names != "")


def not_stopped(word: Column, stop: Sequence[str] = S.STOP_NAMES) -> Column:
    return ~word.isin(*stop) if stop else F.lit(True)
