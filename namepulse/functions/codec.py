"""Bytes on the wire: malformed text, and counts as eight-byte longs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REPLACEMENT = "�"
_ESCAPE = "\u001a"


def clean_utf8(value: Column) -> Column:
    """Text with malformed UTF-8 sequences dropped.

    Spark marks a malformed sequence with U+FFFD. A U+FFFD that the text
    itself holds is set aside first, so only the marks go.
    """
    marked = F.make_valid_utf8(
        F.replace(
            F.replace(value, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")),
            F.lit(_REPLACEMENT),
            F.lit(_ESCAPE + "1"),
        )
    )
    dropped = F.replace(marked, F.lit(_REPLACEMENT), F.lit(""))
    restored = F.replace(
        F.replace(dropped, F.lit(_ESCAPE + "1"), F.lit(_REPLACEMENT)),
        F.lit(_ESCAPE + "0"),
        F.lit(_ESCAPE),
    )
    return F.when(F.is_valid_utf8(value), value).otherwise(restored)


def encode_count(count: Column) -> Column:
    """A count as eight bytes, most significant first."""
    return F.unhex(F.lpad(F.hex(count), 16, "0"))


def decode_count(data: Column) -> Column:
    return F.conv(F.hex(data), 16, -10).cast("bigint")
