"""Arrays cut to a fixed length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_n_padded(array: Column, n: int) -> Column:
    """Exactly ``n`` elements; those the array lacks are NULL."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(array, i))
