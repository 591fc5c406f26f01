"""Text checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def invalid_utf8(c: Column) -> Column:
    return ~F.is_valid_utf8(c)


def byte_pieces(c: Column, size: int) -> Column:
    """The value's bytes in consecutive pieces of ``size``, as strings; an empty text is one piece."""
    raw = c.cast("binary")
    last = F.greatest(F.ceil(F.length(raw) / size) - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last.cast("int")), lambda k: F.substring(raw, k * size + 1, F.lit(size)).cast("string")
    )
