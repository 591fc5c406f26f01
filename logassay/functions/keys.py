"""Columns as keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(field: T.StructField) -> Column:
    """The column in a form that can be grouped and ordered: a map as its sorted entries."""
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(field.name)).alias(field.name)
    return F.col(field.name)
