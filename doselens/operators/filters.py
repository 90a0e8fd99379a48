"""Optional report filters (F1, F2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Filters = Mapping[str, Sequence[object]]


def member_of(frame: DataFrame, filters: Filters) -> DataFrame:
    """keep rows whose column is in its list; an empty list keeps all rows."""
    for column, values in filters.items():
        if values:
            frame = frame.filter(F.col(column).isin(list(values)))
    return frame


def known(frame: DataFrame, column: str) -> DataFrame:
    """rows that have a value."""
    return frame.filter(F.col(column).isNotNull())
