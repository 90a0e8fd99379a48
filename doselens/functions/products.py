"""Product identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, as_column, try_number


def application_id(
    text: ColumnOrName, suffix_fallback: bool = False
) -> tuple[Column, Column]:
    """P20: split ``NDA012345`` into its type ``NDA`` and number 12345.

    The number is the last six characters. Where those are not numeric the type
    loses only five characters and the number is the whole id if that is a
    five-digit number, which a letter prefix rules out (Q4);
    ``suffix_fallback`` takes the last five characters instead.
    """
    text = as_column(text)
    six = try_number(F.right(text, F.lit(6)))
    if suffix_fallback:
        five = try_number(F.right(text, F.lit(5)))
    else:
        five = text.try_cast("decimal(5,0)").cast("bigint")
    suffix_length = F.when(six.isNull(), 5).otherwise(6)
    kind = F.left(text, F.length(text) - suffix_length)
    return kind, F.coalesce(six, five)
