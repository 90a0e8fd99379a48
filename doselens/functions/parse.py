"""Text to numbers and dates.

Lenient conversions return null on bad text, strict ones fail the query under
Spark's default ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Date layouts that are recognised, as pattern and Spark format.
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
DAY_MONTH_NAME = (r"^\d{2}-[A-Za-z]{3}-\d{4}$", "dd-MMM-yyyy")
US_DAY = (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy")


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def try_number(text: ColumnOrName) -> Column:
    """Text to integer, rounding halves away from zero; bad text is null.

    For counts and measures, which 64 bits hold; keys take ``try_key``.
    """
    return as_column(text).try_cast("decimal(38,0)").try_cast("bigint")


def try_key(text: ColumnOrName) -> Column:
    """P2 for keys: as ``try_number`` with all 38 digits, so no long id loses its rows."""
    return as_column(text).try_cast("decimal(38,0)")


def try_decimal(text: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Text to a fixed-point number; bad text and overflow are null."""
    return as_column(text).try_cast(f"decimal({precision},{scale})")


def strict_number(text: ColumnOrName, type_name: str = "bigint") -> Column:
    """Text to integer; bad text fails the query."""
    return as_column(text).cast("decimal(38,0)").cast(type_name)


def try_int(text: ColumnOrName) -> Column:
    """P5: text to a 32-bit integer, else null."""
    return as_column(text).try_cast("decimal(38,0)").try_cast("int")


def blank_to_null(text: ColumnOrName) -> Column:
    """Strip spaces, then treat nothing left as null."""
    return F.nullif(F.trim(as_column(text)), F.lit(""))


def try_day(text: ColumnOrName, date_format: str | None = None) -> Column:
    """``yyyy-MM-dd`` text to a date, every other layout is null.

    The pattern guard keeps bad text away from the formatter, which signals it
    by an exception per row; with no guard a column of other layouts is about
    five times slower. ``date_format`` reads another layout (Q3).
    """
    text = as_column(text)
    if date_format is not None:
        return F.try_to_date(text, date_format)
    return F.when(text.rlike(ISO_DAY), text.try_cast("date"))


def try_day_auto(text: ColumnOrName) -> Column:
    """ISO, ``01-May-2020`` or ``05/01/2020`` text to a date, else null."""
    text = as_column(text)
    parsed = F.when(text.rlike(ISO_DAY), text.try_cast("date"))
    for pattern, layout in (DAY_MONTH_NAME, US_DAY):
        parsed = parsed.when(text.rlike(pattern), F.try_to_date(text, layout))
    return parsed


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from start to end; negative when reversed."""
    return F.date_diff(as_column(end), as_column(start))


def first_match(text: ColumnOrName, pattern: str) -> Column:
    """First match of a pattern, or null."""
    return F.regexp_substr(as_column(text), F.lit(pattern))


def part_of(text: ColumnOrName, delimiter: str, number: int) -> Column:
    """The n-th delimited part, ``''`` when there are fewer parts."""
    return F.split_part(as_column(text), F.lit(delimiter), F.lit(number))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null for a zero divisor."""
    return F.try_divide(numerator, denominator)
