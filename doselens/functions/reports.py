"""Safety-report fields: age, gender, weight, flags, dose."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import (
    ColumnOrName,
    as_column,
    first_match,
    part_of,
    safe_ratio,
    strict_number,
    try_decimal,
    try_number,
)

# Years per age unit, as divisor or factor.
DAYS_PER_YEAR = Decimal("365.25")
WEEKS_PER_YEAR = Decimal("52.1775")
MONTHS_PER_YEAR = 12
YEARS_PER_DECADE = 10

# Pounds per kilogram, and the ages that are believed.
LBS_PER_KG = Decimal("2.20462")
AGE_RANGE = (0, 130)

# Dose texts that are understood.
DOSE_WITH_UNIT = r"^[0-9.]+\s*[A-Za-z]+$"
DOSE_NUMBER = r"^[0-9.]+"
DOSE_RANGE = r"^[0-9.]+\-[0-9.]+$"
DOSE_TYPE = "decimal(18,8)"

# Age group label, first age above the group, population column.
AGE_GROUPS = [
    ("Under 5", 5, "pop_under_5"),
    ("5-9", 10, "pop_5_to_9"),
    ("10-14", 15, "pop_10_to_14"),
    ("15-19", 20, "pop_15_to_19"),
    ("20-24", 25, "pop_20_to_24"),
    ("25-34", 35, "pop_25_to_34"),
    ("35-44", 45, "pop_35_to_44"),
    ("45-54", 55, "pop_45_to_54"),
    ("55-59", 60, "pop_55_to_59"),
    ("60-64", 65, "pop_60_to_64"),
    ("65-74", 75, "pop_65_to_74"),
    ("75-84", 85, "pop_75_to_84"),
    ("85+", None, "pop_85_plus"),
]


def age_years(age: ColumnOrName, unit: ColumnOrName) -> Column:
    """P10: age text and unit code to whole years, not yet range-checked.

    The text is rounded to an integer before the unit is applied (Q1), and the
    result is rounded again. Unknown units are null (Q16).
    """
    number = try_number(age).cast("decimal(20,0)")
    unit = as_column(unit)
    years = (
        F.when(unit == "DY", number / F.lit(DAYS_PER_YEAR))
        .when(unit == "MON", number / F.lit(MONTHS_PER_YEAR))
        .when(unit == "WK", number / F.lit(WEEKS_PER_YEAR))
        .when(unit == "DEC", number * F.lit(YEARS_PER_DECADE))
        .when(unit == "YR", number)
    )
    return F.round(years, 0).try_cast("bigint")


def in_range(value: ColumnOrName, bounds: tuple[int, int] = AGE_RANGE) -> Column:
    """The whole number inside the bounds, else null.

    A lookup in the list of allowed numbers names the value once. Comparisons
    would name it three times, and a filter that Spark moves below them would
    carry as many copies of the whole age calculation.
    """
    low, high = bounds
    allowed = F.sequence(F.lit(low), F.lit(high))
    return F.get(allowed, as_column(value).try_cast("int") - F.lit(low))


def gender(sex: ColumnOrName, gender_code: ColumnOrName) -> Column:
    """M or F. The second code counts only where the first is null (Q15)."""
    sex = as_column(sex)
    source = F.when(sex.isNull(), as_column(gender_code)).otherwise(sex)
    return F.when(source.isin("M", "F"), source)


def weight_lbs(weight: ColumnOrName, unit: ColumnOrName) -> Column:
    """Weight text and unit code to pounds with one decimal.

    The text is rounded to an integer first (Q1).
    """
    number = try_number(weight).cast("decimal(20,0)")
    unit = as_column(unit)
    pounds = (
        F.when(unit == "KG", number * F.lit(LBS_PER_KG))
        .when(unit == "G", number / F.lit(1000) * F.lit(LBS_PER_KG))
        .when(unit == "LBS", number)
    )
    return F.round(pounds, 1).cast("decimal(24,1)")


def code_flag(code: ColumnOrName) -> Column:
    """Code 1 is true, 2 is false, any other number null; bad text fails."""
    number = strict_number(code, "int")
    return F.when(number == 1, True).when(number == 2, False)


def dose_amount(text: ColumnOrName) -> Column:
    """Dose text to a number; the first layout that fits decides.

    ``a/b`` is a ratio, ``5 mg`` its number, ``a-b`` the middle of the range,
    and anything else a plain number or null.
    """
    text = as_column(text)
    ratio = safe_ratio(
        try_decimal(part_of(text, "/", 1)), try_decimal(part_of(text, "/", 2))
    )
    middle = (
        try_decimal(part_of(text, "-", 1)) + try_decimal(part_of(text, "-", 2))
    ) / F.lit(2)
    return (
        F.when(text.contains("/"), ratio.cast(DOSE_TYPE))
        .when(
            text.rlike(DOSE_WITH_UNIT),
            try_decimal(first_match(text, DOSE_NUMBER)).cast(DOSE_TYPE),
        )
        .when(text.contains("-") & text.rlike(DOSE_RANGE), middle.cast(DOSE_TYPE))
        .otherwise(try_decimal(text).cast(DOSE_TYPE))
    )


def age_group(age: ColumnOrName) -> Column:
    """One of thirteen age group labels."""
    age = as_column(age)
    closed = [(label, limit) for label, limit, _ in AGE_GROUPS if limit is not None]
    open_label = AGE_GROUPS[-1][0]
    first_label, first_limit = closed[0]
    chain = reduce(
        lambda acc, group: acc.when(age < group[1], group[0]),
        closed[1:],
        F.when(age < first_limit, first_label),
    )
    return chain.when(age >= closed[-1][1], open_label)
