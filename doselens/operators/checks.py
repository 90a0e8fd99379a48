"""Data checks.

A check is a condition that is true for a violating row. ``violations`` lists
the rows, ``summary`` counts several checks in one pass; a check passes when it
finds none. ``observed`` counts them by quarter in the very job that writes the rows.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.parse import ColumnOrName, as_column, try_key
from ..functions.reports import AGE_RANGE, age_years

# Dose texts that are allowed to stay unparsed.
WORDS_ONLY = "^[A-Za-z ]+$"

WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def dose_unparsed() -> Column:
    """A dose text that gave no number although it is not just words."""
    raw = F.col("dose_amt_raw")
    return F.col("dose_amount").isNull() & raw.isNotNull() & ~raw.rlike(WORDS_ONLY)


def not_a_number(column: ColumnOrName = "nda_number") -> Column:
    """A value that is present but not a number.

    On the cleaned column this cannot happen (Q12); on the raw ``nda_num`` it
    counts what cleaning turns into null.
    """
    text = as_column(column).cast("string")
    return text.isNotNull() & try_key(text).isNull()


def too_long_a_number(column: ColumnOrName) -> Column:
    """A whole number beyond 38 digits, which cleaning turns into null: its rows find no partner."""
    text = as_column(column)
    return try_key(text).isNull() & text.rlike(WHOLE_NUMBER)


def age_out_of_range(column: ColumnOrName = "age_in_years") -> Column:
    """An age outside the believed range; meaningful before the clamp (Q12)."""
    return ~as_column(column).between(*AGE_RANGE)


def violations(frame: DataFrame, check: Column, *columns: str) -> DataFrame:
    """The violating rows of one check."""
    return frame.filter(check).select(*columns)


def summary(frame: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check with its number of violations, from a single scan."""
    counted = frame.agg(*[F.count_if(check).alias(n) for n, check in checks.items()])
    return counted.unpivot([], list(checks), "check_name", "violations")


MOST_QUARTERS = 1000
"""Quarters of one write that are told apart, 250 years of them."""


def raw_checks(table: str, columns: Collection[str]) -> dict[str, Column]:
    """T2, T3 and the keys on the raw rows of a quarterly table, where it has the columns."""
    every = {
        "DEMO": {
            "raw_age_is_realistic": ("age", "age_cod"),
            "report_key_fits_38_digits": ("primaryid",),
        },
        "DRUG": {
            "raw_nda_num_is_numeric": ("nda_num",),
            "drug_key_fits_38_digits": ("caseid", "drug_seq"),
        },
    }
    conditions = {
        "raw_age_is_realistic": lambda: age_out_of_range(age_years("age", "age_cod")),
        "report_key_fits_38_digits": lambda: too_long_a_number("primaryid"),
        "raw_nda_num_is_numeric": lambda: not_a_number("nda_num"),
        "drug_key_fits_38_digits": lambda: too_long_a_number(F.concat("caseid", "drug_seq")),
    }
    have = {name.lower() for name in columns}
    return {
        check: conditions[check]()
        for check, needed in every.get(table, {}).items()
        if have.issuperset(needed)
    }


def observed(frame: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame, which counts the violations of each check by quarter while it is written.

    The counts are gathered by the tasks that write, so a task that is repeated counts
    once. A histogram with a bin for each quarter holds them, exactly.
    """
    observation = Observation()
    quarter = F.col("src_year").cast("int") * 10 + F.col("src_quarter").cast("int")
    counts = [
        F.histogram_numeric(F.when(check, quarter), F.lit(MOST_QUARTERS)).alias(name)
        for name, check in checks.items()
    ]
    return frame.observe(observation, F.count("*").alias("rows"), *counts), observation


def violations_by_quarter(
    observation: Observation, checks: Collection[str], quarters: Collection[tuple[int, int]]
) -> list[tuple[int, int, str, int]]:
    """Year, quarter, check and violations of a finished write, 0 where there are none."""
    found = observation.get
    rows = []
    for check in checks:
        counts: dict[int, int] = {}
        # Tasks' histograms are put together side by side, so a quarter may have several bars.
        for bar in found.get(check) or []:
            counts[int(bar["x"])] = counts.get(int(bar["x"]), 0) + int(bar["y"])
        rows += [(y, q, check, counts.get(y * 10 + q, 0)) for y, q in sorted(quarters)]
    return rows
