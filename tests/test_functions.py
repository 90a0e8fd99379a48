"""Cleaning functions on edge rows with hand-written results."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from doselens.functions import census, parse, products, reports, trials
from doselens.operators import checks


def results(spark, rows, schema, column):
    """The column for each row, in row order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(numbered, f"row_number int, {schema}")
    return [r.result for r in frame.select("row_number", column.alias("result")).orderBy("row_number").collect()]


def check(spark, cases, schema, column):
    rows = [case[:-1] for case in cases]
    assert results(spark, rows, schema, column) == [case[-1] for case in cases]


def test_try_number(spark):
    check(spark, [
        ("12", 12), ("12.5", 13), ("-12.5", -13), ("12.4", 12), (" 12 ", 12), ("1e3", 1000),
        ("", None), ("abc", None), (None, None), ("9" * 25, None),
    ], "s string", parse.try_number("s"))


def test_try_decimal(spark):
    check(spark, [
        ("1.005", Decimal("1.01")), ("7", Decimal("7.00")), ("123456789.5", None), ("1.2.3", None),
        (None, None),
    ], "s string", parse.try_decimal("s"))


def test_strict_number(spark):
    check(spark, [("12", 12), ("1.0", 1), (None, None)], "s string", parse.strict_number("s"))
    with pytest.raises(PySparkException):
        results(spark, [("x",)], "s string", parse.strict_number("s"))


def test_try_int_and_blank(spark):
    check(spark, [("7", 7), ("x", None), ("99999999999", None)], "s string", parse.try_int("s"))
    check(spark, [("  ", None), (" a ", "a"), (None, None)], "s string", parse.blank_to_null("s"))


def test_try_day(spark):
    check(spark, [
        ("2020-05-01", date(2020, 5, 1)), ("20200501", None), ("2020-05", None),
        ("2020-02-30", None), ("2020-5-1", None), ("", None), (None, None),
    ], "s string", parse.try_day("s"))
    check(spark, [("20200501", date(2020, 5, 1)), ("2020-05-01", None)], "s string",
          parse.try_day("s", "yyyyMMdd"))


def test_try_day_auto(spark):
    day = date(2020, 5, 1)
    check(spark, [
        ("2020-05-01", day), ("01-May-2020", day), ("01-MAY-2020", day), ("05/01/2020", day),
        ("2020-05", None), ("13/01/2020", None), ("31-Feb-2020", None), (None, None),
    ], "s string", parse.try_day_auto("s"))


def test_days_between(spark):
    check(spark, [
        (date(2020, 1, 1), date(2020, 1, 3), 2), (date(2020, 1, 3), date(2020, 1, 1), -2),
        (None, date(2020, 1, 1), None), (date(2020, 1, 1), None, None),
    ], "a date, b date", parse.days_between("a", "b"))


def test_parts_and_patterns(spark):
    check(spark, [("7/3", "3"), ("7", ""), (None, None)], "s string", parse.part_of("s", "/", 2))
    check(spark, [("18 Years", "18"), ("N/A", None), (None, None)], "s string",
          parse.first_match("s", "[0-9]+"))


def test_age_years(spark):
    check(spark, [
        ("730", "DY", 2), ("18", "MON", 2), ("17", "MON", 1), ("2.5", "DEC", 30), ("52", "WK", 1),
        ("40", "YR", 40), ("5", "HR", None), ("5", None, None), ("UNK", "YR", None),
        ("14", "DEC", 140), ("9" * 17, "DEC", 999999999999999990), ("9" * 18, "DEC", None),
    ], "a string, u string", reports.age_years("a", "u"))


def test_age_clamp(spark):
    check(spark, [(0, 0), (130, 130), (131, None), (-1, None), (None, None)], "a bigint",
          reports.in_range("a"))


def test_gender(spark):
    check(spark, [
        ("M", "F", "M"), ("F", None, "F"), ("UNK", "M", None), (None, "F", "F"), (None, "M", "M"),
        (None, "NS", None), (None, None, None),
    ], "s string, g string", reports.gender("s", "g"))


def test_weight(spark):
    check(spark, [
        ("70.5", "KG", Decimal("156.5")), ("7050", "G", Decimal("15.5")),
        ("150", "LBS", Decimal("150.0")), ("150", "XX", None), ("n/a", "KG", None),
    ], "w string, u string", reports.weight_lbs("w", "u"))


def test_code_flag(spark):
    check(spark, [("1", True), ("2", False), ("3", None), (None, None)], "c string",
          reports.code_flag("c"))
    with pytest.raises(PySparkException):
        results(spark, [("yes",)], "c string", reports.code_flag("c"))


def test_dose_amount(spark):
    check(spark, [
        ("7/3", Decimal("2.33333333")), ("7/0", None), ("7 mg", Decimal("7")), ("7mg", Decimal("7")),
        ("7-12", Decimal("9.5")), ("7.25", Decimal("7.25")), ("-5", Decimal("-5")),
        ("5 mg/ml", None), ("1.2.3", None), ("1.2.3 mg", None), ("UNKNOWN", None), (None, None),
        ("7/2/9", Decimal("3.5")), ("99999999.99/0.01", Decimal("9999999999")),
        ("123456789 mg", None),
    ], "d string", reports.dose_amount("d"))


def test_age_group(spark):
    check(spark, [
        (0, "Under 5"), (4, "Under 5"), (5, "5-9"), (9, "5-9"), (10, "10-14"), (15, "15-19"),
        (20, "20-24"), (25, "25-34"), (34, "25-34"), (35, "35-44"), (45, "45-54"), (55, "55-59"),
        (60, "60-64"), (65, "65-74"), (75, "75-84"), (84, "75-84"), (85, "85+"), (130, "85+"),
        (None, None),
    ], "a int", reports.age_group("a"))


def test_application_id(spark):
    ids = [("NDA012345",), ("BLA12345",), ("12345",), ("ANDA1",), (None,)]
    for fallback, numbers in ((False, [12345, None, 12345, None, None]),
                              (True, [12345, 12345, 12345, None, None])):
        kind, number = products.application_id("i", fallback)
        assert results(spark, ids, "i string", kind) == ["NDA", "BLA", "", "", None]
        assert results(spark, ids, "i string", number) == numbers


def test_state_code(spark):
    check(spark, [(1, "AL"), (2, "AK"), (3, None), (56, "WY"), (72, "PR"), (0, None), (99, None),
                  (-1, None), (None, None)], "c int", census.state_postal_code("c"))
    assert len(census.STATE_POSTAL_CODES) == 52


def test_row_total(spark):
    check(spark, [(1, 2, 3), (None, 2, None)], "a bigint, b bigint", census.total_of(["a", "b"]))


def test_phase_bucket(spark):
    check(spark, [
        ("PHASE1|PHASE2", "Phase 1/2"), ("PHASE2|PHASE3", "Phase 2/3"), ("phase1", "Phase 1"),
        ("EARLY_PHASE1", "Phase 1"), ("PHASE2", "Phase 2"), ("PHASE3", "Phase 3"),
        ("PHASE4", "Phase 4"), ("NA", "N/A"), ("", "Unknown"), (None, "Unknown"),
    ], "p string", trials.phase_bucket("p"))


def test_flags(spark):
    check(spark, [("x", True), ("  ", False), ("", False), (None, False)], "s string",
          trials.has_text("s"))
    check(spark, [("INDUSTRY", True), ("NIH", False), (None, False)], "s string",
          trials.equals("s", "INDUSTRY"))


def test_age_number(spark):
    cases = [("18 Years", 18, 18), ("6 Months", 6, 1), ("30 Days", 30, 0), ("104 Weeks", 104, 2),
             ("5 Hours", 5, 0), ("N/A", None, None), (None, None, None)]
    check(spark, [(text, plain) for text, plain, _ in cases], "s string", trials.age_number("s"))
    check(spark, [(text, unit) for text, _, unit in cases], "s string",
          trials.age_number("s", respect_units=True))


def test_eligibility_bucket(spark):
    check(spark, [
        (None, "Unknown"), (17, "Includes children (<18)"), (18, "Adults (18-64)"),
        (64, "Adults (18-64)"), (65, "Older adults (65+)"),
    ], "a int", trials.eligibility_bucket("a"))


def test_sex_label(spark):
    check(spark, [("ALL", "All"), ("FEMALE", "F"), ("MALE", "M"), ("OTHER", "OTHER"), (None, None)],
          "s string", trials.sex_label("s"))


def test_lenient_functions_survive_without_ansi(spark):
    """Lenient results do not depend on the session's ANSI setting."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        check(spark, [("12.5", 13), ("abc", None)], "s string", parse.try_number("s"))
        check(spark, [("7/0", None), ("7-12", Decimal("9.5"))], "d string", reports.dose_amount("d"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_keys_of_38_digits(spark):
    check(spark, [("12", Decimal(12)), ("9" * 25, Decimal("9" * 25)), ("12.5", Decimal(13)), ("-" + "9" * 38, Decimal("-" + "9" * 38)),
                  ("9" * 39, None), ("x", None), (None, None)], "s string", parse.try_key("s"))
    check(spark, [("12", False), ("9" * 38, False), ("9" * 39, True), (" -" + "1" * 39, True), ("0" * 50, False),
                  ("x", False), (None, False)],
          "s string", F.coalesce(checks.too_long_a_number("s"), F.lit(False)))
