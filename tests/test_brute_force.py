"""Dirty-text parsers and the trial report against plain Python on random rows."""

import random
import re
import statistics
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from pyspark.sql import functions as F

from doselens.functions import parse, reports
from doselens.plans import marts

ROWS = 3000


def fixed(text, precision, scale):
    """A lenient fixed-point reading of a text."""
    if text is None:
        return None
    try:
        number = Decimal(text.strip()).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
    except InvalidOperation:
        return None
    if not number.is_finite() or abs(number) >= Decimal(10) ** (precision - scale):
        return None
    return number


def ratio(a, b, scale):
    return (a / b).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)


def dose(text):
    if text is None:
        return None
    if "/" in text:
        parts = [fixed(p, 10, 2) for p in text.split("/")[:2]]
        return None if None in parts or parts[1] == 0 else ratio(*parts, 8)
    if re.fullmatch(r"[0-9.]+\s*[A-Za-z]+", text):
        return fixed(re.match(r"[0-9.]+", text).group(), 10, 2)
    if re.fullmatch(r"[0-9.]+-[0-9.]+", text):
        parts = [fixed(p, 10, 2) for p in text.split("-")]
        return None if None in parts else sum(parts) / 2
    return fixed(text, 10, 2)


def random_texts(alphabet, longest):
    source = random.Random(7)
    texts = ["".join(source.choices(alphabet, k=source.randint(0, longest))) for _ in range(ROWS)]
    return [None, *texts]


def run(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    found = rows.select("i", column.alias("v")).orderBy("i").collect()
    return [r.v for r in found]


def test_dose_amount(spark):
    texts = random_texts("0123456789..//--- mgX", 7) + random_texts("0123456789.", 12)
    assert run(spark, texts, reports.dose_amount("s")) == [dose(t) for t in texts]
    assert sum(dose(t) is not None for t in texts) > ROWS / 4


def test_try_number(spark):
    zero_with_huge_exponent = re.compile(r"[ +-]*[0.]+e\+?\d{2,} *")  # null in Spark, 0 elsewhere
    texts = [t for t in random_texts("0123456789.- e+", 6)
             if t is None or not zero_with_huge_exponent.fullmatch(t)]
    expected = [fixed(t, 38, 0) for t in texts]
    fits = [n is not None and -(2**63) <= n < 2**63 for n in expected]
    assert run(spark, texts, parse.try_number("s")) == [
        int(n) if fit else None for n, fit in zip(expected, fits)]


def test_age_and_weight(spark):
    source = random.Random(11)
    units = {"DY": Decimal("365.25"), "MON": 12, "WK": Decimal("52.1775"), "YR": 1, "DEC": Decimal("0.1")}
    rows = [(source.choice([str(source.randint(-50, 60000)), f"{source.randint(0, 99)}.5", "UNK"]),
             source.choice([*units, "HR"]), source.choice(["KG", "G", "LBS", "XX"])) for _ in range(ROWS)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n string, u string, w string")
    found = frame.orderBy("i").select(
        reports.age_years("n", "u").alias("age"), reports.weight_lbs("n", "w").alias("weight")).collect()
    for (text, unit, weight_unit), row in zip(rows, found):
        number = fixed(text, 38, 0)
        age = None if number is None or unit not in units else int(ratio(number, units[unit], 0))
        per_unit = {"KG": Decimal("2.20462"), "G": Decimal("0.00220462"), "LBS": Decimal(1)}.get(weight_unit)
        weight = None if number is None or per_unit is None else fixed(str(number * per_unit), 30, 1)
        assert (row.age, row.weight) == (age, weight), (text, unit, weight_unit)


def test_trial_report(spark):
    """Few groups of very different size, with nulls among keys and measures."""
    source = random.Random(3)

    def study():
        return (source.choice(["ALL", "ALL", "ALL", "MALE", None]),
                source.choice([None, *range(5), 10**7]), source.choice([None, -3, 0, 7, 7, 900]),
                source.choice([None, 1, 2]), source.random() < 0.5)

    rows = [study() for _ in range(ROWS)]
    frame = spark.createDataFrame(rows, """eligible_sex string, enrollment bigint,
        study_duration_days int, location_count bigint, has_drug_intervention boolean""").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in (
            "overall_status", "study_type", "lead_sponsor_class", "first_location_country")],
        F.lit("N/A").alias("phase_bucket"), F.lit(False).alias("is_industry_sponsored"),
        F.lit(None).cast("bigint").alias("minimum_age_years"))
    groups = defaultdict(list)
    for row in rows:
        groups[(row[0], row[4])].append(row)

    def of(values, reduce):
        known = [v for v in values if v is not None]
        return reduce(known) if known else None

    expected = sorted(
        (sex or "ALL", drug, len(g), of([r[1] for r in g], sum), of([r[1] for r in g], lambda v: sum(v) / len(v)),
         of([r[1] for r in g], statistics.median), of([r[2] for r in g], lambda v: sum(v) / len(v)),
         of([r[2] for r in g], statistics.median), of([r[3] for r in g], sum), len(g) if drug else 0)
        for (sex, drug), g in groups.items())
    report = marts.rpt_clinical_trials(frame.repartition(7))
    found = sorted(
        (r.eligible_sex, r.has_drug_intervention, r.study_count, r.total_enrollment, r.avg_enrollment,
         r.median_enrollment, r.avg_duration_days, r.median_duration_days, r.total_locations,
         r.drug_study_count) for r in report.collect())
    assert found == expected
    counts = marts.trial_counts(frame).collect()
    assert sorted((r.eligible_sex, r.has_drug_intervention, r.study_count, r.drug_study_count)
                  for r in counts) == sorted((e[0], e[1], e[2], e[-1]) for e in expected)
