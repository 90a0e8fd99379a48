"""Trial fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, as_column, first_match, try_number
from .reports import DAYS_PER_YEAR, MONTHS_PER_YEAR, WEEKS_PER_YEAR

# Substrings that must all occur, and the bucket, first fit wins.
PHASE_BUCKETS = [
    (["PHASE1", "PHASE2"], "Phase 1/2"),
    (["PHASE2", "PHASE3"], "Phase 2/3"),
    (["PHASE1"], "Phase 1"),
    (["PHASE2"], "Phase 2"),
    (["PHASE3"], "Phase 3"),
    (["PHASE4"], "Phase 4"),
    (["NA"], "N/A"),
]

# Eligibility buckets, in report order, with their age groups.
CHILDREN = "Includes children (<18)"
ADULTS = "Adults (18-64)"
OLDER_ADULTS = "Older adults (65+)"
ELIGIBILITY_BUCKETS = {
    CHILDREN: ["Under 5", "5-9", "10-14", "15-19"],
    ADULTS: ["20-24", "25-34", "35-44", "45-54", "55-59", "60-64"],
    OLDER_ADULTS: ["65-74", "75-84", "85+"],
}

# Labels of the sexes a trial admits.
SEX_LABELS = {"ALL": "All", "FEMALE": "F", "MALE": "M"}


def phase_bucket(phases: ColumnOrName) -> Column:
    """Broad phase by substring, ignoring case (Q7)."""
    phases = as_column(phases)
    chain = F
    for needles, label in PHASE_BUCKETS:
        test = F.lit(True)
        for needle in needles:
            test = test & phases.ilike(f"%{needle}%")
        chain = chain.when(test, label)
    return chain.otherwise("Unknown")


def has_text(text: ColumnOrName) -> Column:
    """True when there is more than spaces; null is false."""
    return F.coalesce(F.length(F.trim(as_column(text))) > 0, F.lit(False))


def equals(text: ColumnOrName, value: str) -> Column:
    """Equality in which null is false."""
    return F.coalesce(as_column(text) == value, F.lit(False))


def age_number(text: ColumnOrName, respect_units: bool = False) -> Column:
    """The first number of ``18 Years``, whatever the unit (Q6).

    ``respect_units`` converts months, weeks and days, and counts hours and
    minutes as 0 years.
    """
    text = as_column(text)
    number = try_number(first_match(text, "[0-9]+"))
    if not respect_units:
        return number
    exact = number.cast("decimal(20,0)")
    years = (
        F.when(text.ilike("%month%"), exact / F.lit(MONTHS_PER_YEAR))
        .when(text.ilike("%week%"), exact / F.lit(WEEKS_PER_YEAR))
        .when(text.ilike("%day%"), exact / F.lit(DAYS_PER_YEAR))
        .when(text.ilike("%hour%") | text.ilike("%minute%"), exact * F.lit(0))
        .otherwise(exact)
    )
    return F.round(years, 0).try_cast("bigint")


def eligibility_bucket(minimum_age: ColumnOrName) -> Column:
    """The comparison bucket of the lowest admitted age."""
    age = as_column(minimum_age)
    return (
        F.when(age.isNull(), "Unknown")
        .when(age < 18, CHILDREN)
        .when(age < 65, ADULTS)
        .otherwise(OLDER_ADULTS)
    )


def sex_label(sex: ColumnOrName) -> Column:
    """Short label, any other value unchanged."""
    sex = as_column(sex)
    chain = F
    for value, label in SEX_LABELS.items():
        chain = chain.when(sex == value, label)
    return chain.otherwise(sex)
