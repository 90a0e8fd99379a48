"""Report queries over the report tables.

Each takes report tables that were filtered beforehand and returns a result of
a few rows. Population figures are always sums over the selected states (Q10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.reports import AGE_GROUPS
from ..functions.trials import ELIGIBILITY_BUCKETS, sex_label
from ..operators import aggregates as agg
from ..operators.distinct import distinct_members
from ..operators.filters import member_of
from ..operators.joins import on_spine

AGE_LABELS = [label for label, _, _ in AGE_GROUPS]
COLUMN_OF_AGE = {label: column for label, _, column in AGE_GROUPS}
POPULATION = ["male_pop", "female_pop", "total_pop", *COLUMN_OF_AGE.values()]


def select_faers(
    report: DataFrame,
    years: Sequence[int] = (),
    genders: Sequence[str] = (),
    ingredients: Sequence[str] = (),
    brands: Sequence[str] = (),
) -> DataFrame:
    """F2 for the age and gender reports."""
    return member_of(
        report,
        {
            "source_year": years,
            "gender": genders,
            "active_ingredient_name": ingredients,
            "brand_name": brands,
        },
    )


def select_census(report: DataFrame, states: Sequence[str] = ()) -> DataFrame:
    """F2 for the population report."""
    return member_of(report, {"state_abbreviation": states})


def select_trials(
    report: DataFrame, statuses: Sequence[str] = (), phases: Sequence[str] = ()
) -> DataFrame:
    """F2 for the trial report."""
    return member_of(report, {"overall_status": statuses, "phase_bucket": phases})


def filter_options(age: DataFrame, census: DataFrame, trials: DataFrame) -> DataFrame:
    """The values each filter can take, sorted."""
    found = (
        agg.options(age, ["active_ingredient_name", "brand_name"])
        .unionByName(agg.options(census, ["state_abbreviation"]))
        .unionByName(agg.options(trials, ["overall_status", "phase_bucket"]))
    )
    return found.orderBy("option", "value")


def upper_names(frame: DataFrame) -> DataFrame:
    """All column names in upper case."""
    return frame.toDF(*[name.upper() for name in frame.columns])


def headline(age: DataFrame, census: DataFrame, trials: DataFrame) -> DataFrame:
    """One row of totals.

    The three one-row totals are stacked and added up, so no join is needed.
    """
    reports = age.agg(
        agg.total("report_count").alias("total_reports"),
        F.coalesce(agg.distinct_values("age_group"), F.lit(0))
        .cast("bigint")
        .alias("age_groups"),
    )
    people = census.agg(agg.total("total_pop").alias("total_population"))
    studies = trials.agg(agg.total("study_count").alias("total_trials"))
    stacked = reports.unionByName(people, allowMissingColumns=True).unionByName(
        studies, allowMissingColumns=True
    )
    figures = ["total_reports", "total_population", "age_groups", "total_trials"]
    rate = agg.rate_per_100k(F.col("total_reports"), F.col("total_population"))
    return agg.column_totals(stacked, figures).withColumn("reports_per_100k", rate)


def distinct_headline(members: DataFrame) -> DataFrame:
    """M13 with Q9: the different reports behind the selected cells, and by gender and year.

    ``members`` are the cells of ``marts.report_members`` after ``select_faers``. A row for
    each gender and year, and one of nulls for all of them, which is not their sum.
    """
    everything = distinct_members(members, name="distinct_reports")
    by_key = distinct_members(members, ["gender", "source_year"], "distinct_reports")
    return by_key.unionByName(everything, allowMissingColumns=True)


def label_spine(spark: SparkSession, key: str, labels: Sequence[str]) -> DataFrame:
    """O3: a fixed label list with its order."""
    listed = F.array(*[F.lit(label) for label in labels])
    return spark.range(1).select(F.posexplode(listed).alias("position", key))


def age_comparison(age: DataFrame, census: DataFrame) -> DataFrame:
    """Percent of reports and of people in each age group."""
    reports = agg.label_totals(age, "age_group", AGE_LABELS, "report_count", "all_reports")
    faers = agg.shares(
        reports, {label: label for label in AGE_LABELS}, "all_reports",
        "age_group", "faers_pct",
    )
    people = agg.shares(
        agg.column_totals(census, POPULATION),
        {column: label for label, column in COLUMN_OF_AGE.items()}, "total_pop",
        "age_group", "census_pct",
    )
    spine = label_spine(age.sparkSession, "age_group", AGE_LABELS)
    merged = on_spine(spine, "age_group", faers, people)
    return merged.orderBy("position").drop("position")


def _faers_genders(gender: DataFrame) -> DataFrame:
    return agg.regrouped(gender, "gender", "report_count").select(
        F.lit("faers").alias("source"), "gender", F.col("report_count").alias("amount")
    )


def _census_genders(census: DataFrame) -> DataFrame:
    totals = census.agg(F.sum("male_pop").alias("M"), F.sum("female_pop").alias("F"))
    long = totals.unpivot([], ["M", "F"], "gender", "amount")
    return long.select(F.lit("census").alias("source"), "gender", "amount")


def gender_split(gender: DataFrame, census: DataFrame) -> DataFrame:
    """Reports and people by gender."""
    return _faers_genders(gender).unionByName(_census_genders(census))


def age_three_way(age: DataFrame, census: DataFrame, trials: DataFrame) -> DataFrame:
    """Percent of people, reports and trials in three age buckets.

    The youngest bucket holds the 15-19 group, and trials of unknown age are
    left out (Q17).
    """
    key = "age_bucket"
    reports = agg.label_totals(age, "age_group", AGE_LABELS, "report_count", "all_rows")
    people = agg.column_totals(census, list(COLUMN_OF_AGE.values()))
    studies = agg.label_totals(
        trials, "eligibility_age_bucket", list(ELIGIBILITY_BUCKETS), "study_count", "all_rows"
    )
    census_buckets = {
        bucket: [COLUMN_OF_AGE[label] for label in labels]
        for bucket, labels in ELIGIBILITY_BUCKETS.items()
    }
    merged = on_spine(
        label_spine(age.sparkSession, key, list(ELIGIBILITY_BUCKETS)),
        key,
        agg.bucket_shares(people, census_buckets, key, "census_pct"),
        agg.bucket_shares(reports, ELIGIBILITY_BUCKETS, key, "faers_pct"),
        agg.bucket_shares(studies, {b: [b] for b in ELIGIBILITY_BUCKETS}, key, "trials_pct"),
    )
    return merged.orderBy("position").drop("position")


def gender_three_way(gender: DataFrame, census: DataFrame, trials: DataFrame) -> DataFrame:
    """Reports, people and trials by gender or admitted sex."""
    studies = agg.regrouped(trials, "eligible_sex", "study_count").select(
        F.lit("trials").alias("source"),
        sex_label("eligible_sex").alias("gender"),
        F.col("study_count").alias("amount"),
    )
    return gender_split(gender, census).unionByName(studies)
