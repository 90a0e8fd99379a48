"""Dimension and report tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reports, trials
from ..functions.census import BROAD_AGE_BANDS, POPULATION_COLUMNS
from ..operators.distinct import member_cells
from ..operators.filters import known
from ..operators.joins import drugs_with_products, reports_with_drugs
from ..operators.selection import selected_medians
from .staging import clean_demo, clean_drug

# The columns of the dimension tables, in order.
DIM_DRUG_REPORT_COLUMNS = [
    "primary_id", "if_code", "event_date", "manufacturer_received_date",
    "initial_fda_received_date", "current_fda_received_date", "report_code",
    "manufacturer_number", "manufacturer_name",
]
DIM_DRUG_DRUG_COLUMNS = [
    "gender", "weight_in_lbs", "role_code", "drug_name", "is_validated_trade_name",
]
DIM_DRUG_DOSE_COLUMNS = [
    "dose", "cumulative_dose", "dechallenge", "rechallenge", "lot_number",
    "expiration_date", "dose_amount", "dose_unit", "dose_form", "dose_frequency",
    "source_year", "source_quarter",
]
DIM_DRUG_PRODUCT_COLUMNS = [
    "last_updated", "application_type", "application_number",
    "active_ingredient_name", "active_ingredient_strength", "brand_name",
    "dosage_form", "marketing_status", "product_number", "reference_drug",
    "reference_standard", "te_code", "sponsor_name",
]
DIM_CENSUS_COLUMNS = [
    *list(POPULATION_COLUMNS.values())[:16],
    *BROAD_AGE_BANDS,
    *list(POPULATION_COLUMNS.values())[16:],
    "state_abbreviation", "state_code", "county_code", "fips_code",
]
DIM_TRIAL_COLUMNS = [
    "nct_id", "brief_title", "official_title", "org_study_id", "overall_status",
    "start_date", "primary_completion_date", "completion_date",
    "study_first_posted", "last_update_posted", "study_duration_days",
    "study_type", "phases", "phase_bucket", "enrollment", "enrollment_type",
    "allocation", "intervention_model", "primary_purpose", "masking",
    "eligible_sex", "healthy_volunteers", "minimum_age_years",
    "maximum_age_years", "std_ages", "lead_sponsor_name", "lead_sponsor_class",
    "is_industry_sponsored", "conditions", "intervention_names",
    "intervention_types", "drug_interventions", "has_drug_intervention",
    "primary_outcome", "location_count", "first_location_country",
]

# The label a report shows where a key is null.
DRUG_LABELS = {
    "gender": "UNK",
    "source_year": -1,
    "active_ingredient_name": "UNKNOWN",
    "brand_name": "UNKNOWN",
}
TRIAL_LABELS = {
    "overall_status": "UNKNOWN",
    "phase_bucket": "Unknown",
    "eligible_sex": "ALL",
    "study_type": "UNKNOWN",
}


def labelled(labels: dict[str, object]) -> list[Column]:
    """Keys with their label in place of null.

    Used after the group-by: null and a real value equal to the label stay two
    rows (Q5).
    """
    return [F.coalesce(F.col(n), F.lit(label)).alias(n) for n, label in labels.items()]


def dim_drug_faers(stg_faers: DataFrame, stg_openfda_drugs: DataFrame) -> DataFrame:
    """M6: report-drug x product x ingredient."""
    drugs = stg_openfda_drugs.withColumnRenamed("route", "product_route")
    return drugs_with_products(stg_faers, drugs).select(
        *DIM_DRUG_REPORT_COLUMNS,
        reports.in_range("age_in_years").alias("age_in_years"),
        *DIM_DRUG_DRUG_COLUMNS,
        F.coalesce("route", "product_route").alias("route"),
        *DIM_DRUG_DOSE_COLUMNS,
        *DIM_DRUG_PRODUCT_COLUMNS,
    )


def dim_fips_census(stg_census: DataFrame) -> DataFrame:
    """M7: counties."""
    return stg_census.select(*DIM_CENSUS_COLUMNS)


def dim_clinical_trials(stg_clinical_trials: DataFrame) -> DataFrame:
    """M8: studies."""
    return stg_clinical_trials.select(*DIM_TRIAL_COLUMNS)


REPORT_KEYS = ["source_year", "gender", "active_ingredient_name", "brand_name"]


def report_cells(dim: DataFrame) -> DataFrame:
    """Row count and youngest age by age group and report keys.

    Both drug reports are regroupings of the cells, so a build that wants both
    aggregates the dimension once.
    """
    return dim.groupBy(
        reports.age_group("age_in_years").alias("age_group"), *REPORT_KEYS
    ).agg(F.count("*").alias("report_count"), F.min("age_in_years").alias("youngest"))


def report_cells_counted(
    demo_faers: DataFrame,
    drug_faers: DataFrame,
    stg_openfda_drugs: DataFrame,
    by_age: bool = True,
    drug_key: Column | None = None,
) -> DataFrame:
    """The same cells straight from the sources, without the dimension's rows.

    Drugs and products are counted by their own keys before they are shuffled
    for a join, and the counts multiply in the joins, so a drug or application
    that holds a large part of all rows shrinks to few rows inside the map
    tasks. Reports hardly repeat, so they are joined as they are; a hot one is
    split by adaptive execution. With ``by_age`` only reports with an age count;
    without it the cells have neither age group nor youngest age.
    """
    people = known(clean_demo(demo_faers), "primary_id")
    keys, youngest = [], []
    if by_age:
        age = reports.in_range("age_in_years")
        people = known(people.select("primary_id", "gender", age.alias("age")), "age")
        people = people.withColumn("age_group", reports.age_group("age"))
        keys = ["age_group"]
        youngest = [F.min("age").alias("youngest")]
    people = people.select("primary_id", "gender", *(["age", "age_group"] if by_age else []))
    uses = (
        known(known(clean_drug(drug_faers, drug_key), "primary_id"), "nda_number")
        .groupBy("primary_id", "nda_number", "source_year")
        .agg(F.count("*").alias("uses"))
    )
    per_drug = (
        reports_with_drugs(people, uses)
        .groupBy("nda_number", *keys, "source_year", "gender")
        .agg(F.sum("uses").alias("rows"), *youngest)
    )
    return cells_with_products(per_drug, stg_openfda_drugs, by_age)


def cells_with_products(
    per_drug: DataFrame, stg_openfda_drugs: DataFrame, by_age: bool = True
) -> DataFrame:
    """Cells from counted rows of each application number, whose products are counted first."""
    keys = ["age_group"] if by_age else []
    products = (
        known(stg_openfda_drugs, "application_number")
        .groupBy("application_number", "active_ingredient_name", "brand_name")
        .agg(F.count("*").alias("products"))
    )
    again = [F.min("youngest").alias("youngest")] if by_age else []
    return (
        drugs_with_products(per_drug, products)
        .groupBy(*keys, *REPORT_KEYS)
        .agg(F.sum(F.col("rows") * F.col("products")).alias("report_count"), *again)
    )


def age_report(cells: DataFrame, ordered: bool = False) -> DataFrame:
    """M9 from cells that have an age group.

    ``ordered`` sorts by the youngest age, which is then dropped (O1, A7). The
    other keys break ties, so that the many rows of one age can be sorted in
    several tasks.
    """
    if ordered:
        cells = cells.orderBy("youngest", *REPORT_KEYS)
    labels = {key: DRUG_LABELS[key] for key in REPORT_KEYS}
    return cells.select("age_group", "report_count", *labelled(labels))


def gender_report(cells: DataFrame) -> DataFrame:
    """M10 from cells, summed over the age groups."""
    counted = cells.groupBy(*REPORT_KEYS).agg(F.sum("report_count").alias("report_count"))
    return counted.select(*labelled(DRUG_LABELS), "report_count")


def rpt_faers_age_distribution(dim: DataFrame, ordered: bool = False) -> DataFrame:
    """M9: counts by age group, year, gender, ingredient and brand.

    ``ordered`` sorts by the youngest age of each row. A written table keeps no
    order, so it is meant for reading.
    """
    return age_report(report_cells(known(dim, "age_in_years")), ordered)


def rpt_faers_gender(
    dim: DataFrame, distinct_reports: bool = False, work: str | None = None
) -> DataFrame:
    """Counts by gender, year, ingredient and brand.

    ``report_count`` counts rows of the dimension, not reports (Q9);
    ``distinct_reports`` adds the number of different reports. With ``work``, a shared
    folder the keys are written to, reports are told apart in tasks of their own, and no
    task holds the different reports beside the rows it sorts for the joins.
    """
    if work is not None:
        dim = _written(dim.select(*REPORT_KEYS, "primary_id"), f"{work}/report_keys_{uuid.uuid4().hex}")
    measures = [F.count("*").alias("report_count")]
    if distinct_reports:
        measures.append(F.count_distinct("primary_id").alias("distinct_reports"))
    counted = dim.groupBy(*REPORT_KEYS).agg(*measures)
    extra = ["distinct_reports"] if distinct_reports else []
    return counted.select(*labelled(DRUG_LABELS), "report_count", *extra)


def report_members(dim: DataFrame, work: str) -> DataFrame:
    """Which reports stand in each cell of the drug reports, labelled like them.

    Filters of the reports (F2) hold for these cells too, and ``distinct_members`` counts the
    different reports that are left, in all or by any of the keys.
    """
    labels = {key: DRUG_LABELS[key] for key in REPORT_KEYS}
    rows = dim.select(
        reports.age_group("age_in_years").alias("age_group"), *labelled(labels), "primary_id"
    )
    return member_cells(rows, ["age_group", *REPORT_KEYS], "primary_id", work)


def rpt_faers_age_distribution_counted(
    demo_faers: DataFrame,
    drug_faers: DataFrame,
    stg_openfda_drugs: DataFrame,
    ordered: bool = False,
    drug_key: Column | None = None,
) -> DataFrame:
    """M9 straight from the sources, when the dimension is not wanted."""
    cells = report_cells_counted(demo_faers, drug_faers, stg_openfda_drugs, drug_key=drug_key)
    return age_report(cells, ordered)


def rpt_faers_gender_counted(
    demo_faers: DataFrame,
    drug_faers: DataFrame,
    stg_openfda_drugs: DataFrame,
    drug_key: Column | None = None,
) -> DataFrame:
    """M10 straight from the sources, when the dimension is not wanted."""
    cells = report_cells_counted(demo_faers, drug_faers, stg_openfda_drugs, False, drug_key)
    return cells.select(*labelled(DRUG_LABELS), "report_count")


def rpt_census_demographics(dim_fips_census: DataFrame) -> DataFrame:
    """Population by state; counties of no known state form one row."""
    sums = {
        "male_pop": "male_population",
        "female_pop": "female_population",
        "total_pop": "total_population",
        **{column: column for _, _, column in reports.AGE_GROUPS},
    }
    return dim_fips_census.groupBy("state_abbreviation").agg(
        *[F.sum(source).alias(name) for name, source in sums.items()]
    )


TRIAL_MEASURES = {"enrollment": "enrollment", "study_duration_days": "duration_days"}


def _trial_keys(dim_clinical_trials: DataFrame) -> tuple[DataFrame, list[str]]:
    """The studies with the nine keys of the report in front, and the keys.

    Four keys are grouped as they are and labelled afterwards; sponsor class,
    country and age bucket are grouped by their label (Q5).
    """
    keyed = dim_clinical_trials.select(
        *TRIAL_LABELS,
        F.coalesce("lead_sponsor_class", F.lit("OTHER")).alias("sponsor_class"),
        F.coalesce("first_location_country", F.lit("UNKNOWN")).alias("country"),
        "is_industry_sponsored",
        "has_drug_intervention",
        trials.eligibility_bucket("minimum_age_years").alias("eligibility_age_bucket"),
        "location_count",
        *[F.col(name).cast("bigint").alias(name) for name in TRIAL_MEASURES],
    )
    return keyed, keyed.columns[:9]


def _trial_labels(counted: DataFrame) -> DataFrame:
    return counted.select(
        *labelled(TRIAL_LABELS), *[c for c in counted.columns if c not in TRIAL_LABELS]
    )


def trial_counts(dim_clinical_trials: DataFrame) -> DataFrame:
    """A1, A5: the nine keys of M12 with the numbers of studies only."""
    keyed, keys = _trial_keys(dim_clinical_trials)
    counted = keyed.groupBy(*keys).agg(
        F.count("*").alias("study_count"),
        F.count_if("has_drug_intervention").alias("drug_study_count"),
    )
    return _trial_labels(counted)


def _written(frame: DataFrame, folder: str) -> DataFrame:
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def rpt_clinical_trials(dim_clinical_trials: DataFrame, work: str | None = None) -> DataFrame:
    """Study counts and measures by nine keys.

    An exact median needs every different value of a group in one place. The
    values are therefore counted first, spread over all tasks, so that a group
    with a large part of all studies arrives as its different values only. With
    ``work``, a shared folder the counted values are written to, medians are selected
    in rounds instead, and no task meets more of a group than the bins of a round.
    """
    keyed, keys = _trial_keys(dim_clinical_trials)
    values = (
        keyed.unpivot([*keys, "location_count"], list(TRIAL_MEASURES), "measure", "value")
        .groupBy(*keys, "measure", "value")
        .agg(F.count("*").alias("studies"), F.sum("location_count").alias("locations"))
    )
    if work is not None:
        values = _written(values, f"{work}/trial_values_{uuid.uuid4().hex}")
    value, studies = F.col("value"), F.col("studies")

    def of(measure: str, column: Column) -> Column:
        return F.when(F.col("measure") == measure, column)

    def average(measure: str) -> Column:
        known_values = F.when(value.isNotNull(), studies)
        return F.try_divide(
            F.sum(of(measure, value * studies)), F.sum(of(measure, known_values))
        )

    each_study = next(iter(TRIAL_MEASURES))
    counted = values.groupBy(*keys).agg(
        F.sum(of(each_study, studies)).alias("study_count"),
        F.sum(of("enrollment", value * studies)).alias("total_enrollment"),
        *[average(m).alias(f"avg_{name}") for m, name in TRIAL_MEASURES.items()],
        *[
            F.percentile(of(m, value), 0.5, studies).alias(f"median_{name}")
            for m, name in TRIAL_MEASURES.items()
            if work is None
        ],
        F.sum(of(each_study, F.col("locations"))).alias("total_locations"),
    )
    if work is not None:
        selected = selected_medians(values, [*keys, "measure"], "value", "studies")
        medians = selected.groupBy(*keys).agg(
            *[F.max(of(m, F.col("median"))).alias(f"median_{name}") for m, name in TRIAL_MEASURES.items()]
        )
        # Null keys are groups too.
        named = medians.select(*[F.col(k).alias(f"_{k}") for k in keys], *medians.columns[len(keys) :])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        counted = counted.join(named, same, "left").drop(*[f"_{k}" for k in keys])
    drug_studies = F.when(F.col("has_drug_intervention"), F.col("study_count")).otherwise(0)
    return _trial_labels(counted.withColumn("drug_study_count", drug_studies))
