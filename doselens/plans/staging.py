"""Cleaned tables (M1-M5). All of them are lazy, as views are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import census, parse, products, reports, trials
from ..operators.flatten import product_ingredient_rows, submission_field_rows
from ..operators.joins import reports_with_drugs

# Cleaned column and the bronze text it copies.
DEMO_TEXTS = {
    "if_code": "i_f_code",
    "report_code": "rept_cod",
    "manufacturer_number": "mfr_num",
    "manufacturer_name": "mfr_sndr",
}
DEMO_DAYS = {
    "event_date": "event_dt",
    "manufacturer_received_date": "mfr_dt",
    "initial_fda_received_date": "init_fda_dt",
    "current_fda_received_date": "fda_dt",
}
DRUG_TEXTS = {
    "role_code": "role_cod",
    "drug_name": "drugname",
    "route": "route",
    "dose": "dose_vbm",
    "cumulative_dose": "cum_dose_chr",
    "dechallenge": "dechal",
    "rechallenge": "rechal",
    "lot_number": "lot_nbr",
    "dose_amt_raw": "dose_amt",
    "dose_unit": "dose_unit",
    "dose_form": "dose_form",
    "dose_frequency": "dose_freq",
}
STG_FAERS_COLUMNS = [
    "primary_id", "if_code", "event_date", "manufacturer_received_date",
    "initial_fda_received_date", "current_fda_received_date", "report_code",
    "manufacturer_number", "manufacturer_name", "age_in_years", "gender",
    "weight_in_lbs", "role_code", "drug_name", "is_validated_trade_name", "route",
    "dose", "cumulative_dose", "dechallenge", "rechallenge", "lot_number",
    "expiration_date", "nda_number", "dose_amt_raw", "dose_amount", "dose_unit",
    "dose_form", "dose_frequency", "source_year", "source_quarter",
]
PRODUCT_TEXTS = [
    "brand_name", "dosage_form", "marketing_status", "reference_drug",
    "reference_standard", "te_code", "route",
]
TRIAL_TEXTS = [
    "nct_id", "brief_title", "official_title", "org_study_id", "overall_status",
    "study_type", "phases", "enrollment_type", "allocation", "intervention_model",
    "primary_purpose", "masking", "healthy_volunteers", "std_ages",
    "lead_sponsor_name", "lead_sponsor_class", "conditions", "intervention_names",
    "intervention_types", "drug_interventions", "primary_outcome",
    "first_location_country",
]
TRIAL_DAYS = [
    "start_date", "primary_completion_date", "completion_date",
    "study_first_posted", "last_update_posted",
]


def _texts(mapping: dict[str, str]) -> list[Column]:
    return [F.col(source).cast("string").alias(name) for name, source in mapping.items()]


def clean_demo(
    demo_faers: DataFrame, date_format: str | None = None, keep: Sequence[Column] = ()
) -> DataFrame:
    """Typed report demographics. Ages are not yet range-checked.

    ``keep`` names more columns of the source to carry along.
    """
    return demo_faers.select(
        *keep,
        parse.try_key("primaryid").alias("primary_id"),
        *_texts(DEMO_TEXTS),
        *[
            parse.try_day(source, date_format).alias(name)
            for name, source in DEMO_DAYS.items()
        ],
        reports.age_years("age", "age_cod").alias("age_in_years"),
        reports.gender("sex", "gndr_cod").alias("gender"),
        reports.weight_lbs("wt", "wt_cod").alias("weight_in_lbs"),
    )


def clean_drug(
    drug_faers: DataFrame,
    drug_key: Column | None = None,
    date_format: str | None = None,
    keep: Sequence[Column] = (),
) -> DataFrame:
    """Typed report drugs.

    The key is the case id followed by the drug's sequence number (Q2);
    ``drug_key`` gives another text to take the number from, ``keep`` more columns to
    carry along.
    """
    if drug_key is None:
        drug_key = F.concat("caseid", "drug_seq")
    return drug_faers.select(
        *keep,
        parse.try_key(drug_key).alias("primary_id"),
        *_texts(DRUG_TEXTS),
        reports.code_flag("val_vbm").alias("is_validated_trade_name"),
        parse.try_day("exp_dt", date_format).alias("expiration_date"),
        parse.try_key("nda_num").alias("nda_number"),
        reports.dose_amount("dose_amt").alias("dose_amount"),
        parse.strict_number("src_year", "int").alias("source_year"),
        parse.strict_number("src_quarter", "int").alias("source_quarter"),
    )


def stg_faers(
    demo_faers: DataFrame,
    drug_faers: DataFrame,
    drug_key: Column | None = None,
    date_format: str | None = None,
) -> DataFrame:
    """M1: one row per drug of a report."""
    demo = clean_demo(demo_faers, date_format).withColumn(
        "age_in_years", reports.in_range("age_in_years")
    )
    drug = clean_drug(drug_faers, drug_key, date_format)
    return reports_with_drugs(demo, drug).select(*STG_FAERS_COLUMNS)


def stg_openfda_drugs(
    openfda_drugs: DataFrame, suffix_fallback: bool = False
) -> DataFrame:
    """M2: one row per active ingredient of a product."""
    kind, number = products.application_id("application_id", suffix_fallback)
    return product_ingredient_rows(openfda_drugs).select(
        "last_updated",
        kind.alias("application_type"),
        number.alias("application_number"),
        F.col("ingredient.name").alias("active_ingredient_name"),
        F.col("ingredient.strength").alias("active_ingredient_strength"),
        parse.strict_number("product.product_number").alias("product_number"),
        *[F.col(f"product.{name}").alias(name) for name in PRODUCT_TEXTS],
        "sponsor_name",
    )


def stg_openfda_values(
    openfda_drugs: DataFrame, id_field: str = "reportnumber"
) -> DataFrame:
    """M3: one row per field of a submission."""
    return submission_field_rows(openfda_drugs, id_field)


def stg_census(census_fips: DataFrame) -> DataFrame:
    """M4: one row per county with typed counts and broad age bands."""
    counts = census_fips.select(
        *[
            parse.strict_number(parse.blank_to_null(source)).alias(name)
            for source, name in census.POPULATION_COLUMNS.items()
        ],
        *[
            parse.try_int(parse.blank_to_null(source)).alias(name)
            for source, name in (
                ("state", "state_code"),
                ("county", "county_code"),
                ("fips_code", "fips_code"),
            )
        ],
    )
    return counts.select(
        "*",
        *[
            census.total_of(parts).alias(band)
            for band, parts in census.BROAD_AGE_BANDS.items()
        ],
        census.state_postal_code("state_code").alias("state_abbreviation"),
    )


def stg_clinical_trials(
    clinical_trials: DataFrame, respect_units: bool = False
) -> DataFrame:
    """M5: one row per study with typed dates, counts and buckets."""
    typed = clinical_trials.select(
        *[F.col(name).cast("string").alias(name) for name in TRIAL_TEXTS],
        *[parse.try_day_auto(F.col(name).cast("string")).alias(name) for name in TRIAL_DAYS],
        F.col("sex").cast("string").alias("eligible_sex"),
        parse.try_number(F.col("enrollment").cast("string")).alias("enrollment"),
        parse.try_number(F.col("location_count").cast("string")).alias("location_count"),
        *[
            trials.age_number(F.col(f"{which}_age").cast("string"), respect_units).alias(
                f"{which}_age_years"
            )
            for which in ("minimum", "maximum")
        ],
    )
    return typed.select(
        "*",
        parse.days_between("start_date", "completion_date").alias("study_duration_days"),
        trials.phase_bucket("phases").alias("phase_bucket"),
        trials.has_text("drug_interventions").alias("has_drug_intervention"),
        trials.equals("lead_sponsor_class", "INDUSTRY").alias("is_industry_sponsored"),
    )
