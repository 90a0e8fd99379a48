"""Nested records to rows and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The declared shape of one approved-drug result.
PRODUCT_RESULT = """struct<
    application_number: string, sponsor_name: string, reportnumber: string,
    products: array<struct<
        product_number: string, brand_name: string, dosage_form: string,
        marketing_status: string, reference_drug: string,
        reference_standard: string, te_code: string, route: string,
        active_ingredients: array<struct<name: string, strength: string>>>>,
    submissions: array<variant>>"""
PRODUCT_DOCUMENT = (
    f"meta struct<last_updated: string>, results array<{PRODUCT_RESULT}>"
)

# The declared shape of one study record.
STUDY = """struct<protocolSection: struct<
    identificationModule: struct<nctId: string, briefTitle: string,
        officialTitle: string, orgStudyIdInfo: struct<id: string>>,
    statusModule: struct<overallStatus: string,
        startDateStruct: struct<date: string>,
        primaryCompletionDateStruct: struct<date: string>,
        completionDateStruct: struct<date: string>,
        studyFirstPostDateStruct: struct<date: string>,
        lastUpdatePostDateStruct: struct<date: string>>,
    descriptionModule: struct<briefSummary: string>,
    designModule: struct<studyType: string, phases: array<string>,
        enrollmentInfo: struct<count: bigint, type: string>,
        designInfo: struct<allocation: string, interventionModel: string,
            primaryPurpose: string, maskingInfo: struct<masking: string>>>,
    eligibilityModule: struct<eligibilityCriteria: string,
        healthyVolunteers: boolean, sex: string, minimumAge: string,
        maximumAge: string, stdAges: array<string>>,
    contactsLocationsModule: struct<locations: array<struct<country: string>>>,
    sponsorCollaboratorsModule: struct<
        leadSponsor: struct<name: string, class: string>>,
    outcomesModule: struct<primaryOutcomes: array<struct<measure: string>>>,
    armsInterventionsModule: struct<
        interventions: array<struct<name: string, type: string>>>,
    conditionsModule: struct<conditions: array<string>>>>"""

# Flat column and its path below the protocol section.
STUDY_FIELDS = {
    "nct_id": "identificationModule.nctId",
    "brief_title": "identificationModule.briefTitle",
    "official_title": "identificationModule.officialTitle",
    "org_study_id": "identificationModule.orgStudyIdInfo.id",
    "overall_status": "statusModule.overallStatus",
    "start_date": "statusModule.startDateStruct.date",
    "primary_completion_date": "statusModule.primaryCompletionDateStruct.date",
    "completion_date": "statusModule.completionDateStruct.date",
    "study_first_posted": "statusModule.studyFirstPostDateStruct.date",
    "last_update_posted": "statusModule.lastUpdatePostDateStruct.date",
    "brief_summary": "descriptionModule.briefSummary",
    "study_type": "designModule.studyType",
    "enrollment": "designModule.enrollmentInfo.count",
    "enrollment_type": "designModule.enrollmentInfo.type",
    "allocation": "designModule.designInfo.allocation",
    "intervention_model": "designModule.designInfo.interventionModel",
    "primary_purpose": "designModule.designInfo.primaryPurpose",
    "masking": "designModule.designInfo.maskingInfo.masking",
    "eligibility_criteria": "eligibilityModule.eligibilityCriteria",
    "healthy_volunteers": "eligibilityModule.healthyVolunteers",
    "sex": "eligibilityModule.sex",
    "minimum_age": "eligibilityModule.minimumAge",
    "maximum_age": "eligibilityModule.maximumAge",
    "lead_sponsor_name": "sponsorCollaboratorsModule.leadSponsor.name",
    "lead_sponsor_class": "sponsorCollaboratorsModule.leadSponsor.class",
}

# Flat column and the text list it joins.
STUDY_LISTS = {
    "phases": "designModule.phases",
    "std_ages": "eligibilityModule.stdAges",
    "conditions": "conditionsModule.conditions",
}


def joined(items: Column) -> Column:
    """Pipe-joined list; a missing item is an empty slot, no list is ``''``."""
    texts = F.transform(items, lambda item: F.coalesce(item, F.lit("")))
    return F.coalesce(F.array_join(texts, "|"), F.lit(""))


def joined_of_type(items: Column, field: str, kind: str) -> Column:
    """Pipe-joined field of the elements of one type."""
    return joined(F.filter(items, lambda item: item["type"] == kind)[field])


def count_of(items: Column) -> Column:
    """P25: list length, 0 for a missing list."""
    return F.coalesce(F.size(items), F.lit(0)).cast("bigint")


def first_of(items: Column, field: str) -> Column:
    """A field of the first element, or null."""
    return F.get(items, F.lit(0))[field]


def study_columns(study: str = "study") -> list[Column]:
    """The 34 flat columns of a nested study."""
    section = f"{study}.protocolSection"
    interventions = F.col(f"{section}.armsInterventionsModule.interventions")
    locations = F.col(f"{section}.contactsLocationsModule.locations")
    outcomes = F.col(f"{section}.outcomesModule.primaryOutcomes")
    fields = [F.col(f"{section}.{path}").alias(n) for n, path in STUDY_FIELDS.items()]
    lists = [joined(F.col(f"{section}.{p}")).alias(n) for n, p in STUDY_LISTS.items()]
    return [
        *fields,
        *lists,
        joined(interventions["name"]).alias("intervention_names"),
        joined(interventions["type"]).alias("intervention_types"),
        joined_of_type(interventions, "name", "DRUG").alias("drug_interventions"),
        count_of(locations).alias("location_count"),
        first_of(locations, "country").alias("first_location_country"),
        first_of(outcomes, "measure").alias("primary_outcome"),
    ]


def flatten_studies(studies: DataFrame, study: str = "study") -> DataFrame:
    """One flat row per nested study."""
    return studies.select(*study_columns(study))


def result_rows(documents: DataFrame) -> DataFrame:
    """One row per result of ``{meta, results}`` documents."""
    return documents.select(
        F.col("meta.last_updated").cast("timestamp_ntz").alias("last_updated"),
        F.explode("results").alias("result"),
    )


def product_ingredient_rows(documents: DataFrame) -> DataFrame:
    """Result x product x active ingredient.

    Explode is inner at each level, so a result without products and a product
    without ingredients give no rows.
    """
    return (
        result_rows(documents)
        .select("last_updated", "result", F.explode("result.products").alias("product"))
        .select(
            "last_updated",
            F.col("result.application_number").alias("application_id"),
            F.col("result.sponsor_name").alias("sponsor_name"),
            "product",
            F.explode("product.active_ingredients").alias("ingredient"),
        )
    )


def submission_field_rows(
    documents: DataFrame, id_field: str = "reportnumber"
) -> DataFrame:
    """One row per key of each submission, keys being unknown beforehand.

    A submission is a variant, so any key is kept, also one whose value is null.
    ``id_field`` names the result field used as report id (Q11).
    """
    return (
        result_rows(documents)
        .select(
            F.col(f"result.{id_field}").alias("report_id"),
            F.explode("result.submissions").alias("submission"),
        )
        .select(
            "report_id",
            F.explode(F.col("submission").cast("map<string, variant>")).alias(
                "field_name", "field_value"
            ),
        )
    )
