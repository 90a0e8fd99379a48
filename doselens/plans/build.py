"""Building the gold tables from bronze frames (K3-K5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.filters import known
from ..sources.tables import save_table, save_views
from . import maintained, marts, staging


def staging_views(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """K4: the cleaned tables as lazy views."""
    views = {
        "stg_faers": staging.stg_faers(bronze["demo_faers"], bronze["drug_faers"]),
        "stg_openfda_drugs": staging.stg_openfda_drugs(bronze["openfda_drugs"]),
        "stg_openfda_values": staging.stg_openfda_values(bronze["openfda_drugs"]),
        "stg_census": staging.stg_census(bronze["census_fips"]),
        "stg_clinical_trials": staging.stg_clinical_trials(bronze["clinical_trials"]),
    }
    save_views(views)
    return views


def build_marts(
    bronze: Mapping[str, DataFrame], schema: str = "marts", counted: DataFrame | None = None
) -> dict[str, DataFrame]:
    """K5: write the three dimensions, then the four reports from them.

    A report reads its dimension back from the written table, so the joins run
    once however many reports use them. The two drug reports share one pass
    over the dimension, written as ``faers_report_cells``. With ``counted``, maintained
    cells that are up to date, they come from those, and the dimension is not read.
    """
    views = staging_views(bronze)
    drugs = save_table(
        marts.dim_drug_faers(views["stg_faers"], views["stg_openfda_drugs"]),
        "dim_drug_faers", schema,
    )
    counties = save_table(
        marts.dim_fips_census(views["stg_census"]), "dim_fips_census", schema
    )
    studies = save_table(
        marts.dim_clinical_trials(views["stg_clinical_trials"]), "dim_clinical_trials", schema
    )
    if counted is None:
        cells = marts.report_cells(drugs)
    else:
        cells = maintained.report_cells(counted, views["stg_openfda_drugs"])
    cells = save_table(cells, "faers_report_cells", schema)
    reports = {
        "rpt_faers_age_distribution": marts.age_report(known(cells, "age_group")),
        "rpt_faers_gender": marts.gender_report(cells),
        "rpt_census_demographics": marts.rpt_census_demographics(counties),
        "rpt_clinical_trials": marts.rpt_clinical_trials(studies),
    }
    return {
        "dim_drug_faers": drugs,
        "dim_fips_census": counties,
        "dim_clinical_trials": studies,
        **{name: save_table(frame, name, schema) for name, frame in reports.items()},
    }
