"""The whole flow as one Spark job: landed files to bronze, gold and checks.

    python -m doselens.job LANDING BRONZE --work SHARED --warehouse TABLES
        [--schema marts] [--shuffled-bytes N] [--cores N]

The package must be importable on the executors (``--py-files``), which unzip.
``LANDING`` has the folders ``faers`` (quarterly archives), ``drugs`` (product
documents), ``census`` (county matrices) and ``trials`` (study pages). ``SHARED``
and ``TABLES`` are folders the whole cluster shares. ``BRONZE/load_status`` tells
what became of every landed archive, ``BRONZE/rejected_pages`` and
``BRONZE/rejected_studies`` what could not be read of the trials, ``BRONZE/page_faults``
which pages are missing where they are named by their token (``page-TOKEN.json``).
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import checks
from .plans import maintained, staging
from .plans.build import build_marts
from .session import build_session
from .sources import documents, tables
from .sources.archives import remove_unzipped
from .streaming.refresh import read_checks, refresh_quarters

FAERS_TABLES = ("DEMO", "DRUG", "REAC")


def ingest(spark: SparkSession, landing: str, bronze: str, work: str | None = None) -> None:
    """Landed files to bronze; archives that were ingested before are left alone."""
    refresh_quarters(spark, f"{landing}/faers", FAERS_TABLES, bronze, work)
    pages = documents.read_study_pages(spark, f"{landing}/trials")
    parsed = documents.latest_studies(documents.parse_studies(pages))
    tables.write_parquet(documents.kept_studies(parsed), f"{bronze}/studies")
    studies = tables.read_parquet(spark, f"{bronze}/studies")
    products = documents.read_product_document(spark, f"{landing}/drugs", work)
    frames = {
        "openfda_drugs": products,
        "census_fips": documents.read_census_matrix(spark, f"{landing}/census"),
        "clinical_trials": documents.clinical_trials(studies),
        "rejected_studies": documents.rejected_studies(studies),
        "rejected_pages": documents.rejected_pages(pages),
        "page_faults": documents.chain_faults(documents.landed_pages(pages)),
    }
    for name, frame in frames.items():
        tables.write_parquet(frame, f"{bronze}/{name}")
    remove_unzipped(products)


def bronze_tables(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    """The bronze tables the models read."""
    quarterly = ("demo_faers", "drug_faers")
    whole = ("openfda_drugs", "census_fips", "clinical_trials")
    return {
        **{name: tables.read_quarters(spark, f"{bronze}/{name}") for name in quarterly},
        **{name: tables.read_parquet(spark, f"{bronze}/{name}") for name in whole},
    }


def data_checks(frames: dict[str, DataFrame]) -> DataFrame:
    """T1-T3 on the cleaned rows, and on raw values where cleaning hides them (Q12).

    The last checks count keys of more than 38 digits; their rows join with nothing.
    """
    cleaned = staging.stg_faers(frames["demo_faers"], frames["drug_faers"])
    summaries = [
        checks.summary(
            cleaned,
            {
                "dose_amount_is_numeric": checks.dose_unparsed(),
                "nda_number_is_numeric": checks.not_a_number(),
                "age_is_realistic": checks.age_out_of_range(),
            },
        ),
        checks.summary(
            frames["drug_faers"],
            {
                "raw_nda_num_is_numeric": checks.not_a_number("nda_num"),
                "drug_key_fits_38_digits": checks.too_long_a_number(F.concat("caseid", "drug_seq")),
            },
        ),
        checks.summary(
            staging.clean_demo(frames["demo_faers"]),
            {"raw_age_is_realistic": checks.age_out_of_range()},
        ),
        checks.summary(
            frames["demo_faers"], {"report_key_fits_38_digits": checks.too_long_a_number("primaryid")}
        ),
    ]
    return reduce(DataFrame.unionByName, summaries)


def written_checks(spark: SparkSession, bronze: str, cells: DataFrame) -> DataFrame:
    """The rows of ``data_checks`` from what was counted when bronze and cells were written.

    Nothing is scanned but the small record of the quarters and the cells.
    """
    raw = read_checks(spark, bronze).groupBy("check_name").agg(F.sum("violations").alias("violations"))
    return maintained.cell_checks(cells).unionByName(raw)


def run(
    spark: SparkSession, landing: str, bronze: str, schema: str = "marts", work: str | None = None
) -> dict[str, DataFrame]:
    """Ingest, build and check; returns the written tables.

    Cells of the drug reports are kept in ``bronze/report_cells`` and follow the quarters
    that were replaced, so reports and checks read only what changed.
    """
    ingest(spark, landing, bronze, work)
    frames = bronze_tables(spark, bronze)
    cells = maintained.refresh_cells(spark, bronze, f"{bronze}/report_cells")
    marts = build_marts(frames, schema, cells)
    checked = written_checks(spark, bronze, cells)
    return {**marts, "data_checks": tables.save_table(checked, "data_checks", schema)}


def parsed_options(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("landing")
    parser.add_argument("bronze")
    parser.add_argument("--work", required=True, help="shared folder for unzipped text")
    parser.add_argument("--warehouse", required=True, help="shared folder of the written tables")
    parser.add_argument("--schema", default="marts")
    parser.add_argument("--shuffled-bytes", type=int, default=1 << 40, help="of the largest shuffle")
    parser.add_argument("--cores", type=int, default=64, help="of the cluster")
    return parser.parse_args(arguments)


def session_for(options: argparse.Namespace) -> SparkSession:
    return build_session(
        "doselens", options.shuffled_bytes, options.cores, options.work, options.warehouse
    )


def main() -> None:
    options = parsed_options()
    spark = session_for(options)
    written = run(spark, options.landing, options.bronze, options.schema, options.work)
    written["data_checks"].show(truncate=False)


if __name__ == "__main__":
    main()
