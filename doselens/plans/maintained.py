"""M9 and M10 kept up to date when a quarter is replaced (A1, A2).

A report row and a drug row may come from different quarters, so counts are kept in cells
by the quarter of the report and that of the drug, before products are joined. A cell
depends on its two quarters alone. When quarters are replaced, the cells of either
side's changed quarters go and are counted anew: changed drugs against all reports, and
changed reports against the drugs that did not change. Nothing is subtracted, so the
youngest age is as exact as the counts.

Cells and the versions of the quarters they were counted from are written together under
a new number; a run that breaks off leaves the last number as it was. A quarter's version
comes from the names, sizes and times of its files, so it is known without reading them.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reports
from ..operators import checks
from ..operators.filters import known
from ..operators.joins import reports_with_drugs
from ..sources.tables import read_quarters, save_table
from . import marts, staging

Quarter = tuple[int | None, int | None]

DEMO_QUARTER = ("demo_year", "demo_quarter")
DRUG_QUARTER = ("drug_year", "drug_quarter")
CELL_KEYS = [*DEMO_QUARTER, *DRUG_QUARTER, "nda_number", "gender", "age_group"]
CELLS = (
    "demo_year int, demo_quarter int, drug_year int, drug_quarter int, nda_number decimal(38,0), "
    "gender string, age_group string, rows bigint, unparsed_doses bigint, unread_numbers bigint, "
    "unlikely_ages bigint, youngest int"
)
VERSIONS = "side string, src_year int, src_quarter int, version bigint"
SIDES = {"demo": "demo_faers", "drug": "drug_faers"}
KEPT_NUMBERS = 2
"""Numbers whose files stay, so that a reader of the last one is not cut off."""


def _quarter(names: tuple[str, str]) -> list[Column]:
    return [
        F.col(source).cast("int").alias(name)
        for source, name in zip(("src_year", "src_quarter"), names, strict=True)
    ]


def within(quarters: Collection[Quarter], names: tuple[str, str] = ("src_year", "src_quarter")) -> Column:
    """Rows of some quarters. On partition columns only their files are read."""
    year, quarter = (F.col(name) for name in names)
    tests = [year.eqNullSafe(y) & quarter.eqNullSafe(q) for y, q in sorted(quarters, key=str)]
    return reduce(Column.__or__, tests, F.lit(False))


def joined_cells(
    demo_faers: DataFrame, drug_faers: DataFrame, drug_key: Column | None = None
) -> DataFrame:
    """Rows of J1 counted by both quarters, application number, gender and age group.

    Reports are counted by their own keys first, as they are far fewer than drugs, and the
    counts multiply in the join. Drugs hardly repeat, so they are joined as they are: counting
    them would hold nearly all of them in memory. A hot key's drugs are split by adaptive
    execution. The rows that violate T1 to T3 are counted with them, so the checks cost no scan
    of their own.
    """
    age = reports.in_range("age_in_years")
    people = known(staging.clean_demo(demo_faers, keep=_quarter(DEMO_QUARTER)), "primary_id")
    people = people.select("primary_id", *DEMO_QUARTER, "gender", age.cast("int").alias("age"))
    people = people.groupBy(*people.columns).agg(F.count("*").alias("reports"))
    people = people.withColumn("age_group", reports.age_group("age"))
    drugs = known(
        staging.clean_drug(drug_faers, drug_key, keep=_quarter(DRUG_QUARTER)), "primary_id"
    )
    uses = drugs.select(
        "primary_id", "nda_number", *DRUG_QUARTER,
        checks.dose_unparsed().alias("unparsed"),
        checks.not_a_number().alias("unread"),
    )

    def total(check: Column) -> Column:
        return F.sum(F.when(check, F.col("reports")).otherwise(0))

    return (
        reports_with_drugs(people, uses)
        .groupBy(*CELL_KEYS)
        .agg(
            F.sum("reports").alias("rows"),
            total(F.col("unparsed")).alias("unparsed_doses"),
            total(F.col("unread")).alias("unread_numbers"),
            total(checks.age_out_of_range("age")).alias("unlikely_ages"),
            F.min("age").alias("youngest"),
        )
    )


def refreshed_cells(
    cells: DataFrame,
    demo_faers: DataFrame,
    drug_faers: DataFrame,
    changed_demo: Collection[Quarter],
    changed_drug: Collection[Quarter],
    drug_key: Column | None = None,
) -> DataFrame:
    """The cells after quarters of either side were replaced, added or taken away."""
    parts = [cells.filter(~within(changed_demo, DEMO_QUARTER) & ~within(changed_drug, DRUG_QUARTER))]
    if changed_drug:
        parts.append(joined_cells(demo_faers, drug_faers.filter(within(changed_drug)), drug_key))
    if changed_demo:
        unchanged = drug_faers.filter(~within(changed_drug))
        parts.append(joined_cells(demo_faers.filter(within(changed_demo)), unchanged, drug_key))
    return reduce(DataFrame.unionByName, parts)


def report_cells(cells: DataFrame, stg_openfda_drugs: DataFrame) -> DataFrame:
    """The cells of both drug reports, as ``marts.report_cells`` gives them."""
    per_drug = (
        known(cells, "nda_number")
        .groupBy("nda_number", "age_group", F.col("drug_year").alias("source_year"), "gender")
        .agg(F.sum("rows").alias("rows"), F.min("youngest").alias("youngest"))
    )
    return marts.cells_with_products(per_drug, stg_openfda_drugs)


CELL_CHECKS = {
    "dose_amount_is_numeric": "unparsed_doses",
    "nda_number_is_numeric": "unread_numbers",
    "age_is_realistic": "unlikely_ages",
}


def cell_checks(cells: DataFrame) -> DataFrame:
    """T1-T3 on the rows of J1, a row for each check, from the counts in the cells."""
    totals = cells.agg(
        *[F.coalesce(F.sum(column), F.lit(0)).alias(name) for name, column in CELL_CHECKS.items()]
    )
    return totals.unpivot([], list(CELL_CHECKS), "check_name", "violations")


def quarter_versions(spark: SparkSession, path: str) -> dict[Quarter, int]:
    """The version of each quarter below a folder of ``write_quarters``, from its listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", "*.parquet").load(path)
    named = [
        F.regexp_extract("path", f"/{name}=([0-9]+)/", 1).try_cast("int").alias(name)
        for name in ("src_year", "src_quarter")
    ]
    version = F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
    # One row for each quarter.
    rows = files.select("*", *named).groupBy("src_year", "src_quarter").agg(version).collect()
    return {(year, quarter): found for year, quarter, found in rows}


def _numbers(spark: SparkSession, state: str) -> list[int]:
    """The numbers of complete states, the oldest first. Versions are written last."""
    place = spark._jvm.org.apache.hadoop.fs.Path(state)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(
        int(name) for name in names if name.isdigit() and system.exists(done(f"{state}/{name}/versions/_SUCCESS"))
    )


def _drop(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def changed_quarters(
    before: Mapping[Quarter, int], now: Mapping[Quarter, int]
) -> set[Quarter]:
    """Quarters that were replaced, added or taken away."""
    return {quarter for quarter in before.keys() | now.keys() if before.get(quarter) != now.get(quarter)}


def refresh_cells(
    spark: SparkSession, bronze: str, state: str, drug_key: Column | None = None
) -> DataFrame:
    """Brings the cells below ``state`` up to date with the quarters below ``bronze``.

    Only changed quarters of the changed side are read, with the other side; without a
    change nothing is read but the listing. The first run counts everything.
    """
    now = {side: quarter_versions(spark, f"{bronze}/{name}") for side, name in SIDES.items()}
    numbers = _numbers(spark, state)
    before: dict[str, dict[Quarter, int]] = {side: {} for side in SIDES}
    cells = spark.createDataFrame([], CELLS)
    if numbers:
        last = f"{state}/{numbers[-1]}"
        cells = spark.read.schema(CELLS).parquet(f"{last}/cells")
        for side, year, quarter, version in spark.read.schema(VERSIONS).parquet(f"{last}/versions").collect():
            before[side][year, quarter] = version
    changed = {side: changed_quarters(before[side], now[side]) for side in SIDES}
    if numbers and not any(changed.values()):
        return cells
    sources = {side: read_quarters(spark, f"{bronze}/{name}") for side, name in SIDES.items()}
    if numbers:
        fresh = refreshed_cells(cells, sources["demo"], sources["drug"], changed["demo"], changed["drug"], drug_key)
    else:
        fresh = joined_cells(sources["demo"], sources["drug"], drug_key)
    own = f"{state}/{numbers[-1] + 1 if numbers else 1}"
    _drop(spark, own)  # what a run left that broke off
    fresh.select(*cells.columns).write.parquet(f"{own}/cells")
    rows = [(side, *quarter, version) for side in SIDES for quarter, version in now[side].items()]
    spark.createDataFrame(rows, VERSIONS).coalesce(1).write.parquet(f"{own}/versions")
    for number in numbers[: len(numbers) + 1 - KEPT_NUMBERS]:
        _drop(spark, f"{state}/{number}")
    return spark.read.schema(CELLS).parquet(f"{own}/cells")


def refresh_reports(
    spark: SparkSession, bronze: str, state: str, openfda_drugs: DataFrame, schema: str = "marts"
) -> dict[str, DataFrame]:
    """M9 and M10 from maintained cells, without the dimension; also when products changed."""
    cells = refresh_cells(spark, bronze, state)
    products = staging.stg_openfda_drugs(openfda_drugs)
    joined = save_table(report_cells(cells, products), "faers_report_cells", schema)
    return {
        name: save_table(frame, name, schema)
        for name, frame in {
            "rpt_faers_age_distribution": marts.age_report(known(joined, "age_group")),
            "rpt_faers_gender": marts.gender_report(joined),
        }.items()
    }
