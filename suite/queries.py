"""The registered queries: each operator and model over the whole given tables.

Dates and times are shown as text and fixed-point numbers as doubles, so that a
result compares equal whichever engine produced it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from doselens import job
from doselens.functions import census, parse, products, reports, trials
from doselens.operators import aggregates as agg
from doselens.operators import checks
from doselens.operators.distinct import distinct_members
from doselens.operators.filters import known
from doselens.operators.flatten import flatten_studies, result_rows
from doselens.plans import maintained, marts, staging
from doselens.plans import reports as report_plans
from doselens.sources import archives, documents, tables
from doselens.streaming import refresh

from . import bronze

Query = Callable[[SparkSession, str], DataFrame]


def scratch(spark: SparkSession) -> str:
    """The shared folder of the cluster; on one machine also a local one, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.partition("[")[0] == "local":
        folder = f"{tempfile.gettempdir()}/doselens"
    return folder or tables.shared_folder(spark)


def shown(frame: DataFrame) -> DataFrame:
    """Dates and times as text, keys as whole numbers, fixed-point numbers as doubles."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType) and not field.dataType.scale:
            column = column.try_cast("bigint")
        elif isinstance(field.dataType, (DateType, TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


# Models over the given tables.

def _stg_faers(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_faers(bronze.demo_faers(spark, sf), bronze.drug_faers(spark, sf))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_openfda_drugs(bronze.openfda_drugs(spark, sf))


def _dim_drug(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_drug_faers(_stg_faers(spark, sf), _products(spark, sf))


def _dim_census(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_fips_census(staging.stg_census(bronze.census_fips(spark, sf)))


def _dim_trials(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_clinical_trials(
        staging.stg_clinical_trials(bronze.clinical_trials(spark, sf))
    )


def _age(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rpt_faers_age_distribution(_dim_drug(spark, sf))


def _age_counted(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rpt_faers_age_distribution_counted(
        bronze.demo_faers(spark, sf), bronze.drug_faers(spark, sf), _products(spark, sf)
    )


def _gender(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rpt_faers_gender(_dim_drug(spark, sf))


def _gender_counted(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rpt_faers_gender_counted(
        bronze.demo_faers(spark, sf), bronze.drug_faers(spark, sf), _products(spark, sf)
    )


def _population(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rpt_census_demographics(_dim_census(spark, sf))


def _trials(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rpt_clinical_trials(_dim_trials(spark, sf))


def _trial_counts(spark: SparkSession, sf: str) -> DataFrame:
    return marts.trial_counts(_dim_trials(spark, sf))


# Scalar functions.

def _of_demo(*columns: object) -> Query:
    return lambda spark, sf: bronze.demo_faers(spark, sf).select("primaryid", *columns)


def _of_drug(*columns: object) -> Query:
    return lambda spark, sf: bronze.drug_faers(spark, sf).select(
        "caseid", "drug_seq", *columns
    )


def _of_trials(*columns: object) -> Query:
    return lambda spark, sf: bronze.clinical_trials(spark, sf).select("nct_id", *columns)


def _lazily(build: Callable[[], Query]) -> Query:
    """Column expressions need a running session, so they are built on call."""
    return lambda spark, sf: shown(build()(spark, sf))


def _application_id(spark: SparkSession, sf: str) -> DataFrame:
    ids = result_rows(bronze.openfda_drugs(spark, sf)).select(
        F.col("result.application_number").alias("application_id")
    )
    kind, number = products.application_id("application_id")
    _, suffix = products.application_id("application_id", suffix_fallback=True)
    return ids.select(
        "application_id", kind.alias("application_type"),
        number.alias("application_number"), suffix.alias("suffix_number"),
    )


def _path_access(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of a declared shape, and fields of a variant of which one is absent."""
    submission = F.get("result.submissions", F.lit(0))
    return result_rows(bronze.openfda_drugs(spark, sf)).select(
        F.col("last_updated").cast("string").alias("last_updated"),
        F.col("result.reportnumber").alias("report_id"),
        F.get("result.products", F.lit(0))["brand_name"].alias("first_brand"),
        F.try_variant_get(submission, "$.submission_status", "string").alias("status"),
        F.try_variant_get(submission, "$.absent.deeper", "string").alias("absent"),
    )


def _ages(spark: SparkSession, sf: str) -> DataFrame:
    demo = staging.clean_demo(bronze.demo_faers(spark, sf))
    return shown(demo.select("primary_id", reports.in_range("age_in_years").alias("age_in_years")))


# Sources.

def _text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each report as a line of its quarter's archive, some too long or too short."""
    demo = bronze.demo_faers(spark, sf)
    names = [n for n in demo.columns if n not in ("src_year", "src_quarter")]
    cells = [F.coalesce(F.col(name), F.lit("")) for name in names]
    number = F.col("primaryid").cast("bigint")
    line = (
        F.when(number % 7 == 0, F.concat_ws("$", *cells, F.lit("extra"), F.lit("")))
        .when(number % 11 == 0, F.concat_ws("$", *cells[:-2]))
        .otherwise(F.concat_ws("$", *cells))
    )
    path = F.concat(
        F.lit("file:/landing/faers_ascii_"), F.col("src_year").cast("string"),
        F.lit("q"), F.col("src_quarter").cast("string"), F.lit(".zip"),
    )
    lines = demo.select(path.alias("path"), line.alias("line"))
    return archives.split_columns(lines, archives.SEPARATOR.join(names))


def _product_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each result as a line of JSON."""
    results = bronze.openfda_drugs(spark, sf).select(F.explode("results").alias("result"))
    lines = results.select(F.to_json("result").alias("value"))
    return staging.stg_openfda_drugs(documents.product_lines(lines, "2026-05-01"))


def _load_status(spark: SparkSession, sf: str) -> DataFrame:
    """Two files in the shape of the first, with the status of each."""
    status = tables.parquet_load_status(spark, [f"{sf}/orders.parquet", f"{sf}/lineitem.parquet"])
    return status.withColumn("file", F.substring_index("file", "/", -1))


def _pages_of(studies: DataFrame, text: Column) -> DataFrame:
    """Landed pages of up to ten studies that stand together."""
    number = F.substring("study.protocolSection.identificationModule.nctId", 4, 20).cast("bigint")
    page = F.floor(number / 40).alias("page")
    texts = studies.groupBy(page).agg(F.collect_list(text).alias("texts"))
    return texts.select(F.transform("texts", F.parse_json).alias("studies"))


def _study_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _pages_of(bronze.studies(spark, sf), F.to_json("study"))


def _read_studies(spark: SparkSession, sf: str) -> DataFrame:
    return documents.clinical_trials(documents.parse_studies(_study_pages(spark, sf)))


def _page_faults(spark: SparkSession, sf: str) -> DataFrame:
    """A chain of pages over the orders from which some were taken away, and some are doubled."""
    number = F.floor(F.col("o_orderkey") / 40).cast("bigint")
    found = tables.read_parquet(spark, f"{sf}/orders.parquet").select(number.alias("page")).distinct()
    last = found.agg(F.max("page")).first()[0]
    token = lambda page: F.concat(F.lit("t"), page.cast("string"))
    landed = found.filter((F.col("page") % 10 != 3)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.when(F.col("page") % 25 == 4, 2).otherwise(1)))
    )
    return documents.chain_faults(landed.select(
        F.when(F.col("page") > 0, token(F.col("page"))).alias("page_token"),
        F.when(F.col("page") < last, token(F.col("page") + 1)).alias("nextPageToken"),
    ))


def _latest_studies(spark: SparkSession, sf: str) -> DataFrame:
    """Studies of which every third stands on a second page, in an older form."""
    study = F.col("study")
    status = study["protocolSection"]["statusModule"]
    older = study.withField("protocolSection.statusModule.lastUpdatePostDateStruct", F.struct(F.lit("1900-01-01").alias("date")))
    key = F.substring("study.protocolSection.identificationModule.nctId", 4, 20).cast("bigint")
    newer = study.withField("protocolSection.statusModule.lastUpdatePostDateStruct", F.struct(F.lit("2025-01-01").alias("date")))
    studies = bronze.studies(spark, sf)
    both = studies.select(newer.alias("study")).unionByName(
        studies.filter((key % 3 == 0) & status.isNotNull()).select(older.alias("study"))
    )
    parsed = documents.latest_studies(documents.parse_studies(_pages_of(both, F.to_json("study"))))
    return parsed.select(
        F.col("study.protocolSection.identificationModule.nctId").alias("nct_id"),
        F.col("study.protocolSection.statusModule.lastUpdatePostDateStruct.date").alias("updated"),
    )


LINES_PER_PART = 500_000
"""Lines of a text that one task sorts and writes."""


def _first_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of four texts in which some quantities are no numbers, and where the first is.

    A text is written in parts, each by a task of its own; their number goes by that of the lines.
    """
    lines = tables.read_parquet(spark, f"{sf}/lineitem.parquet")
    quantity = F.when(F.col("l_partkey") % 97 == 5, "many").otherwise(F.col("l_quantity").cast("int").cast("string"))
    text = F.concat_ws(",", "l_orderkey", "l_linenumber", quantity).alias("value")
    folder = f"{scratch(spark)}/lines_{uuid.uuid4().hex}"
    bucket = (F.col("l_orderkey") % 4).cast("int").alias("bucket")
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    parts = max(4, -(-lines.count() // LINES_PER_PART))
    placed = lines.select(bucket, *order, text).repartitionByRange(parts, "bucket", *order)
    ordered = placed.sortWithinPartitions("bucket", *order)
    ordered.select("bucket", "value").write.partitionBy("bucket").text(folder)
    schema = "a bigint, b int, c int"
    found = tables.bad_lines(spark, [folder], lambda value: tables.malformed_csv(schema, value), parts=True)
    name = F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("int").alias("bucket")
    return found.select(name, "lines", "bad_lines", "first_bad_line")


def _rejected_studies(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in which every fiftieth study is broken in one of three ways."""
    number = F.col("study.protocolSection.identificationModule.nctId")
    key = F.substring(number, 4, 20).cast("bigint")
    head = F.concat(
        F.lit('{"protocolSection":{"identificationModule":{"nctId":"'), number, F.lit('"},')
    )
    broken = (
        F.when(key % 150 == 0, F.concat(head, F.lit('"designModule":null}}')))
        .when(key % 150 == 50, F.concat(head, F.lit('"designModule":{"phases":[1]}}}')))
        .otherwise(F.concat(head, F.lit('"armsInterventionsModule":{"interventions":["x"]}}}')))
    )
    text = F.when(key % 50 == 0, broken).otherwise(F.to_json("study"))
    parsed = documents.parse_studies(_pages_of(bronze.studies(spark, sf), text))
    nct_id = F.try_variant_get(
        "raw", "$.protocolSection.identificationModule.nctId", "string"
    )
    return parsed.select(
        F.substring(nct_id, 4, 20).cast("bigint").alias("order_key"), "rejected"
    )


def _census_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Counties as landed matrices of a header and up to ten rows."""
    counties = bronze.census_fips(spark, sf, "c_custkey")
    names = [*census.CENSUS_VARIABLES.values(), "state", "county"]
    header = F.array(*[F.lit(n) for n in (*census.CENSUS_VARIABLES, "state", "county")])
    cells = F.array(*[F.col(name) for name in names])
    rows = counties.groupBy(F.floor(F.col("c_custkey") / 10)).agg(F.collect_list(cells).alias("rows"))
    matrix = F.concat(F.array(header), F.col("rows"))
    matrices = rows.select(F.to_json(matrix).alias("value"))
    return documents.census_rows(matrices)


def _diagonal_union(spark: SparkSession, sf: str) -> DataFrame:
    drug = bronze.drug_faers(spark, sf).withColumnRenamed("src_year", "SRC_YEAR")
    return tables.diagonal_union([bronze.demo_faers(spark, sf), drug])


def _template_load(spark: SparkSession, sf: str) -> DataFrame:
    return tables.template_union([bronze.drug_faers(spark, sf), bronze.demo_faers(spark, sf)])


def _table_by_name(spark: SparkSession, sf: str) -> DataFrame:
    tables.save_views({"landed_reports": bronze.demo_faers(spark, sf)})
    return tables.source(spark, "landed_reports")


def _raw_check_summary(spark: SparkSession, sf: str) -> DataFrame:
    return job.data_checks(
        {"demo_faers": bronze.demo_faers(spark, sf), "drug_faers": bronze.drug_faers(spark, sf)}
    )


def _submission_values(spark: SparkSession, sf: str) -> DataFrame:
    rows = staging.stg_openfda_values(bronze.openfda_drugs(spark, sf))
    return rows.withColumn("field_value", F.col("field_value").cast("string"))


LONG = "90000000000000000001"


def _long_keys(spark: SparkSession, sf: str) -> DataFrame:
    """J1 on ids that 64 bits cannot hold: each has 20 digits more than the given one."""
    demo = bronze.demo_faers(spark, sf).withColumn("primaryid", F.concat(F.lit(LONG), "primaryid"))
    key = F.concat(F.lit(LONG), "caseid", "drug_seq")
    joined = staging.stg_faers(demo, bronze.drug_faers(spark, sf), drug_key=key)
    return joined.select(
        F.col("primary_id").cast("string").alias("primary_id"), "gender", "drug_name", "source_year"
    )


def _product_document(spark: SparkSession, sf: str) -> DataFrame:
    """The products out of JSON documents of many results, written from the given parts."""
    folder = f"{scratch(spark)}/documents_{uuid.uuid4().hex}"
    bronze.write_product_documents(spark, sf, folder)
    found = documents.read_product_document(spark, folder, scratch(spark))
    # The documents begin with a null.
    return staging.stg_openfda_drugs(found.filter(F.get("results", F.lit(0)).isNotNull()))


def _maintained_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of both drug reports, counted once, then kept up with replaced quarters.

    The first delivery of two quarters of reports and two of drugs lacks half of their
    rows and has other genders; a quarter of drugs comes only with the second.
    """
    folder = f"{scratch(spark)}/maintained_{uuid.uuid4().hex}"
    demo, drug = bronze.demo_faers(spark, sf), bronze.drug_faers(spark, sf)
    early_demo = maintained.within([(1995, 1), (1996, 2)])
    early_drug = maintained.within([(1995, 2), (1996, 2)])
    late_drug = maintained.within([(1997, 3)])
    half = F.pmod(F.xxhash64("primaryid"), F.lit(2)) == 0
    first = demo.filter(~early_demo | half).withColumn("sex", F.when(~early_demo, F.col("sex")))
    tables.write_quarters(first, f"{folder}/demo_faers")
    half = F.pmod(F.xxhash64("caseid"), F.lit(2)) == 0
    tables.write_quarters(drug.filter(~late_drug & (~early_drug | half)), f"{folder}/drug_faers")
    maintained.refresh_cells(spark, folder, f"{folder}/cells")
    tables.write_quarters(demo.filter(early_demo), f"{folder}/demo_faers")
    tables.write_quarters(drug.filter(early_drug | late_drug), f"{folder}/drug_faers")
    cells = maintained.refresh_cells(spark, folder, f"{folder}/cells")
    return maintained.report_cells(cells, _products(spark, sf))


def _check_summary(spark: SparkSession, sf: str) -> DataFrame:
    return checks.summary(
        _stg_faers(spark, sf),
        {
            "dose_amount_is_numeric": checks.dose_unparsed(),
            "nda_number_is_numeric": checks.not_a_number(),
            "age_is_realistic": checks.age_out_of_range(),
        },
    )


def _checks_at_write(spark: SparkSession, sf: str) -> DataFrame:
    """The raw checks by quarter, counted by the jobs that write the quarters."""
    folder = f"{scratch(spark)}/checked_{uuid.uuid4().hex}"
    sources = {"DEMO": bronze.demo_faers(spark, sf), "DRUG": bronze.drug_faers(spark, sf)}
    for table, frame in sources.items():
        quarters = {tuple(r) for r in frame.select("src_year", "src_quarter").distinct().collect()}
        found = refresh.write_checked(frame, f"{folder}/{table.lower()}_faers", table, quarters)
        refresh.record_checks(spark, folder, table, quarters, found)
    return refresh.read_checks(spark, folder)


def _selected_headline(spark: SparkSession, sf: str) -> DataFrame:
    return report_plans.headline(
        report_plans.select_faers(_age_counted(spark, sf), years=[1996, 1997], genders=["F"]),
        report_plans.select_census(_population(spark, sf), states=["AL", "CA", "DE"]),
        report_plans.select_trials(
            _trial_counts(spark, sf), statuses=["COMPLETED"], phases=["Phase 1", "Phase 1/2"]
        ),
    )


def _distinct_selected(spark: SparkSession, sf: str) -> DataFrame:
    members = marts.report_members(_dim_drug(spark, sf), scratch(spark))
    selected = report_plans.select_faers(
        members, years=[1996, 1997], genders=["F", "UNK"], ingredients=["red", "bolt", "ring", "gizmo"]
    )
    return report_plans.distinct_headline(selected)


def _distinct_by_age(spark: SparkSession, sf: str) -> DataFrame:
    members = marts.report_members(_dim_drug(spark, sf), scratch(spark))
    return distinct_members(members, ["age_group"], "distinct_reports")


def queries() -> dict[str, Query]:
    from_trials = lambda *names: lambda s, d: shown(_dim_trials(s, d).select(*names))
    return {
        "p02_try_number": _lazily(lambda: _of_demo(
            parse.try_number("primaryid").alias("id_number"),
            parse.try_number("age").alias("age_number"),
            parse.try_number("wt").alias("weight_number"),
        )),
        "p03_try_decimal": _lazily(lambda: _of_drug(
            parse.try_decimal("dose_amt").alias("dose"),
            parse.try_decimal(F.concat("caseid", F.lit("00000.125"))).alias("wide"),
        )),
        "p04_strict_number": _lazily(lambda: _of_drug(
            parse.strict_number("val_vbm", "int").alias("val_vbm"),
            parse.strict_number("caseid").alias("case_number"),
        )),
        "p05_try_int": lambda s, d: bronze.census_fips(s, d).select(
            "state", "county",
            parse.try_int("fips_code").alias("fips_number"),
            parse.try_int("Male_Population").alias("male_number"),
        ),
        "p06_blank_to_null": lambda s, d: bronze.census_fips(s, d).select(
            "fips_code",
            parse.blank_to_null("Total_Population").alias("total_text"),
            parse.blank_to_null("85_Plus_Population").alias("oldest_text"),
            parse.try_int(parse.blank_to_null("county")).alias("county_number"),
        ),
        "p07_try_date": lambda s, d: shown(
            staging.clean_demo(bronze.demo_faers(s, d)).select(
                "primary_id", *staging.DEMO_DAYS
            )
        ),
        "p07_try_date_format": _lazily(lambda: _of_demo(
            parse.try_day("mfr_dt", "yyyyMMdd").alias("received")
        )),
        "p08_try_date_auto": from_trials("nct_id", *staging.TRIAL_DAYS),
        "p09_duration_days": from_trials("nct_id", "study_duration_days"),
        "p10_age_years": _lazily(lambda: _of_demo(
            "age", "age_cod", reports.age_years("age", "age_cod").alias("age_in_years")
        )),
        "p11_gender": _lazily(lambda: _of_demo(
            "sex", "gndr_cod", reports.gender("sex", "gndr_cod").alias("gender")
        )),
        "p12_weight_lbs": _lazily(lambda: _of_demo(
            "wt", "wt_cod", reports.weight_lbs("wt", "wt_cod").alias("weight_in_lbs")
        )),
        "p13_code_flag": _lazily(lambda: _of_drug(
            "val_vbm", reports.code_flag("val_vbm").alias("is_validated_trade_name")
        )),
        "p14_dose_amount": _lazily(lambda: _of_drug(
            "dose_amt", reports.dose_amount("dose_amt").alias("dose_amount")
        )),
        "p15_split_part": _lazily(lambda: _of_drug(
            parse.part_of("dose_amt", "/", 1).alias("first_part"),
            parse.part_of("dose_amt", "/", 2).alias("second_part"),
        )),
        "p16_p17_patterns": _lazily(lambda: _of_drug(
            F.col("dose_amt").rlike(reports.DOSE_WITH_UNIT).alias("with_unit"),
            F.col("dose_amt").rlike(reports.DOSE_RANGE).alias("is_range"),
            parse.first_match("dose_amt", reports.DOSE_NUMBER).alias("leading_number"),
        )),
        "p20_application_id": _application_id,
        "p21_path_access": _path_access,
        "p22_study_flatten": lambda s, d: flatten_studies(bronze.studies(s, d)),
        "p23_joined_lists": _lazily(lambda: _of_trials(
            "phases", "conditions", "std_ages", "intervention_names", "intervention_types"
        )),
        "p24_drug_list": _lazily(lambda: _of_trials("drug_interventions")),
        "p25_first_and_count": _lazily(lambda: _of_trials(
            "location_count", "first_location_country", "primary_outcome"
        )),
        "p27_state_code": lambda s, d: _dim_census(s, d).select(
            "fips_code", "state_code", "state_abbreviation"
        ),
        "p28_age_bands": lambda s, d: _dim_census(s, d).select(
            "fips_code", *census.BROAD_AGE_BANDS
        ),
        "p29_phase_bucket": _lazily(lambda: _of_trials(
            "phases", trials.phase_bucket("phases").alias("phase_bucket")
        )),
        "p30_flags": from_trials("nct_id", "has_drug_intervention", "is_industry_sponsored"),
        "p31_age_text": _lazily(lambda: _of_trials(
            trials.age_number("minimum_age").alias("minimum_age_years"),
            trials.age_number("maximum_age").alias("maximum_age_years"),
            trials.age_number("minimum_age", respect_units=True).alias("minimum_age_by_unit"),
        )),
        "p32_clamp": _ages,
        "p35_age_group": lambda s, d: _ages(s, d).select(
            "primary_id", reports.age_group("age_in_years").alias("age_group")
        ),
        "p36_eligibility_bucket": lambda s, d: _dim_trials(s, d).select(
            "nct_id", "minimum_age_years",
            trials.eligibility_bucket("minimum_age_years").alias("age_bucket"),
        ),
        "p37_safe_ratio": _lazily(lambda: _of_drug(
            parse.safe_ratio(
                parse.try_decimal(parse.part_of("dose_amt", "/", 1)),
                parse.try_decimal(parse.part_of("dose_amt", "/", 2)),
            ).cast(reports.DOSE_TYPE).alias("ratio")
        )),
        "p38_upper_names": lambda s, d: report_plans.upper_names(_population(s, d)),
        "p40_sex_label": _lazily(lambda: _of_trials(trials.sex_label("sex").alias("sex_label"))),
        "s01_text_lines": _text_lines,
        "s06_product_lines": lambda s, d: shown(_product_lines(s, d)),
        "s06_product_document": lambda s, d: shown(_product_document(s, d)),
        "s07_study_pages": _read_studies,
        "s07_page_faults": _page_faults,
        "s07_latest_studies": _latest_studies,
        "s08_census_matrix": _census_matrix,
        "s09_parquet_scan": lambda s, d: shown(tables.read_parquet(s, f"{d}/orders.parquet")),
        "s11_template_load": _template_load,
        "s12_load_status": _load_status,
        "s12_first_bad_lines": _first_bad_lines,
        "s13_rejected_studies": _rejected_studies,
        "s14_table_by_name": _table_by_name,
        "u01_diagonal_union": _diagonal_union,
        "j01_stg_faers": lambda s, d: shown(_stg_faers(s, d)),
        "j01_long_keys": _long_keys,
        "j02_dim_drug_faers": lambda s, d: shown(_dim_drug(s, d)),
        "j04_openfda_rows": lambda s, d: shown(_products(s, d)),
        "j05_key_value_rows": _submission_values,
        "m03_stg_openfda_values": lambda s, d: staging.stg_openfda_values(
            bronze.openfda_drugs(s, d)
        ).groupBy("report_id").agg(
            F.count("*").alias("fields"),
            F.count_if(F.col("field_value").cast("string").isNull()).alias("empty_fields"),
        ),
        "m07_dim_fips_census": _dim_census,
        "m08_dim_clinical_trials": lambda s, d: shown(_dim_trials(s, d)),
        "m09_age_distribution": lambda s, d: marts.rpt_faers_age_distribution(
            _dim_drug(s, d), ordered=True
        ),
        "m09_age_distribution_preagg": _age_counted,
        "m09_age_maintained": lambda s, d: marts.age_report(
            known(_maintained_cells(s, d), "age_group")
        ),
        "m10_gender": _gender,
        "m10_gender_maintained": lambda s, d: marts.gender_report(_maintained_cells(s, d)),
        "m10_gender_preagg": _gender_counted,
        "m10_gender_distinct": lambda s, d: marts.rpt_faers_gender(
            _dim_drug(s, d), distinct_reports=True, work=scratch(s)
        ),
        "m11_census_by_state": _population,
        "m12_trials_report": _trials,
        "m12_trials_selected_medians": lambda s, d: marts.rpt_clinical_trials(
            _dim_trials(s, d), scratch(s)
        ),
        "t01_dose_check": lambda s, d: shown(checks.violations(
            _stg_faers(s, d), checks.dose_unparsed(), "dose_amount", "dose_amt_raw"
        )),
        "t02_nda_check": lambda s, d: checks.violations(
            bronze.drug_faers(s, d), checks.not_a_number("nda_num"), "nda_num"
        ),
        "t03_age_check": lambda s, d: checks.violations(
            staging.clean_demo(bronze.demo_faers(s, d)), checks.age_out_of_range(), "age_in_years"
        ),
        "t04_check_summary": _check_summary,
        "t05_raw_check_summary": _raw_check_summary,
        "t06_checks_at_write": _checks_at_write,
        "f01_known_ages": lambda s, d: known(_ages(s, d), "age_in_years"),
        "f02_selected_reports": lambda s, d: report_plans.select_faers(
            _gender(s, d), years=[1996, 1998], genders=["M", "UNK"],
            ingredients=["red", "bolt", "ring"],
        ),
        "a08_age_totals": lambda s, d: agg.regrouped(
            _age_counted(s, d), "age_group", "report_count"
        ),
        "a08_distinct_reports_by_age": _distinct_by_age,
        "a09_population_totals": lambda s, d: agg.column_totals(
            _population(s, d), report_plans.POPULATION
        ),
        "a11_distinct_values": lambda s, d: _dim_trials(s, d).agg(
            agg.distinct_values("eligible_sex").alias("sexes"),
            agg.distinct_values("start_date").alias("start_dates"),
            agg.distinct_values("lead_sponsor_class").alias("sponsor_classes"),
        ),
        "a12_options": lambda s, d: report_plans.filter_options(
            _age_counted(s, d), _population(s, d), _trial_counts(s, d)
        ),
        "m13_headline": lambda s, d: report_plans.headline(
            _age_counted(s, d), _population(s, d), _trial_counts(s, d)
        ),
        "m13_headline_selected": _selected_headline,
        "m13_distinct_selected": _distinct_selected,
        "m14_age_compare": lambda s, d: report_plans.age_comparison(
            _age_counted(s, d), _population(s, d)
        ),
        "m15_gender_split": lambda s, d: report_plans.gender_split(
            _gender_counted(s, d), _population(s, d)
        ),
        "m16_age_three_way": lambda s, d: report_plans.age_three_way(
            _age_counted(s, d), _population(s, d), _trial_counts(s, d)
        ),
        "m17_gender_three_way": lambda s, d: report_plans.gender_three_way(
            _gender_counted(s, d), _population(s, d), _trial_counts(s, d)
        ),
    }
