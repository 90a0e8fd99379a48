"""Landed JSON to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.census import CENSUS_VARIABLES
from ..operators.flatten import PRODUCT_RESULT, STUDY, flatten_studies
from .json_documents import members

STUDY_PAGE = "studies array<variant>, nextPageToken string, _corrupt_record string"

# Parts of a study that must be objects, or lists, when present.
STUDY_OBJECTS = [
    "identificationModule", "identificationModule.orgStudyIdInfo", "statusModule",
    "statusModule.startDateStruct", "statusModule.primaryCompletionDateStruct",
    "statusModule.completionDateStruct", "statusModule.studyFirstPostDateStruct",
    "statusModule.lastUpdatePostDateStruct", "descriptionModule", "designModule",
    "designModule.enrollmentInfo", "designModule.designInfo",
    "designModule.designInfo.maskingInfo", "eligibilityModule",
    "contactsLocationsModule", "sponsorCollaboratorsModule",
    "sponsorCollaboratorsModule.leadSponsor", "outcomesModule",
    "armsInterventionsModule", "conditionsModule",
]
STUDY_RECORD_LISTS = [
    "contactsLocationsModule.locations", "outcomesModule.primaryOutcomes",
    "armsInterventionsModule.interventions",
]
STUDY_TEXT_LISTS = [
    "designModule.phases", "eligibilityModule.stdAges", "conditionsModule.conditions",
]


def read_product_document(
    spark: SparkSession, path: str, work: str | None = None
) -> DataFrame:
    """``{meta, results: [...]}`` documents, bare or as the first member of a zip.

    Documents may have any size: each is cut in many tasks (``json_documents``), and
    gives one row per result, with its date and an array of that result. A document
    that is not JSON of this form fails the read. The pieces are written to ``work``,
    or else below the shared checkpoint folder; ``remove_unzipped`` deletes them.
    """
    found = members(spark, path, work)
    blank = F.trim("value", F.lit(" \t\r\n")) == ""
    # Within brackets, since text after a value would be overlooked.
    bad = blank | F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).isNull()
    error = F.concat(F.lit("not a JSON value in "), "path", F.lit(": "), F.left("value", F.lit(100)))
    checked = F.when(bad, F.raise_error(error)).otherwise(F.from_json("value", PRODUCT_RESULT))
    # The optimizer may move this before the filter below, so it asks for the role itself.
    checked = F.when(F.col("role") == "results[]", checked)
    results = found.filter((F.col("role") == "results[]") & ~(F.col("only") & blank))
    date = F.get_json_object(F.concat(F.lit("{"), "value", F.lit("}")), "$.last_updated")
    dates = found.filter("role = 'meta{}'").groupBy("path").agg(F.max(date).alias("last_updated"))
    return results.join(dates, "path", "left").select(
        F.struct("last_updated").alias("meta"), F.array(checked).alias("results")
    )


def read_product_lines(spark: SparkSession, path: str, last_updated: str) -> DataFrame:
    """S6 for one result per line, which Spark splits into many tasks."""
    return product_lines(spark.read.text(path), last_updated)


def product_lines(
    lines: DataFrame, last_updated: str, column: str = "value"
) -> DataFrame:
    """Results as JSON text, in the columns of ``read_product_document``."""
    result = F.from_json(column, PRODUCT_RESULT)
    return lines.select(
        F.struct(F.lit(last_updated).alias("last_updated")).alias("meta"),
        F.array(result).alias("results"),
    )


def read_study_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages ``{studies, nextPageToken}``, one row per page.

    Studies stay untyped here, so that one malformed study spoils neither its
    page nor its neighbours. A page that is not JSON has no studies and keeps
    its text in ``_corrupt_record``.
    """
    return spark.read.schema(STUDY_PAGE).json(path, multiLine=True)


PAGE_NAME = r"(?:^|/)page-([^/]*)\.json$"
"""A landed page is named by the token it was asked for with; the first has none."""


def landed_pages(pages: DataFrame) -> DataFrame:
    """Path, own token and next token of pages that are named by their token (``PAGE_NAME``).

    ``pages`` still has the file's ``_metadata``, as ``read_study_pages`` gives it.
    """
    path = F.url_decode(F.col("_metadata.file_path"))
    token = F.regexp_extract(path, PAGE_NAME, 1)
    return pages.select(
        path.alias("path"), F.nullif(token, F.lit("")).alias("page_token"), "nextPageToken"
    ).filter(F.col("path").rlike(PAGE_NAME))


def chain_faults(pages: DataFrame) -> DataFrame:
    """What is wrong with a chain of pages, a row for each fault: ``fault``, ``token``, ``pages``.

    Each page but the first is named once by another's next token, one page has none, and
    a page stands there once. A removed page is told as MISSING_PAGE with its token. A
    page that cannot be read names no next one, so it counts among the last pages, and
    the one after it is unnamed. ``pages`` has ``page_token`` and ``nextPageToken``; the
    tokens are compared by joins, so a chain may have any length.
    """
    own = pages.groupBy(F.col("page_token").alias("token")).agg(F.count("*").alias("pages"))
    named = pages.groupBy(F.col("nextPageToken").alias("token")).agg(F.count("*").alias("pages"))
    known, pointers = own.filter("token is not null"), named.filter("token is not null")

    def told(fault: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(fault).alias("fault"), "token", "pages")

    ends = pages.agg(
        F.count("*").alias("all_pages"),
        F.count_if(F.col("page_token").isNull()).alias("first_pages"),
        F.count_if(F.col("nextPageToken").isNull()).alias("last_pages"),
    )
    nothing = F.lit(None).cast("string").alias("token")
    faults = [
        told("MISSING_PAGE", pointers.join(known, "token", "left_anti")),
        told("UNNAMED_PAGE", known.join(pointers, "token", "left_anti")),
        told("REPEATED_PAGE", known.filter("pages > 1")),
        told("REPEATED_POINTER", pointers.filter("pages > 1")),
        *[
            told(fault, ends.filter(test).select(nothing, F.col(count).alias("pages")))
            for fault, count, test in (
                ("NO_FIRST_PAGE", "first_pages", "all_pages > 0 and first_pages = 0"),
                ("SEVERAL_FIRST_PAGES", "first_pages", "first_pages > 1"),
                ("NO_LAST_PAGE", "last_pages", "all_pages > 0 and last_pages = 0"),
                ("SEVERAL_LAST_PAGES", "last_pages", "last_pages > 1"),
            )
        ],
    ]
    return reduce(DataFrame.unionByName, faults)


def latest_studies(parsed: DataFrame) -> DataFrame:
    """One row for each study of ``parse_studies`` that several pages hold.

    The one updated last is kept, an accepted one before a rejected one. Studies without
    a readable id are kept as they are: equal ones meet and are counted, so pages are parsed
    once for both kinds. Copies meet in the map tasks first.
    """
    identity = "identificationModule.nctId"
    nct_id = F.try_variant_get("raw", f"$.protocolSection.{identity}", "string")
    updated = F.col("study.protocolSection.statusModule.lastUpdatePostDateStruct.date")
    rank = F.struct(~F.col("rejected"), updated, F.xxhash64(F.to_json("study")))
    text = F.when(F.col("nct_id").isNull(), F.to_json("raw")).alias("text")
    keyed = parsed.withColumn("nct_id", nct_id).select("*", text)
    chosen = keyed.groupBy("nct_id", "text").agg(
        F.max_by(F.struct("raw", "study", "rejected"), rank).alias("kept"),
        F.when(F.col("nct_id").isNull(), F.count("*")).otherwise(1).cast("int").alias("copies"),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return chosen.select("kept", each).select("kept.*")


def malformed(raw: Column, study: Column) -> Column:
    """True where a part of the study is present but of the wrong kind.

    ``raw`` is the study as landed and ``study`` its typed form, which is null
    at a part that does not fit. Absent parts are fine, a null part is not.
    """
    def present(path: str) -> Column:
        return F.try_variant_get(raw, f"$.protocolSection.{path}", "variant").isNotNull()

    def typed(path: str) -> Column:
        column = study["protocolSection"]
        for name in path.split("."):
            column = column[name]
        return column

    def unfit(path: str) -> Column:
        # The typed part is at hand; the landed one is looked up only where that is null.
        return typed(path).isNull() & present(path)

    def bad_texts(path: str) -> Column:
        kind = F.schema_of_variant(
            F.try_variant_get(raw, f"$.protocolSection.{path}", "variant")
        )
        return (F.size(typed(path)) > 0) & (
            (kind != "ARRAY<STRING>") | F.exists(typed(path), lambda text: text.isNull())
        )

    def bad_field(item: Column, name: str) -> Column:
        value = F.try_variant_get(item, f"$.{name}", "variant")
        return value.isNotNull() & (F.schema_of_variant(value) != "STRING")

    interventions = F.try_variant_get(
        raw, "$.protocolSection.armsInterventionsModule.interventions", "array<variant>"
    )
    section = F.try_variant_get(raw, "$.protocolSection", "variant")
    tests = [
        study.isNull(),
        study["protocolSection"].isNull() & section.isNotNull(),
        *[unfit(path) for path in (*STUDY_OBJECTS, *STUDY_RECORD_LISTS, *STUDY_TEXT_LISTS)],
        *[bad_texts(path) for path in STUDY_TEXT_LISTS],
        *[
            (F.size(typed(path)) > 0) & F.get(typed(path), F.lit(0)).isNull()
            for path in STUDY_RECORD_LISTS
        ],
        F.exists(typed("armsInterventionsModule.interventions"), lambda item: item.isNull()),
        F.exists(interventions, lambda item: bad_field(item, "name") | bad_field(item, "type")),
    ]
    found = F.lit(False)
    for test in tests:
        found = found | F.coalesce(test, F.lit(False))
    return found


def parse_studies(pages: DataFrame) -> DataFrame:
    """One row per study with ``raw``, typed ``study`` and ``rejected``.

    A study is typed inside the explode, so that its many uses below refer to
    one result instead of typing it again for each.
    """
    typed = F.transform(
        "studies",
        lambda raw: F.struct(
            raw.alias("raw"), F.try_variant_get(raw, "$", STUDY).alias("study")
        ),
    )
    return pages.select(F.inline(typed)).withColumn(
        "rejected", malformed(F.col("raw"), F.col("study"))
    )


def kept_studies(parsed: DataFrame) -> DataFrame:
    """Parsed studies for writing, with the landed form of the rejected ones only.

    Pages are costly to parse; accepted and rejected studies are both taken
    from the written rows.
    """
    return parsed.withColumn("raw", F.when(F.col("rejected"), F.col("raw")))


def clinical_trials(parsed: DataFrame) -> DataFrame:
    """The flat bronze table of the studies that could be read."""
    return flatten_studies(parsed.filter(~F.col("rejected")))


def rejected_studies(parsed: DataFrame) -> DataFrame:
    """The studies that were left out, with their id where it is readable."""
    nct_id = F.try_variant_get(
        "raw", "$.protocolSection.identificationModule.nctId", "string"
    )
    return parsed.filter("rejected").select(nct_id.alias("nct_id"), "raw")


def rejected_pages(pages: DataFrame) -> DataFrame:
    """The text of the pages that are not JSON."""
    unread = F.col("_corrupt_record").isNotNull() & F.col("studies").isNull()
    return pages.filter(unread).select("_corrupt_record")


def read_census_matrix(spark: SparkSession, path: str) -> DataFrame:
    """JSON matrices ``[[header...], [row...], ...]`` to the county table."""
    return census_rows(spark.read.text(path, wholetext=True))


def census_rows(matrices: DataFrame, column: str = "value") -> DataFrame:
    """Rows of JSON matrices, columns found by the header of each matrix."""
    parsed = matrices.select(F.from_json(column, "array<array<string>>").alias("matrix"))
    rows = parsed.select(
        F.get("matrix", F.lit(0)).alias("header"),
        F.explode(F.slice("matrix", F.lit(2), F.size("matrix"))).alias("cells"),
    ).select(F.map_from_arrays("header", "cells").alias("cell"))
    state, county = F.col("cell")["state"], F.col("cell")["county"]
    return rows.select(
        *[F.col("cell")[code].alias(name) for code, name in CENSUS_VARIABLES.items()],
        state.alias("state"),
        county.alias("county"),
        F.concat(state, county).alias("fips_code"),
    )
