"""Periodic re-ingest of quarterly archives.

A run compares the landed archives with the record of earlier runs, and reads
those that are new, were replaced, or could not be read. The record tells what
became of every landed archive, so nothing is left out in silence. Schedule runs
as often as wanted. (A file stream would not do: it never looks again at a name
it has seen, so a corrected archive would be missed.)
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks
from ..sources.archives import (
    archive_status,
    archive_table,
    list_archives,
    newest_readable,
    remove_unzipped,
    unzip_archives,
)
from ..sources.tables import write_quarters

STATUS_FIELDS = """path string, table_name string, modificationTime timestamp, length bigint,
    src_year int, src_quarter int, member string, status string, row_count bigint, error string,
    in_use boolean"""
STATUS_COLUMNS = [field.split()[0] for field in STATUS_FIELDS.split(",")]
CHECK_FIELDS = "table_name string, src_year int, src_quarter int, check_name string, violations bigint"
NOT_COVERED = "NOT_COVERED"
Quarter = tuple[int, int]
UNSETTLED = ("LOAD_FAILED", NOT_COVERED)


def _places(spark: SparkSession, path: str):
    """The places of a record and of the next one beside it, and their file system."""
    place, beside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.next"))
    return place, beside, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _read_record(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """A record; empty before the first was written.

    A run that broke off between taking the old one away and putting the new one in its
    place has left the new one beside it, whole.
    """
    place, beside, system = _places(spark, path)
    done = spark._jvm.org.apache.hadoop.fs.Path(beside, "_SUCCESS")
    if system.exists(place):
        return spark.read.schema(fields).parquet(path)
    if system.exists(done):
        return spark.read.schema(fields).parquet(f"{path}.next")
    return spark.createDataFrame([], fields)


def _write_record(spark: SparkSession, path: str, rows: Sequence, fields: str) -> None:
    """Writes a record beside the old one and then takes its place."""
    frame = spark.createDataFrame(list(rows), fields)
    frame.coalesce(1).write.mode("overwrite").parquet(f"{path}.next")
    place, beside, system = _places(spark, path)
    system.delete(place, True)
    if not system.rename(beside, place):
        raise OSError(f"{path}.next could not take the place of {path}")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The record of earlier runs; empty before the first."""
    return _read_record(spark, path, STATUS_FIELDS)


def write_checked(
    rows: DataFrame, path: str, table: str, quarters: Collection[Quarter]
) -> list[tuple[int, int, str, int]]:
    """K2 with T2, T3: writes quarters; returns year, quarter, check and violations."""
    tests = checks.raw_checks(table, rows.columns)
    if not tests:
        write_quarters(rows, path)
        return []
    seen = []

    def watch(frame: DataFrame) -> DataFrame:
        frame, observation = checks.observed(frame, tests)
        seen.append(observation)
        return frame

    write_quarters(rows, path, watch)
    return checks.violations_by_quarter(seen[0], tests, quarters)


def read_checks(spark: SparkSession, bronze: str) -> DataFrame:
    """The violations of the raw checks in each quarter that was written."""
    return _read_record(spark, f"{bronze}/quarter_checks", CHECK_FIELDS)


def record_checks(
    spark: SparkSession,
    bronze: str,
    table: str,
    quarters: Collection[Quarter],
    found: Sequence[tuple[int, int, str, int]],
) -> None:
    """Puts a table's written quarters in place of what the record says of them."""
    # A few rows for each quarter.
    before = [tuple(r) for r in read_checks(spark, bronze).collect()]
    kept = [r for r in before if r[0] != table or (r[1], r[2]) not in quarters]
    _write_record(spark, f"{bronze}/quarter_checks", kept + [(table, *r) for r in found], CHECK_FIELDS)


def refresh_quarters(
    spark: SparkSession,
    landing: str,
    wanted: Sequence[str],
    bronze: str,
    work: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Write the quarters of new and replaced archives; returns the load record.

    Table ``T`` goes to ``bronze/t_faers``, the record to ``bronze/load_status``:
    one row for each landed archive and table with its status and whether its
    rows are in use. Of several archives of a quarter the newest readable one is
    used. ``years`` limits the quarters that are loaded; archives outside it are
    recorded as NOT_COVERED. Whole quarter partitions are replaced and the record
    is written last, so a run that broke off is repeated with the same result. The
    violations of the raw checks are counted by the jobs that write the quarters and kept
    in ``bronze/quarter_checks``, a row for each table, quarter and check.
    """
    record = f"{bronze}/load_status"
    # One row for each archive and table; a few thousand for decades of quarters.
    before = spark.createDataFrame(read_status(spark, record).collect(), STATUS_FIELDS)
    landed = list_archives(spark, landing)
    landed = spark.createDataFrame(landed.collect(), landed.schema)
    state = ["path", "table_name", "modificationTime", "length"]
    names = F.explode(F.array(*[F.lit(name) for name in wanted]))
    everything = landed.withColumn("table_name", names)
    settled = before.filter(~F.col("status").isin(*UNSETTLED)).select(*state)
    pending = everything.join(settled, state, "left_anti")
    if years is not None:
        pending = pending.filter(F.col("src_year").between(*years))
    paths = [row.path for row in pending.select("path").distinct().collect()]

    unzipped = unzip_archives(spark, paths, wanted, work) if paths else None
    if unzipped is None:
        fresh = spark.createDataFrame([], "path string, table_name string, member string, "
                                      "status string, row_count bigint, error string")
    else:
        fresh = archive_status(unzipped).select(
            "path", "table_name", "member", "status", "row_count", "error"
        )
        fresh = spark.createDataFrame(fresh.collect(), fresh.schema)
    known = before.join(everything.select(*state), state, "left_semi").join(
        fresh, ["path", "table_name"], "left_anti"
    )
    now = everything.join(fresh, ["path", "table_name"]).unionByName(
        known.filter(F.col("status") != NOT_COVERED).select(*everything.columns, "member", "status", "row_count", "error")
    )
    chosen = newest_readable(now.drop("modificationTime"), landed)
    if unzipped is not None:
        for name in wanted:
            own = chosen.filter(F.col("table_name") == name).join(
                fresh.select("path", "table_name"), ["path", "table_name"], "left_semi"
            )
            # One row for each archive that is used.
            quarters = {(r.src_year, r.src_quarter) for r in own.collect()}
            if quarters:
                rows = archive_table(unzipped, name, own)
                path = f"{bronze}/{name.lower()}_faers"
                record_checks(spark, bronze, name, quarters, write_checked(rows, path, name, quarters))
    missing = everything.join(now, ["path", "table_name"], "left_anti").select(
        *everything.columns,
        *[F.lit(None).cast("string").alias(c) for c in ("member", "error")],
        F.lit(NOT_COVERED).alias("status"),
        F.lit(0).cast("bigint").alias("row_count"),
    )
    in_use = chosen.select("path", "table_name", F.lit(True).alias("in_use"))
    final = now.unionByName(missing).join(in_use, ["path", "table_name"], "left")
    final = final.na.fill(False, ["in_use"]).select(*STATUS_COLUMNS)
    _write_record(spark, record, final.collect(), STATUS_FIELDS)
    if unzipped is not None:
        remove_unzipped(unzipped)
    return spark.read.schema(STATUS_FIELDS).parquet(record)
