"""Checks that are counted while quarters are written."""

import shutil

import pytest
from pyspark.sql import functions as F

from doselens import job
from doselens.operators import checks
from doselens.plans import maintained
from doselens.sources import tables
from doselens.streaming import refresh
from test_maintained import deliveries, scans


def demo_rows(spark, ages):
    return spark.createDataFrame(
        [(str(i), str(age), "YR", 2012 + i % 3, i % 2 + 1) for i, age in enumerate(ages)],
        "primaryid string, age string, age_cod string, src_year int, src_quarter int").repartition(5)


def quarters_of(frame):
    return {tuple(r) for r in frame.select("src_year", "src_quarter").distinct().collect()}


def record(spark, bronze):
    return {tuple(r)[:4]: r.violations for r in refresh.read_checks(spark, bronze).collect()}


def written(spark, bronze, frame, table="DEMO"):
    found = refresh.write_checked(frame, f"{bronze}/{table.lower()}_faers", table, quarters_of(frame))
    refresh.record_checks(spark, bronze, table, quarters_of(frame), found)


def test_counts_by_quarter_follow_replaced_quarters(spark, tmp_path):
    bronze = str(tmp_path)
    first = demo_rows(spark, [10, 300, -1, 400, 20, 131] * 20)
    written(spark, bronze, first)
    assert spark.read.parquet(f"{bronze}/demo_faers").count() == 120
    test = checks.raw_checks("DEMO", first.columns)["raw_age_is_realistic"]

    def counted(frame):
        rows = frame.groupBy("src_year", "src_quarter").agg(F.count_if(test).alias("n")).collect()
        return {("DEMO", r.src_year, r.src_quarter, "raw_age_is_realistic"): r.n for r in rows}

    ages = {k: v for k, v in record(spark, bronze).items() if k[3] == "raw_age_is_realistic"}
    assert ages == counted(first) and len(ages) == 6 and 0 < sum(ages.values()) < 120
    second = demo_rows(spark, [10, 20, 30, 500]).filter("src_year = 2012")
    written(spark, bronze, second)
    expected = counted(first) | counted(second)
    assert {k: v for k, v in record(spark, bronze).items() if k[3] == "raw_age_is_realistic"} == expected
    assert {k[3] for k in record(spark, bronze)} == {"raw_age_is_realistic", "report_key_fits_38_digits"}


def test_tables_without_the_columns_are_written_unchecked(spark, tmp_path):
    frame = demo_rows(spark, [1, 2, 3]).select("primaryid", "src_year", "src_quarter")
    written(spark, str(tmp_path), frame, "REAC")
    written(spark, str(tmp_path), frame.withColumnRenamed("primaryid", "CASEID").withColumn("Drug_Seq", F.lit("9" * 40)), "DRUG")
    assert {k[3]: v for k, v in record(spark, str(tmp_path)).items()} == {"drug_key_fits_38_digits": 1}


def test_a_record_whose_change_broke_off_is_found(spark, tmp_path):
    written(spark, str(tmp_path), demo_rows(spark, [500, 1, 2]))
    before = record(spark, str(tmp_path))
    shutil.move(str(tmp_path / "quarter_checks"), str(tmp_path / "quarter_checks.next"))
    assert record(spark, str(tmp_path)) == before and sum(before.values()) == 1


def test_checks_equal_those_of_a_scan(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    demo, drug, _ = deliveries(spark, 7)
    demo = demo.withColumn("age", F.when(F.col("primaryid") == "11", "999").otherwise(F.col("age")))
    drug = drug.withColumn("nda_num", F.when(F.col("caseid") == "1", "x").otherwise(F.col("nda_num")))
    written(spark, bronze, demo, "DEMO")
    written(spark, bronze, drug, "DRUG")
    cells = maintained.refresh_cells(spark, bronze, f"{bronze}/report_cells")
    found = job.written_checks(spark, bronze, cells)
    sources = {n: tables.read_quarters(spark, f"{bronze}/{n}") for n in ("demo_faers", "drug_faers")}
    scanned = {r.check_name: r.violations for r in job.data_checks(sources).collect()}
    assert {r.check_name: r.violations for r in found.collect()} == scanned
    assert scanned["raw_age_is_realistic"] and scanned["raw_nda_num_is_numeric"] and scanned["dose_amount_is_numeric"]
    assert not any("primaryid#" in line or "caseid#" in line for line in scans(found))


@pytest.mark.parametrize("n", [1, 400])
def test_every_quarter_has_its_own_bin(spark, tmp_path, n):
    rows = spark.range(n * 3).select(
        F.lit("9" * 40).alias("primaryid"), (F.col("id") % n / 4 + 1900).cast("int").alias("src_year"),
        (F.col("id") % n % 4 + 1).cast("int").alias("src_quarter"))
    frame, seen = checks.observed(rows.repartition(7), checks.raw_checks("DEMO", rows.columns))
    frame.write.format("noop").mode("overwrite").save()
    quarters = quarters_of(rows)
    found = checks.violations_by_quarter(seen, ["report_key_fits_38_digits"], quarters)
    assert len(found) == n and {violations for *_, violations in found} == {3}
