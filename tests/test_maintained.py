"""Drug reports that follow replaced quarters, against counting everything again."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from doselens.operators import checks
from doselens.operators.filters import known
from doselens.plans import maintained, marts, staging
from doselens.sources import tables
from test_models import small_bronze


def deliveries(spark, seed):
    """Reports and drugs of three quarters; a hot report and a hot drug in each."""
    rng = random.Random(seed)
    demo, drug, products = small_bronze(spark)
    people = [("11" if i % 3 == 0 else f"{i}1", str(rng.randint(0, 90)) if i % 7 else None, "YR", rng.choice("MF"),
               2012 + i % 3, 1) for i in range(60)]
    uses = [("1" if i % 3 == 0 else str(i), "1", "000007" if i % 2 else f"{i % 5:06d}" if i % 5 else None,
             rng.choice(["1.2.3", "5 mg", None]), 2012 + rng.randint(0, 2), 1) for i in range(90)]
    names = "primaryid string, age string, age_cod string, sex string, src_year int, src_quarter int"
    demo = spark.createDataFrame(people, names).join(demo.select("primaryid").limit(0), "primaryid", "left").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in demo.columns if c not in names])
    names = "caseid string, drug_seq string, nda_num string, dose_amt string, src_year int, src_quarter int"
    drug = spark.createDataFrame(uses, names).select(
        "*", *[F.lit(None).cast("string").alias(c) for c in drug.columns if c not in names])
    return demo, drug, products


def shown(frame):
    return sorted(map(str, frame.select(sorted(frame.columns)).collect()))


def expected(demo, drug, products):
    dim = marts.dim_drug_faers(staging.stg_faers(demo, drug), products)
    return shown(marts.rpt_faers_age_distribution(dim)), shown(marts.rpt_faers_gender(dim))


def reports(cells, products):
    joined = maintained.report_cells(cells, products)
    return shown(marts.age_report(known(joined, "age_group"))), shown(marts.gender_report(joined))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "state")


def write(bronze, demo=None, drug=None):
    for name, frame in (("demo_faers", demo), ("drug_faers", drug)):
        if frame is not None:
            tables.write_quarters(frame, f"{bronze}/{name}")


@pytest.mark.parametrize(("demo_years", "drug_years"), [([2013], []), ([], [2012]), ([2012, 2014], [2014]), ([2012, 2013, 2014], [2012, 2013, 2014])])
def test_replaced_quarters_equal_a_full_count(spark, folder, demo_years, drug_years):
    bronze, state = folder
    old_demo, old_drug, products = deliveries(spark, 1)
    new_demo, new_drug, _ = deliveries(spark, 2)
    write(bronze, old_demo, old_drug)
    cells = maintained.refresh_cells(spark, bronze, state)
    assert reports(cells, products) == expected(old_demo, old_drug, products)
    write(bronze, new_demo.filter(F.col("src_year").isin(demo_years)) if demo_years else None,
          new_drug.filter(F.col("src_year").isin(drug_years)) if drug_years else None)
    demo, drug = (tables.read_quarters(spark, f"{bronze}/{n}") for n in ("demo_faers", "drug_faers"))
    cells = maintained.refresh_cells(spark, bronze, state)
    assert reports(cells, products) == expected(demo, drug, products)
    stg = staging.stg_faers(demo, drug)
    unparsed = stg.filter(checks.dose_unparsed()).count()
    assert unparsed and cells.agg(F.sum("unparsed_doses")).first()[0] == unparsed
    assert cells.agg(F.sum("rows")).first()[0] == stg.count()


def test_added_and_removed_quarters(spark, folder, tmp_path):
    bronze, state = folder
    demo, drug, products = deliveries(spark, 3)
    write(bronze, demo.filter("src_year < 2014"), drug.filter("src_year > 2012"))
    maintained.refresh_cells(spark, bronze, state)
    write(bronze, demo.filter("src_year = 2014"), drug.filter("src_year = 2012"))
    cells = maintained.refresh_cells(spark, bronze, state)
    assert reports(cells, products) == expected(demo, drug, products)
    (tmp_path / "bronze" / "drug_faers" / "src_year=2013").rename(tmp_path / "aside")
    cells = maintained.refresh_cells(spark, bronze, state)
    assert reports(cells, products) == expected(demo, drug.filter("src_year != 2013"), products)
    assert not any(maintained.changed_quarters(v, maintained.quarter_versions(spark, f"{bronze}/{n}")) for n, v in
                   ((n, maintained.quarter_versions(spark, f"{bronze}/{n}")) for n in maintained.SIDES.values()))
    files = cells.inputFiles()
    assert maintained.refresh_cells(spark, bronze, state).inputFiles() == files


def test_a_run_that_broke_off_is_repeated(spark, folder, tmp_path):
    bronze, state = folder
    demo, drug, products = deliveries(spark, 4)
    write(bronze, demo, drug.filter("src_year = 2012"))
    maintained.refresh_cells(spark, bronze, state)
    write(bronze, None, drug)
    spark.createDataFrame([(1,)], "broken int").write.parquet(f"{state}/2/cells")
    cells = maintained.refresh_cells(spark, bronze, state)
    assert reports(cells, products) == expected(demo, drug, products)


def scans(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("simple")
    return [line for line in text.getvalue().splitlines() if "FileScan" in line]


def test_only_changed_quarters_of_the_changed_side_are_read(spark, folder):
    bronze, state = folder
    demo, drug, _ = deliveries(spark, 5)
    write(bronze, demo, drug)
    cells = maintained.refresh_cells(spark, bronze, state)
    sources = [tables.read_quarters(spark, f"{bronze}/{n}") for n in ("demo_faers", "drug_faers")]

    def filters(changed_demo, changed_drug):
        lines = scans(maintained.refreshed_cells(cells, *sources, changed_demo, changed_drug))
        found = {"demo": [], "drug": []}
        for line in lines:
            side = "demo" if "primaryid#" in line else "drug" if "caseid#" in line else None
            if side:
                found[side].append(re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)[1])
        return found

    only_drug = filters([], [(2013, 1)])
    assert only_drug["demo"] == [""] and len(only_drug["drug"]) == 1
    assert "2013" in only_drug["drug"][0] and "NOT" not in only_drug["drug"][0]
    only_demo = filters([(2013, 1)], [])
    assert len(only_demo["demo"]) == 1 and "2013" in only_demo["demo"][0]
    assert len(only_demo["drug"]) == 1
    both = filters([(2012, 1)], [(2013, 1)])
    assert sorted("2012" in f for f in both["demo"]) == [False, True]
    assert sorted("NOT" in f for f in both["drug"]) == [False, True]


def test_drugs_are_not_gathered_before_the_join(spark):
    demo, drug, _ = deliveries(spark, 5)
    cells = maintained.joined_cells(demo, drug)
    text = cells._jdf.queryExecution().executedPlan().toString()
    assert "Join" in text and not re.search(r"Aggregate\(keys=\[primary_id#\d+, nda_number", text)
    # A report and a drug of one key meet as often as both come.
    hot = demo.filter("primaryid = '11'").count() * drug.filter("caseid = '1'").count()
    assert cells.agg(F.sum("rows")).first()[0] >= hot > 400


def test_a_hot_drug_key_is_split(spark):
    demo, drug, _ = deliveries(spark, 5)
    many = spark.range(0, 6000, 1, 16)
    key = F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string"))
    wide = drug.limit(1).drop("caseid", "drug_seq", "nda_num").crossJoin(
        many.select(key.alias("caseid"), F.lit("1").alias("drug_seq"), (F.col("id") % 900).cast("string").alias("nda_num")))
    names = {"autoBroadcastJoinThreshold": "-1", "adaptive.autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false",
             "adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "adaptive.advisoryPartitionSizeInBytes": "1KB",
             "adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {name: spark.conf.get(f"spark.sql.{name}", None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(f"spark.sql.{name}", value)
        cells = maintained.joined_cells(demo, wide.select(*drug.columns))
        rows = cells.collect()
        assert "skew=true" in cells._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(f"spark.sql.{name}") if value is None else spark.conf.set(f"spark.sql.{name}", value)
    reports = {r.primaryid: r["count"] for r in demo.groupBy("primaryid").count().collect()}
    found = wide.select(F.concat("caseid", "drug_seq").alias("key")).collect()
    assert sum(r.rows for r in rows) == sum(reports.get(r.key, 0) for r in found)
