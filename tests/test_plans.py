"""What the plans of the models look like, and that hot keys are split."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from doselens import session
from doselens.plans import marts, staging
from suite import queries as registered
from test_models import small_bronze

SF = "/root/testdata/sf0.001"
QUERIES = registered.queries()


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("simple")
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
EAGER_SKEW = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


# A document is cut by Python tasks, and pieces that reach over splits are put in order;
# medians are selected by adding up the bins of a group, 1,024 at most, in their order; lines
# are numbered by adding up the splits of a file.
ORDERED = ("s06_product_document", "m12_trials_selected_medians", "s12_first_bad_lines")
IN_SQL = [name for name in QUERIES if name not in ORDERED]


@pytest.mark.parametrize("name", IN_SQL)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("EvalPython", "MapInArrow", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin", "Window"):
        assert operator not in text


def read_columns(text, table):
    """The columns each scan of a table reads."""
    scans = [line for line in text.splitlines() if f"/{table}.parquet" in line]
    assert scans
    return [re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1).count("#") for line in scans]


def test_reports_read_only_their_columns(spark):
    text = plan(QUERIES["m10_gender_preagg"](spark, SF))
    assert read_columns(text, "orders") == [2]
    assert read_columns(text, "lineitem") == [4]
    text = plan(QUERIES["m10_gender"](spark, SF))
    assert read_columns(text, "orders") == [2]


def test_landed_parts_are_looked_up_only_without_a_typed_one(spark):
    with settings(spark, spark__sql__debug__maxToStringFields="1000"):
        text = plan(QUERIES["s13_rejected_studies"](spark, SF))
    assert "AND isnotnull(try_variant_get(" in text
    assert "(isnotnull(try_variant_get(raw" not in text


def test_a_long_text_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registered, "LINES_PER_PART", 700)
    monkeypatch.setattr(registered, "scratch", lambda spark: str(tmp_path))
    found = QUERIES["s12_first_bad_lines"](spark, SF).collect()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey").collect()
    expected = set()
    for bucket in range(4):
        own = [line[2] % 97 == 5 for line in sorted(tuple(r) for r in lines if r[0] % 4 == bucket)]
        expected.add((bucket, len(own), sum(own), own.index(True) + 1))
    assert {tuple(r) for r in found} == expected
    files = list(tmp_path.glob("lines_*/bucket=*/part-*.txt"))
    longest = max(len(file.read_text().splitlines()) for file in files)
    assert len(files) >= 9 and longest < 2100


@pytest.mark.parametrize("name", ["j02_dim_drug_faers", "m09_age_distribution_preagg"])
def test_joins_beyond_the_broadcast_limit(spark, name):
    expected = sorted(map(str, QUERIES[name](spark, SF).collect()))
    with settings(spark, **NO_BROADCAST):
        frame = QUERIES[name](spark, SF)
        assert plan(frame).count("SortMergeJoin") == 2
        assert sorted(map(str, frame.collect())) == expected


@pytest.mark.parametrize("name", ["m09_age_distribution_preagg", "m10_gender_preagg"])
def test_counting_first_shuffles_little(spark, name):
    with settings(spark, **NO_BROADCAST):
        assert plan(QUERIES[name](spark, SF)).count("Exchange hashpartitioning") <= 8


def test_hot_report_and_hot_application_are_split(spark, tmp_path):
    """A third of the drugs share a report and an application."""
    demo, drug, products = small_bronze(spark)
    many = spark.range(0, 6000, 1, 16).withColumn("hot", F.col("id") % 3 == 0)
    wide = drug.limit(1).drop("caseid", "nda_num").crossJoin(
        many.select(
            F.when(F.col("hot"), "1").otherwise(F.col("id").cast("string")).alias("caseid"),
            F.when(F.col("hot"), "000007").otherwise(F.lpad(F.col("id") % 5, 6, "0")).alias("nda_num"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
    ).withColumn("dose_vbm", F.col("text")).select(*drug.columns)
    wide.write.parquet(str(tmp_path / "drug"))
    wide = spark.read.parquet(str(tmp_path / "drug")).repartition(16)
    with settings(spark, **EAGER_SKEW):
        stg = staging.stg_faers(demo, wide)
        reports = stg.collect()
        assert "skew=true" in plan(stg)
        dim = marts.dim_drug_faers(stg, products.repartition(4))
        rows = dim.collect()
        assert plan(dim).split("Initial Plan")[0].count("skew=true") == 2
    assert len(reports) == staging.stg_faers(demo, wide).count()
    assert len(rows) == marts.dim_drug_faers(staging.stg_faers(demo, wide), products).count()


def test_shuffle_sizing():
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(100 * 10**12, 4000) == 372530
