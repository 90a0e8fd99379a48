"""Distinct counts that are regrouped and filtered, against counting the rows."""

import random

import pytest
from pyspark.sql import functions as F

from doselens.operators import distinct
from doselens.plans import marts, reports, staging
from test_models import small_bronze


def counted(rows, keys, member):
    return {tuple(r)[:-1]: r[-1] for r in rows.groupBy(*keys).agg(F.count_distinct(member)).collect()}


def regrouped(cells, keys):
    return {tuple(r)[:-1]: r[-1] for r in distinct.distinct_members(cells, keys).collect()}


@pytest.mark.parametrize("most", [0, 3, 2048])
def test_regrouped_counts(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(distinct, "MOST_LISTED", most)
    rng = random.Random(most)
    rows = [(rng.choice("abc") if rng.random() > 0.1 else None, rng.randint(0, 3), rng.choice([None, *range(10**19, 10**19 + 60)]))
            for _ in range(900)]
    frame = spark.createDataFrame([(k, n, None if m is None else str(m)) for k, n, m in rows], "k string, n int, m string")
    frame = frame.withColumn("m", F.col("m").cast("decimal(38,0)"))
    cells = distinct.member_cells(frame, ["k", "n"], "m", str(tmp_path))
    known = frame.filter("m is not null")
    for keys in (["k", "n"], ["k"], ["n"], []):
        assert regrouped(cells, keys) == counted(known, keys, "m")
    some = F.col("n").isin(1, 2) & F.coalesce(F.col("k") != "b", F.lit(True))
    assert regrouped(cells.filter(some), ["k"]) == counted(known.filter(some), ["k"], "m")
    assert regrouped(cells.filter("n = 99"), []) == {(): 0} and regrouped(cells.filter("n = 99"), ["k"]) == {}
    assert regrouped(distinct.member_cells(frame.limit(0), ["k"], "m", str(tmp_path)), []) == {(): 0}


def test_a_hot_cell_is_many_rows_of_bounded_size(spark, tmp_path):
    """A third of the members in one cell, and all of them in another key."""
    rows = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("cell"), (F.col("id") * 7 + 10**15).alias("m"))
    rows = rows.unionByName(rows.withColumn("cell", F.lit(1000)))
    cells = distinct.member_cells(rows, ["cell"], "m", str(tmp_path))
    assert cells.filter(F.size("members_listed") > distinct.MOST_LISTED).count() == 0
    assert cells.filter("members_bitmap is not null").agg(F.max(F.length("members_bitmap"))).first()[0] == 4096
    # Numbered by first cell, each small cell lies in a bucket or two.
    spread = cells.filter("cell between 0 and 999").groupBy("cell").count().agg(F.max("count")).first()[0]
    assert spread <= 2
    assert regrouped(cells, ["cell"]) == counted(rows, ["cell"], "m")
    assert regrouped(cells, []) == {(): 120_000}


def test_repeated_members_count_once_and_are_not_gathered_with_the_rows(spark, tmp_path):
    rows = spark.range(0, 30_000, 1, 8).select((F.col("id") % 3).alias("cell"), (F.col("id") % 5_000).alias("m"))
    plan = distinct._pairs(rows, ["cell"], "m")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    cells = distinct.member_cells(rows, ["cell"], "m", str(tmp_path))
    assert regrouped(cells, ["cell"]) == {(0,): 5_000, (1,): 5_000, (2,): 5_000}
    assert regrouped(cells, []) == {(): 5_000}


def test_distinct_reports_are_counted_apart_from_the_joins(spark, tmp_path):
    demo, drug, products = small_bronze(spark)
    dim = marts.dim_drug_faers(staging.stg_faers(demo, drug), products)
    report = marts.rpt_faers_gender(dim, distinct_reports=True, work=str(tmp_path))
    assert "Join" not in report._jdf.queryExecution().executedPlan().toString()
    expected = marts.rpt_faers_gender(dim, distinct_reports=True)
    assert report.columns == expected.columns
    assert sorted(map(str, report.collect())) == sorted(map(str, expected.collect()))


def test_distinct_headline_under_filters(spark, tmp_path):
    demo, drug, products = small_bronze(spark)
    dim = marts.dim_drug_faers(staging.stg_faers(demo, drug), products)
    members = marts.report_members(dim, str(tmp_path))
    chosen = reports.select_faers(members, years=[2013], brands=["brand1", "brand3"])
    rows = {(r.gender, r.source_year): r.distinct_reports for r in reports.distinct_headline(chosen).collect()}
    wanted = dim.filter("source_year = 2013 and brand_name in ('brand1', 'brand3')")
    wanted = wanted.withColumn("gender", F.coalesce("gender", F.lit("UNK")))
    expected = counted(wanted, ["gender", "source_year"], "primary_id")
    expected[None, None] = wanted.select("primary_id").distinct().count()
    assert rows == expected and len(rows) > 1
    listed = {(r.gender, r.source_year): r.n for r in members.groupBy("gender", "source_year").agg(F.count("*").alias("n")).collect()}
    assert all(n < 100 for n in listed.values())
