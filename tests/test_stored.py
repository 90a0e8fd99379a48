"""J1 over stored buckets."""

from pyspark.sql import functions as F

from doselens.plans import staging, stored
from test_maintained import deliveries
from test_plans import NO_BROADCAST, plan, settings


def test_stored_sides_join_without_a_shuffle(spark):
    demo, drug, _ = deliveries(spark, 11)
    drug = drug.unionByName(drug.limit(1).withColumn("caseid", F.lit("x")))
    expected = sorted(map(str, staging.stg_faers(demo, drug).collect()))
    written = stored.store_cleaned(demo, drug, 4, "stored_test")
    hot = {str(r.primary_id) for r in written["hot_report_keys"].collect()}
    assert "11" in hot and len(hot) < 16
    for name in stored.SIDES:
        assert written[name].filter(F.col("primary_id").isin(list(hot))).count() == 0
        apart = written[f"{name}_hot"]
        assert apart.count() and apart.filter(~F.col("primary_id").isin(list(hot))).count() == 0
    with settings(spark, **NO_BROADCAST):
        joined = stored.stored_faers(spark, "stored_test")
        cold = spark.table("stored_test.cleaned_demo").join(spark.table("stored_test.cleaned_drug"), "primary_id")
        text = plan(cold)
        assert "SortMergeJoin" in text and "Exchange" not in text
        # Only the two sides of the hot keys are shuffled.
        assert plan(joined).count("Exchange hashpartitioning") == 2
        assert sorted(map(str, joined.collect())) == expected
    again = stored.store_cleaned(demo.limit(0), drug, 4, "stored_test")
    assert again["cleaned_demo"].count() == 0 and stored.stored_faers(spark, "stored_test").count() == 0
