"""Medians by selection, against sorting."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from doselens.operators import selection


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_medians_equal_sorting(spark, bins):
    rng = random.Random(bins)
    rows = [(rng.choice(["a", "b", None, "c"]), rng.randint(0, 1), rng.choice([None, rng.randint(-40, 40), rng.randint(-3, 3)]), rng.randint(0, 4))
            for _ in range(300)] + [("alone", 0, -7, 1), ("two", 0, 5, 1), ("two", 0, 8, 1), ("none", 0, None, 3)]
    groups = defaultdict(list)
    for k, n, value, weight in rows:
        groups[k, n] += [value] * weight if value is not None else []
    expected = {key: float(statistics.median(values)) for key, values in groups.items() if values}
    frame = spark.createDataFrame(rows, "k string, n int, value bigint, weight bigint").repartition(4)
    found = {(r.k, r.n): r.median for r in selection.selected_medians(frame, ["k", "n"], "value", "weight", bins=bins).collect()}
    assert found == expected


def test_far_values_and_empty_tables(spark):
    far = [(1, -(2**62)), (1, 2**62), (1, 3), (2, 2**62), (2, 2**62 - 1024)]
    frame = spark.createDataFrame([(k, v, 1) for k, v in far], "k int, value bigint, weight bigint")
    found = {r.k: r.median for r in selection.selected_medians(frame, ["k"], "value", "weight").collect()}
    assert found == {1: 3.0, 2: float(2**62 - 512)}
    assert selection.selected_medians(frame.limit(0), ["k"], "value", "weight").count() == 0


def test_a_group_of_a_million_values(spark, tmp_path):
    """Beside a small one; each round's aggregates hold bins, not values."""
    values = spark.range(0, 1_000_001, 1, 8).select(
        F.lit("hot").alias("k"), (F.col("id") * 7919 % 1_000_001 * 3).alias("value"), F.lit(1).cast("bigint").alias("weight"))
    values = values.unionByName(spark.createDataFrame([("cold", 5, 1)], "k string, value bigint, weight bigint"))
    values.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    found = {r.k: r.median for r in selection.selected_medians(stored, ["k"], "value", "weight").collect()}
    assert found == {"hot": 1_500_000.0, "cold": 5.0}
    text = selection.selected_medians(stored, ["k"], "value", "weight")._jdf.queryExecution().toString()
    assert "collect_list" not in text and "percentile" not in text
