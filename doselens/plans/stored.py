"""Cleaned reports and drugs in buckets of their key, so that builds join them in place.

Both sides are shuffled once, when they are stored; every later J1 over them reads matching
buckets side by side. A key with more rows than a bucket should hold would make one bucket,
and so one task, as large as it is. Such keys are counted first and stored apart, where
adaptive execution splits them as in any join. Storing pays from the second build on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reports
from ..operators.filters import known
from ..operators.joins import reports_with_drugs
from ..sources.tables import save_buckets, save_table
from . import staging

KEY = "primary_id"
HOT_BUCKETS = 0.25
"""Share of an even bucket from which a key's rows are stored apart."""
SIDES = ("cleaned_demo", "cleaned_drug")


def hot_keys(frame: DataFrame, buckets: int, share: float = HOT_BUCKETS) -> DataFrame:
    """Keys with more rows than a share of an even bucket: at most buckets / share of them."""
    counted = frame.groupBy(KEY).agg(F.count("*").alias("rows"))
    total = counted.agg(F.sum("rows")).first()[0] or 0
    return counted.filter(F.col("rows") > max(1, share * total / buckets)).select(KEY)


def store_cleaned(
    demo_faers: DataFrame, drug_faers: DataFrame, buckets: int, schema: str = "marts"
) -> dict[str, DataFrame]:
    """Writes both sides of J1 in ``buckets``, and the rows of hot keys as tables of their own."""
    demo = staging.clean_demo(demo_faers).withColumn("age_in_years", reports.in_range("age_in_years"))
    frames = dict(zip(SIDES, (known(demo, KEY), known(staging.clean_drug(drug_faers), KEY)), strict=True))
    hot = hot_keys(frames["cleaned_demo"], buckets).unionByName(hot_keys(frames["cleaned_drug"], buckets))
    hot = save_table(hot.distinct(), "hot_report_keys", schema)
    written = {"hot_report_keys": hot}
    for name, frame in frames.items():
        written[name] = save_buckets(frame.join(hot, KEY, "left_anti"), name, KEY, buckets, schema)
        apart = frame.join(hot, KEY, "left_semi")
        written[f"{name}_hot"] = save_table(apart, f"{name}_hot", schema)
    return written


def stored_faers(spark: SparkSession, schema: str = "marts") -> DataFrame:
    """M1 from the stored sides: bucket by bucket, and the hot keys by an ordinary join."""
    parts = []
    for ending in ("", "_hot"):
        demo, drug = (spark.table(f"{schema}.{name}{ending}") for name in SIDES)
        parts.append(reports_with_drugs(demo, drug).select(*staging.STG_FAERS_COLUMNS))
    return parts[0].unionByName(parts[1])
