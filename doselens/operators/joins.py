"""The joins of the reference's models.

None of the large joins carries a broadcast hint. Spark broadcasts a side only
while its measured size is below ``spark.sql.autoBroadcastJoinThreshold``; above
it the join is a sort-merge join whose oversized partitions are split by
adaptive execution, which is what keeps one hot key from landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def reports_with_drugs(demo: DataFrame, drug: DataFrame) -> DataFrame:
    """Inner join on ``primary_id``; rows without one drop out."""
    return demo.join(drug, "primary_id")


def drugs_with_products(reports: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join of a drug's number with a product's application number.

    Application numbers have few digits, so a drug's number beyond 64 bits equals none.
    """
    number = reports["nda_number"].try_cast("bigint")
    return reports.join(products, number == products["application_number"])


def on_spine(spine: DataFrame, key: str, *sides: DataFrame) -> DataFrame:
    """Left-join small per-label results onto a label list.

    The sides hold at most one row per label of the spine.
    """
    joined = spine
    for side in sides:
        joined = joined.join(side, key, "left")
    return joined.na.fill(0.0)
