"""Group-by helpers of the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(column: str) -> Column:
    """A10: sum that is 0 for no rows."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def regrouped(frame: DataFrame, key: str, measure: str) -> DataFrame:
    """Sum of a pre-aggregated measure by one of its keys."""
    return frame.groupBy(key).agg(F.sum(measure).alias(measure))


def distinct_values(column: str) -> Column:
    """Number of distinct values in which null counts as one; 0 for no rows."""
    has_null = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return F.count_distinct(column) + has_null


def column_totals(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the sum of each column."""
    return frame.agg(*[F.sum(name).alias(name) for name in columns])


def label_totals(
    frame: DataFrame, key: str, labels: Sequence[str], measure: str, total_name: str
) -> DataFrame:
    """One row with the sum of a measure for each label and for all rows.

    Holding the labels side by side lets the share of the total be computed in
    the same single aggregation, without joining the total back.
    """
    return frame.agg(
        *[
            F.sum(F.when(F.col(key) == label, F.col(measure))).alias(label)
            for label in labels
        ],
        F.sum(measure).alias(total_name),
    )


def shares(
    totals: DataFrame, labels: Mapping[str, str], total_name: str, key: str, share: str
) -> DataFrame:
    """Wide totals to rows of (label, percent of the total).

    ``labels`` maps a column of the one-row frame to the label it becomes.
    """
    percents = [
        (F.try_divide(F.col(column), F.col(total_name)) * 100).alias(label)
        for column, label in labels.items()
    ]
    return totals.select(*percents).unpivot([], list(labels.values()), key, share)


def bucket_shares(
    totals: DataFrame, buckets: Mapping[str, Sequence[str]], key: str, share: str
) -> DataFrame:
    """Totals grouped into buckets, each as percent of all buckets.

    With nothing in any bucket every share is 0.
    """
    amounts = {
        bucket: reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])
        for bucket, columns in buckets.items()
    }
    everything = reduce(add, amounts.values())
    guarded = F.when(everything == 0, 1).otherwise(everything)
    percents = [(amount / guarded * 100).alias(b) for b, amount in amounts.items()]
    return totals.select(*percents).unpivot([], list(buckets), key, share)


def rate_per_100k(reports: Column, population: Column) -> Column:
    """Reports per 100,000 people, null without people."""
    return F.try_divide(reports, population) * 100_000


def options(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct non-null values of several columns, in one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("option"), F.col(name).cast("string").alias("value"))
            for name in columns
        ]
    )
    return (
        frame.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    )
