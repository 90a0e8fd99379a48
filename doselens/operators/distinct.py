"""Exact distinct counts that can be regrouped and filtered afterwards (A8 with Q9).

Sums of counts cannot tell how many different reports stand behind several cells, since a
report stands in many. Here each cell keeps which reports it has: reports are numbered,
numbers are cut into buckets of 32,768, and a bucket holds its few numbers as a list or
its many as a bitmap. Cells are merged by OR, so any filter on their keys and any
grouping by them gives an exact count without going back to the rows.

Reports are numbered in the order of the first cell they stand in, which keeps a cell's
reports together in few buckets. A cell's part of a bucket has at most 32,768 members, so a
cell with a third of all reports is many rows of bounded size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_LISTED = 2048
"""Members up to which a list of two bytes each is no larger than the bitmap of 4 KB."""

BUCKET, LISTED, BITS = "member_bucket", "members_listed", "members_bitmap"


def _pairs(rows: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Members with their keys, as often as they come.

    A report stands in a cell once or a few times, so taking out the others would hold
    nearly every row of a task in memory. They meet in the lists of the buckets.
    """
    return rows.filter(F.col(member).isNotNull()).select(*keys, F.col(member).alias("_member"))


def member_cells(rows: DataFrame, keys: Sequence[str], member: str, work: str) -> DataFrame:
    """For each combination of the keys which members it has, in buckets.

    Null members count nowhere, null keys are values of their own. Numbers must be the
    same wherever they are used, so the numbered members are written once below ``work``.
    """
    spark = rows.sparkSession
    folder = f"{work}/members_{uuid.uuid4().hex}"
    _pairs(rows, keys, member).write.parquet(f"{folder}/pairs")
    pairs = spark.read.parquet(f"{folder}/pairs")
    first = pairs.groupBy("_member").agg(F.min(F.struct(*keys)).alias("_first"))
    # Within each range the numbers have no gaps.
    ordered = first.repartitionByRange("_first", "_member").sortWithinPartitions("_first", "_member")
    ordered.select("_member", F.monotonically_increasing_id().alias("_number")).write.parquet(f"{folder}/numbers")
    numbers = spark.read.parquet(f"{folder}/numbers")

    placed = pairs.join(numbers, "_member").select(
        *keys,
        F.bitmap_bucket_number("_number").alias(BUCKET),
        F.bitmap_bit_position("_number").cast("smallint").alias("_place"),
    )
    listed = placed.groupBy(*keys, BUCKET).agg(F.collect_set("_place").alias(LISTED))
    listed.write.parquet(f"{folder}/listed")
    listed = spark.read.parquet(f"{folder}/listed")
    few = listed.filter(F.size(LISTED) <= MOST_LISTED).withColumn(BITS, F.lit(None).cast("binary"))
    many = _bitmaps(listed.filter(F.size(LISTED) > MOST_LISTED), keys)
    return few.unionByName(many.withColumn(LISTED, F.lit(None).cast("array<smallint>")))


def _bitmaps(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lists of members as bitmaps, by keys and bucket."""
    places = cells.select(*keys, BUCKET, F.explode(LISTED).alias("_place"))
    places = places.withColumn("_place", F.col("_place").cast("bigint"))
    return places.groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("_place").alias(BITS))


def merged(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The cells regrouped by fewer keys: a bitmap for each bucket."""
    whole = cells.filter(F.col(BITS).isNotNull()).select(*keys, BUCKET, BITS)
    lists = _bitmaps(cells.filter(F.col(LISTED).isNotNull()), keys)
    both = whole.unionByName(lists)
    return both.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_members(cells: DataFrame, keys: Sequence[str] = (), name: str = "distinct_members") -> DataFrame:
    """The number of different members by some of the keys; one row without keys.

    Cells are filtered beforehand like any other rows.
    """
    counted = merged(cells, keys).groupBy(*keys) if keys else merged(cells).groupBy()
    total = F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("bigint")
    return counted.agg(total.alias(name))
