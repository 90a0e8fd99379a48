"""Exact medians of groups of any size by selection in rounds (A4).

An aggregate that sorts a group's values holds all its different values in one task. Here
each round counts the values of a group in a bounded number of bins, counted in the map
tasks first, and goes on with the one bin that holds the wanted rank. A round divides
the range of values by the number of bins, so three rounds settle a billion different
values and seven any 64-bit ones; no task holds more of a group than its bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024
"""Bins of a round."""


def _rounds(lowest: int, highest: int, bins: int) -> int:
    rounds, span = 0, 1
    while span <= highest - lowest:
        rounds, span = rounds + 1, span * bins
    return rounds


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(38,0)")


def selected_medians(
    values: DataFrame, keys: Sequence[str], value: str, weight: str, name: str = "median", bins: int = BINS
) -> DataFrame:
    """The median of whole numbers by the keys, each counting ``weight`` times.

    Of an even number it is the mean of the two in the middle. Null values count nowhere,
    and groups without others have no row; null keys are a group. Values are read
    once for each round and should be stored. One row, the range of all values, comes
    to the driver.
    """
    known = values.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).select(
        *keys, F.col(value).cast("decimal(38,0)").alias("_value"), F.col(weight).alias("_weight")
    )
    lowest, highest = known.agg(F.min("_value"), F.max("_value")).first()
    rounds = _rounds(int(lowest or 0), int(highest or 0), bins)
    start = _whole(int(lowest or 0))
    last = F.sum("_weight").cast("bigint") - 1
    middle = F.array_distinct(F.array(F.floor(last / 2), F.ceil(last / 2)))
    wanted = known.groupBy(*keys).agg(middle.alias("_ranks"))
    wanted = wanted.select(
        *keys, F.explode("_ranks").alias("_rank"), start.alias("_start")
    ).withColumn("_left", F.col("_rank"))
    for number in range(rounds, 0, -1):
        wanted = _narrowed(known, wanted, keys, bins ** (number - 1), bins)
    return wanted.groupBy(*keys).agg(F.avg(F.col("_start").cast("double")).alias(name))


def _narrowed(
    known: DataFrame, wanted: DataFrame, keys: Sequence[str], width: int, bins: int
) -> DataFrame:
    """Each wanted rank with the start of the bin, of a width, that holds it.

    ``_left`` counts the values of the bin before the wanted one.
    """
    renamed = wanted.select(*[F.col(k).alias(f"_own_{k}") for k in keys], "_rank", "_start", "_left")
    same: Column = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_own_{key}"))
    end = F.col("_start") + _whole(width * bins)
    inside = (F.col("_value") >= F.col("_start")) & (F.col("_value") < end)
    met = known.join(renamed, same & inside)
    # Below the number of bins, whatever the width.
    place = F.expr(f"cast((_value - _start) div cast('{width}' as decimal(38,0)) as int)")
    counted = met.groupBy(*keys, "_rank", "_start", "_left", place.alias("_bin")).agg(
        F.sum("_weight").cast("bigint").alias("_held")
    )
    over = Window.partitionBy(*keys, "_rank").orderBy("_bin")
    through = counted.withColumn("_through", F.sum("_held").over(over))
    before = F.col("_through") - F.col("_held")
    chosen = through.filter((before <= F.col("_left")) & (F.col("_left") < F.col("_through")))
    moved = F.col("_start") + F.col("_bin").cast("decimal(10,0)") * _whole(width)
    return chosen.select(
        *keys, "_rank", moved.cast("decimal(38,0)").alias("_start"), (F.col("_left") - before).alias("_left")
    )
