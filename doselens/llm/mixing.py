"""Mixing sources to target weights by apportioning blocks.

The wanted words of a source follow its weight, up to a number of passes over
it; what a source cannot take is shared out again by weight. The whole mix is
cut into blocks of equally many words. Sainte-Laguë gives each source a whole
number of blocks by highest quotients, and then each shard of a source its part
of those. In a shard the documents stand in a seeded order; their words are one
stream that is cut into blocks, and a seeded permutation of the blocks tells
which of them are taken once more than the others.

A shard holds about ``shard_words`` words, so a source of any size is spread
over many tasks, and only sums by shard and by source come together. Everything
is a column expression, a join or a window over such sums.

Null and empty texts have size 0 and nothing is taken of them. Null sources are
one source, last in order. Repeated rows are documents of their own; equal rows
may be given different blocks, but always the same ones in all. An empty table
gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doselens.llm.common import WORD, materialize

BLOCK_WORDS = 32
SHARD_WORDS = 1 << 20
PASSES = 3
WEIGHTS = (1, 2, 3)
PRIME = 2_147_483_647
"""A prime above the number of blocks of a shard; multiplying by it permutes them."""


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded(seed: int, *parts: Column) -> Column:
    """A whole number below 2^60 from a seed and values."""
    values = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *values)), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def apportion(
    frame: DataFrame, votes: str, house: str, order: str, group: Sequence[str] = ()
) -> DataFrame:
    """Adds ``seats`` by Sainte-Laguë: the highest of votes/1, votes/3, votes/5 and so on win.

    ``house`` is the number of seats of the group, the same in all its rows.
    Equal quotients go by ``order``. A divisor a little too high and one a little
    too low enclose the seats of each row; only the quotients between them are
    ranked, at most three for each row on average.
    """
    whole = Window.partitionBy(*group)
    counted = frame.withColumns(
        {"_votes": F.sum(votes).over(whole), "_rows": F.count("*").over(whole)}
    )

    def rounded(seats: Column) -> Column:
        exact = F.col(votes) * F.greatest(seats, F.lit(0)) / F.col("_votes") + 0.5
        return F.when(F.col("_votes") > 0, F.floor(exact)).otherwise(0).cast("bigint")

    bounded = counted.withColumns(
        {
            "_least": rounded(F.col(house) - F.col("_rows")),
            "_most": rounded(F.col(house) + F.col("_rows")),
        }
    ).withColumn("_open", F.col(house) - F.sum("_least").over(whole))
    between = F.when(
        F.col("_most") > F.col("_least"), F.sequence("_least", F.col("_most") - 1)
    )
    quotients = bounded.withColumn("_seat", F.explode_outer(between)).withColumn(
        "_quotient", F.col(votes) / (2 * F.col("_seat") + 1)
    )
    ranked = quotients.withColumn(
        "_rank",
        F.row_number().over(
            whole.orderBy(F.col("_quotient").desc_nulls_last(), order, "_seat")
        ),
    )
    won = (F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_open"))).cast("bigint")
    kept = [c for c in frame.columns]
    return ranked.groupBy(*kept).agg((F.first("_least") + F.sum(won)).alias("seats"))


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, passes: float = PASSES
) -> DataFrame:
    """Adds rank, weight and target to rows of a source and its size.

    Sources take the weights in turn, by code point and null last. A target is
    at most ``passes`` times the size. Sources are put in the order in which they
    reach that bound as a common level of words for each unit of weight rises;
    ``_level`` is that level if all before a source have reached theirs.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(listed, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    )
    everything = Window.partitionBy()
    filling = Window.orderBy(passes * F.col("source_size") / F.col("weight"), "rank")
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    bound = passes * F.col("source_size")
    spent = F.coalesce(F.sum(bound).over(earlier), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    levels = ranked.withColumns(
        {
            "bound": bound.cast("double"),
            "_level": (F.sum("source_size").over(everything) - spent)
            / (F.sum("weight").over(everything) - used),
        }
    )
    # The level rises while sources reach their bound and falls once one does not.
    level = F.max("_level").over(everything)
    target = F.least(F.col("bound"), level * F.col("weight"))
    return levels.withColumn("target", target).drop("_level", "bound")


def mix(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    passes: int = PASSES,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 0,
) -> DataFrame:
    """A row for each document: doc_id, size, source_size, target, words taken and copies.

    ``taken`` counts words block by block. ``copies`` is for a mix of whole
    documents: a document is taken as often as the block of its first word.
    """
    sizes = materialize(
        documents.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
        ),
        "mix-sizes",
    )
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(totals, weights, passes).withColumns(
        {
            "shards": F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)),
            "house": F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("bigint"),
        }
    )
    by_source = apportion(aimed, "target", "house", "rank").withColumnRenamed("seats", "blocks")
    by_source = materialize(by_source, "mix-sources")

    named = by_source.withColumnRenamed("source", "_source")
    placed = (
        sizes.join(named, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("place", seeded(seed, F.col("doc_id")))
        .withColumn("shard", F.col("place") % F.col("shards"))
        .select("doc_id", "size", "source_size", "target", "rank", "blocks", "shard", "place")
    )
    shards = placed.groupBy("rank", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(shards, "shard_size", "blocks", "shard", ["rank"]).drop("blocks")

    stream = Window.partitionBy("rank", "shard").orderBy("place", "doc_id", "size")
    ends = placed.withColumn("end", F.sum("size").over(stream)).join(quotas, ["rank", "shard"])
    start, end = F.col("end") - F.col("size"), F.col("end")
    cut = ends.withColumns(
        {
            "n_blocks": F.greatest(F.ceil(F.col("shard_size") / block_words), F.lit(1)),
            "start": start,
        }
    )
    cut = cut.withColumn("quota", F.least(F.col("seats"), passes * F.col("n_blocks")))
    step, shift = F.lit(PRIME) % F.col("n_blocks"), seeded(seed, F.col("rank"), F.col("shard"))

    def chosen(block: Column) -> Column:
        turn = (step * block + F.col("shift") % F.col("n_blocks")) % F.col("n_blocks")
        return turn < F.col("quota") % F.col("n_blocks")

    def overlap(block: Column) -> Column:
        inside = F.least(end, (block + 1) * block_words) - F.greatest(F.col("start"), block * block_words)
        return F.when(chosen(block), inside).otherwise(0)

    first = F.floor(F.col("start") / block_words)
    touched = F.sequence(first, F.floor((F.col("end") - 1) / block_words))
    extra = F.aggregate(touched, F.lit(0).cast("bigint"), lambda sum_, b: sum_ + overlap(b))
    passed = F.floor(F.col("quota") / F.col("n_blocks"))
    taken = F.when(F.col("size") > 0, F.col("size") * passed + extra).otherwise(0)
    copies = F.when(F.col("size") > 0, passed + chosen(first).cast("int")).otherwise(0)
    return cut.withColumn("shift", shift).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.cast("bigint").alias("taken"),
        copies.cast("int").alias("copies"),
    )
