"""Connected components of links, without gathering a component anywhere.

Large-star and small-star steps alternate until the links no longer change. Each
step finds the smallest neighbour of a node by an aggregate, which is combined
before it is shuffled, and joins it back, so a node with a third of all links
stays a join key that adaptive execution can split. Each round's links are
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import materialize

MOST_ROUNDS = 60


def _smallest_neighbours(links: DataFrame) -> DataFrame:
    return links.groupBy("node").agg(F.min("other").alias("smallest"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    around = both.join(_smallest_neighbours(both), "node")
    target = F.least("smallest", "node")
    return around.where("other > node").select(F.col("other").alias("node"), target.alias("other"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    smallest = _smallest_neighbours(links)
    moved = links.join(smallest, "node").select(F.col("other").alias("node"), F.col("smallest").alias("other"))
    own = smallest.select("node", F.col("smallest").alias("other"))
    return moved.unionByName(own).where("node != other").distinct()


def components(links: DataFrame) -> DataFrame:
    """For each node of the links (node, other) the smallest node it is linked with.

    Nodes are whole numbers; a node that is the smallest of its component, or
    has no link, has no row. Repeated, reversed and looping links do no harm.
    """
    ordered = links.select(
        F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
    ).where("node != other")
    current = materialize(ordered.distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        current = materialize(_small_star(_large_star(current)), "links")
        # Two numbers that tell whether a round changed anything.
        state = tuple(
            current.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "other"))).first()
        )
        if state == before:
            return current.select("node", F.col("other").alias("component"))
        before = state
    raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")
