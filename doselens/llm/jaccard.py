"""N-gram Jaccard join by adaptive multi-match prefixes.

A document is the set of its word shingles; two are linked when the share of
shingles they have in common reaches a threshold. The result is the connected
component of each document, on demand with the number of documents it is linked
with (``jaccard_components``), or every linked pair of different sets (``jaccard_links``).

Documents with equal sets are one set from the start. Shingles are ordered by
their hash, the same order for all. Of two linked sets of sizes n the first
n - ceil(t n) + l shingles of each, their l-prefix, have at least l in common. So a
set may leave out l - 1 shingles of its l-prefix when it looks for partners, and
still meets every partner whose own l is not smaller in one of the others. Each
set takes the l at which looking costs least, going by how many other sets have
each shingle: frequent shingles are left out and the prefix is lengthened for
them. A pair that meets is kept only if, for every l that both prefixes allow,
they have l shingles in common there; then the whole texts are compared.

Sets are kept as a sketch that holds the longest prefix they may need. A shingle
that only one sketch has cannot bring a pair together and is dropped at once.

Large groups of near copies would meet in each of their shingles. So before
that, a set that shares half its sketch with the smallest set (by id) of its
shingles joins that one's cluster. Inside a cluster all sets of fitting sizes are
compared in blocks, by a product of incidence matrices; a task gets two blocks
of bounded size, and gives back links that span what it found linked, and the number
of links of each set or all pairs if they are wanted. Pairs of different clusters go
the way above. Every pair that reaches the threshold is thus compared, in one task.

Nulls and texts without words have the empty set and are linked with nothing.
Texts of fewer words than the width are one shingle. A null id is not compared
and its component is null. Repeated rows fall into one component; rows that share
an id but not the text are compared under that id. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import (
    add_columns,
    discard,
    filter_of,
    materialize,
    passes,
    released,
    texts,
)
from doselens.llm.components import components
from doselens.llm.shingles import WIDTH, mixed, shingle_set

THRESHOLD = (80, 100)
SLACK = 24
"""Shingles of a sketch beyond the shortest prefix, besides a twentieth of the set."""
CHEAP = 8
"""Partners a set may look at without lengthening its prefix further."""
DEAR = 32
"""Sets that have a token, from which on a pair that meets in it is told once only."""
TOLD = 12
"""Such tokens that a row carries; two sets with others in common are told more than once."""
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 17
"""A block holds about so many sets, and fewer if they are large."""
TOKEN_BITS = 48
COLUMNS = 4096


def _least_common(n: np.ndarray | int, threshold: tuple[int, int]):
    """ceil(t n)."""
    return -(-n * threshold[0] // threshold[1])


def _shortest(n: np.ndarray | int, threshold: tuple[int, int]):
    """The length of the 1-prefix."""
    return n - _least_common(n, threshold) + 1


def _sketch_length(n: np.ndarray | int, threshold: tuple[int, int]):
    return np.minimum(n, _shortest(n, threshold) + n // 20 + SLACK)


def _sketch_length_of(n: Column, threshold: tuple[int, int]) -> Column:
    common = F.floor((n * threshold[0] + threshold[1] - 1) / threshold[1])
    return F.least(n, n - common + 1 + F.floor(n / 20) + SLACK)


def sketches(
    documents: DataFrame, key: str, text: str, threshold: tuple[int, int], width: int
) -> DataFrame:
    """For each document the size of its set, two marks of the whole set, and its sketch."""

    def prepare():
        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            sizes, ones, twos, kept = [], [], [], []
            for value in texts(batch, text):
                found = shingle_set(value, width)
                sizes.append(len(found))
                ones.append(mixed(found, 3).sum(dtype=np.uint64))
                twos.append(np.bitwise_xor.reduce(mixed(found, 5)) if len(found) else 0)
                kept.append(found[: _sketch_length(len(found), threshold)].tobytes())
            return [
                pa.array(sizes, pa.int64()),
                pa.array(np.array(ones, np.uint64).view(np.int64)),
                pa.array(np.array(twos, np.uint64).view(np.int64)),
                pa.array(kept, pa.binary()),
            ]

        return run

    chosen = documents.select(F.col(key).cast("bigint").alias("doc_id"), text)
    fields = "n_shingles bigint, mark1 bigint, mark2 bigint, sketch binary"
    return add_columns(chosen, fields, prepare, drop=[text])


def _sketch_tokens(sets: DataFrame, wanted: Broadcast | None = None) -> DataFrame:
    """A row for each shingle of a sketch: id, place, token; only of tokens a filter passes.

    Tokens have ``TOKEN_BITS`` bits of the hash, from the top, so that they take
    less room on the way; equal ones by chance only cost a comparison.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                arrays = [np.frombuffer(s, "<u8") for s in part.column(1).to_pylist()]
                lengths = [len(a) for a in arrays]
                tokens = np.concatenate(arrays)
                rows = np.repeat(np.arange(len(arrays)), lengths)
                places = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
                if wanted is not None:
                    kept = passes(wanted.value, _filtered(tokens >> np.uint64(64 - TOKEN_BITS)))
                    tokens, rows, places = tokens[kept], rows[kept], places[kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        pa.array(places),
                        pa.array((tokens >> np.uint64(64 - TOKEN_BITS)).view(np.int64)),
                    ],
                    names=["id", "place", "token"],
                )

    known = sets.where("doc_id is not null and n_shingles > 0").select("doc_id", "sketch")
    return known.mapInArrow(released(run), "id bigint, place int, token bigint")


def _filtered(tokens: np.ndarray) -> np.ndarray:
    """Tokens with some of their middle bits at the top too, where a filter looks."""
    return tokens | (tokens >> np.uint64(20) & np.uint64(63)) << np.uint64(58)


def _shared_tokens(sets: DataFrame) -> DataFrame:
    """The sketch rows whose token another document has, with the smallest such id.

    That id stands for a distinct set, since a set goes by its smallest id.
    """
    often = (
        _sketch_tokens(sets)
        .groupBy("token")
        .agg(F.count("*").alias("_rows"), F.min("id").alias("pivot"))
        .where("_rows > 1")
        .select("token", "pivot")
    )
    often = materialize(often, "frequent-tokens")
    spread = often.select(F.expr("token | shiftleft(shiftright(token, 20) & 63, 58)").alias("spread"))
    words = sets.sparkSession.sparkContext.broadcast(filter_of(spread, "spread"))
    shared = materialize(_sketch_tokens(sets, words).join(often, "token"), "shared-tokens")
    discard(often)
    return shared


def _clusters(shared: DataFrame, own: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Sets that share half their sketch with a pivot, and the sets around them: id, cluster."""
    meetings = shared.where("id != pivot").groupBy("id", "pivot").agg(F.count("*").alias("met"))
    sized = meetings.join(own, "id")
    near = sized.where(2 * F.col("met") >= _sketch_length_of(F.col("n"), threshold))
    best = near.groupBy("id").agg(
        F.max_by("pivot", F.struct(F.col("met"), -F.col("pivot"))).alias("pivot")
    )
    found = components(best.select(F.col("id").alias("node"), F.col("pivot").alias("other")))
    named = found.select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    roots = named.select(F.col("cluster").alias("id"), "cluster").distinct()
    return materialize(named.unionByName(roots), "clusters")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def choose_prefix(
    n: int, places: np.ndarray, costs: np.ndarray, threshold: tuple[int, int]
) -> tuple[int, np.ndarray, np.ndarray]:
    """The l of a set, the rows in its prefix, and those of them it looks for partners with.

    ``places`` and ``costs`` describe the shingles of the sketch that other sets
    have; the others cost nothing. An l of at least 1 leaves out the l - 1 dearest.
    """
    shortest = int(_shortest(n, threshold))
    most = int(_sketch_length(n, threshold)) - shortest + 1
    best: tuple | None = None
    steps = [l for l in (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 512) if l < most]
    for matches in [*steps, most]:
        inside = np.flatnonzero(places < shortest + matches - 1)
        cheapest = inside[np.argsort(costs[inside], kind="stable")]
        kept = cheapest[: max(0, len(inside) - (matches - 1))]
        cost = int(costs[kept].sum())
        if best is None or 5 * cost < 4 * best[0]:
            best = cost, matches, inside, kept
        if cost <= CHEAP:
            break
    return best[1:]


def _earlier(tokens: np.ndarray, marked: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """The last ``TOLD`` marked tokens before each place."""
    chosen = tokens[marked]
    ends = np.cumsum(marked) - marked
    return [chosen[max(0, end - TOLD) : end] for end in ends[places].tolist()]


def _prefixes(grouped: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Prefix rows of each set: those marked ``looks`` are looked for, all can be found.

    ``main`` marks rows of the cluster that has most of the token's sets. ``sought`` and
    ``sure`` are the set's dear tokens before this one that it looks for, and that
    every other set finds it by: where two sets have one of them in common, they met there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out: list[list] = [[] for _ in range(11)]
            for row in batch.to_pylist():
                tokens, first = np.unique(np.array(row["tokens"], np.int64), return_index=True)
                places = np.array(row["places"], np.int64)[first]
                costs = np.array(row["costs"], np.int64)[first]
                own = np.array(row["mains"], np.int64)[first] == row["cluster"]
                matches, inside, kept = choose_prefix(row["n"], places, costs, threshold)
                looks = np.zeros(len(tokens), bool)
                looks[kept] = True
                count = len(inside)
                shortest = int(_shortest(row["n"], threshold))
                sought = _earlier(tokens, looks & (costs >= DEAR), inside)
                sure = _earlier(tokens, (places < shortest) & (costs >= DEAR), inside)
                values = (
                    tokens[inside], [row["id"]] * count, [row["cluster"]] * count, [row["n"]] * count,
                    [matches] * count, places[inside], [shortest] * count, looks[inside], own[inside],
                    sought, sure,
                )
                for column, value in zip(out, values, strict=True):
                    column.extend(value)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.bool_()] * 2 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["token", "id", "cluster", "n", "matches", "place", "shortest", "looks", "main",
                       "sought", "sure"],
            )

    return grouped.mapInArrow(
        released(run),
        "token bigint, id bigint, cluster bigint, n bigint, matches int, place int, shortest int, "
        "looks boolean, main boolean, sought array<bigint>, sure array<bigint>",
    )


def _enough_matches(grouped: DataFrame, pairs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs that have l shingles in common in their l-prefixes, for every l."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            kept = []
            for row in batch.to_pylist():
                left = np.array(row["tokens"], np.int64), np.array(row["places"], np.int64)
                right = np.array(row["tokens2"], np.int64), np.array(row["places2"], np.int64)
                _, i, j = np.intersect1d(left[0], right[0], return_indices=True)
                sizes = np.array([row["n"], row["n2"]])
                shortest = _shortest(sizes, threshold)
                most = int((_sketch_length(sizes, threshold) - shortest).min()) + 1
                first = np.maximum(left[1][i] - shortest[0], right[1][j] - shortest[1]) + 2
                first = np.sort(first[first <= most])
                kept.append(len(first) >= most and bool((first[:most] <= np.arange(1, most + 1)).all()))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(kept, pa.bool_())) for c in (batch.column("a"), batch.column("b"))],
                names=["a", "b"],
            )

    one = grouped.select(F.col("id").alias("a"), "n", "tokens", "places")
    two = grouped.select(
        F.col("id").alias("b"),
        F.col("n").alias("n2"),
        F.col("tokens").alias("tokens2"),
        F.col("places").alias("places2"),
    )
    return pairs.join(one, "a").join(two, "b").mapInArrow(released(run), "a bigint, b bigint")


def _candidates(
    shared: DataFrame, own: DataFrame, clusters: DataFrame, threshold: tuple[int, int]
) -> DataFrame:
    """Pairs (a, b) of different clusters that may reach the threshold."""
    # Only distinct sets are left, with their size and cluster.
    placed = own.join(clusters, "id", "left").select(
        "id", "n", F.coalesce("cluster", "id").alias("cluster")
    )
    named = shared.select("token", "id", "place").join(placed, "id")
    across = (
        named.groupBy("token", "cluster")
        .agg(F.count("*").alias("sets"))
        .groupBy("token")
        .agg(
            F.sum("sets").alias("cost"),
            F.count("*").alias("_clusters"),
            F.max_by("cluster", F.struct("sets", "cluster")).alias("main"),
        )
        .where("_clusters > 1")
        .select("token", "cost", "main")
    )
    grouped = (
        named.join(across, "token")
        .groupBy("id", "cluster", "n")
        .agg(F.collect_list(F.struct("token", "place", "cost", "main")).alias("rows"))
        .select(
            "id",
            "cluster",
            "n",
            F.col("rows.token").alias("tokens"),
            F.col("rows.place").alias("places"),
            F.col("rows.cost").alias("costs"),
            F.col("rows.main").alias("mains"),
        )
    )
    grouped = materialize(grouped, "sketch-groups")
    prefixes = materialize(_prefixes(grouped, threshold), "prefixes")
    low, high = threshold
    fits = (
        (F.col("p.token") == F.col("q.token"))
        & (F.col("p.cluster") != F.col("q.cluster"))
        & ((F.col("q.matches") > F.col("p.matches"))
           | ((F.col("q.matches") == F.col("p.matches")) & (F.col("p.id") < F.col("q.id"))))
        & (F.col("q.place") < F.col("q.shortest") + F.col("p.matches") - 1)
        & (high * F.col("p.n") >= low * F.col("q.n"))
        & (high * F.col("q.n") >= low * F.col("p.n"))
        & ~F.arrays_overlap("p.sought", "q.sure")
    )

    def met(looking: DataFrame, found: DataFrame) -> DataFrame:
        pairs = looking.drop("sure").alias("p").join(found.drop("sought").alias("q"), fits)
        return pairs.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"))

    # The sets of the cluster that has most of a token's are not led past one another.
    pairs = met(prefixes.where("looks and not main"), prefixes).unionByName(
        met(prefixes.where("looks and main"), prefixes.where("not main"))
    )
    pairs = pairs.distinct()
    kept = materialize(_enough_matches(grouped, pairs, threshold), "candidates")
    discard(prefixes, grouped)
    return kept


def _block_tasks(clusters: DataFrame, own: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """For each pair of blocks of a cluster whose sets may link, its sets: task, side, id.

    Sets are sorted into classes of size so that linked ones are in the same
    class or in neighbouring ones, and each class into blocks by a hash of the id.
    """
    step = float(np.log(1.01 * threshold[1] / threshold[0]))
    member = clusters.join(own.select("id", "n"), "id").withColumn(
        "size_class", F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    )
    room = F.greatest(
        F.lit(4.0),
        F.least(F.lit(float(BLOCK_SETS)), BLOCK_SHINGLES / F.exp((F.col("size_class") + 1) * step)),
    )
    cells = member.groupBy("cluster", "size_class").count()
    cells = cells.withColumn("blocks", F.ceil(F.col("count") / room).cast("int"))
    cells = materialize(cells, "cells")
    member = member.join(cells.drop("count"), ["cluster", "size_class"])
    member = member.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    same = (
        cells.where("count > 1")
        .withColumn("i", every("blocks"))
        .withColumn("j", F.explode(F.sequence("i", F.col("blocks") - 1)))
        .select("cluster", "size_class", F.col("size_class").alias("class2"), "i", "j")
    )
    above = cells.select(
        "cluster", (F.col("size_class") - 1).alias("size_class"), F.col("blocks").alias("blocks2")
    )
    apart = (
        cells.join(above, ["cluster", "size_class"])
        .withColumn("i", every("blocks"))
        .withColumn("j", every("blocks2"))
        .select("cluster", "size_class", (F.col("size_class") + 1).alias("class2"), "i", "j")
    )
    tasks = same.unionByName(apart).withColumn(
        "task", F.concat_ws(":", F.lit("block"), "cluster", "size_class", "i", "class2", "j")
    )
    one = tasks.select("cluster", "size_class", F.col("i").alias("block"), "task", F.lit(0).alias("side"))
    two = tasks.where("size_class != class2 or i != j").select(
        "cluster", F.col("class2").alias("size_class"), F.col("j").alias("block"), "task",
        F.lit(1).alias("side"),
    )
    blocks = one.unionByName(two).join(member, ["cluster", "size_class", "block"])
    return blocks.select("task", "side", "id")


def _stars(clusters: DataFrame) -> DataFrame:
    """Tasks that compare the sets of a cluster with its smallest one: task, side, id."""
    blocks = F.ceil(F.count("*") / BLOCK_SETS).cast("int")
    counted = clusters.groupBy("cluster").agg(blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    sides = clusters.join(counted, "cluster").where("id != cluster").select(
        F.concat_ws(":", F.lit("star"), "cluster", block).alias("task"), F.lit(1).alias("side"), "id"
    )
    centres = counted.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws(":", F.lit("star"), "cluster", "block").alias("task"),
        F.lit(0).alias("side"),
        F.col("cluster").alias("id"),
    )
    return sides.unionByName(centres)


def _ring_tasks(
    clusters: DataFrame, own: DataFrame, stars: DataFrame, threshold: tuple[int, int]
) -> DataFrame:
    """What is left to compare of clusters whose sets were compared with their centre.

    Sets linked with the centre are connected, so pairs of them are left out. One minus
    the similarity is a metric: of linked sets the distances to the centre differ by no more
    than the largest distance of a link. Rings are half as wide, so sets three rings
    apart are not linked. Sizes are sorted into classes as in ``_block_tasks``.
    """
    low, high = threshold
    step = float(np.log(1.01 * high / low))
    member = clusters.join(own.select("id", "n"), "id").join(stars, "id", "left").select(
        "cluster",
        "id",
        F.floor(F.log(F.col("n").cast("double")) / step).cast("int").alias("size_class"),
        F.coalesce(high * F.col("common") >= low * F.col("union"), F.lit(True)).alias("linked"),
        F.coalesce(F.expr(f"(2 * {high} * (union - common)) div ({high - low} * union)"), F.lit(0))
        .cast("int").alias("ring"),
    )
    cell = ["cluster", "size_class", "linked", "ring"]
    room = F.greatest(
        F.lit(4.0),
        F.least(F.lit(float(BLOCK_SETS)), BLOCK_SHINGLES / F.exp((F.col("size_class") + 1) * step)),
    )
    cells = member.groupBy(*cell).count().withColumn("blocks", F.ceil(F.col("count") / room).cast("int"))
    cells = materialize(cells, "cells")
    member = member.join(cells.drop("count"), cell)
    member = member.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    near = cells.withColumn("up", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "out", F.explode(F.sequence(F.lit(-2), F.lit(2)))
    )
    near = near.select(
        *cell, "blocks", (F.col("size_class") + F.col("up")).alias("class2"), (F.col("ring") + F.col("out")).alias("ring2")
    )
    others = cells.select(
        "cluster", F.col("size_class").alias("class2"), F.col("ring").alias("ring2"),
        F.col("linked").alias("linked2"), F.col("blocks").alias("blocks2"),
    )
    # Cells of one size class are paired once, in the order of ring and link.
    once = (F.col("class2") > F.col("size_class")) | (F.struct("ring2", "linked2") >= F.struct("ring", "linked"))
    paired = near.join(others, ["cluster", "class2", "ring2"]).where(once & ~(F.col("linked") & F.col("linked2")))
    same = (F.col("class2") == F.col("size_class")) & (F.col("ring2") == F.col("ring")) & (F.col("linked2") == F.col("linked"))
    paired = paired.withColumn("same", same).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first = F.when(F.col("same"), F.col("i")).otherwise(0)
    paired = paired.withColumn("j", F.explode(F.sequence(first, F.col("blocks2") - 1)))
    paired = paired.withColumn(
        "task", F.concat_ws(":", F.lit("ring"), *(F.col(c).cast("string") for c in (*cell, "i", "class2", "linked2", "ring2", "j")))
    )
    one = paired.select(*cell, F.col("i").alias("block"), "task", F.lit(0).alias("side"))
    two = paired.where("not same or i != j").select(
        "cluster", F.col("class2").alias("size_class"), F.col("linked2").alias("linked"),
        F.col("ring2").alias("ring"), F.col("j").alias("block"), "task", F.lit(1).alias("side"),
    )
    return one.unionByName(two).join(member, [*cell, "block"]).select("task", "side", "id")


def _wanted_texts(documents: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    """Id and text of the wanted documents.

    A filter of fixed size passes over the texts first, so that few unwanted
    ones are shuffled; the join decides, so a full filter costs only time.
    """
    spread = F.xxhash64("id")
    words = filter_of(ids.select(spread.alias("spread")), "spread")
    shared = documents.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy(zero_copy_only=False).astype(np.int64)
            kept = pa.array(passes(shared.value, hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(kept) for i in range(2)], names=["id", "text"]
            )

    given = documents.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")
    )
    passed = given.withColumn("hash", spread).mapInArrow(released(run), "id bigint, text string")
    return materialize(passed.join(ids, "id"), "wanted-texts")


def linked_sets(
    sets: list[np.ndarray], sides: np.ndarray, threshold: tuple[int, int]
) -> np.ndarray:
    """Which of the sets reach the threshold with which.

    With two sides only pairs across them count.
    """
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))]] * 2)
        common[1] = common[0][::-1]
    else:
        tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
        repeated = np.bincount(column) > 1
        number = np.cumsum(repeated) - 1
        kept = repeated[column]
        row, column = np.repeat(np.arange(len(sets)), sizes)[kept], number[column[kept]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(sets), len(sets)), np.float32)
        width = int(repeated.sum())
        for start in range(0, width, COLUMNS):
            first, last = np.searchsorted(column, [start, start + COLUMNS])
            part = np.zeros((len(sets), min(COLUMNS, width - start)), np.float32)
            part[row[first:last], column[first:last] - start] = 1
            common += part @ part.T
    low, high = threshold
    union = sizes[:, None] + sizes[None, :] - common
    linked = high * common >= low * union
    if sides.any() and not sides.all():
        linked &= sides[:, None] != sides[None, :]
    np.fill_diagonal(linked, False)
    return linked


def spanning_links(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever is linked."""
    found, seen = [], np.zeros(len(linked), bool)
    for root in np.flatnonzero(linked.any(axis=1)):
        front = [] if seen[root] else [root]
        seen[root] = True
        while front:
            node = front.pop()
            for other in np.flatnonzero(linked[node] & ~seen):
                seen[other] = True
                found.append((int(node), int(other)))
                front.append(int(other))
    return found


LINKS = "node bigint, other bigint, links bigint"


def _compare(
    tasks: DataFrame, wanted: DataFrame, threshold: tuple[int, int], width: int, give: str
) -> DataFrame:
    """Links (node, other, links) found by comparing the whole texts of each task.

    ``give`` is "span" for links that span what is linked, "count" for those and, with a
    null for other, the number of documents each set is linked with, or "pairs" for all links.
    "star" gives each set of side 1 with its common shingles with, and those of the union with,
    the set of side 0.
    """

    def links(rows: list[tuple[int, int, int, str]]) -> list[tuple[int, int | None, int | None]]:
        if len(rows) < 2:
            return []
        found = [shingle_set(text or "", width) for *_, text in rows]
        if give == "star":
            centre = next(f for row, f in zip(rows, found, strict=True) if not row[0])
            common = [len(np.intersect1d(centre, f, assume_unique=True)) for f in found]
            return [
                (row[1], k, len(centre) + len(f) - k)
                for row, f, k in zip(rows, found, common, strict=True) if row[0]
            ]
        ids = np.array([row[1] for row in rows])
        linked = linked_sets(found, np.array([row[0] for row in rows]), threshold)
        if give == "span":
            return [(rows[i][1], rows[j][1], None) for i, j in spanning_links(linked)]
        # A repeated row counts in the copies of its set.
        first = np.unique(ids, return_index=True)[1]
        single, ids = linked[np.ix_(first, first)], ids[first]
        if give == "pairs":
            places = zip(*np.nonzero(np.triu(single)), strict=True)
            return [(int(ids[i]), int(ids[j]), None) for i, j in places]
        counts = single @ np.array([row[2] for row in rows], np.int64)[first]
        spanning = [(rows[i][1], rows[j][1], None) for i, j in spanning_links(linked)]
        return spanning + [(int(ids[i]), None, int(counts[i])) for i in np.flatnonzero(counts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []
        for batch in batches:
            out = []
            for name, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != task:
                    out += links(rows)
                    task, rows = name, []
                rows.append(row)
            yield _link_rows(out)
        yield _link_rows(links(rows))

    def _link_rows(found: list[tuple[int, int | None, int | None]]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["node", "other", "links"]
        )

    copies = F.col("copies") if "copies" in wanted.columns else F.lit(1).alias("copies")
    gathered = tasks.join(wanted, "id").select("task", "side", "id", copies, "text")
    ordered = gathered.repartition("task").sortWithinPartitions("task")
    return ordered.mapInArrow(released(run), LINKS)


def _join(
    documents: DataFrame, key: str, text: str, threshold: tuple[int, int], width: int, give: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The set of each document, the compared texts, and what ``_compare`` gives."""
    sets = materialize(sketches(documents, key, text, threshold, width), "sketches")
    compared = sets.where("doc_id is not null and n_shingles > 0")
    marks = ["n_shingles", "mark1", "mark2"]
    # Written before it is joined, so that a set with many copies can be split in the join.
    own = materialize(compared.groupBy(*marks).agg(F.min("doc_id").alias("id")), "set-marks")
    members = sets.drop("sketch").join(own, marks, "left")
    members = materialize(members.select("doc_id", "n_shingles", "id"), "set-members")
    own = materialize(
        own.groupBy("id").agg(F.max("n_shingles").alias("n")), "distinct-sets"
    )
    shared = _shared_tokens(sets)
    discard(sets)
    clusters = _clusters(shared, own, threshold)
    pairs = _candidates(shared, own, clusters, threshold)
    discard(shared)

    named = F.concat_ws(":", F.lit("pair"), "a", "b")
    pair_tasks = pairs.select(named.alias("task"), F.lit(0).alias("side"), F.col("a").alias("id"))
    pair_tasks = pair_tasks.unionByName(
        pairs.select(named.alias("task"), F.lit(1).alias("side"), F.col("b").alias("id"))
    )
    ids = clusters.select("id").unionByName(pair_tasks.select("id")).distinct()
    ids = materialize(ids, "wanted")
    if give == "count":
        known = members.where("doc_id is not null and id is not null")
        ids = ids.join(known.groupBy("id").agg(F.count("*").alias("copies")), "id")
        ids = materialize(ids, "wanted-copies")
    wanted = _wanted_texts(documents, ids, key, text)
    if give != "span":
        tasks = materialize(_block_tasks(clusters, own, threshold).unionByName(pair_tasks), "tasks")
        return members, wanted, _compare(tasks, wanted, threshold, width, give)

    # A cluster of more than a block is compared with its centre first, unless an id
    # of it stands for several texts: their distances say nothing about one another.
    several = wanted.groupBy("id").agg(F.count_distinct(F.xxhash64("text")).alias("texts"))
    sized = clusters.join(several, "id", "left").groupBy("cluster")
    sized = sized.agg(((F.count("*") > BLOCK_SETS) & (F.max("texts") <= 1)).alias("large"))
    sized = materialize(clusters.join(sized, "cluster"), "sized-clusters")
    small, large = (sized.where(F.col("large") == flag).drop("large") for flag in (False, True))
    tasks = _block_tasks(small, own, threshold).unionByName(pair_tasks)
    if large.isEmpty():
        return members, wanted, _compare(materialize(tasks, "tasks"), wanted, threshold, width, give)
    stars = _compare(materialize(_stars(large), "star-tasks"), wanted, threshold, width, "star")
    stars = stars.groupBy(F.col("node").alias("id")).agg(
        F.max("other").alias("common"), F.max("links").alias("union")
    )
    stars = materialize(stars, "stars")
    tasks = materialize(tasks.unionByName(_ring_tasks(large, own, stars, threshold)), "tasks")
    low, high = threshold
    to_centre = large.join(stars, "id").where(high * F.col("common") >= low * F.col("union")).select(
        F.col("id").alias("node"), F.col("cluster").alias("other"), F.lit(None).cast("bigint").alias("links")
    )
    return members, wanted, _compare(tasks, wanted, threshold, width, give).unionByName(to_centre)


def jaccard_components(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
    width: int = WIDTH,
    links: bool = False,
) -> DataFrame:
    """A row for each document: doc_id, n_shingles and component_id.

    ``threshold`` is a fraction (numerator, denominator). The component is the
    smallest id that links lead to. With ``links`` there is n_links too: the number of
    other rows whose set reaches the threshold with the document's, copies included;
    null for a null id. It supposes that rows that share an id share the text.
    """
    members, wanted, found = _join(
        documents, key, text, threshold, width, "count" if links else "span"
    )
    if links:
        found = materialize(found, "found-links")
    linked = components(found.where("other is not null").select("node", "other") if links
                        else found.select("node", "other"))
    discard(wanted)
    linked = linked.select(F.col("node").alias("id"), "component")
    chosen = ["doc_id", "n_shingles", F.coalesce("component", "id", "doc_id").alias("component_id")]
    if links:
        counts = found.where("other is null").groupBy(F.col("node").alias("id"))
        counts = materialize(counts.agg(F.sum("links").alias("links")), "link-counts")
        known = members.where("doc_id is not null and id is not null")
        copies = known.groupBy("id").agg((F.count("*") - 1).alias("copies"))
        members = members.join(counts, "id", "left").join(copies, "id", "left")
        n_links = F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(0))
        chosen.append(F.when(F.col("doc_id").isNotNull(), n_links).alias("n_links"))
    return members.join(linked, "id", "left").select(*chosen)


def jaccard_links(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
    width: int = WIDTH,
) -> DataFrame:
    """A row for each linked pair of different sets: a, b and a < b.

    A set goes by the smallest id of its documents. The pairs of a group of near
    copies grow with the square of its different texts.
    """
    _, _, found = _join(documents, key, text, threshold, width, "pairs")
    pair = F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    return found.select(*pair)
