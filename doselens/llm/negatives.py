"""Hard negatives: rows of other labels that score almost as high as an anchor's positives.

Vectors are made of whole numbers, so scores are exact. Each vector is cut into segments,
of which only the mean and the deviation are kept: for two segments of length L the
inner product lies within L * (mean * mean -+ deviation * deviation), by Cauchy's
inequality on what is left of each after its mean. Sums over the segments bound the score.
Pairs that the bounds of long segments cannot decide are bounded by shorter ones, and
those left are scored. Nothing is skipped that could be among the results.

Anchors and rows are dealt by hash into groups of bounded size; a task has one group of
each, holds the best rows of its anchors, and gives only those. The first pass finds the
positives, the second the negatives, whose range of scores each positive sets. So every
anchor meets every row in blocks, and what tasks give grows with anchors x row groups.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no
part. Rows that share an id count as one, that of the smallest label and vector, and the id
is an anchor if any of them is. Missing components of shorter vectors are 0. Components
beyond 2^22 after scaling are held at 2^22, so that scores fit 64 bits. Equal scores are
ordered by id. Other columns are left out; a table without anchors gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from doselens.llm.common import materialize

SCALE = 256
LARGEST = 1 << 22
SEGMENTS = (16, 4)
"""Components of a segment, level by level."""
GROUP_BYTES = 16 << 20
"""Bytes of the vectors of a group."""
LEAST_ROWS = 1024
"""Rows of a group, unless there are fewer; what tasks give grows with the number of groups."""
ANCHORS_AT_ONCE = 512
ROWS_AT_FIRST, ROWS_AT_ONCE = 256, 4096
"""Rows of the first block, and of the largest; early blocks set the marks for later ones."""
DENSE = 0.1
"""From this share of open pairs on, a whole block is worked out at once."""
ROUNDING = 1e-12
"""More than sums of doubles lose, as a share of the product of the vectors' lengths."""
NONE = -np.iinfo(np.int64).max

FOUND = "anchor bigint, slot int, score bigint, other bigint"
_FOUND = pa.schema(
    [("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("other", pa.int64())]
)


@dataclass
class Vectors:
    """The vectors of a group in the order of label and id, with their summaries."""

    ids: np.ndarray
    labels: np.ndarray
    codes: np.ndarray
    order: np.ndarray
    levels: list[np.ndarray]
    """For each level, means and deviations of all segments, scaled by the root of the length."""
    norms: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, width: int) -> Vectors:
        ids = table.column("id").to_numpy().astype(np.int64)
        labels = table.column("label").to_numpy().astype(np.int64)
        order = np.lexsort((ids, labels))
        lists = table.column("codes").combine_chunks()
        lengths = lists.value_lengths().to_numpy().astype(np.int64)
        codes = np.zeros((len(ids), width), np.int32)
        rows = np.repeat(np.arange(len(ids)), lengths)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes[rows, places] = lists.flatten().to_numpy()
        codes = codes[order]
        levels = [summaries(codes, length) for length in SEGMENTS if 2 * length < width + 1]
        norms = np.sqrt(np.einsum("ij,ij->i", codes, codes, dtype=np.float64))
        return cls(ids[order], labels[order], codes, order, levels, norms)

    def spans(self) -> Iterator[tuple[int, int, int]]:
        """Label, first place and end of each run of a label."""
        starts = np.flatnonzero(np.diff(self.labels, prepend=self.labels[:1] - 1))
        ends = np.append(starts[1:], len(self.labels))
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            yield int(self.labels[start]), start, end


def summaries(codes: np.ndarray, length: int) -> np.ndarray:
    """Means, then deviations, of all segments of ``length``, times the root of ``length``.

    So the products of two rows' halves are what the segments add to the bounds.
    """
    parts = -(-codes.shape[1] // length)
    padded = np.zeros((len(codes), parts * length))
    padded[:, : codes.shape[1]] = codes
    cut = padded.reshape(len(codes), parts, length)
    means = cut.mean(axis=2)
    deviations = np.sqrt(np.square(cut - means[:, :, None]).mean(axis=2))
    return np.concatenate([means, deviations], axis=1) * np.sqrt(length)


@dataclass
class Best:
    """The best rows of each slot: highest score, then smallest id."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, slots: int, most: int) -> Best:
        return cls(np.full((slots, most), NONE), np.zeros((slots, most), np.int64))

    @property
    def least(self) -> np.ndarray:
        """The score that a row must reach, as soon as a slot is full."""
        return self.scores[:, -1]

    def take(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        last, last_id = self.scores[slots, -1], self.ids[slots, -1]
        better = (scores > last) | ((scores == last) & (ids < last_id))
        slots, scores, ids = slots[better], scores[better], ids[better]
        if not len(slots):
            return
        touched = np.unique(slots)
        most = self.scores.shape[1]
        slots = np.concatenate([slots, np.repeat(touched, most)])
        scores = np.concatenate([scores, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        first = np.flatnonzero(np.diff(slots, prepend=-1))
        place = np.arange(len(slots)) - np.repeat(first, np.diff(np.append(first, len(slots))))
        kept = place < most
        self.scores[slots[kept], place[kept]] = scores[kept]
        self.ids[slots[kept], place[kept]] = ids[kept]


def _exact(one: np.ndarray, other: np.ndarray, dense: bool) -> np.ndarray:
    """Inner products of whole numbers: of all pairs, or row by row."""
    most = [float(np.abs(x).max(initial=0)) for x in (one, other)]
    kind = np.float64 if most[0] * most[1] * one.shape[1] < 2**53 else np.int64
    one, other = one.astype(kind), other.astype(kind)
    found = one @ other.T if dense else np.einsum("ij,ij->i", one, other)
    return found.astype(np.int64)


def open_pairs(
    anchors: Vectors, own: slice, rows: Vectors, block: slice, least: np.ndarray, most: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block whose scores may lie within each anchor's marks: places and scores."""
    a: np.ndarray | None = None
    r: np.ndarray | None = None
    n, m = own.stop - own.start, block.stop - block.start
    slack = 0.5 + ROUNDING * anchors.norms[own] * rows.norms[block].max(initial=0)
    floor = least - slack
    ceiling = None if most is None else most + slack
    for one, other in zip(anchors.levels, rows.levels, strict=True):
        half = one.shape[1] // 2
        left, right = one[own], other[block]
        if a is None:
            middle = left[:, :half] @ right[:, :half].T
            spread = left[:, half:] @ right[:, half:].T
            open_ones = middle + spread >= floor[:, None]
            if ceiling is not None:
                open_ones &= middle - spread <= ceiling[:, None]
            if np.count_nonzero(open_ones) < DENSE * n * m:
                a, r = np.nonzero(open_ones)
        else:
            middle = np.einsum("ij,ij->i", left[a, :half], right[r, :half])
            spread = np.einsum("ij,ij->i", left[a, half:], right[r, half:])
            kept = middle + spread >= floor[a]
            if ceiling is not None:
                kept &= middle - spread <= ceiling[a]
            a, r = a[kept], r[kept]
    if a is not None:
        return a, r, _exact(anchors.codes[own][a], rows.codes[block][r], dense=False)
    scores = _exact(anchors.codes[own], rows.codes[block], dense=True)
    wanted = scores >= least[:, None]
    if most is not None:
        wanted &= scores <= most[:, None]
    a, r = np.nonzero(wanted)
    return a, r, scores[a, r]


def _blocks(ranges: list[tuple[int, int]]) -> Iterator[slice]:
    """Blocks of the ranges, small ones first."""
    size = ROWS_AT_FIRST
    for start, end in ranges:
        while start < end:
            yield slice(start, min(start + size, end))
            start += size
            size = min(2 * size, ROWS_AT_ONCE)


def best_positives(anchors: Vectors, rows: Vectors, most: int) -> Best:
    """For each anchor the best rows of its label, but for its own row."""
    best = Best.empty(len(anchors.ids), most)
    ranges = {label: (start, end) for label, start, end in rows.spans()}
    for label, start, end in anchors.spans():
        if label not in ranges:
            continue
        for first in range(start, end, ANCHORS_AT_ONCE):
            own = slice(first, min(first + ANCHORS_AT_ONCE, end))
            for block in _blocks([ranges[label]]):
                a, r, scores = open_pairs(anchors, own, rows, block, best.least[own], None)
                ids = rows.ids[block][r]
                other = ids != anchors.ids[own][a]
                best.take(a[other] + first, scores[other], ids[other])
    return best


def best_negatives(anchors: Vectors, low: np.ndarray, high: np.ndarray, rows: Vectors, most: int) -> Best:
    """For each anchor and positive the best rows of other labels with scores within its marks.

    Slots of an anchor without a positive have a low mark above the high one.
    """
    n, each = low.shape
    best = Best.empty(n * each, most)
    ranges = {label: (start, end) for label, start, end in rows.spans()}
    for label, start, end in anchors.spans():
        others = [span for own_label, span in ranges.items() if own_label != label]
        for first in range(start, end, ANCHORS_AT_ONCE):
            own = slice(first, min(first + ANCHORS_AT_ONCE, end))
            for block in _blocks(others):
                slots = slice(own.start * each, own.stop * each)
                need = np.maximum(low[own], best.least[slots].reshape(-1, each))
                wanted = need <= high[own]
                least = np.where(wanted, need, np.iinfo(np.int64).max).min(axis=1)
                ceiling = np.where(wanted, high[own], NONE).max(axis=1)
                a, r, scores = open_pairs(anchors, own, rows, block, least, ceiling)
                ids = rows.ids[block][r]
                for slot in range(each):
                    inside = (scores <= high[own][a, slot]) & (scores >= need[a, slot])
                    best.take((a[inside] + first) * each + slot, scores[inside], ids[inside])
    return best


def _given(anchor_ids: np.ndarray, best: Best, each: int) -> pa.Table:
    slot, place = np.nonzero(best.scores != NONE)
    return pa.table(
        [
            pa.array(anchor_ids[slot // each]),
            pa.array((slot % each).astype(np.int32)),
            pa.array(best.scores[slot, place]),
            pa.array(best.ids[slot, place]),
        ],
        schema=_FOUND,
    )


def unique_vectors(
    rows: DataFrame, is_anchor: Column, key: str, vector: str, label: str, scale: float
) -> DataFrame:
    """A row for each id: label, whole-number components, and whether it is an anchor."""
    usable = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = F.transform(
        vector,
        lambda x: F.floor(
            F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * scale))
        ).cast("int"),
    )
    chosen = rows.where(
        F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~usable
    ).select(
        F.col(key).cast("bigint").alias("id"),
        F.struct(F.col(label).cast("bigint").alias("label"), held.alias("codes")).alias("held"),
        is_anchor.alias("is_anchor"),
    )
    unique = chosen.groupBy("id").agg(F.min("held").alias("held"), F.max("is_anchor").alias("is_anchor"))
    return unique.select("id", "held.label", "held.codes", "is_anchor")


def mine(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: float = SCALE,
) -> DataFrame:
    """The hard negatives of each anchor and positive, best first.

    Negatives score from ``least_percent`` to ``most_percent`` of what the positive scores.
    """
    spark = rows.sparkSession
    vectors = materialize(unique_vectors(rows, is_anchor, key, vector, label, scale), "vectors")
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("codes")), F.lit(0))).first()
    width = max(width, 1)
    asked = vectors.where("is_anchor")
    held = max(1, GROUP_BYTES // (4 * width))
    anchor_groups = -(-asked.count() // held) or 1
    # As many tasks as a shuffle has, fewer for few rows, and more where groups would be too large.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_groups = max(-(-n // held), min(tasks, -(-n // LEAST_ROWS)), 1)

    def dealt(frame: DataFrame, name: str, groups: int, other: str, times: int) -> DataFrame:
        own = F.pmod(F.xxhash64("id", F.lit(name)), F.lit(groups)).cast("int").alias(name)
        spread = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(other)
        # New names, for cogroup loses columns that both of its sides take from one frame.
        return frame.select(own, spread, *(F.col(c).alias(c) for c in frame.columns))

    row_cells = dealt(vectors.select("id", "label", "codes"), "j", row_groups, "i", anchor_groups)
    row_cells = row_cells.groupBy("i", "j")

    def first_pass(key: tuple, own: pa.Table, other: pa.Table) -> pa.Table:
        if not own.num_rows or not other.num_rows:
            return _FOUND.empty_table()
        anchors, against = Vectors.of(own, width), Vectors.of(other, width)
        return _given(anchors.ids, best_positives(anchors, against, positives), 1)

    def second_pass(key: tuple, own: pa.Table, other: pa.Table) -> pa.Table:
        if not own.num_rows or not other.num_rows:
            return _FOUND.empty_table()
        anchors, against = Vectors.of(own, width), Vectors.of(other, width)
        scores = np.full((len(anchors.ids), positives), -1, np.int64)
        for at, found in enumerate(own.column("scores").to_pylist()):
            scores[at, : len(found)] = found
        scores = scores[anchors.order]
        # Below 0 the range is empty, which its marks show by themselves.
        low, high = -(-least_percent * scores // 100), most_percent * scores // 100
        return _given(anchors.ids, best_negatives(anchors, low, high, against, negatives), positives)

    def by_anchor(frame: DataFrame):
        return dealt(frame, "i", anchor_groups, "j", row_groups).groupBy("i", "j")

    def ranked(found: DataFrame, most: int, *of: str) -> DataFrame:
        order = Window.partitionBy(*of).orderBy(F.col("score").desc(), "other")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)

    anchors = asked.select("id", "label", "codes")
    found = by_anchor(anchors).cogroup(row_cells).applyInArrow(first_pass, FOUND)
    best = ranked(found, positives, "anchor").select(
        "anchor", (F.col("place") - 1).alias("slot"), "score", F.col("other").alias("positive_id")
    )
    best = materialize(best, "positives")
    listed = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "score"))).alias("all"))
    with_marks = anchors.join(listed, anchors["id"] == listed["anchor"]).select(
        "id", "label", "codes", F.col("all.score").alias("scores")
    )
    found = by_anchor(with_marks).cogroup(row_cells).applyInArrow(second_pass, FOUND)
    kept = ranked(found, negatives, "anchor", "slot")
    return kept.join(best.withColumnRenamed("score", "positive_score"), ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
