"""Hard negatives against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from doselens.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(rows, every=5, positives=5, least=50, most=95):
    held = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        codes = [int(np.floor(max(-(2.0**22), min(2.0**22, 256 * float(np.float32(x)))))) for x in vector]
        held[key] = min(held.get(key, (label, codes)), (label, codes))
    found = set()
    for anchor, (label, codes) in held.items():
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(codes, c)), k, l) for k, (l, c) in held.items() if k != anchor)
        for own, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(k, s) for s, k, l in scored if l != label and least * -own <= 100 * -s <= most * -own]
            found |= {(anchor, positive, i + 1, k, -own, -s) for i, (k, s) in enumerate(inside[:3])}
    return found


def mined(frame, every=5):
    return [tuple(r) for r in negatives.mine(frame, F.col("vec_id") % every == 0).select(*RESULT).collect()]


def random_rows(seed, n, width, grid=None):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        vector = [c + rng.gauss(0, 0.15) for c in centre]
        rows.append((i, [round(x * grid) / grid for x in vector] if grid else vector, rng.randint(0, 3)))
    return rows


@pytest.mark.parametrize(("width", "grid"), [(64, None), (40, 4), (7, 2), (1, 1)])
def test_negatives_equal_all_pairs(spark, monkeypatch, width, grid):
    """Also with many ties, small groups and small blocks."""
    monkeypatch.setattr(negatives, "GROUP_BYTES", 4 * width * 20)
    monkeypatch.setattr(negatives, "ROWS_AT_FIRST", 8)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 7)
    rows = random_rows(width, 150, width, grid)
    found = mined(vectors(spark, rows))
    assert len(found) == len(set(found)) and set(found) == brute(rows)
    assert found or width == 1


def test_rows_that_take_no_part_and_odd_vectors(spark):
    rows = random_rows(9, 60, 24)
    nan, inf = float("nan"), float("inf")
    odd = [
        (None, [1.0] * 24, 1), (100, None, 1), (105, [1.0, None] * 12, 1), (110, [nan] * 24, 0),
        (115, [inf] * 24, 0), (120, [0.3] * 24, None), (125, [], 1), (130, [0.5] * 3, 2),
        (135, [1e30, -1e30] * 12, 1), (140, [9e9] * 24, 2), (5, [0.9] * 24, 3), (5, [0.9] * 24, 3),
    ]
    frame = vectors(spark, rows + odd).withColumn("score", F.lit("clash")).withColumn("I", F.lit(1))
    assert set(mined(frame)) == brute(rows + odd)


def test_tables_without_anchors(spark):
    frame = vectors(spark, random_rows(2, 20, 8))
    assert mined(frame.where("vec_id % 5 != 0")) == []
    assert mined(frame.limit(0)) == []
    assert mined(frame.where("vec_id = 5")) == []


def test_repeated_tables_give_the_same_rows(spark):
    frame = vectors(spark, random_rows(3, 80, 16))
    assert sorted(mined(frame)) == sorted(mined(frame.unionAll(frame)))


def test_one_vector_in_many_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_AT_FIRST", 8)
    rows = random_rows(4, 60, 32) + [(i, [0.25] * 32, i % 2) for i in range(60, 160)]
    assert set(mined(vectors(spark, rows))) == brute(rows)


def test_bounds_hold_and_close_pairs(spark):
    """Every score lies within the bounds of each level, and shorter segments are no worse."""
    rng = np.random.default_rng(1)
    codes = (rng.normal(0, 40, (80, 37)) + rng.normal(0, 90, (80, 1))).astype(np.int32)
    scores = codes.astype(np.int64) @ codes.T
    widths = []
    for length in (37, 16, 4, 2, 1):
        held = negatives.summaries(codes, length)
        half = held.shape[1] // 2
        middle = held[:, :half] @ held[:, :half].T
        spread = held[:, half:] @ held[:, half:].T
        assert (middle - spread <= scores + 0.5).all() and (scores - 0.5 <= middle + spread).all()
        widths.append(spread.mean())
    assert widths[-1] < 1e-6 and widths[0] > widths[2] > widths[3]


def test_filter_decides_pairs_before_scoring():
    """On vectors whose components go together most pairs are never scored."""
    rng = np.random.default_rng(2)
    levels = np.repeat(rng.normal(0, 60, (400, 4)), 16, axis=1)
    codes = (levels + rng.normal(0, 3, (400, 64))).astype(np.int32)
    held = negatives.summaries(codes, 16)
    half = held.shape[1] // 2
    upper = held[:, :half] @ held[:, :half].T + held[:, half:] @ held[:, half:].T
    scores = np.sort(codes.astype(np.int64) @ codes.T, axis=1)
    assert (upper >= scores[:, [-5]]).mean() < 0.05
