"""Toxicity by a naive-Bayes-scaled linear classifier over character n-grams.

The features of a text are the character n-grams of its words, with their
borders, each hashed into one of 2^20 places and counted as there or not. For
each place the labelled texts give the naive Bayes log-count ratio: how much
likelier it is in a toxic text. A feature has the value of its ratio where it is
there, and a logistic regression with a quadratic penalty is fitted on that, over
all places whose share differs between the classes by more than chance would have it.

Labels are taken from at most ``labelled_rows`` rows, those of the lowest hash of
their id; that bound also limits what is broadcast, and what comes to the driver is the
telling places of those rows. Everything else covers all documents. Rows of unknown
label teach nothing; contradicting labels of a document count as toxic, and of several
texts under one labelled id the first by code point is learned from. Null and empty texts have no features and get the score
of the intercept. If one class is missing, every score is the share of toxic
rows, or 0 without any row. Repeated documents are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import BatchFunction, add_columns, materialize, released, texts
from doselens.llm.letters import letter_runs

BITS = 20
LENGTHS = (3, 4, 5)
LABELLED_ROWS = 20_000
LEAST_CONTRAST = 5.0
"""Standard errors by which the share of a feature must differ between the classes.

Among a million places some differ by nearly that by chance.
"""
PENALTY = 0.05
THRESHOLD = 0.3


def places(text: str) -> np.ndarray:
    """The hashed places of all n-grams of a text, with repetitions."""
    parts = []
    for points, own in letter_runs(text, max(LENGTHS)):
        n, begin = own.stop - own.start, own.start
        gap = points == 0
        for length in LENGTHS:
            mixed = np.full(n, 0x811C9DC5 + length, np.uint32)
            inside = np.zeros(n, bool)
            for back in range(length):
                window = slice(begin - back, begin - back + n)
                mixed = (mixed ^ points[window]) * np.uint32(0x01000193)
                # A blank may only stand at either border.
                if 0 < back < length - 1:
                    inside |= gap[window]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA6B)
            parts.append((mixed >> np.uint32(32 - BITS))[~inside])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


@dataclass
class Model:
    """Weights of the kept places, in the order of the places."""

    kept: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        """The weight of every place, 0 for those that were not kept."""
        found = np.zeros(1 << BITS)
        found[self.kept] = self.weights
        return found

    def score(self, text: str, table: np.ndarray | None = None) -> float:
        """The chance that a text is toxic; ``table`` spares making it for each text."""
        weights = self.table() if table is None else table
        found = places(text)
        telling = np.unique(found[weights[found] != 0])
        margin = self.intercept + float(weights[telling].sum())
        return 1 / (1 + float(np.exp(-np.clip(margin, -35, 35))))


def _class_counts(taught: DataFrame) -> DataFrame:
    """For each place, the toxic and the other texts that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            for label, text in zip(labels, texts(batch), strict=True):
                counts[label, np.unique(places(text))] += 1
        found = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array(found, pa.int32()),
                "toxic": pa.array(counts[1, found]),
                "other": pa.array(counts[0, found]),
            }
        )

    parts = taught.mapInArrow(released(run), "place int, toxic bigint, other bigint")
    return parts.groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    labelled_rows: int = LABELLED_ROWS,
    least_contrast: float = LEAST_CONTRAST,
) -> Model:
    """Fits the classifier on the documents that ``labels`` marks (doc_id, toxic)."""
    bounded = (
        labels.where("toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(labelled_rows)
    )
    # At most labelled_rows rows of two numbers.
    joined = documents.select("doc_id", "text").join(F.broadcast(bounded), "doc_id")
    # One row for each id, so that the bound on ids is one on rows.
    single = joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    taught = materialize(single.select("text", "toxic"), "toxicity-labelled")
    sizes = {row["toxic"]: row["count"] for row in taught.groupBy("toxic").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not (toxic and other):
        share = toxic / max(1, toxic + other)
        margin = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(0, np.int64), np.zeros(0), float(margin))

    # One row for each place, 2^20 at most.
    counts = _class_counts(taught).toArrow().sort_by("place")
    place, have, have_not = (c.to_numpy() for c in counts.columns)
    p, q = (have + 1) / (toxic + 2), (have_not + 1) / (other + 2)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    pooled = (have + have_not + 1) / (toxic + other + 2)
    contrast = (p - q) / np.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / other))
    telling = np.abs(contrast) >= least_contrast
    kept, ratios = place[telling].astype(np.int64), ratio[telling]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = np.full(1 << BITS, -1, np.int32)
        row[kept] = np.arange(len(kept))
        for batch in batches:
            packed = []
            for text in texts(batch):
                found = row[places(text)]
                packed.append(np.unique(found[found >= 0]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_pydict(
                {"toxic": batch.column("toxic"), "kept": pa.array(packed, pa.binary())}
            )

    # At most labelled_rows rows of the telling places of a text.
    rows = taught.mapInArrow(released(run), "toxic int, kept binary").collect()
    rows = sorted((r["toxic"], bytes(r["kept"])) for r in rows)
    labelled = np.array([label for label, _ in rows], np.float64)
    lengths = [len(packed) // 4 for _, packed in rows]
    columns = np.frombuffer(b"".join(packed for _, packed in rows), "<i4")
    fitted = _logistic(np.repeat(np.arange(len(rows)), lengths), columns, ratios, labelled)
    return Model(kept, fitted[:-1] * ratios, float(fitted[-1]))


def _logistic(
    rows: np.ndarray, columns: np.ndarray, ratios: np.ndarray, labels: np.ndarray, rounds: int = 200
) -> np.ndarray:
    """Logistic regression of sparse rows by limited-memory quasi-Newton steps; the intercept comes last.

    ``rows`` and ``columns`` say which features which rows have; a feature's value is its ratio.
    """
    n, width = len(labels), len(ratios)
    penalty = np.full(width + 1, PENALTY * n / 100)
    penalty[-1] = 1e-6
    values = ratios[columns]

    def evaluated(weights: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(rows, values * weights[columns], n) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels
        slope = np.append(np.bincount(columns, values * error[rows], width), error.sum())
        loss = np.logaddexp(0, margin).sum() - labels @ margin + penalty @ weights**2 / 2
        return float(loss), slope + penalty * weights

    weights = np.zeros(width + 1)
    weights[-1] = np.log(labels.sum() / (n - labels.sum()))
    loss, slope = evaluated(weights)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, used = slope.copy(), []
        for moved, turned in reversed(past):
            used.append((moved @ step) / (moved @ turned))
            step -= used[-1] * turned
        if past:
            moved, turned = past[-1]
            step *= (moved @ turned) / (turned @ turned)
        else:
            step /= max(1.0, np.linalg.norm(slope))
        for (moved, turned), share in zip(past, reversed(used), strict=True):
            step += (share - (turned @ step) / (moved @ turned)) * moved
        size, gain = 1.0, float(slope @ step)
        while True:
            after, after_slope = evaluated(weights - size * step)
            if after <= loss - 1e-4 * size * gain or size < 1e-8:
                break
            size /= 2
        moved, turned = -size * step, after_slope - slope
        if moved @ turned > 1e-12:
            past = [*past[-9:], (moved, turned)]
        done = loss - after < 1e-8 * max(1.0, abs(loss))
        weights, loss, slope = weights + moved, after, after_slope
        if done:
            break
    return weights


def add_scores(frame: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score`` and ``predicted`` to the frame."""

    def prepare() -> BatchFunction:
        table = model.table()

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            scores = [model.score(t, table) for t in texts(batch, text)]
            predicted = [int(score >= THRESHOLD) for score in scores]
            return [pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())]

        return run

    return add_columns(frame, "score double, predicted int", prepare)
