"""Language identification by hyperdimensional profiles.

Each letter, and the blank, has a random vector of plus and minus ones drawn
from a seed and its code point. An n-gram of three is bound from them: the first
vector rotated by two places, times the second rotated by one, times the third.
A text is the bundle (sum) of the vectors of its n-grams, and so is a language
over all texts learned for it. The language whose bundle has the highest cosine
with that of the text is predicted, and the cosine, at least 0, is the score.

Bundles are sums of whole numbers, so learning gives the same in any order. Only
one vector for each language and task leaves a task.

Texts that are null or hold no letter are ``und`` with score 0, and so is every
text if nothing could be learned. Equal cosines go to the language first by code
point. Rows with a null language teach nothing. Repeated rows count repeatedly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doselens.llm.common import ROWS_AT_ONCE, BatchFunction, add_columns, released
from doselens.llm.letters import letter_runs

DIMENSIONS = 1024
SEED = 20
GRAM_LIMIT = 16_000
"""Vectors of n-grams remembered at once in a task."""
GRAMS_AT_ONCE = 2048
"""N-grams whose vectors are added up together."""
UNKNOWN = "und"


class Space:
    """The vectors of letters and n-grams."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        self.row: dict[int, int] = {}
        # Single bytes: a worker keeps these beside whatever else its tasks hold.
        self.vectors = np.zeros((256, self.dimensions), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) > GRAM_LIMIT:
                self.letters.clear()
            random = np.random.default_rng([self.seed, point])
            self.letters[point] = (random.integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)
        return self.letters[point]

    def _rows(self, grams: list[int]) -> list[int]:
        """Rows of the vectors, binding those not met before."""
        if len(self.row) + len(grams) > GRAM_LIMIT:
            self._forget()
        missing = [gram for gram in grams if gram not in self.row]
        if len(self.row) + len(missing) > len(self.vectors):
            more = np.zeros((max(len(self.vectors), len(missing)), self.dimensions), np.int8)
            self.vectors = np.concatenate([self.vectors, more])
        for gram in missing:
            one, two, three = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
            row = self.row[gram] = len(self.row)
            self.vectors[row] = (
                np.roll(self.letter(one), 2) * np.roll(self.letter(two), 1) * self.letter(three)
            )
        return [self.row[gram] for gram in grams]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the n-grams' vectors, each as often as counted."""
        total = np.zeros(self.dimensions)
        for at in range(0, len(grams), GRAMS_AT_ONCE):
            part = slice(at, at + GRAMS_AT_ONCE)
            rows = self._rows(grams[part].tolist())
            total += counts[part].astype(np.float32) @ self.vectors[rows].astype(np.float32)
        return total


def ngrams(text: str) -> np.ndarray:
    """The windows of three around each letter, coded; blanks stand for other characters."""
    parts = []
    for points, own in letter_runs(text, 1):
        points = points.astype(np.uint64)
        middle = points[own]
        coded = points[:-2] << np.uint64(42) | middle << np.uint64(21) | points[2:]
        parts.append(coded[middle > 0])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def learn(
    documents: DataFrame, text: str = "text", lang: str = "lang", space: Space | None = None
) -> dict[str, np.ndarray]:
    """The bundle of each language over all rows with a language.

    Counts of n-grams are whole numbers below 2^24 in a batch, so the sums are exact.
    """
    dimensions, seed = (space or Space()).dimensions, (space or Space()).seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Space(dimensions, seed)
        bundles: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found: dict[str, list[np.ndarray]] = defaultdict(list)
                for name, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    found[name].append(ngrams(value or ""))
                for name, grams in found.items():
                    counted = np.unique(np.concatenate(grams), return_counts=True)
                    bundles[name] += own.bundle(*counted)
        for name, bundle in bundles.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * dimensions),
                    "place": pa.array(range(dimensions), pa.int32()),
                    "value": pa.array(bundle.astype(np.int64)),
                }
            )

    taught = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    parts = taught.select(lang, text).mapInArrow(released(run), "lang string, place int, value bigint")
    # One value for each language and dimension comes to the driver.
    sums = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect()
    bundles: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions))
    for name, place, value in sums:
        bundles[name][place] = value
    return dict(bundles)


def identify(
    frame: DataFrame,
    bundles: dict[str, np.ndarray],
    text: str = "text",
    space: Space | None = None,
) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to the frame."""
    names = sorted(bundles)
    dimensions, seed = (space or Space()).dimensions, (space or Space()).seed
    prototypes = np.array([bundles[n] / (np.linalg.norm(bundles[n]) or 1) for n in names])

    def prepare() -> BatchFunction:
        own = Space(dimensions, seed)

        def predict(value: str | None) -> tuple[str, float]:
            grams = ngrams(value or "")
            if not (len(grams) and names):
                return UNKNOWN, 0.0
            vector = own.bundle(*np.unique(grams, return_counts=True))
            cosines = prototypes @ vector / (np.linalg.norm(vector) or 1)
            best = int(np.argmax(cosines))
            return names[best], float(min(1.0, max(0.0, cosines[best])))

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [predict(value) for value in batch.column(text).to_pylist()]
            return [
                pa.array([name for name, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ]

        return run

    return add_columns(frame, "lang_pred string, score double", prepare)


def recognised(least_score: float = 0.05) -> Column:
    """Whether a prediction counts: some language, and a cosine of ``least_score`` or more."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
