"""Fingerprints by a quartile bucket digest.

Every window of five bytes gives the triplets that hold its last byte; each is
hashed into one of 256 buckets. A bucket is coded by the quartile its count
falls into, so a digest has two bits for each bucket. Before them stand the
length on a logarithmic scale and how far the quartiles lie apart. Unlike a hash
of the whole, equal parts of two texts give equal counts.

The difference of two digests sums the steps between the bucket codes (the step
from the lowest to the highest quartile counts double), the difference of the
lengths and of the spreads, each bounded. A digest of a text is the same each
time; equal texts have equal digests. Null and empty texts have the digest of no
triplets, as texts of one or two bytes have; it is at the largest difference from that of
any text with some.
Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doselens.llm.common import BatchFunction, add_columns, materialize, texts

BUCKETS = 256
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
"""How far back the other two bytes of a triplet lie."""
STEP = np.array([[abs(a - b) + 3 * (abs(a - b) == 3) for b in range(4)] for a in range(4)])
MOST = BUCKETS * 2
"""A difference of so much or more is a likeness of 0: two steps for each bucket."""
LENGTH_STEPS = 4
"""Steps of the length code for each doubling."""
LENGTH_COST, SPREAD_COST = 6, 4
CHUNK = 1 << 22
EMPTY = "00" * (3 + BUCKETS // 4)

_MIX = [np.uint32((2 * i + 1) * 0x9E3779B1 & 0xFFFFFFFF) for i in range(3 * len(TRIPLETS))]


def bucket_counts(data: bytes) -> np.ndarray:
    """How often the triplets of the bytes fall into each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, max(len(data), 1), CHUNK):
        part = np.frombuffer(data[max(0, start - 4) : start + CHUNK], np.uint8).astype(np.uint32)
        begin = 4 if start else 0
        for salt, (near, far) in enumerate(TRIPLETS):
            first = max(begin, far)
            if len(part) <= first:
                continue
            n = len(part) - first
            mixed = part[first:] * _MIX[3 * salt] + part[first - near : first - near + n] * _MIX[3 * salt + 1]
            mixed += part[first - far : first - far + n] * _MIX[3 * salt + 2]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA6B)
            counts += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    return counts


def fingerprint(text: str) -> str:
    """The digest of a text: length code, two spreads, and the coded buckets, as hex."""
    data = text.encode()
    counts = bucket_counts(data)
    if not counts.any():
        return EMPTY
    low, middle, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    four = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    top = max(int(high), 1)
    head = [
        1 + min(254, round(LENGTH_STEPS * log2(len(data) + 1))),
        min(255, 64 * int(low) // top),
        min(255, 64 * int(middle) // top),
    ]
    return bytes(head).hex() + four.sum(axis=1, dtype=np.uint8).tobytes().hex()


def difference(one: str, other: str) -> int:
    """The bounded difference of two digests: 0 for equal ones, ``MOST`` at most."""
    if one == other:
        return 0
    a, b = np.frombuffer(bytes.fromhex(one + other), np.uint8).reshape(2, -1).astype(np.int64)
    if not (a[0] and b[0]):
        return MOST
    length = LENGTH_COST * max(0, abs(a[0] - b[0]) - 1)
    spread = SPREAD_COST * sum(max(0, abs(a[i] - b[i]) // 4 - 1) for i in (1, 2))
    shifts = np.array([0, 2, 4, 6])
    steps = STEP[a[3:, None] >> shifts & 3, b[3:, None] >> shifts & 3].sum()
    return int(min(MOST, length + spread + steps))


def likeness(one: str, other: str) -> float:
    """1 for equal digests, 0 from the largest difference on."""
    return 1 - difference(one, other) / MOST


def add_fingerprints(frame: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Adds the digest of a text column."""

    def prepare() -> BatchFunction:
        return lambda batch: [pa.array([fingerprint(t) for t in texts(batch, text)])]

    return add_columns(frame, f"`{name}` string", prepare)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_FIELDS = [part.strip().split()[0] for part in RESULT.split(",")]


def _compare(doc_id: int | None, text: str, own: str, following: str, next_own: str) -> tuple:
    changed = edited(text, following)
    mark = fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), digest, own, mark, likeness(own, mark), likeness(own, next_own)


def compare_neighbours(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's digest beside that of an edited text and of the next document.

    The next document is the one with the next higher key (nulls first; equal
    keys by their text), and the first after the last. Documents are dealt out
    by ranges of the key and read in order, so each task has the next one at
    hand, except for its last document. The first and last document of each task
    are set aside, matched by task, and compared in a second, small step.
    """
    chosen = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = None
        for batch in batches:
            done, edges = [], []
            ids = batch.column(0).to_pylist()
            for doc_id, own_text in zip(ids, texts(batch), strict=True):
                mark = fingerprint(own_text)
                if held is None:
                    edges.append((part, True, doc_id, own_text))
                else:
                    done.append(_compare(*held, own_text, mark))
                held = (doc_id, own_text, mark)
            yield _rows(done, edges)
        if held is not None:
            yield _rows([], [(part, False, held[0], held[1])])

    schema = f"{RESULT}, part int, is_first boolean, edge_id bigint, edge_text string"
    everything = materialize(ordered.mapInArrow(run, schema), "digests")
    inner = everything.where("part is null").select(*_FIELDS)

    edges = everything.where("part is not null").select("part", "is_first", "edge_id", "edge_text")
    # One row for each task: its number, and the number of the next task with rows.
    parts = edges.where("is_first").select("part")
    wrapped = F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())
    )
    parts = parts.withColumn("next_part", wrapped)
    firsts = edges.where("is_first").select(
        F.col("part").alias("next_part"), F.col("edge_text").alias("next_text")
    )
    lasts = edges.where("not is_first").join(parts, "part").join(firsts, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("edge_id").to_pylist()
            pairs = zip(ids, texts(batch, "edge_text"), texts(batch, "next_text"), strict=True)
            rows = [_compare(i, t, fingerprint(t), n, fingerprint(n)) for i, t, n in pairs]
            yield pa.RecordBatch.from_pydict(_columns(rows))

    last_rows = lasts.select("edge_id", "edge_text", "next_text").mapInArrow(finish, RESULT)
    return inner.unionByName(last_rows)


_TYPES = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _columns(rows: list[tuple], more: int = 0) -> dict[str, pa.Array]:
    """The result's columns, with ``more`` nulls below the rows."""
    columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
    kinds = [_TYPES[part.split()[1]] for part in RESULT.split(",")]
    return {
        name: pa.array([*values, *[None] * more], kind)
        for name, values, kind in zip(_FIELDS, columns, kinds, strict=True)
    }


def _rows(done: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
    parts, firsts, ids, texts_ = list(zip(*edges, strict=True)) or [()] * 4
    empty = [None] * len(done)
    return pa.RecordBatch.from_pydict(
        _columns(done, len(edges))
        | {
            "part": pa.array([*empty, *parts], pa.int32()),
            "is_first": pa.array([*empty, *firsts], pa.bool_()),
            "edge_id": pa.array([*empty, *ids], pa.int64()),
            "edge_text": pa.array([*empty, *texts_], pa.string()),
        }
    )
