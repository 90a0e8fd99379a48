"""Token-id files with Elias-Fano document boundaries.

A shard file holds the ids of consecutive documents in one array. Where each
document starts is a rising sequence, stored by Elias-Fano: the low bits of each
value are packed, the high bits are written in unary into a bit vector, and a
sampled select structure finds the i-th value without reading what lies before.
It takes about two bits and the low bits for each document, where a table of
offsets takes 64. The document ids are rising too and stored the same way.

Shards are cut from documents ordered by id, so their files follow one another;
a manifest row for each shard gives its place in the whole sequence.

Null texts are empty and hold the end id alone. Null document ids come first and
are read back as null. Equal document ids keep one entry each, in the order of
a hash of their texts. An empty table gives an empty manifest. Files are written beside
their place under a name of their own and renamed; the manifest names the files
of the attempts that were committed, so a task that runs again does no harm.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from doselens.llm.common import materialize, new_folder, texts
from doselens.llm.pieces import Remembered, cut

MAGIC = b"IDSHARD1"
SAMPLE = 512
"""One place in the bit vector is stored for each so many values."""
SHARD_IDS = 8_000_000
"""A shard is closed when it holds so many ids."""
REMEMBERED = 250_000
"""Pieces remembered before a new generation begins; the last one stays known."""
RUN = 4096
"""Documents read from a shard at once."""
MANIFEST = "path string, first_doc bigint, n_docs bigint, n_ids bigint, part int, place int"


class EliasFano:
    """A sequence of non-negative integers that never fall, packed."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])[:: SAMPLE // 8]

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = _pack(values & ((1 << low_bits) - 1), low_bits)
        places = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"))

    def select(self, index: int) -> int:
        """The value at an index, from the sampled block that holds its bit."""
        if not 0 <= index < self.n:
            raise IndexError(index)
        block = int(np.searchsorted(self.before, index, "right")) - 1
        start = block * (SAMPLE // 8)
        rest = index - int(self.before[block])
        while True:
            window = np.unpackbits(self.high[start : start + SAMPLE // 8], bitorder="little")
            ones = np.flatnonzero(window)
            if rest < len(ones):
                place = start * 8 + int(ones[rest])
                break
            rest -= len(ones)
            start += SAMPLE // 8
        return (place - index) << self.low_bits | self._low(index)

    def _low(self, index: int) -> int:
        if not self.low_bits:
            return 0
        first = index * self.low_bits
        last = first + self.low_bits
        window = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return window >> first % 8 & ((1 << self.low_bits) - 1)

    def run(self, first: int, count: int) -> np.ndarray:
        """The values from an index on: a select finds the first, its bits are read on from there."""
        count = min(count, self.n - first)
        if count <= 0:
            return np.zeros(0, np.int64)
        block = int(np.searchsorted(self.before, first, "right")) - 1
        start, skipped = block * (SAMPLE // 8), first - int(self.before[block])
        parts, found = [], 0
        while found < skipped + count:
            window = np.unpackbits(self.high[start : start + SAMPLE], bitorder="little")
            ones = np.flatnonzero(window) + 8 * start
            parts.append(ones)
            found += len(ones)
            start += SAMPLE
        places = np.concatenate(parts)[skipped : skipped + count]
        high = (places - np.arange(first, first + count)) << self.low_bits
        # Whole bytes that hold the low bits of the run.
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        held = np.unpackbits(self.low[begin // 8 : (end + 7) // 8], bitorder="little")
        held = held[begin % 8 : begin % 8 + end - begin].reshape(count, self.low_bits)
        return high | held.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<i8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence at the start of the data, and the length it takes."""
        n, low_bits, low, high = np.frombuffer(data[:32], "<i8").tolist()
        lows = np.frombuffer(data[32 : 32 + low], np.uint8)
        highs = np.frombuffer(data[32 + low : 32 + low + high], np.uint8)
        return cls(n, low_bits, lows, highs), 32 + low + high


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    bits = values[:, None] >> np.arange(width) & 1
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little")


def shard_bytes(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard: header, packed document ids, packed boundaries, id array.

    Ids take two bytes where all of them fit, else four.
    """
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    lowest = int(known[0]) if len(known) else 0
    wide = ids.dtype.itemsize > 2 and bool(len(ids)) and int(ids.max()) > 0xFFFF
    array = ids.astype("<u4" if wide else "<u2", copy=False).tobytes()
    names = EliasFano.build(known - lowest).to_bytes()
    bounds = EliasFano.build(ends).to_bytes()
    head = {"nulls": len(doc_ids) - len(known), "lowest": lowest, "width": 4 if wide else 2}
    head |= {"names": len(names), "bounds": len(bounds), "crc32": zlib.crc32(array)}
    header = json.dumps(head).encode()
    return MAGIC + len(header).to_bytes(4, "little") + header + names + bounds + array


class Shard:
    """A shard file opened for reading."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a shard file")
        view = memoryview(data)
        at = 12 + int.from_bytes(view[8:12], "little")
        head = json.loads(bytes(view[12:at]))
        self.nulls, self.lowest = head["nulls"], head["lowest"]
        self.names, _ = EliasFano.from_bytes(view[at:])
        at += head["names"]
        self.bounds, _ = EliasFano.from_bytes(view[at:])
        at += head["bounds"]
        if zlib.crc32(view[at:]) != head["crc32"]:
            raise ValueError("the id array is damaged")
        self.ids = np.frombuffer(view[at:], f"<u{head['width']}")

    def __len__(self) -> int:
        return self.bounds.n

    def doc_id(self, index: int) -> int | None:
        return None if index < self.nulls else self.lowest + self.names.select(index - self.nulls)

    def start(self, index: int) -> int:
        return self.bounds.select(index - 1) if index else 0

    def document(self, index: int) -> np.ndarray:
        """The ids of one document, found by two selects."""
        return self.ids[self.start(index) : self.bounds.select(index)]

    def documents(self, run: int = RUN) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """Document ids, starts and ends, some documents at a time."""
        for first in range(0, len(self), run):
            ends = self.bounds.run(first, run)
            starts = np.concatenate([[self.start(first)], ends[:-1]])
            unnamed = max(0, min(len(ends), self.nulls - first))
            names = self.names.run(first + unnamed - self.nulls, len(ends) - unnamed) + self.lowest
            yield [None] * unnamed + names.tolist(), starts, ends


class LibraryEncoder:
    """Ids by the tokenizers library, for byte-level vocabularies.

    Such a tokenizer cuts a text by its pattern and encodes each piece by
    itself, so the pattern is applied here and each piece goes through the
    library's model once for as long as it is remembered. A text with the name of an
    added token goes through the library as a whole, which gives that token its id.
    """

    def __init__(self, path: str, pattern: str) -> None:
        tokenizer = Tokenizer.from_file(path)
        self.model, self.tokenizer = tokenizer.model, tokenizer
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        # Two bytes for each id where the vocabulary fits into them.
        size = tokenizer.get_vocab_size()
        self.id_type = "<u2" if size <= 1 << 16 else "<u4"
        self.packed = [i.to_bytes(int(self.id_type[2]), "little") for i in range(size)]
        self.pattern = pattern
        self.letters = _byte_letters()
        self.pieces = Remembered(self._library, REMEMBERED)

    def encode(self, text: str) -> bytes:
        """The ids, packed as ``id_type``."""
        if any(name in text for name in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, self.id_type).tobytes()
        return b"".join(map(self.pieces.joined, cut(text, self.pattern)))

    def _library(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            spelt = piece.replace(" ", self.letters[0x20])
        else:
            spelt = piece.encode().decode("latin-1").translate(self.letters)
        tokens = self.model.tokenize(spelt)
        return b"".join([self.packed[token.id] for token in tokens])


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Fixed rule: visible Latin-1 characters stand for themselves, the other bytes
    in order for the characters from 256 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(256 + i) for i, byte in enumerate(hidden)}


@lru_cache(maxsize=2)
def library_encoder(path: str, pattern: str) -> LibraryEncoder:
    """The encoder of a Python worker, which goes on with it in its next tasks."""
    return LibraryEncoder(path, pattern)


def _location(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder[:5] == "file:" else f"file://{folder}")


def _put(folder: str, name: str, data: bytes) -> str:
    """Writes beside the place and renames, so that readers see whole files only."""
    system, base = _location(folder)
    system.create_dir(base, recursive=True)
    beside = f"{base}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(beside) as out:
        out.write(data)
    system.move(beside, f"{base}/{name}")
    return f"{folder.rstrip('/')}/{name}"


def read_shard(path: str) -> Shard:
    folder, _, name = path.rpartition("/")
    system, base = _location(folder)
    with system.open_input_stream(f"{base}/{name}") as stream:
        return Shard(stream.read())


def write_shards(
    documents: DataFrame,
    folder: str,
    encoder: Callable[[], LibraryEncoder],
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Writes the ids of all documents in the order of their keys; returns the manifest.

    ``encoder`` is called once in each task; what it gives has ``encode``, which
    packs the ids of a text, and their ``id_type``. The manifest has a row for each shard with the number of
    ids before it; it is written once, so the files are made once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder()
        encode, id_type = own.encode, np.dtype(own.id_type)
        end = np.array([end_id], id_type).tobytes()
        names: list[int | None] = []
        parts: list[bytes] = []
        ends: list[int] = []
        total = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), id_type)
            first = next((d for d in names if d is not None), None)
            name = f"{'null' if first is None else first}-{len(names)}-{uuid.uuid4().hex}.ids"
            path = _put(folder, name, shard_bytes(names, np.array(ends), ids))
            return pa.RecordBatch.from_pydict(
                {
                    "path": pa.array([path]),
                    "first_doc": pa.array([first], pa.int64()),
                    "n_docs": pa.array([len(names)], pa.int64()),
                    "n_ids": pa.array([total], pa.int64()),
                    "part": pa.array([part], pa.int32()),
                    "place": pa.array([place], pa.int32()),
                }
            )

        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), texts(batch, text), strict=True):
                packed = encode(value) + end
                total += len(packed) // id_type.itemsize
                names.append(name)
                parts.append(packed)
                ends.append(total)
                if total >= shard_ids:
                    yield close()
                    names, parts, ends, total = [], [], [], 0
                    place += 1
        if names:
            yield close()

    chosen = documents.select(F.col(key).cast("bigint").alias(key), F.col(text).alias(text))
    # By a hash of the text too, so that one id on many rows is no one task.
    hashed = chosen.withColumn("_hash", F.xxhash64(text))
    ordered = hashed.repartitionByRange(key, "_hash").sortWithinPartitions(key, "_hash", text)
    ordered = ordered.drop("_hash")
    manifest = materialize(ordered.mapInArrow(run, MANIFEST), "shard-manifest")
    # One row for each shard: shards hold millions of ids, so this window stays small.
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_shards(manifest: DataFrame) -> DataFrame:
    """The documents of all shards: id, place of the first id, number and crc32 of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                shard = read_shard(path)
                for names, starts, ends in shard.documents():
                    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
                    sums = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in pairs]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(names, pa.int64()),
                            "start": pa.array(starts + before, pa.int64()),
                            "n_tokens": pa.array(ends - starts, pa.int64()),
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    # As many tasks as a shuffle has; small rows would else be joined into one task.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("path", "ids_before").repartition(tasks, "path")
    return files.mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def new_shard_folder(frame: DataFrame) -> str:
    return new_folder(frame.sparkSession, "id-shards")
