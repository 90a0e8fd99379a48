"""Cutting one large JSON document into the members of its lists, in many tasks.

Spark's text reader cuts a file into splits and hands over the bytes between closing
braces, so no line is longer than an object. What a byte means depends on all before it:
whether it stands in a string, behind a backslash, and how deep. So a first scan finds,
for each split and each of the four states it may begin in, the state it ends in and how
far it goes up or down; composing these in the order of the splits gives where each really
begins. With that a second scan cuts every split by itself: text between the commas of the
containers that the document's fields hold, and the document without them, which tells
the fields' names. Pieces of a member that reaches over splits are put together by a shuffle
of those pieces alone.

What passes through the driver is a row of a few numbers for each split.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .archives import literal_paths, received
from .tables import shared_folder

QUOTE, BACKSLASH, COMMA = 34, 92, 44
CLOSING = "}"
"""Where the reader cuts; a byte of its own in UTF-8."""
STEP = np.zeros(256, np.int8)
"""How each byte changes the depth outside strings."""
STEP[[ord("{"), ord("[")]] = 1
STEP[[ord("}"), ord("]")]] = -1

ZIP_MAGIC = b"PK\x03\x04"
SEGMENT_PARTS = 64
PART_BYTES = 1 << 20
"""Unzipped bytes of a row, and rows of a segment, which is scanned like a split."""
SCAN_BYTES = 1 << 22
"""Bytes scanned at once, unless a line is longer."""
ROWS_AT_ONCE = 1000

SPLITS = "path string, split bigint, bytes bigint, zipped boolean, ends array<int>, steps array<bigint>"
PIECES = (
    "path string, split bigint, seq bigint, container int, data binary, starts boolean, "
    "ends boolean, opened boolean, closed boolean, containers int"
)
NAMES = [part.split()[0] for part in PIECES.split(", ")]

Lines = Callable[[], DataFrame]
"""Path, split and line of all lines, in order within a split, and each split in one task."""


def toggles(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """The places of the quotes that count, and whether the next byte is escaped."""
    quotes = np.flatnonzero(data == QUOTE)
    slashes = np.flatnonzero(data == BACKSLASH)
    if not len(data):
        return quotes, escaped
    if not len(slashes):
        return (quotes[quotes > 0] if escaped else quotes), False
    starts = slashes[np.diff(slashes, prepend=-2) != 1]

    def behind(places: np.ndarray) -> np.ndarray:
        """Whether an odd number of backslashes stands right before each place."""
        before = places - 1
        run = np.searchsorted(starts, before, side="right") - 1
        start = starts[np.maximum(run, 0)]
        # A pending backslash uses up the first byte.
        length = places - start - ((start == 0) & escaped)
        odd = (data[np.maximum(before, 0)] == BACKSLASH) & (length % 2 == 1)
        return np.where(places == 0, escaped, odd)

    last = behind(np.array([len(data)]))[0]
    return quotes[~behind(quotes)], bool(last)


def outside(places: np.ndarray, quotes: np.ndarray, in_string: bool) -> np.ndarray:
    """Which places stand outside strings."""
    return (np.searchsorted(quotes, places) % 2 == 1) == in_string


def states_after(data: np.ndarray) -> tuple[list[int], list[int]]:
    """For each state a chunk may begin in, the state it ends in and its change of depth.

    A state is 2 in a string, plus 1 behind a backslash.
    """
    brackets = np.flatnonzero(STEP[data])
    ends, steps = [], []
    for state in range(4):
        in_string, escaped = bool(state & 2), bool(state & 1)
        quotes, last = toggles(data, escaped)
        ends.append(2 * (in_string ^ (len(quotes) % 2 == 1)) + last)
        steps.append(int(STEP[data[brackets[outside(brackets, quotes, in_string)]]].sum()))
    return ends, steps


def _chunks(batches: Iterator[pa.RecordBatch], mark: bool) -> Iterator[tuple[str, int, bytes]]:
    """Path, split and bytes of runs of lines; ``mark`` puts the closing braces back."""
    end = CLOSING.encode() if mark else b""
    for batch in batches:
        columns = [batch.column(i) for i in range(3)]
        key, held, size = None, [], 0
        for path, split, line in zip(*(c.to_pylist() for c in columns), strict=True):
            if key != (path, split) or size > SCAN_BYTES:
                if held:
                    yield *key, b"".join(held)
                key, held, size = (path, split), [], 0
            held += [line, end]
            size += len(line) + 1
        if held:
            yield *key, b"".join(held)


def _scan(lines: DataFrame, mark: bool) -> DataFrame:
    """A row for each split: its bytes, how it begins, and where each state leads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found = None, None

        def row() -> pa.RecordBatch:
            size, zipped, ends, steps = found
            values = [*key, size, zipped, ends, steps]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                names=["path", "split", "bytes", "zipped", "ends", "steps"],
            )

        for path, split, data in _chunks(batches, mark):
            if key != (path, split):
                if key is not None:
                    yield row()
                key, found = (path, split), (0, data.startswith(ZIP_MAGIC), [0, 1, 2, 3], [0] * 4)
            size, zipped, ends, steps = found
            next_ends, next_steps = states_after(np.frombuffer(data, np.uint8))
            found = (
                size + len(data),
                zipped,
                [next_ends[e] for e in ends],
                [s + next_steps[e] for s, e in zip(steps, ends, strict=True)],
            )
        if key is not None:
            yield row()

    return lines.mapInArrow(run, SPLITS)


@dataclass
class Cutter:
    """Cuts the bytes of one split, whose beginning state and depth are known."""

    path: str
    split: int
    state: int
    depth: int
    over: bool
    containers: int = 0
    """Containers opened in this split; 0 stands for the one that was open before."""
    seq: int = 0
    held: list[bytes] = field(default_factory=list)
    """The open member, as far as it stands in this split."""
    starts: bool = False
    opened: bool = False
    frame: list[bytes] = field(default_factory=list)
    """The document around the containers."""

    def _row(self, ends: bool, closed: bool) -> tuple:
        data = b"".join(self.held)
        self.seq += 1
        return (
            self.path, self.split, self.seq, self.containers, data, self.starts, ends, self.opened,
            closed, None,
        )

    def feed(self, data: bytes) -> Iterator[tuple]:
        """Members that end in ``data``."""
        if self.over:
            return
        array = np.frombuffer(data, np.uint8)
        quotes, escaped = toggles(array, bool(self.state & 1))
        in_string = bool(self.state & 2)
        places = np.flatnonzero((STEP[array] != 0) | (array == COMMA))
        places = places[outside(places, quotes, in_string)]
        steps = STEP[array[places]].astype(np.int64)
        before = self.depth + np.cumsum(steps) - steps
        wanted = np.where(
            steps > 0, before <= 1, np.where(steps < 0, (before == 1) | (before == 2), before == 2)
        )
        at = 0
        for place, step, depth in zip(places[wanted].tolist(), steps[wanted].tolist(), before[wanted].tolist(), strict=True):
            if step > 0:
                if depth == 1:
                    self.frame.append(data[at : place + 1])
                    at = place + 1
                    self.containers += 1
                    self.held, self.starts, self.opened = [], True, True
            elif depth == 2:
                self.held.append(data[at:place])
                closed = step < 0
                yield self._row(True, closed)
                self.held, self.starts, self.opened = [], not closed, False
                at = place if closed else place + 1
            else:
                self.frame.append(data[at : place + 1])
                self.over = True
                return
        self.depth += int(steps.sum())
        self.state = 2 * (in_string ^ (len(quotes) % 2 == 1)) + escaped
        (self.held if self.depth >= 2 else self.frame).append(data[at:])

    def close(self) -> Iterator[tuple]:
        """What is left at the end of the split."""
        if not self.over and self.depth >= 2 and (self.starts or any(self.held)):
            yield self._row(False, False)
        if frame := b"".join(self.frame):
            yield (
                self.path, self.split, 0, None, frame, None, None, None, None, self.containers
            )


KINDS = [
    pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.bool_(), pa.bool_(),
    pa.bool_(), pa.int32(),
]


def _cut(lines: DataFrame, mark: bool, begins: dict[tuple[str, int], tuple[int, int]]) -> DataFrame:
    """The pieces of all splits, of which ``begins`` has the beginning state and depth."""
    known = lines.sparkSession.sparkContext.broadcast(begins)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], names=NAMES
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, cutter = None, None
        for path, split, data in _chunks(batches, mark):
            if key != (path, split):
                if cutter is not None:
                    yield from cutter.close()
                key, cutter = (path, split), None
                if key in known.value:
                    state, depth = known.value[key]
                    cutter = Cutter(path, split, state, depth, over=depth < 1 and split > 0)
            if cutter is not None:
                yield from cutter.feed(data)
        if cutter is not None:
            yield from cutter.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row[4])
            if len(held) >= ROWS_AT_ONCE or size >= SCAN_BYTES:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return lines.mapInArrow(run, PIECES)


def compose(splits: Sequence) -> dict[tuple[str, int], tuple[int, int]]:
    """Where the splits of one document begin, in their order: state and depth.

    ``splits`` are rows of ``_scan`` with the ``length`` of the document. Fails if its
    brackets or strings do not close.
    """
    begins, state, depth = {}, 0, 0
    for row in splits:
        begins[row.path, row.split] = state, depth
        state, depth = row.ends[state], depth + row.steps[state]
    # The reader tells not whether a brace followed the last line, but the length does; it
    # leaves out a byte order mark of three bytes.
    extra = sum(row.bytes for row in splits) - splits[0].length
    missing = 1 if extra in (1, -2) else 0
    if state or depth != -missing:
        raise ValueError(f"{splits[0].path}: brackets or strings are not closed")
    return begins


def _lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    text = spark.read.option("lineSep", CLOSING).option("recursiveFileLookup", True)
    return text.text(literal_paths(list(paths.values()))).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("line"),
    )


def _unzipped(spark: SparkSession, lines: DataFrame, lengths: dict[str, int], folder: str) -> DataFrame:
    """The first member of each zip, as rows of at most ``PART_BYTES``, written to ``folder``.

    A zip can only be read from its start, so each is one task, which keeps it in a scratch file.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        for path, content in received(batches):
            content.truncate(lengths[path])
            archive = zipfile.ZipFile(content)
            with archive.open(archive.namelist()[0]) as stream:
                number = 0
                while data := stream.read(PART_BYTES):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": pa.array([path]),
                            "split": pa.array([number // SEGMENT_PARTS], pa.int64()),
                            "part": pa.array([number], pa.int64()),
                            "line": pa.array([data], pa.binary()),
                        }
                    )
                    number += 1

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number = None, 0
        for path, split, data in _chunks(batches, True):
            if path not in lengths:
                continue
            key, number = (path, split), number + 1 if key == (path, split) else 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([split], pa.int64()), pa.array([number], pa.int64()), pa.array([data], pa.binary())],
                names=["path", "split", "part", "line"],
            )

    fields = "path string, split bigint, part bigint, line binary"
    given = lines.mapInArrow(numbered, fields).repartition(len(lengths), "path")
    ordered = given.sortWithinPartitions("path", "split", "part").select("path", "line")
    ordered.mapInArrow(parts, fields).write.option("parquet.block.size", str(PART_BYTES * 16)).parquet(folder)
    written = spark.read.parquet(folder).repartition("path", "split")
    return written.sortWithinPartitions("path", "split", "part").select("path", "split", "line")


ROLES = "path string, roles array<string>, opened array<struct<split:bigint,n:int>>"


def _roles(frames: DataFrame) -> DataFrame:
    """The name of each container of a document, from the document around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = b"".join(part["data"] for part in row["parts"]).decode()
                fields = json.loads(text, object_pairs_hook=tuple)
                if not isinstance(fields, tuple):
                    raise ValueError(f"{row['path']}: not an object")
                # An empty object is now an empty tuple, and an empty list a list.
                names = [f"{name}[]" if v == [] else f"{name}{{}}" for name, v in fields if v in ([], ())]
                opened = [{"split": p["split"], "n": p["containers"]} for p in row["parts"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]]),
                        pa.array([names], pa.list_(pa.string())),
                        pa.array([opened], pa.list_(pa.struct([("split", pa.int64()), ("n", pa.int32())]))),
                    ],
                    names=["path", "roles", "opened"],
                )

    parts = F.sort_array(F.collect_list(F.struct("split", "data", "containers"))).alias("parts")
    return frames.groupBy("path").agg(parts).mapInArrow(run, ROLES)


def members(spark: SparkSession, path: str | Sequence[str], work: str | None = None) -> DataFrame:
    """The members of the lists and objects that the fields of JSON documents hold.

    A row for each: ``path``; ``role``, the field's name with ``[]`` or ``{}``; ``value``,
    the member's text; and ``only``, true if its container has no other, when a blank value
    means an empty container. Documents may have any size and stand in the first member
    of a zip. The pieces are written once to ``work``, or else below the shared checkpoint
    folder. A document whose brackets or strings do not close fails the read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = listed.load(path if isinstance(path, str) else list(path))
    files = files.select("path", F.col("_metadata.file_path").alias("uri"), "length").collect()
    paths = {f.uri: f.path for f in files}
    lengths = {f.uri: f.length for f in files}
    folder = f"{work or shared_folder(spark)}/json_{uuid.uuid4().hex}"

    def begins(found: DataFrame, total: dict[str, int] | None) -> tuple[dict, list[str]]:
        documents: dict[str, list] = {}
        zipped = set()
        for row in found.collect():
            documents.setdefault(row.path, []).append(row)
            if row.zipped and row.split == 0:
                zipped.add(row.path)
        places = {}
        for name, own in documents.items():
            if total is None or name not in zipped:
                own.sort(key=lambda r: r.split)
                length = total[name] if total else sum(r.bytes for r in own)
                places |= compose([_Split(*r, length) for r in own])
        return places, sorted(zipped)

    lines = _lines(spark, paths)
    places, zips = begins(_scan(lines, True), lengths)
    read = {name for name, _ in places} | set(zips)
    if missing := sorted(lengths.keys() - read):
        raise ValueError(f"no document in {missing}")
    frames = [_cut(lines, True, places)] if places else []
    if zips:
        unzipped = _unzipped(spark, lines, {z: lengths[z] for z in zips}, f"{folder}/unzipped")
        inside, _ = begins(_scan(unzipped, False), None)
        if missing := sorted(set(zips) - {name for name, _ in inside}):
            raise ValueError(f"no document in {missing}")
        frames.append(_cut(unzipped, False, inside))
    for number, frame in enumerate(frames):
        frame.write.option("parquet.block.size", str(16 << 20)).parquet(f"{folder}/pieces/kind={number}")
    pieces = spark.read.schema(PIECES).parquet(f"{folder}/pieces")

    roles = _roles(pieces.where("containers is not null").select("path", "split", "data", "containers"))
    held = pieces.where("containers is null").drop("containers")
    whole = held.where("starts and ends").select("path", "split", "container", "data", "opened", "closed")
    # At most two pieces of a split belong to members that reach over its ends.
    over = Window.partitionBy("path").orderBy("split", "seq")
    begun = F.last(F.when(F.col("starts"), F.struct("split", "container", "opened")), ignorenulls=True)
    chained = held.where("not (starts and ends)").withColumn("begun", begun.over(over))
    joined = chained.groupBy("path", "begun").agg(
        F.sort_array(F.collect_list(F.struct("split", "seq", "data"))).alias("parts"),
        F.bool_or("closed").alias("closed"),
    )
    data = F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["data"]))
    joined = joined.select("path", "begun.split", "begun.container", data.alias("data"), "begun.opened", "closed")
    number = F.col("container") + F.aggregate(
        "opened_before", F.lit(0), lambda n, o: n + F.when(o["split"] < F.col("split"), o["n"]).otherwise(0)
    )
    found = whole.unionByName(joined).join(roles.withColumnRenamed("opened", "opened_before"), "path")
    return found.select(
        "path",
        F.get("roles", number - 1).alias("role"),
        F.col("data").cast("string").alias("value"),
        (F.col("opened") & F.col("closed")).alias("only"),
    )


@dataclass(frozen=True)
class _Split:
    path: str
    split: int
    bytes: int
    zipped: bool
    ends: list[int]
    steps: list[int]
    length: int
