"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"
"""A word: anything between ASCII white space."""

LOCAL_CHECKPOINTS = "/tmp/checkpoints"
"""Where checkpoints go when no folder is named and all runs on one machine, as in tests."""

ROWS_AT_ONCE = 300
"""Rows of a batch that are worked on, and sent back, together."""

BatchFunction = Callable[[pa.RecordBatch], Sequence[pa.Array]]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        folder = LOCAL_CHECKPOINTS
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    This cuts the lineage: what follows neither recomputes it nor depends on
    the executors that made it, and its true size is known to the planner.
    """
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes the files of materialized frames that nothing reads any more."""
    for frame in frames:
        jvm = frame.sparkSession._jvm
        conf = frame.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


ArrowFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(run: ArrowFunction) -> ArrowFunction:
    """The function, which at its end gives what it held back to the system.

    Python workers live on for tasks of other stages, beside whose memory theirs counts.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                # Only the GNU library has it.
                pass

    return own


def add_columns(
    frame: DataFrame,
    fields: str | StructType,
    prepare: Callable[[], BatchFunction],
    drop: Sequence[str] = (),
) -> DataFrame:
    """The frame with columns computed from Arrow batches.

    ``prepare`` runs once in each task and returns the function of a batch. New
    columns replace old ones of the same name (ignoring case); ``drop`` names columns that the
    function reads and the result leaves out.
    """
    added = StructType.fromDDL(fields) if isinstance(fields, str) else fields
    new, dropped = {f.name.lower() for f in added.fields}, set(drop)
    kept = [
        (i, f)
        for i, f in enumerate(frame.schema.fields)
        if f.name.lower() not in new and f.name not in dropped
    ]
    places = [i for i, _ in kept]
    schema = StructType([f for _, f in kept] + added.fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                columns = [part.column(i) for i in places]
                yield pa.RecordBatch.from_arrays([*columns, *function(part)], names=names)

    return frame.mapInArrow(released(run), schema)


FILTER_WORDS = 1 << 20
"""64-bit words of a filter, whatever the number of its values."""
CHUNK_WORDS = 1 << 13
"""Words that come to the driver as one value."""


def filter_of(values: DataFrame, name: str) -> np.ndarray:
    """A filter of fixed size (8 MB) for a column of evenly spread 64-bit numbers.

    It passes every value it was made from, and others by chance. It only spares
    work before an exact join: a filter with too many values passes them all.
    """
    word = F.pmod(F.col(name), F.lit(FILTER_WORDS)).cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({name}, 58) as int))").alias("bit")
    found = values.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            words, bits = batch.column("word").to_numpy(), batch.column("bits").to_numpy()
            for chunk in np.unique(words // CHUNK_WORDS).tolist():
                own = words // CHUNK_WORDS == chunk
                held = chunks.setdefault(chunk, np.zeros(CHUNK_WORDS, np.int64))
                held[words[own] % CHUNK_WORDS] = bits[own]
        packed = [held.tobytes() for held in chunks.values()]
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(list(chunks), pa.int32()), "packed": pa.array(packed, pa.binary())}
        )

    chunked = found.withColumn("chunk", F.expr(f"word div {CHUNK_WORDS}")).repartition("chunk")
    rows = chunked.select("word", "bits").mapInArrow(released(pack), "chunk int, packed binary").collect()
    filled = np.zeros((FILTER_WORDS // CHUNK_WORDS, CHUNK_WORDS), np.int64)
    for chunk, packed in rows:
        filled[chunk] = np.frombuffer(packed, np.int64)
    return filled.reshape(-1).view(np.uint64)


def passes(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether a filter passes 64-bit numbers."""
    word = (values.view(np.uint64) & np.uint64(FILTER_WORDS - 1)).astype(np.int64)
    bit = values.view(np.uint64) >> np.uint64(58)
    return (words[word] >> bit & np.uint64(1)).astype(bool)


def remainder(key: Column, of: int = 4) -> Column:
    """crc32 of the id as text, modulo ``of``; null ids count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of


def held_out(key: Column) -> Column:
    """True for the rows no model learns from."""
    return remainder(key) == 2


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column with nulls as empty texts."""
    return [t or "" for t in batch.column(name).to_pylist()]
