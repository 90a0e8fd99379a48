"""Quarterly zip archives of ``$``-separated text.

Python only unzips: a task gets an archive in parts, keeps it in a scratch file,
and writes the text of its members in bounded chunks into a table in the shared folder, once for all wanted tables. That table
is read like any other, so cutting lines, splitting, naming and typing columns
is Spark SQL in as many tasks as the text needs, and a lost executor does not
unzip anything again. What passes through the driver is one small row per
archive and table (its header and status).
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import shared_folder

# Archive naming, text layout and member selection.
ARCHIVE_NAME = r"faers_ascii_(\d{4})[qQ]([1-4])[^/]*\.zip$"
QUARTER_IN_PATH = r"faers_ascii_(\d{4})[qQ]([1-4])"
SEPARATOR = "$"
ENCODING = "ISO-8859-1"
MEMBER_ENDING = ".txt"
IGNORED_FOLDER = "__MACOSX"

CHUNK_BYTES = 128 << 10
"""Unzipped bytes a task holds at a time, but for a line that is longer.

They are a row of the written table, whose reader holds many rows at once.
"""
ROW_GROUP_BYTES = 16 << 20
PART_BYTES = 16 << 10
"""Bytes of an archive in one row on the way to its task; a batch has up to 10,000 rows."""

DAMAGE = (
    zipfile.BadZipFile, zlib.error, EOFError, ValueError, NotImplementedError, RuntimeError,
)
"""What unreadable archives raise; failures to reach one are left to Spark's retries."""

UNZIPPED = """path string, table_name string, text string, member string, header string,
    status string, error string"""
NAMES = ["path", "table_name", "text", "member", "header", "status", "error"]


def quarter_columns(path: Column) -> list[Column]:
    """Year and quarter from an archive's path."""
    return [
        F.regexp_extract(path, QUARTER_IN_PATH, group).try_cast("int").alias(name)
        for group, name in ((1, "src_year"), (2, "src_quarter"))
    ]


def literal_paths(paths: Sequence[str]) -> list[str]:
    """Paths in which nothing is taken for a pattern."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]


def list_archives(spark: SparkSession, landing: str | Sequence[str]) -> DataFrame:
    """The landed archives with their quarter, size and time, whatever the year.

    ``landing`` is a folder or a list of archives. A folder without any gives no rows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(literal_paths([landing] if isinstance(landing, str) else landing))
        .select("path", "modificationTime", "length", *quarter_columns(F.col("path")))
    )
    return files.filter(F.col("path").rlike(ARCHIVE_NAME))


def choose_member(names: Sequence[str], table: str, skip_ignored: bool = True) -> str | None:
    """The first text member whose name contains the table's name."""
    for name in names:
        if skip_ignored and name.startswith(IGNORED_FOLDER):
            continue
        if table.lower() in name.lower() and name.lower().endswith(MEMBER_ENDING):
            return name
    return None


def _chunks(archive: zipfile.ZipFile, member: str) -> Iterator[str]:
    """The text of a member in pieces that end where a line ends."""
    open_line: list[bytes] = []
    with archive.open(member) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            cut = chunk.rfind(b"\n")
            if cut < 0:
                open_line.append(chunk)
                continue
            yield b"".join([*open_line, chunk[:cut]]).decode(ENCODING)
            open_line = [chunk[cut + 1 :]]
    if rest := b"".join(open_line):
        yield rest.decode(ENCODING)


def _below_header(chunks: Iterator[str]) -> Iterator[tuple[str, str | None]]:
    """The header, which is the first line that is not blank, with the text below it."""
    header = None
    for chunk in chunks:
        if header is not None:
            yield header, chunk
            continue
        lines = chunk.lstrip("\r\n")
        if lines:
            first, newline, below = lines.partition("\n")
            header = first.removesuffix("\r")
            yield header, below if newline else None


def _rows(path: str, table: str, **values: str | None) -> pa.RecordBatch:
    row = {"path": path, "table_name": table, **values}
    return pa.RecordBatch.from_arrays(
        [pa.array([row.get(name)], pa.string()) for name in NAMES], names=NAMES
    )


def _member_rows(path: str, content: IO[bytes], table: str) -> Iterator[pa.RecordBatch]:
    """The text of an archive's member, and after it the row with its status."""
    found: dict[str, str | None] = {"status": "NO_MEMBER"}
    try:
        archive = zipfile.ZipFile(content)
        found["member"] = choose_member(archive.namelist(), table)
        if found["member"] is not None:
            found["status"] = "EMPTY"
            for header, text in _below_header(_chunks(archive, found["member"])):
                found.update(status="LOADED", header=header)
                if text is not None:
                    yield _rows(path, table, text=text)
    except DAMAGE as problem:
        found.update(status="LOAD_FAILED", error=str(problem))
    yield _rows(path, table, **found)


PARTS = "path string, block bigint, part bigint, data binary"


def _parts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The bytes of archives of any size, as rows that can be put in order again.

    ``paths`` has the path for each URI. Spark's text reader cuts a file at the byte
    of a newline and hands over all others as they are. After the last line a
    newline stands here whether the file has it or not; the length tells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number = None, 0
        for batch in batches:
            keys = zip(batch.column("uri").to_pylist(), batch.column("block").to_pylist(), strict=True)
            start = 0
            for key, same in groupby(keys):
                stop = start + sum(1 for _ in same)
                lines = batch.column("line").slice(start, stop - start).to_pylist()
                start = stop
                if key != file:
                    file, number = key, 0
                data = b"\n".join([*lines, b""])
                cuts = [data[at : at + PART_BYTES] for at in range(0, len(data), PART_BYTES)]
                n = len(cuts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array([paths[key[0]]] * n, pa.string()),
                        "block": pa.array([key[1]] * n, pa.int64()),
                        "part": pa.array(range(number, number + n), pa.int64()),
                        "data": pa.array(cuts, pa.binary()),
                    }
                )
                number += n

    lines = spark.read.option("lineSep", "\n").text(literal_paths(list(paths.values()))).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    return lines.mapInArrow(run, PARTS)


def received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, IO[bytes]]]:
    """Path and scratch file of each file whose bytes come in order: path first, data last.

    The file is gone when the next one is asked for. Rows without data only name a file.
    """
    path, content = None, None
    for batch in batches:
        paths, data = batch.column(0).to_pylist(), batch.column(batch.num_columns - 1)
        for own, part in zip(paths, data, strict=True):
            if own != path:
                if content is not None:
                    yield path, content
                    content.close()
                path, content = own, tempfile.TemporaryFile()
            if part.is_valid:
                content.write(part.as_buffer())
    if content is not None:
        yield path, content
        content.close()


def unzip_archives(
    spark: SparkSession,
    landing: str | Sequence[str],
    wanted: str | Sequence[str],
    work: str | None = None,
) -> DataFrame:
    """The text of the wanted tables of all archives, with their status.

    Each archive is opened once for all tables. Every archive, whatever its size, is
    read by Spark's own file reader, so its storage settings hold and paths need no
    second form. Its bytes go in small parts to one task, which keeps them in a
    scratch file of its own while it unzips them; so besides the shuffle an executor
    needs room for an archive on disk, and never in memory. The rows are written once to
    ``work``, or else below the shared checkpoint folder; ``remove_unzipped`` deletes them.
    Damage may show up only at the end of a member, so the status row comes last:
    LOADED, EMPTY (no line in the member), NO_MEMBER or LOAD_FAILED.
    """
    names = [wanted] if isinstance(wanted, str) else list(wanted)
    # One row for each archive, a few hundred for decades of quarters.
    files = list_archives(spark, landing).select("path", "_metadata.file_path", "length").collect()
    if not files:
        raise ValueError(f"no archive in {landing}")
    lengths = {f.path: f.length for f in files}

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, content in received(batches):
            content.truncate(lengths[path])
            content.flush()
            for table in names:
                yield from _member_rows(path, content, table)

    folder = f"{work or shared_folder(spark)}/unzipped_{uuid.uuid4().hex}"
    # A row for each archive, also for one without bytes.
    named = spark.createDataFrame([(f.path, -1, 0, None) for f in files], PARTS)
    parts = named.unionByName(_parts(spark, {f.file_path: f.path for f in files}))
    ordered = parts.repartition(len(files), "path").sortWithinPartitions("path", "block", "part")
    unzipped = ordered.mapInArrow(unzip, UNZIPPED)
    # A reader holds a row group of each of its tasks at once, several times.
    unzipped.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(folder)
    return spark.read.parquet(folder)


def remove_unzipped(unzipped: DataFrame) -> None:
    """Delete the files written by ``unzip_archives`` once their rows are stored elsewhere."""
    spark = unzipped.sparkSession
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for folder in {file.rpartition("/")[0] for file in unzipped.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def _lines(unzipped: DataFrame) -> DataFrame:
    """One row per line below the header; a blank line is a row."""
    texts = unzipped.filter(F.col("text").isNotNull())
    line = F.explode(F.split("text", "\n", -1)).alias("line")
    lines = texts.select("path", "table_name", line)
    return lines.withColumn("line", F.regexp_replace("line", r"\r$", ""))


def archive_status(unzipped: DataFrame) -> DataFrame:
    """For each archive and table the member, header, row count, status and error."""
    found = unzipped.filter(F.col("status").isNotNull()).drop("text")
    counts = _lines(unzipped).groupBy("path", "table_name").count()
    rows = F.when(F.col("status") == "LOADED", F.coalesce("count", F.lit(0))).otherwise(0)
    counted = found.join(counts, ["path", "table_name"], "left")
    return counted.select(
        *found.columns, rows.alias("row_count"), *quarter_columns(F.col("path"))
    )


def newest_readable(status: DataFrame, times: DataFrame) -> DataFrame:
    """K2: the newest readable archive of each quarter and table, by landing time.

    ``times`` has ``path`` and ``modificationTime``.
    """
    newest = Window.partitionBy("table_name", "src_year", "src_quarter").orderBy(
        F.desc("modificationTime"), F.desc("path")
    )
    readable = status.filter("status = 'LOADED'").join(times.select("path", "modificationTime"), "path")
    ranked = readable.withColumn("age_rank", F.row_number().over(newest))
    return ranked.filter("age_rank = 1").drop("age_rank")


def column_names(header: str) -> list[str]:
    """The names in a header line; a repeated name is numbered."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for name in header.split(SEPARATOR):
        repeats = seen.get(name.lower())
        seen[name.lower()] = 0 if repeats is None else repeats + 1
        names.append(name if repeats is None else f"{name}_duplicated_{repeats}")
    return names


def _union_names(headers: Sequence[str], from_first: bool) -> list[str]:
    """The named columns of all headers, matched ignoring case, in order of appearance."""
    found: dict[str, str] = {}
    for header in headers[:1] if from_first else headers:
        for name in column_names(header):
            if name:
                found.setdefault(name.lower(), name)
    return list(found.values())


def split_by_headers(
    lines: DataFrame, headers: Sequence[tuple[str, str]], from_first: bool = False
) -> DataFrame:
    """Lines of files with different headers to one table, in one pass.

    ``headers`` has a path and its header for each file, in order. A line is
    split once; a small table tells where each column stands in the lines of
    its file. There is no quoting. Empty fields, fields a short line lacks and
    columns a header lacks are null; fields beyond the header and fields without
    a name are dropped.
    """
    union = _union_names([header for _, header in headers], from_first)
    places = []
    for path, header in headers:
        at = {name.lower(): i for i, name in enumerate(column_names(header)) if name}
        places.append((path, [at.get(name.lower(), -1) for name in union]))
    layout = lines.sparkSession.createDataFrame(places, "path string, places array<int>")
    fields = F.split("line", r"\$", -1).alias("fields")
    split = lines.join(layout, "path").select("path", "places", fields)

    def column(i: int) -> Column:
        place = F.get("places", F.lit(i))
        return F.when(place >= 0, F.nullif(F.get("fields", place), F.lit("")))

    return split.select(
        *[column(i).alias(name) for i, name in enumerate(union)],
        *quarter_columns(F.col("path")),
    )


def split_columns(lines: DataFrame, header: str) -> DataFrame:
    """Lines to string columns by position.

    There is no quoting. Empty fields and fields a short line lacks are null,
    fields beyond the header and fields without a name are dropped.
    """
    fields = F.split("line", r"\$", -1).alias("fields")
    return lines.select("path", fields).select(
        *[
            F.nullif(F.get("fields", F.lit(position)), F.lit("")).alias(name)
            for position, name in enumerate(column_names(header))
            if name
        ],
        *quarter_columns(F.col("path")),
    )


def learned_header(status: DataFrame) -> list[str]:
    """S3: the column names of the newest readable archive."""
    newest = (
        status.filter("status = 'LOADED'")
        .orderBy(F.desc("src_year"), F.desc("src_quarter"))
        .select("header")
        .first()
    )
    if newest is None:
        raise ValueError("no readable archive to learn the columns from")
    return column_names(newest.header)


def archive_table(
    unzipped: DataFrame, table: str, paths: DataFrame | None = None, from_first: bool = False
) -> DataFrame:
    """One table out of the text of all readable archives.

    Every column is a string and the result has every column of every quarter.
    ``paths`` names the archives to use (one per quarter, as ``newest_readable``
    gives them). ``from_first`` keeps only the columns of the earliest quarter
    (S11, Q13). A damaged archive gives no rows at all.
    """
    own = unzipped.filter(F.col("table_name") == table)
    readable = own.filter("status = 'LOADED'").select(
        "path", "header", *quarter_columns(F.col("path"))
    )
    if paths is not None:
        readable = readable.join(paths.select("path"), "path", "left_semi")
    rows = readable.orderBy("src_year", "src_quarter", "path").collect()
    if not rows:
        raise ValueError("no readable archive")
    headers = [(row.path, row.header) for row in rows]
    return split_by_headers(_lines(own), headers, from_first)


def read_archives(
    spark: SparkSession,
    landing: str | Sequence[str],
    table: str,
    from_first: bool = False,
    work: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Unzip the archives and read one of their tables.

    Of several archives of a quarter the newest readable one counts. ``years``
    limits the quarters to a first and last year; without it all count.
    """
    unzipped = unzip_archives(spark, landing, table, work)
    status = unzipped.filter(F.col("status").isNotNull()).select(
        "path", "table_name", "status", *quarter_columns(F.col("path"))
    )
    if years is not None:
        status = status.filter(F.col("src_year").between(*years))
    chosen = newest_readable(status, list_archives(spark, landing))
    return archive_table(unzipped, table, chosen, from_first)


def read_text_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S1, U1 for unzipped members, which Spark can split into many tasks.

    Lines are cut and named as for archives: the first line that is not blank
    is the header, and blank lines below it are rows. All headers are found in
    one scan and all lines are split in another.
    """
    raw = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        # The reader keeps the bytes of a line as they are.
        F.regexp_replace(F.decode(F.col("value").cast("binary"), ENCODING), r"\r$", "").alias("line"),
    )
    headers = (
        raw.withColumn("row", F.monotonically_increasing_id())
        .filter((F.col("block") == 0) & (F.col("line") != ""))
        .groupBy("path")
        .agg(F.min_by("line", "row").alias("header"))
        .select("path", "header", *quarter_columns(F.col("path")))
        .orderBy("src_year", "src_quarter", "path")
        .collect()
    )
    known = [(row.path, row.header) for row in headers]
    first = spark.createDataFrame(known, "path string, header string")
    lines = raw.join(first, "path").filter("line != header").select("path", "line")
    return split_by_headers(lines, known)
