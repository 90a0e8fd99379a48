"""Tables in and out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet with the schema of its footer."""
    return spark.read.parquet(*paths)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir or pass a shared folder")
    return folder


def read_csv(spark: SparkSession, *paths: str, infer_types: bool = True) -> DataFrame:
    """Comma-separated text with a header and optional double quotes.

    Inferring types reads the data twice; all columns are strings without it.
    """
    return spark.read.csv(
        list(paths), header=True, sep=",", quote='"', inferSchema=infer_types
    )


def source(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A table by name."""
    return spark.table(f"{schema}.{name}" if schema else name)


def conform(frame: DataFrame, template: StructType) -> DataFrame:
    """The template's columns, matched by name ignoring case.

    Extra columns are dropped, absent ones are null, and a value that does not
    fit the template's type is null.
    """
    present = {field.name.lower(): field for field in frame.schema.fields}
    columns = []
    for wanted in template.fields:
        found = present.get(wanted.name.lower())
        if found is None:
            column = F.lit(None).cast(wanted.dataType)
        elif found.dataType == wanted.dataType:
            column = F.col(found.name)
        else:
            column = F.col(found.name).try_cast(wanted.dataType)
        columns.append(column.alias(wanted.name))
    return frame.select(*columns)


def template_union(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames in the shape of the first."""
    template = frames[0].schema
    return reduce(
        DataFrame.unionByName, [conform(frame, template) for frame in frames]
    )


def load_from_template(
    spark: SparkSession, paths: Sequence[str], tolerant: bool = False
) -> DataFrame:
    """Many Parquet files in the shape of the first, in one scan.

    The reader itself matches columns by name ignoring case, fills absent ones
    with null and skips extra ones. Use ``template_union`` where types differ.
    ``tolerant`` skips what is damaged, which ``parquet_load_status`` then tells (S12).
    """
    template = spark.read.parquet(paths[0]).schema
    reader = spark.read.schema(template).option("ignoreCorruptFiles", tolerant)
    return reader.parquet(*paths)


def diagonal_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name ignoring case; columns a frame lacks are null."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )


def _location(path: Column) -> Column:
    """A path in one spelling, whatever number of slashes follows its scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+:)/+", "$1/")


LARGEST_FILE = (1 << 31) - 1024
"""Spark's reader of whole files hands over no larger one."""


def _readable_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files among ``paths`` whose footer can be read. Meant for files without rows."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for file, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    pq.read_metadata(pa.BufferReader(content))
                    good.append(file)
                except (pa.ArrowException, OSError):
                    pass
            yield pa.RecordBatch.from_arrays([pa.array(good, pa.string())], names=["file"])

    files = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(list(paths))
    small = files.filter(F.col("length") <= LARGEST_FILE)
    chosen = small.select(_location(F.col("_metadata.file_path")).alias("file"), "content")
    return chosen.mapInArrow(check, "file string")


def parquet_load_status(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Status and row counts of each of many Parquet files, in the shape of the first.

    The rows a file should have come from its footer, and the rows loaded from
    decoding all its columns, so a file that is damaged below its footer is
    PARTIALLY_LOADED. A file without rows is LOADED if its footer can be read and
    LOAD_FAILED otherwise; only such files are opened once more.
    """
    rows = load_from_template(spark, paths, tolerant=True)
    file = _location(F.col("_metadata.file_path")).alias("file")
    # Counting no column reads footers alone; combining the hashes of all columns decodes them.
    expected = rows.groupBy(file).agg(F.count("*").alias("rows_parsed"))
    every = F.bit_xor(F.xxhash64(*rows.columns))
    decoded = F.when(every.isNotNull(), F.count("*")).alias("rows_loaded")
    files = spark.read.format("binaryFile").load(list(paths))
    listed = files.select(file, F.col("path"))
    counted = listed.join(expected, "file", "left").join(rows.groupBy(file).agg(decoded), "file", "left")
    counted = counted.na.fill(0, ["rows_parsed", "rows_loaded"])
    empty = [row.path for row in counted.filter("rows_parsed = 0").select("path").collect()]
    sound = F.lit(False)
    if empty:
        good = _readable_footers(spark, empty).withColumn("sound", F.lit(True))
        counted, sound = counted.join(good, "file", "left"), F.coalesce("sound", F.lit(False))
    status = (
        F.when((F.col("rows_parsed") == 0) & sound, "LOADED")
        .when(F.col("rows_loaded") == 0, "LOAD_FAILED")
        .when(F.col("rows_loaded") < F.col("rows_parsed"), "PARTIALLY_LOADED")
        .otherwise("LOADED")
    )
    return counted.select("file", status.alias("status"), "rows_parsed", "rows_loaded")


def malformed_csv(schema: str, value: Column, **options: str) -> Column:
    """A line of text that does not fit the columns of a schema."""
    fields = F.from_csv(value, f"{schema}, _bad_line string", {**options, "columnNameOfCorruptRecord": "_bad_line"})
    return fields["_bad_line"].isNotNull()


def malformed_json(schema: str, value: Column) -> Column:
    """A line that is not a JSON object whose fields fit a schema."""
    fields = F.from_json(value, f"{schema}, _bad_line string", {"columnNameOfCorruptRecord": "_bad_line"})
    return fields["_bad_line"].isNotNull()


def bad_lines(
    spark: SparkSession,
    paths: Sequence[str],
    bad: Callable[[Column], Column],
    header: bool = False,
    parts: bool = False,
) -> DataFrame:
    """For each text file its lines, how many are bad, and the number of the first one.

    Lines are numbered from 1, blank lines and a header included; a header is never bad.
    A file is read in as many splits as it has. Each split counts its lines and finds the
    place of its first bad one; what comes before it in the file is the sum over the splits
    before, so nothing but a row for each split is put in order. Files without lines have
    no row. With ``parts`` the files of a folder are one text in the order of their names, as
    Spark's writers number them, so that a large text need not be written by one task; a
    header then stands in each of them, and ``file`` is the folder.
    """
    lines = spark.read.text(list(paths)).select(
        _location(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # Within a split these go up by one from line to line.
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    flagged = lines.select("file", "split", "row", F.coalesce(bad(F.col("value")), F.lit(False)).alias("bad"))
    first, first_bad = F.min("row"), F.min(F.when(F.col("bad"), F.col("row")))
    if header:
        opening = flagged.groupBy("file", "split").agg(first.alias("opening"))
        flagged = flagged.join(opening, ["file", "split"]).withColumn(
            "bad", F.col("bad") & ~((F.col("split") == 0) & (F.col("row") == F.col("opening")))
        )
    splits = flagged.groupBy("file", "split").agg(
        F.count("*").alias("lines"),
        F.count_if("bad").alias("bad"),
        (first_bad - first + 1).alias("place"),
    )
    order = ["split"]
    if parts:
        name = F.substring_index("file", "/", -1)
        folder = F.regexp_replace("file", "/[^/]*$", "")
        splits = splits.withColumns({"size": F.length(name), "part": name, "file": folder})
        # A number of more digits than others is longer.
        order = ["size", "part", "split"]
    before = F.sum("lines").over(
        Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = splits.withColumn("place", F.col("place") + F.coalesce(before, F.lit(0)))
    return placed.groupBy("file").agg(
        F.sum("lines").alias("lines"),
        F.sum("bad").alias("bad_lines"),
        F.min("place").alias("first_bad_line"),
    )


def load_status(
    rows: DataFrame,
    listed: DataFrame | None = None,
    corrupt: str = "_corrupt_record",
    places: DataFrame | None = None,
) -> DataFrame:
    """Status and row counts of each file of a tolerant read of text.

    ``rows`` still has the file's ``_metadata`` and the corrupt-record column,
    whose rows count as not loaded. ``listed`` names the files by ``path``; one
    that gave no row is LOADED, with 0 rows, if its length is 0 and LOAD_FAILED
    otherwise. Rows are counted in the map tasks, so one large file is not one task.
    With ``places``, as ``bad_lines`` gives them, there is ``first_bad_line`` too.
    """
    # Naming every column makes the reader parse, and so judge, all of them.
    fields = [F.col(name).cast("string") for name in rows.columns if name != corrupt]
    bad = F.col(corrupt).isNotNull() & (F.length(F.concat_ws("", *fields)) >= 0)
    counted = rows.groupBy(_location(F.col("_metadata.file_path")).alias("file")).agg(
        F.count("*").alias("rows_parsed"), F.count_if(~bad).alias("rows_loaded")
    )
    empty = F.lit(False)
    if listed is not None:
        length = F.col("length") if "length" in listed.columns else F.lit(-1)
        files = listed.select(_location(F.col("path")).alias("file"), length.alias("length"))
        counted = files.join(counted, "file", "left").na.fill(0, ["rows_parsed", "rows_loaded"])
        empty = (F.col("rows_parsed") == 0) & (F.col("length") == 0)
    status = (
        F.when(empty, "LOADED")
        .when(F.col("rows_loaded") == 0, "LOAD_FAILED")
        .when(F.col("rows_loaded") < F.col("rows_parsed"), "PARTIALLY_LOADED")
        .otherwise("LOADED")
    )
    told = counted.select("file", status.alias("status"), "rows_parsed", "rows_loaded")
    if places is not None:
        told = told.join(places.select("file", "first_bad_line"), "file", "left")
    return told


def write_parquet(frame: DataFrame, path: str) -> None:
    """K1: replace a Parquet data set."""
    frame.write.mode("overwrite").parquet(path)


def write_quarters(
    frame: DataFrame, path: str, watch: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """K2: one partition per quarter; only the quarters present are replaced.

    The rebalance hint gathers the rows of a quarter into files of even size
    and lets adaptive execution split a quarter that is much larger than the
    others. ``watch`` may observe the rows in the tasks that write them.
    """
    keys = ("src_year", "src_quarter")
    rows = frame.hint("rebalance", *keys)
    (
        (watch(rows) if watch else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_quarters(spark: SparkSession, path: str) -> DataFrame:
    """The quarters written by ``write_quarters``, with the columns of them all.

    A filter on ``src_year`` or ``src_quarter`` reads only those partitions.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def save_table(
    frame: DataFrame, name: str, schema: str = "marts", partition_by: Sequence[str] = ()
) -> DataFrame:
    """K3, K5: create or replace ``schema.name`` and return it as a table.

    Reading the written table back also ends the lineage: what is built on it
    does not recompute it, and a lost executor costs only its own tasks.
    """
    spark = frame.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    writer = frame.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"{schema}.{name}")
    return spark.table(f"{schema}.{name}")


def save_buckets(
    frame: DataFrame, name: str, key: str, buckets: int, schema: str = "marts"
) -> DataFrame:
    """K5: a table in sorted buckets of a key; two of equal buckets join without a shuffle.

    A key is in one bucket however many rows it has, so those of hot keys belong elsewhere.
    """
    spark = frame.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    # Dealt by the hash that buckets go by, so each bucket is one file.
    writer = frame.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{schema}.{name}")
    return spark.table(f"{schema}.{name}")


def save_views(frames: Mapping[str, DataFrame]) -> None:
    """K4: register lazy frames by name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def to_client(report: DataFrame):
    """K6: a report result as an Arrow table. Meant for results of a few rows."""
    return report.toArrow()
