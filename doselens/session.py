"""Session settings for large runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 256 << 20
"""Aimed size of a shuffle partition; it should fit a task's share of memory."""

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * PARTITION_BYTES),
    "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    # Rows take several times their size in Parquet; the broadcast limit should see that.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions of the aimed size, at least one for each core.

    Adaptive execution joins partitions that turn out small, so it is better to
    ask for too many than for too few.
    """
    return max(cores, -(-shuffled_bytes // PARTITION_BYTES))


def build_session(
    name: str, shuffled_bytes: int, cores: int, work: str | None = None, warehouse: str | None = None
) -> SparkSession:
    """A session sized for the bytes its largest shuffle moves.

    ``work`` and ``warehouse`` are folders that the whole cluster shares.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if work is not None:
        builder = builder.config("spark.checkpoint.dir", work)
    if warehouse is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    partitions = shuffle_partitions(shuffled_bytes, cores)
    return builder.config("spark.sql.shuffle.partitions", str(partitions)).getOrCreate()
