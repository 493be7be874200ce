"""Session-level helpers: shared scratch space, lineage cuts, checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A side is broadcast only after it was counted and found below both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


OPEN_FILES = 8
OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"
DROP_MOVED_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_ROWS = 10_000
BATCH_BYTES = 1 << 26


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds for some statements."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def rows_as_sorted(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """Tables that are written by partition here keep the order of their tasks' rows.

    Spark otherwise sorts a task's rows by the partition columns first. Where a task has one or a few
    partitions these are equal in nearly all comparisons, which then have to look into the rows. A task keeps up to
    ``files`` files open; if it has more partitions, Spark sorts its remaining rows.
    """
    with setting(spark, OPEN_FILES_KEY, str(files)):
        yield


@contextmanager
def batches_of_rows(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Arrow batches of rows that have up to ``most_bytes`` each are bounded by their number.

    A batch that is bounded by its bytes is measured anew at every row, which takes longer than to write a small row.
    """
    rows = max(1, min(BATCH_ROWS, BATCH_BYTES // most_bytes))
    with setting(spark, BATCH_ROWS_KEY, str(rows)), setting(spark, BATCH_BYTES_KEY, str((1 << 31) - 1)):
        yield


def write_table(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write a table that later steps read back.

    What was moved for it is dropped from the executors' disks as soon as it is there; Spark otherwise keeps shuffle files until
    the driver happens to collect its garbage, so that all moves of a long job add up.
    """
    writer = rows.write.option("compression", "zstd")
    with setting(rows.sparkSession, DROP_MOVED_KEY, "true"):
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared checkpoint folder."""
    path = scratch_path(rows.sparkSession, name)
    write_table(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or set on the context.

    It has to be one that the driver and all executors share, so none is made up here.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured and context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    if context.getCheckpointDir() is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(stored: DataFrame) -> tuple[int, int]:
    """Rows and about the bytes of a stored table: one distributed count."""
    width = F.lit(8 * len(stored.columns))
    for field in stored.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    size = stored.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"], size["bytes"]


def is_small(stored: DataFrame) -> bool:
    """Whether a stored table is below both broadcast bounds."""
    rows, size = measured(stored)
    return rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES
