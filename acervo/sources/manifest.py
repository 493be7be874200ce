"""Versions of a stored table set, published by one row that is written last.

A store is a folder with a ``manifest`` table and one folder per version. A
version counts once its manifest row is there; that row is a single file, which
the commit of its job moves into place, so readers see a whole version or none.
One writer at a time may save to a store.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest of a store, or nothing where none has been saved."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def latest(spark: SparkSession, path: str) -> list[Row]:
    """The rows of the newest version; none for a new store. A version has few rows, whatever its data."""
    manifest = versions(spark, path)
    if manifest is None:
        return []
    newest = manifest.agg(F.max("version").alias("version")).first()["version"]
    return manifest.filter(F.col("version") == newest).collect()


def new_folder(path: str) -> str:
    return f"{path}/versions/{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, rows: list[dict], schema: str, before: list[Row]) -> None:
    """Make ``rows`` the newest version of the store; ``before`` is the one they were made from."""
    version = before[0]["version"] + 1 if before else 1
    table = spark.createDataFrame([(version, *row.values()) for row in rows], f"version long, {schema}")
    table.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
