"""Query batches from text files, one query per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acervo.operators.index import with_dense_ids


def read_query_file(spark: SparkSession, path: str) -> DataFrame:
    """``queries(query_id, line)``, numbered in file and line order."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return with_dense_ids(lines, "file", "start", "row", name="query_id").select(
        "query_id", "line"
    )
