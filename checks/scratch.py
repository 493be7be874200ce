"""What sessions of test and correctness runs may lack: a scratch folder, the package on the workers' path."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def name_scratch(spark: SparkSession) -> None:
    """Set a checkpoint folder where neither the session nor its context has one and all runs in one process."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() is not None:
        return
    if context.master.startswith("local-cluster") or not context.master.startswith("local"):
        return  # the package asks for a shared folder
    context.setCheckpointDir(tempfile.mkdtemp(prefix="acervo-checkpoint-"))


_shipped: set[int] = set()


def ship_package(spark: SparkSession, root: str) -> None:
    """Send the package to workers that would not find it by their path or working folder."""
    context = spark.sparkContext
    places = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if id(context) in _shipped or root in map(os.path.abspath, [os.getcwd(), *filter(None, places)]):
        return
    folder = tempfile.mkdtemp(prefix="acervo-package-")
    packed = shutil.make_archive(os.path.join(folder, "acervo"), "zip", root, "acervo")
    context.addPyFile(packed)
    _shipped.add(id(context))


def with_scratch(query: Query, root: str) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name_scratch(spark)
        ship_package(spark, root)
        return query(spark, sf_dir)

    return run
