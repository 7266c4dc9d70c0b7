"""Makes the package importable on executors."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application, once."""
    context = spark.sparkContext
    if context.applicationId in _done:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="kinfold-"), "kinfold.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(_PACKAGE):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    _done.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
