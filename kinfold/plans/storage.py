"""Tables that cut lineage."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="kinfold-", ignore_cleanup_errors=True)  # gone when the driver ends


def folder(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir, or one of our own where that is unset (local runs)."""
    return (spark.conf.get("spark.checkpoint.dir", None) or _own().name).rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder, and read back. The folder's owner clears it, as lazy results still read it."""
    path = f"{folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
