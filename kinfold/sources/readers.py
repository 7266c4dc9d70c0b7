"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

#: Type and bytes of column types, by Spark's name for them.
SIZES = {"boolean": ("boolean", 1), "tinyint": ("integer", 1), "smallint": ("integer", 2), "int": ("integer", 4), "bigint": ("integer", 8), "float": ("numeric", 4), "double": ("numeric", 8), "date": ("date", 4), "timestamp": ("datetime", 8), "timestamp_ntz": ("datetime", 8), "string": ("string", None), "binary": ("container", None)}


def from_rows(spark: SparkSession, rows: list[list] | pd.DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cases given as lists of lists or as a pandas frame."""
    return spark.createDataFrame(rows, columns) if columns else spark.createDataFrame(rows)


def delimited(spark: SparkSession, path: str, separator: str = ",", schema: str | T.StructType | None = None, header: bool = True) -> DataFrame:
    reader = spark.read.option("sep", separator).option("header", header)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A file, or a folder with partitions in its path names."""
    return spark.read.parquet(path)


def documents(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A collection of JSON documents, one per line."""
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def sql_table(spark: SparkSession, name: str, url: str | None = None, **options) -> DataFrame:
    """A table of the catalog, or of a database over JDBC."""
    return spark.read.jdbc(url, name, properties=options) if url else spark.table(name)


def datastore(spark: SparkSession, names: Iterable[str], url: str | None = None, **options) -> dict[str, DataFrame]:
    return {n: sql_table(spark, n, url, **options) for n in names}


def column_type(kind: T.DataType) -> tuple[str, int | None]:
    """(physical type, bytes); decimals are numeric, nested types containers."""
    if isinstance(kind, T.DecimalType):
        return "numeric", 16 if kind.precision > 18 else 8
    if isinstance(kind, T.DayTimeIntervalType):
        return "timedelta", 8
    return SIZES.get(kind.simpleString(), ("container", None))


def declared_keys(schema: T.StructType) -> dict[str, dict]:
    """Nullability and key roles from field metadata (primary_key, foreign_key, unique)."""
    return {f.name: {"nullable": f.nullable} | {k: f.metadata[k] for k in ("primary_key", "foreign_key", "unique") if k in f.metadata} for f in schema}


def write(df: DataFrame, path: str, if_exists: str = "fail", partition_by: list[str] = ()) -> None:
    mode = {"fail": "errorifexists", "append": "append", "replace": "overwrite"}[if_exists]
    (df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)).parquet(path)


def in_chunks(df: DataFrame, function, schema: str, rows: int = 10_000) -> DataFrame:
    """`function` of a pandas frame, over chunks of at most `rows` rows within the partitions."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), rows):
                yield function(batch.iloc[at : at + rows])

    return df.mapInPandas(run, schema)


def by_group(df: DataFrame, ids: list[str], function, schema: str) -> DataFrame:
    """`function` of all rows of a series together."""
    return df.groupBy(*ids).applyInPandas(function, schema)


def with_lags(df: DataFrame, ids: list[str], order: list[str], columns: list[str], lags: int) -> DataFrame:
    """Rows with the values of the `lags` rows before them in their series."""
    own = W.partitionBy(*ids).orderBy(*order)
    return df.select("*", *(F.lag(c, i).over(own).alias(f"{c}_lag_{i}") for c in columns for i in range(1, lags + 1)))


def map_keys(df: DataFrame, key: str, buckets: int = 4096) -> DataFrame:
    """(key, surrogate): distinct non-null keys numbered 0, 1, ... without a window over all: numbers start after the keys of the hash
    buckets before."""
    keys = df.select(key).dropna().distinct().withColumn("__b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = keys.groupBy("__b").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(W.partitionBy("__b").orderBy(key)) - 1
    return keys.withColumn("__i", inside).join(sizes.select("__b", before.alias("__before")), "__b").select(key, (F.col("__before") + F.col("__i")).alias("surrogate"))
