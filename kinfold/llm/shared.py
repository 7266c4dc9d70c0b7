"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java regular expression.
SPACES = r"[\x20\x09-\x0D]+"
#: Edges, counted, beside which the least neighbour of every node is broadcast (under 10 MB).
BROADCAST_EDGES = 50_000
#: Rejected keys that are broadcast at most (about 120 bytes each).
BROADCAST_KEYS = 1_000_000


@functools.cache
def _own_dir() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="kinfold-", ignore_cleanup_errors=True)  # gone when the driver ends


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints; one of our own where none is named, as in tests."""
    return spark.conf.get("spark.checkpoint.dir", None) or _own_dir().name


def stash(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back: the lineage ends there, no step behind
    it runs twice, and a lost executor costs nothing that is already written. The folder's owner clears it, as lazy results still read it."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def keep_rows(docs: DataFrame, rejected: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of `docs` whose key is not in `rejected` (its one column); a null key matches a null key.

    Up to `BROADCAST_KEYS` rejected rows, counted, are broadcast; beyond that both sides are shuffled. Spark by itself goes by the file of the
    keys, which takes a fraction of their memory, and once a plan broadcasts, it does not turn back at the measured size.
    """
    gone = rejected.select(F.col(rejected.columns[0]).alias("__kinfold_key")).distinct()
    held = F.broadcast(gone) if rejected.count() <= BROADCAST_KEYS else gone.hint("merge")
    return docs.join(held, docs[key].eqNullSafe(gone["__kinfold_key"]), "left_anti")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of an undirected graph given by `edges` (a, b) of comparable ids; component = least id.

    Alternating large-star and small-star rounds: every round is two shuffles on the edges, written to the shared
    folder; the number of rounds grows with the logarithm of the longest chain. Compressed files tell little of the size of
    edges, so these are counted: the least neighbours are broadcast beside up to `BROADCAST_EDGES` of them, and beyond that both sides are
    shuffled. Returned is every node but those that stand for themselves: nodes without an edge, and the least of each component.
    """
    current = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), label)
    before, n = None, current.count()
    while True:
        held = F.broadcast if n <= BROADCAST_EDGES else (lambda df: df.hint("merge"))
        both = current.select(F.col("v").alias("x"), F.col("u").alias("y")).union(current.select("u", "v"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(held(least), "x").where("y > x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(held(least), "v")
        small = small.select("u", "m").union(least.select("v", "m")).where("u <> m").toDF("v", "u").distinct()
        current = stash(small, label)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            return current.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
        before, n = state, state[0]
