"""Tables that grow with the documents are not broadcast, however small Spark takes them to be."""

import contextlib

import numpy as np
from pyspark.sql import functions as F

from kinfold.llm import decontamination, mixing, shared, simhash


@contextlib.contextmanager
def at_most(spark, size, threshold="10m"):
    """A broadcast of more than `size` fails; what Spark takes for less than `threshold` it broadcasts."""
    held = {"spark.sql.maxBroadcastTableSize": size, "spark.sql.autoBroadcastJoinThreshold": threshold}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def numbers(seed, n):
    return np.random.default_rng(seed).integers(-(1 << 63), 1 << 63, n).tolist()


def test_simhash_postings_are_not_broadcast(spark):
    """Seventy postings a fingerprint take many times what the table has that they are exploded from."""
    some = numbers(3, 4000)
    near = {(min(x, x ^ 0b1011), max(x, x ^ 0b1011)) for x in some[:50]}
    with at_most(spark, "2m"):
        fps = shared.stash(spark.createDataFrame([(x,) for x in {*some, *(x for pair in near for x in pair)}], "fp bigint"), "test")
        got = [tuple(sorted(r)) for r in simhash.links(fps).collect()]
    assert len(got) == len(near) and set(got) == near


def test_points_half_way_are_not_broadcast(spark):
    """Each fingerprint has 2,081 points near it."""
    groups = [sorted((x, x ^ 1, x ^ 0b110)) for x in numbers(4, 20)]
    with at_most(spark, "2m"):
        fps = shared.stash(spark.createDataFrame([(x,) for g in groups for x in g], "fp bigint"), "test").distinct()
        got = shared.components(simhash._half_way(fps).toDF("a", "b"), "test").collect()
    assert {r["node"]: r["component"] for r in got} == {x: g[0] for g in groups for x in g[1:]}


def test_edges_are_not_broadcast(spark):
    """Edges to few nodes take little on disk."""
    with at_most(spark, "2m", threshold="512k"):
        edges = spark.range(60_000).select(F.col("id").alias("a"), F.expr("id - id % 400").alias("b"))
        got = shared.components(edges, "test")
        assert got.count() == 60_000 - 150 and got.where("component <> node - node % 400").isEmpty()


#: One page of memory, which any table with a key of several columns takes, and some more.
PAGE = "40m"


def test_documents_to_mix_are_not_broadcast(spark):
    """Sums of 60 sources' buckets are larger than a file of documents, not than its rows."""
    with at_most(spark, PAGE):
        docs = spark.range(300_000).selectExpr("id AS doc_id", "1 + id % 7 AS size", "array(concat('s', id % 60)) AS sources")
        got, sizes, targets = mixing.mix(spark, shared.stash(docs, "test"), lambda names: dict.fromkeys(names, 1))
        rows, taken = got.selectExpr("count(*)", "sum(taken)").first()
    assert rows == 300_000 and abs(taken - sum(targets.values())) < 60 and len(sizes) == 60


def test_words_of_documents_are_not_broadcast(spark, monkeypatch):
    """Items too many to be broadcast; a file that holds a text once is small, its words are not."""
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_ROWS", 10)
    text = " ".join(f"w{i}" for i in range(400))
    items = [(i, " ".join(f"v{i}x{j}" for j in range(60))) for i in range(400)] + [(-1, text)]
    with at_most(spark, PAGE):
        docs = shared.stash(spark.range(2500).selectExpr("id AS doc_id", f"'{text}' AS text"), "test")
        items = shared.stash(spark.createDataFrame(items, "item_id bigint, text string"), "test")
        got = {(r.doc_id, r.item_id, r.n_shared) for r in decontamination.contained(docs, items).collect()}
    assert got == {(i, -1, 396) for i in range(2500)}


def test_many_rejected_keys_are_not_broadcast(spark, monkeypatch):
    """Keys in a row take little on disk; a null among them rejects the rows without a key."""
    monkeypatch.setattr(shared, "BROADCAST_KEYS", 100_000, raising=False)
    with at_most(spark, PAGE):
        gone = shared.stash(spark.range(400_000).selectExpr("nullif(id, 0) AS doc_id"), "test")
        docs = spark.range(399_990, 400_010).selectExpr("id AS doc_id").union(spark.sql("SELECT CAST(null AS BIGINT)"))
        assert sorted(r.doc_id for r in shared.keep_rows(docs, gone).collect()) == list(range(400_000, 400_010))
        assert sorted(r.doc_id for r in shared.keep_rows(docs, gone.where("doc_id <= 399995")).where("doc_id < 400000").collect()) == [399_996, 399_997, 399_998, 399_999]
