"""Layers of the case store, and series that are trained from a stream once they are complete."""

import os

import pytest
from pyspark.sql import functions as F

from kinfold.sources.store import CaseStore
from kinfold.streaming import ingest


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def told(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture
def store(spark, tmp_path):
    s = CaseStore(spark, str(tmp_path / "store"))
    s.train(spark.range(20_000).select("id", F.xxhash64("id").alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("y")), "a", order=["id"])
    return s


def test_an_edit_writes_what_it_changes(store):
    before = size(store.path)
    assert store.edit({"x": 1}, {"id": [77, 77]}) == 1
    assert store.remove({"id": [100, 104]}) == 5
    assert size(store.path) - before < 0.02 * before
    df = store.cases()
    assert df.count() == 19_995 and df.where("id = 77").first().x == 1 and store.edit({"x": 2}, {"id": [77, 77]}) == 1
    assert store.cases().where("id = 77").first().x == 2


def test_compaction_and_clearing_keep_the_rows(store):
    store.edit({"x": 5}, {"id": [10, 19]})
    store.remove({"id": [15, 25]})
    store.add_feature("z", 2.5, condition={"id": [0, 3]})
    store.train(store.spark.createDataFrame([(30_000, 1, "n")], "id bigint, x bigint, y string"), "b")
    before, version = told(store.cases()), store._current("cases")
    assert len(version.layers) == 5 and version.number == 5
    store.compact()
    assert told(store.cases()) == before and len(store._current("cases").layers) == 1
    assert store.clear() == 5 and told(store.cases()) == before
    store.train(store.spark.createDataFrame([(30_001, 1, "n")], "id bigint, x bigint, y string"), "b")
    assert store.cases().agg(F.max("_idx")).first()[0] == 20_001


def test_compaction_by_itself(spark, tmp_path):
    s = CaseStore(spark, str(tmp_path / "s"), most_layers=3)
    for i in range(5):
        s.train(spark.createDataFrame([(i,)], "id bigint"), f"s{i}")
    assert len(s._current("cases").layers) <= 3 and s.count() == 5 and [r._idx for r in s.get(sort_by=[("id", True)]).collect()] == [0, 1, 2, 3, 4]


def test_a_session_is_trained_again_after_it_was_deleted(store):
    store.delete_session("a")
    assert store.count() == 0 and not store.has_session("a")
    store.train(store.spark.range(3).select("id", F.lit(0).cast("bigint").alias("x"), F.lit("").alias("y")), "a")
    assert store.count() == 3 and store.session_indices("a").count() == 3


EVENTS = "k string, at timestamp, v double, stop boolean"


def arrive(spark, path, rows):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    spark.createDataFrame([(k, t0 + timedelta(seconds=s), float(v), e) for k, s, v, e in rows], EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_series_are_trained_once_when_complete(spark, tmp_path):
    path, log, staged = (str(tmp_path / x) for x in ("in", "log", "staged"))
    store = CaseStore(spark, str(tmp_path / "store"))

    def run():
        ingest.train_series(ingest.read_files(spark, path, EVENTS), store, "k", "at", log, staged, gap=100, late=10, ends="stop").awaitTermination()

    def series():
        df = store._read("cases")
        return [] if df is None else sorted((r.k, r.n, r.v) for r in df.groupBy("k", "series_start").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect())

    arrive(spark, path, [("a", 0, 1, False), ("a", 50, 2, False), ("b", 20, 10, False), ("b", 30, 20, True), ("b", 40, 30, False), (None, 5, 9, False)])
    run()
    assert series() == [("b", 2, 30.0)]  # closed by its own row; the others are open
    arrive(spark, path, [("a", 140, 4, False), ("c", 200, 7, False)])
    run()  # a goes on; b was silent for over 100 s and its timer is due
    assert series() == [("b", 1, 30.0), ("b", 2, 30.0)]
    arrive(spark, path, [("a", 500, 8, False), ("c", 290, 9, False)])
    run()
    assert series() == [("a", 3, 7.0), ("b", 1, 30.0), ("b", 2, 30.0), ("c", 2, 16.0)]
    run()  # nothing new: nothing trained again
    assert store.count() == 8
    order = store.cases().where("k = 'a'").orderBy("series_place").collect()
    assert [(r.series_place, r.v) for r in order] == [(0, 1.0), (1, 2.0), (2, 4.0)]


def test_keys_that_share_a_state_end_each_by_itself(spark, tmp_path):
    path, log, out = (str(tmp_path / x) for x in ("in", "log", "out"))

    def run():
        got = ingest.follow_series(ingest.read_files(spark, path, EVENTS), "k", "at", 100, 10, "stop", buckets=1)
        got.writeStream.format("parquet").option("checkpointLocation", log).trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r.k, r.position) for r in spark.read.parquet(out).where("complete").collect())

    arrive(spark, path, [("a", 0, 1, False), ("b", 20, 2, True), ("b", 30, 3, False), ("c", 25, 4, False)])
    assert run() == [("b", 1)]
    arrive(spark, path, [("a", 90, 5, False), ("d", 175, 6, False)])
    assert run() == [("b", 1), ("b", 1), ("c", 1)]  # two silent keys are due, a and d are open
    rows = spark.read.parquet(out).where("NOT complete")
    assert sorted((r.k, r.position, r.v) for r in rows.collect()) == [("a", 0, 1.0), ("a", 1, 5.0), ("b", 0, 2.0), ("b", 0, 3.0), ("c", 0, 4.0), ("d", 0, 6.0)]
