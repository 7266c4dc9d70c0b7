"""Functional dependencies by sketches and exact comparison."""

from itertools import permutations

from pyspark.sql import functions as F

from kinfold.operators import fanout


def brute(rows, columns):
    out = set()
    for k, x in permutations(columns, 2):
        seen = {}
        if all(seen.setdefault(r[k], r[x]) == r[x] for r in rows):
            out.add((k, x))
    return out


def test_dependencies_by_definition(spark):
    df = spark.range(3000).select(
        "id",
        (F.col("id") % 500).alias("a"),
        (F.col("id") % 50).alias("b"),
        F.when(F.col("id") % 50 == 7, None).otherwise(F.concat(F.lit("v"), F.col("id") % 25)).alias("c"),
        F.lit(1).alias("one"),
        F.when(F.col("id") == 2999, F.lit(5)).otherwise(F.col("id") % 500 % 9).alias("nearly"),
        F.lit(None).cast("string").alias("none"),
        F.pmod(F.xxhash64("id"), F.lit(700)).alias("free"),
    ).cache()
    want = brute(df.collect(), df.columns)
    assert set(fanout.dependencies(df)) == want and ("a", "b") in want and ("a", "nearly") not in want and ("b", "c") in want
    parts = fanout.merged([fanout.sketches(df.where(f"id % 4 = {i}")) for i in range(4)])
    left = fanout.candidates(parts)
    assert set(left) >= want and len(left) < 56 and ("free", "a") not in left
    assert set(fanout.dependencies(df, state=parts)) == want


def test_wide_tables_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(fanout, "SKETCHES", 4)
    df = spark.range(60).select("id", *((F.col("id") % i).alias(f"c{i}") for i in (2, 3, 4, 6)))
    assert set(fanout.dependencies(df)) == brute(df.collect(), df.columns)


def test_incremental_refutes_for_good(spark):
    inc = fanout.Incremental(["k", "x", "y"], stable=2)
    batch = lambda rows: spark.createDataFrame(rows, "k bigint, x bigint, y bigint")
    assert not inc.add(batch([(1, 1, 1), (2, 1, 2)])) and ("k", "x") in inc.result()
    assert not inc.add(batch([(1, 2, 1), (3, 1, 3)])) and ("k", "x") not in inc.result()  # only both batches together refute it
    assert not inc.add(batch([(4, 4, 4)])) and inc.add(batch([(5, 5, 5)]))
    assert inc.result() == [("k", "y"), ("y", "k")]


def test_empty(spark):
    none = spark.createDataFrame([], "a string, b string")
    assert set(fanout.dependencies(none)) == {("a", "b"), ("b", "a")}
