"""Differential privacy of aggregates, and the parameter grid against separate searches."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from kinfold.operators import analyze, private
from kinfold.operators.knn import knn, metric_of
from kinfold.operators.react import class_probabilities, influence, predict_continuous

BOUNDS = private.Bounds("u", groups=2, rows=2, clip={"x": (-1.0, 4.0)})


@pytest.fixture(scope="module")
def rows(spark):
    data = [(u, g, float(v)) for u, g, v in itertools.product(["a", "b", None, "d"], ["p", "q", "r"], [-9, 2, 3, 50])] + [("a", None, 1.0), ("b", "p", None)]
    return spark.createDataFrame(data, "u string, g string, x double").cache()


def test_no_unit_changes_more_than_the_sensitivity(rows):
    """Exact: every unit is left out in turn."""
    total = lambda df: {r.g: (r.n, r.sum_x) for r in private.clipped_totals(df, ["g"], BOUNDS).collect()}
    whole = total(rows)
    for u in ["a", "b", None, "d"]:
        rest = total(rows.where(~F.col("u").eqNullSafe(F.lit(u))))
        change = [sum(abs(whole.get(g, (0, 0.0))[i] - rest.get(g, (0, 0.0))[i]) for g in {*whole, *rest}) for i in (0, 1)]
        assert 0 < change[0] <= BOUNDS.sensitivity() == 4 and change[1] <= BOUNDS.sensitivity("x") == 16
    own = private.bounded(rows, ["g"], BOUNDS)
    assert own.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] == 4 and own.agg(F.min("x"), F.max("x")).first() == (-1.0, 4.0)


def test_budget_is_composed_and_noise_follows_it(spark):
    spent = private.budget(2.0, BOUNDS, {"n": 1.0, "x": 3.0})
    assert spent == {"n": (0.5, 8.0), "x": (1.5, 16 / 1.5)} and sum(e for e, _ in spent.values()) == 2.0
    df = spark.range(4000).select(F.col("id").cast("string").alias("u"), F.col("id").alias("g"), F.lit(2.0).alias("x"))
    bounds = private.Bounds("u", 1, 1, {"x": (0.0, 2.0)})
    got = private.private_aggregates(df, ["g"], bounds, 1.0, groups=df, seed=5)
    off = got.agg(F.avg(F.abs(F.col("n") - 1)).alias("n"), F.avg(F.abs(F.col("sum_x") - 2)).alias("x")).first()
    assert abs(off.n - 2.0) < 0.2 and abs(off.x - 4.0) < 0.4  # the mean of a Laplace variable's size is its scale
    assert got.orderBy("g").collect() == private.private_aggregates(df, ["g"], bounds, 1.0, groups=df, seed=5).orderBy("g").collect()


def test_groups_of_one_unit_stay_hidden(spark):
    df = spark.range(3000).select(F.col("id").alias("u"), F.when(F.col("id") < 1000, F.lit("many")).otherwise(F.concat(F.lit("lone"), F.col("id"))).alias("g"), F.lit(1.0).alias("x"))
    got = private.private_aggregates(df, ["g"], private.Bounds("u", 1, 1, {"x": (0.0, 1.0)}), 1.0, delta=1e-6)
    assert [r.g for r in got.collect()] == ["many"]
    with pytest.raises(ValueError):
        private.private_aggregates(df, ["g"], BOUNDS, 1.0)


def test_public_groups_and_empty_tables(spark, rows):
    groups = spark.createDataFrame([("p",), ("zzz",), (None,)], "g string")
    got = private.private_aggregates(rows.limit(0), ["g"], BOUNDS, 1.0, groups=groups)
    assert got.count() == 3 and all(math.isfinite(r.n) for r in got.collect())


@pytest.mark.parametrize("action,kind", [("y", "continuous"), ("c", "nominal")])
def test_grid_cells_are_separate_predictions(spark, action, kind):
    df = spark.range(120).select("id", (F.col("id") % 17).alias("a").cast("double"), (F.pmod(F.xxhash64("id"), F.lit(9))).cast("double").alias("b"), (F.col("id") % 5).cast("double").alias("y"), F.concat(F.lit("v"), F.col("id") % 3).alias("c")).cache()
    m = metric_of(df, ["a", "b"])
    got = {(r.p, r.k, r.dt): (r.n, r.error) for r in analyze.grid(df, m, action, kind, k_values=[2, 5], p_values=[1.0, 2.0], dt_values=[-1.0, -2.0], folds=4, fold_by="id % 4").collect()}
    assert len(got) == 8
    from dataclasses import replace

    folded = df.withColumn("f", F.col("id") % 4)
    actual = df.select(F.col("id").alias("query_id"), F.col(action).alias("actual"))
    for (p, k, dt), (n, error) in got.items():
        near = influence(knn(folded, folded, replace(m, p=p), k, carry=[action], differ=["f"]), dt)
        if kind == "continuous":
            e = actual.join(predict_continuous(near, action, name="v"), "query_id").agg(F.avg(F.abs(F.col("actual") - F.col("v")))).first()[0]
        else:
            probs = class_probabilities(near, action).withColumnRenamed("class", "actual")
            e = actual.join(probs, ["query_id", "actual"], "left").agg(F.avg(1 - F.coalesce("probability", F.lit(0.0)))).first()[0]
        assert n == 120 and abs(e - error) < 1e-9


def test_halving_ends_with_all_cases(spark):
    df = spark.range(200).select("id", (F.col("id") % 40).cast("double").alias("a"), F.pmod(F.xxhash64("id"), F.lit(30)).cast("double").alias("b"), (F.col("id") % 40).cast("double").alias("y"))
    got = analyze.halving(df, metric_of(df, ["a", "b"]), "y", "continuous", p_values=[0.5, 1.0, 2.0, 4.0], share=4, k_values=[1, 3], folds=1).collect()
    assert len({r.p for r in got}) == 1 and {r.n for r in got} == {200}
