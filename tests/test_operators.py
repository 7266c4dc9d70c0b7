"""Known values, invariants and round trips of the case-based operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.functions import flat, formats
from kinfold.operators import analyze, conviction, fanout, graph, influence, knn, profile, rare, react, reduce, series, stats, synth, validate
from kinfold.operators.condition import compile_condition, select_exact
from kinfold.operators.knn import Feature, Metric, metric_of
from kinfold.sources import readers
from kinfold.sources.store import CaseStore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def part(spark):
    return spark.read.parquet(f"{SF}/part.parquet").withColumnRenamed("p_partkey", "id").cache()


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").cache()


# --- bounds, thresholds, chunks


@pytest.mark.parametrize("low,high,want", [(41, 105, (0, 146.518)), (0, 200, (0, 329.744)), (100, 100, (98.351, 101.649)), (0, 0, (0, 0))])
def test_loose_bounds(low, high, want):
    assert profile.loose_bounds(low, high) == pytest.approx(want, abs=1e-3)


def test_loose_bounds_columns_agree(spark):
    data = [(41.0, 105.0), (0.0, 200.0), (-5.0, -1.0), (-3.0, 9.0), (7.0, 7.0)]
    lo, hi = profile.loose_bounds_columns(F.col("a"), F.col("b"))
    got = spark.createDataFrame(data, "a double, b double").select(lo, hi).collect()
    assert [tuple(r) for r in got] == [pytest.approx(profile.loose_bounds(*x)) for x in data]


def test_loose_bounds_order():
    with pytest.raises(ValueError):
        profile.loose_bounds(2, 1)


def test_mode_bounds():
    assert profile.mode_bounds((0.0, 20.0), (5.0, 10.0), [(5.0, 4)], False) == (5.0, 20.0)
    assert profile.mode_bounds((0.0, 20.0), (5.0, 10.0), [(10.0, 9)], False) == (0.0, 10.0)
    assert profile.mode_bounds((0.0, 20.0), (5.0, 10.0), [(5.0, 3)], False) == (0.0, 20.0)


def test_integers():
    assert profile.integer_is_nominal(100, 3, 0, 2)
    assert not profile.integer_is_nominal(64, 60, 1, 99)
    assert profile.integer_is_nominal(64, 64, 1000000, 1999999)
    assert not profile.integer_is_nominal(0, 0, None, None)


@pytest.mark.parametrize("n,most,want", [(100_000, 2000, 1563), (10, 100, 10), (0, 5, 0), (1000, 300, 250)])
def test_chunk_size(n, most, want):
    assert profile.chunk_size(n, most) == want


def test_rare_values_known(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 100 == 0, None).otherwise(F.lit("1")).alias("a"), F.lit(1).alias("w"))
    got = rare.preserve(df, {"a": [None]}, ["a"], 1563)
    assert got.first().multiplier == pytest.approx(1.92, abs=5e-3)
    assert rare.unprotected_multipliers(df, got).first().unprotected == pytest.approx(0.99, abs=5e-3)
    with pytest.raises(ValueError):
        rare.preserve(df, {"a": ["none such"]}, ["a"], 1563)


# --- distances and neighbours


def test_distance_values(spark):
    one = Metric((Feature("x"),))
    two = Metric((Feature("x"), Feature("y")))
    a, b = spark.createDataFrame([(0, 0.0, 0.0)], "id int, x double, y double"), spark.createDataFrame([(0, 1.0, 0.0)], "id int, x double, y double")
    assert knn.pairwise(a, b, one, ["id"]).first().distance == 1
    assert knn.pairwise(a, b, two, ["id"]).first().distance == 1
    assert knn.pairwise(a, a, two, ["id"]).first().distance == 0


def test_cyclic(spark):
    a, b = spark.createDataFrame([(0, 1.0)], "id int, x double"), spark.createDataFrame([(1, 359.0)], "id int, x double")
    assert knn.knn(a, b, Metric((Feature("x", "cyclic", cycle=360.0),)), 1).first().distance == 2


@pytest.mark.parametrize("p", [1.0, 2.0, 0.5])
def test_knn_plans_agree(part, p):
    q = part.where("id % 7 = 0")
    m = metric_of(part, ["p_size", "p_type", "p_retailprice"], p)
    key = lambda df: [(r.query_id, r["rank"], r.case_id, pytest.approx(r.distance)) for r in df.orderBy("query_id", "rank").collect()]
    a = knn.knn(q, part, m, 5)
    assert key(a) == key(knn.knn(q, part, m, 5, broadcast_queries=9)) == key(knn.knn_sql(q, part, m, 5))


def test_knn_nulls_ties_and_repeats(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, "a"), (3, 1.0, "a"), (4, 5.0, None)], "id bigint, x double, z string")
    m = metric_of(df, ["x", "z"])
    got = {(r.query_id, r.case_id): r.distance for r in knn.knn(df, df, m, 9).collect()}
    assert got[2, 3] == 0 and got[1, 4] == 4.0 and got[1, 2] == 5.0 and (1, 1) not in got
    assert knn.knn(df.limit(0), df, m, 3).count() == 0 and knn.knn(df, df.limit(0), m, 3).count() == 0


def test_class_distances(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, z string")
    m = Metric((Feature("z", "nominal", table=(("a", "b", 0.25), ("b", "a", 0.25))),))
    got = {(r.query_id, r.case_id): r.distance for r in knn.knn(df, df, m, 2).collect()}
    assert got[1, 2] == 0.25 and got[1, 3] == 1.0


def test_ordinal(spark):
    df = spark.createDataFrame([(1, "low"), (2, "high"), (3, "mid")], "id bigint, z string")
    m = metric_of(df, ["z"], z={"allowed": ("low", "mid", "high")})
    got = {(r.query_id, r.case_id): r.distance for r in knn.knn(df, df, m, 2).collect()}
    assert got[1, 2] == 2 and got[1, 3] == 1


def test_universal_time(spark):
    df = spark.createDataFrame([(i, float(i), 0.0) for i in range(5)], "id bigint, t double, x double")
    got = knn.knn(df, df, metric_of(df, ["x"]), 9, not_later="t")
    assert all(r.case_id < r.query_id for r in got.collect())


def test_symmetry(part):
    some = part.limit(30)
    d = {(r.from_id, r.to_id): r.distance for r in knn.distance_matrix(some, metric_of(part, ["p_size", "p_type"])).collect()}
    assert len(d) == 900 and all(d[a, b] == d[b, a] for a, b in d) and all(d[a, a] == 0 for a, _ in d)
    with pytest.raises(ValueError):
        knn.distance_matrix(part.limit(1), metric_of(part, ["p_size"]))


# --- predictions


def test_weights_sum_to_one(part):
    near = react.neighbours(part, part, metric_of(part, ["p_size", "p_type"]), 5)
    assert all(r.s == pytest.approx(1) for r in near.groupBy("query_id").agg(F.sum("weight").alias("s")).collect())


def test_predict_is_react(part):
    m = metric_of(part, ["p_size", "p_type"])
    q = part.where("id % 10 = 0")
    near = react.neighbours(q, part, m, 5, carry=["p_retailprice", "p_brand"])
    a = react.react(q, part, m, {"p_retailprice": "continuous", "p_brand": "nominal"}, 5)
    b = react.predict_continuous(near, "p_retailprice").join(react.predict_nominal(near, "p_brand"), "query_id")
    assert {(r.query_id, r.p_retailprice, r.p_brand) for r in a.collect()} == {(r.query_id, r.p_retailprice, r.p_brand) for r in b.collect()}


def test_identical_case_decides(spark):
    c = spark.createDataFrame([(1, 0.0, 10.0), (2, 1.0, 99.0)], "id bigint, x double, y double")
    q = spark.createDataFrame([(9, 0.0, None)], c.schema)
    assert react.react(q, c, metric_of(c, ["x"]), {"y": "continuous"}, 2).first().y == 10.0


def test_null_targets(spark):
    c = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 4.0)], "id bigint, x double, y double")
    q = spark.createDataFrame([(9, 0.0, None)], c.schema)
    m = metric_of(c, ["x"])
    assert react.react(q, c, m, {"y": "continuous"}, 2).first().y == 4.0
    assert react.react(q, c, m, {"y": "continuous"}, 2, allow_nulls=True).first().y is None


def test_confusion_dense(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c")], "actual string, predicted string")
    got = {r.actual: (r.a, r.b, r.c) for r in stats.confusion_dense(stats.confusion(df)).collect()}
    assert got == {"a": (1, 1, 0), "b": (0, 0, 1), "c": (0, 0, 0)}


@pytest.mark.parametrize("method,want", [("relative", [0.5, -1.0]), ("fractional", [-1.0, 2.0]), ("fractional_absolute", [1 / 3, -2 / 3])])
def test_matrix(spark, method, want):
    cells = spark.createDataFrame([("a", "a", 7.0), ("a", "b", 1.0), ("a", "c", -2.0), ("b", "a", 0.0), ("b", "c", 0.0)], "row string, col string, value double")
    got = {(r.row, r.col): r.value for r in stats.normalize_matrix(cells, method).collect()}
    assert [got["a", "b"], got["a", "c"]] == pytest.approx(want) and got["a", "a"] == 7.0 and got["b", "a"] == 0.0
    got = {(r.row, r.col): r.value for r in stats.normalize_matrix(cells, method, absolute=True, fill_diagonal=1.0).collect()}
    assert got["a", "a"] == 1.0 and got["a", "c"] == pytest.approx(abs(want[1]))


def test_statistics_against_numpy(spark):
    rng = np.random.default_rng(0)
    a, p = rng.normal(size=200).round(1), rng.normal(size=200).round(1)
    r = stats.continuous_stats(spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, p, strict=True)], "actual double, predicted double")).first()
    assert r.mae == pytest.approx(np.abs(a - p).mean()) and r.rmse == pytest.approx(np.sqrt(((a - p) ** 2).mean()))
    assert r.r2 == pytest.approx(1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    import pandas as pd

    assert r.spearman_coeff == pytest.approx(pd.Series(a).rank().corr(pd.Series(p).rank()))


def test_contributions_robust_repeatable(part):
    q = part.where("id % 25 = 0")
    m = metric_of(part, ["p_size", "p_type", "p_brand"])
    run = lambda: sorted((r.query_id, r.feature, r.directional) for r in influence.contributions(q, part, m, "p_retailprice", 5, robust=3, seed=2).collect())
    assert run() == run()


def test_permuted_keeps_values(part):
    got = influence.permuted(part, "p_size", 3, blocks=4)
    count = lambda df: sorted(r.p_size for r in df.select("p_size").collect())
    assert count(got) == count(part) and got.join(part.withColumnRenamed("p_size", "s"), "id").where("s <> p_size").count()


def test_converge(part):
    value, n = stats.converge(lambda df: df.agg(F.avg("p_size")).first()[0], part, start=50)
    assert 50 <= n <= part.count() and value > 0


# --- convictions, groups, clusters


def test_outlier_has_low_conviction(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(60)] + [(99, 1000.0)], "id bigint, x double")
    got = {r.id: r for r in conviction.into_features(df, metric_of(df, ["x"]), 5).collect()}
    assert got[99].familiarity_conviction_removal == min(r.familiarity_conviction_removal for r in got.values())
    assert got[99].p_value_of_removal == pytest.approx(1 / 61)
    with pytest.raises(ValueError):
        conviction.into_features(df.withColumn("distance_contribution", F.lit(1)), metric_of(df, ["x"]), 5)


def test_all_contributions_zero(spark):
    df = spark.createDataFrame([(i, float(i % 2), "ab"[i % 3 == 0]) for i in range(60)], "id bigint, x double, g string")
    m = metric_of(df, ["x"])
    assert conviction.into_features(df, m, 3).where("distance_contribution <> 0").count() == 0
    assert conviction.groups(df, df, m, "g", 3).count() == 2


def test_clusters(spark):
    df = spark.createDataFrame([(i, float(i) * 0.1) for i in range(20)] + [(100 + i, 500 + i * 0.1) for i in range(20)] + [(999, 9999.0)], "id bigint, x double")
    got = {r.id: r._cluster_id for r in conviction.clusters(df, metric_of(df, ["x"]), 4).collect()}
    assert {got[i] for i in range(20)} == {0} and {got[100 + i] for i in range(20)} == {100} and got[999] == -1


def brute_condensed(edges, mass, least):
    """Edge by edge: the clusters of `graph.condensed` as sets of nodes."""
    tree, members = {n: n for n in mass}, {n: {n} for n in mass}
    cluster = {n: {n} if mass[n] >= least else None for n in mass}  # of a tree: its open cluster, None if light, "closed" after two met
    done = []
    for _, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in edges):
        x, y = tree[a], tree[b]
        if x == y:
            continue
        one, two = cluster.pop(x), cluster.pop(y)
        if one is not None and two is not None:
            done += [c for c in (one, two) if c != "closed"]
            new = "closed"
        elif one is None and two is None:
            both = members[x] | members[y]
            new = both if sum(mass[n] for n in both) >= least else None
        else:
            heavy, light = (one, members[y]) if two is None else (two, members[x])
            new = heavy if heavy == "closed" else heavy | light
        members[x] |= members.pop(y)
        for n in members[x]:
            tree[n] = x
        cluster[x] = new
    return {frozenset(c) for c in [*done, *(c for c in cluster.values() if c and c != "closed")]}


def _forest(seed):
    import random

    rng = random.Random(seed)
    if seed == 0:  # gaps that grow: every node picks the one before
        return [(i, i + 1, float(i)) for i in range(60)], {i: 1.0 for i in range(61)}, 5
    n = 120
    edges = {tuple(sorted(rng.sample(range(n), 2))): rng.choice([rng.random(), round(rng.random(), 1)]) for _ in range(90 * seed)}
    return [(a, b, w) for (a, b), w in edges.items()], {i: rng.choice([0.0, 0.5, 1.0, 1.0, 4.0]) for i in range(n)}, 4


@pytest.mark.parametrize("seed", range(4))
def test_condensed_forest_against_kruskal(spark, seed):
    edges, mass, least = _forest(seed)
    odd = [(3, 3, 0.0), (None, 1, 0.0), (1, 2, None), (5, 777, 0.0), *((b, a, w + 1) for a, b, w in edges[:20])]  # ignored, or heavier parallels
    links = spark.createDataFrame([*edges, *odd], "a bigint, b bigint, w double")
    got = {}
    rows = graph.condensed(links, spark.createDataFrame(list(mass.items()), "node bigint, mass double"), least).collect()
    for r in rows:
        got.setdefault(r.cluster, set()).add(r.node)
    assert sorted(r.node for r in rows) == sorted(mass)
    assert {frozenset(v) for c, v in got.items() if c is not None} == brute_condensed(edges, mass, least)
    assert all(c is None or c == min(v) for c, v in got.items())


def test_case_clusters_by_definition(spark):
    from kinfold.operators.react import neighbours
    from kinfold.plans import registry

    df = spark.read.parquet(f"{SF}/part.parquet")
    rows = neighbours(df, df, metric_of(df, ["p_size", "p_retailprice"]), 5, id_column="p_partkey").collect()
    near = {}
    for r in rows:
        near.setdefault(r.query_id, {})[r.case_id] = r.distance
    mean = {a: 0.0 if min(x.values()) == 0 else len(x) / sum(1 / d for d in x.values()) for a, x in near.items()}
    links = [(a, b, round(max(d, mean[a], mean[b]), 9)) for a, x in near.items() for b, d in x.items() if a < b and a in near[b]]
    want = brute_condensed(links, dict.fromkeys(near, 1), 5)
    sizes = {min(c): len(c) for c in want} | {-1: df.count() - sum(map(len, want))}
    assert len(want) > 5
    assert {r["_cluster_id"]: r.n for r in registry.queries()["case_clusters"](spark, SF).collect()} == sizes


def test_condensed_forest_of_nothing(spark):
    none = spark.createDataFrame([], "a bigint, b bigint, w double")
    assert graph.condensed(none, spark.createDataFrame([], "node bigint, mass double"), 2).count() == 0
    got = graph.condensed(none, spark.createDataFrame([(1, 3.0), (2, None)], "node bigint, mass double"), 2).collect()
    assert {r.node: r.cluster for r in got} == {1: 1, 2: None}


# --- profiles, validation, formats


def test_infer(spark):
    data = [(i, float(i) / 4, "true", f"2024-01-{i % 28 + 1:02d}", f"{i % 24}:30", '{"a": 1}', f"t{i % 3}", None) for i in range(200)]
    df = spark.createDataFrame(data, "k int, f double, b string, d string, t string, j string, s string, n int")
    got = profile.infer(df, ordinal_values={"s": ["t0", "t1", "t2"]}, ids=["k"])
    assert [got[c].data_type for c in "fbdtjs"] == ["number", "boolean", "formatted_date_time", "formatted_time", "json", "string"]
    assert got["f"].decimal_places == 2 and got["s"].type == "ordinal" and got["k"].type == "nominal" and got["n"].nulls_observed
    assert got["f"].min == 0.0 and got["f"].max > got["f"].observed_max
    assert profile.names(got, types="ordinal") == ["s"] and profile.merge(got, got) == got and not profile.differences(got, got)


def test_suggestions():
    a, b = profile.Suggestions(), profile.Suggestions()
    a.add("fanout_on", "x", ["k"])
    b.add("fanout_on", "y", ["k"])
    a.merge(b)
    out = a.apply({"x": profile.Attributes("x"), "y": profile.Attributes("y")}, "fanout_on")
    assert out["x"].fanout_on == ["k"]
    with pytest.raises(ValueError):
        a.add("fanout_on", "x", ["other"])


def test_validation(spark):
    df = spark.createDataFrame([("1", 5.0), ("x", 50.0), (None, None)], "a string, b double")
    want = {"a": profile.Attributes("a", "continuous", "number", "int", allow_null=False), "b": profile.Attributes("b", "continuous", "number", "double", min=0.0, max=10.0), "c": profile.Attributes("c")}
    got = {(r.feature, r.kind): r.n for r in validate.violations(df, want).collect()}
    assert got[("a", "type")] == 1 and got[("b", "bounds")] == 1 and got[("a", "null")] == 1 and ("c", "missing") in got
    assert [r.a for r in validate.coerce(df, want).collect()] == [1, None, None]
    with pytest.raises(ValueError):
        validate.check(df, want)
    sub = validate.substitute(df, "a", {"1": "one"})
    assert [r.a for r in sub.collect()] == ["one", "x", None] and [r.a for r in validate.substitute(sub, "a", {"1": "one"}, True).collect()] == ["1", "x", None]


def test_formats(spark):
    one = lambda c, *row: spark.createDataFrame([row], ", ".join(f"c{i} {'string' if isinstance(x, str) or x is None else 'double'}" for i, x in enumerate(row))).select(c.alias("v")).first().v
    assert one(formats.time_to_seconds(F.col("c0")), "01:02:03.5") == 3723.5 and one(formats.time_to_seconds(F.col("c0")), "x") is None
    assert one(formats.seconds_to_time(F.col("c0")), 3723.5) == "01:02:03.500000"
    assert [one(formats.to_boolean(F.col("c0")), x) for x in ("YES", "(true)", "no", None)] == [True, True, False, None]
    assert one(formats.to_integer(F.col("c0")), "3.9") == 3 and one(formats.to_integer(F.col("c0"), 8), "300") is None
    assert one(formats.significant(F.col("c0"), 2, 1), 1234.56) == 1200.0 and one(formats.significant(F.col("c0"), 3), 0.0) == 0.0
    assert math.isinf(one(formats.infinity(F.col("c0")), formats.DOUBLE_MAX)) and one(formats.nan_to_null(F.col("c0")), float("nan")) is None
    assert one(formats.detokenize(formats.tokenize(F.col("c0"))), "Hello, you two!") == "Hello, you two!"


def test_flat_json(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "c": [2, 3]}', '{"a": {"b": 1}, "c": [2]}'), (None, "x")], "p string, q string")
    r = df.select(flat.jaccard(flat.paths(F.col("p")), flat.paths(F.col("q"))).alias("d"), flat.edit_distance(F.lit("abc"), F.lit("abd")).alias("e")).collect()
    assert r[0].d == pytest.approx(1 / 3) and r[1].d == 1.0 and r[0].e == pytest.approx(1 / 3)


def test_conditions(part):
    n = lambda c: part.where(compile_condition(c)).count()
    assert n({"p_size": [None, 10]}) + n({"p_size": [11, None]}) == part.count() == n({"p_size": [None, None]}) and n({"p_size": None}) == 0
    assert n({"p_type": [part.first().p_type]}) == n({"p_type": part.first().p_type}) > 0
    with pytest.raises(ValueError):
        select_exact(part, {}, 0)


# --- fanout


def test_fanout(spark):
    df = spark.range(240).select((F.col("id") % 8).cast("string").alias("key_b"), (F.col("id") % 4).cast("string").alias("key_a"), F.rand(1).alias("measure"), F.lit("c").alias("const_col"))
    assert ("key_b", "key_a") in fanout.dependencies(df) and ("key_a", "key_b") not in fanout.dependencies(df)
    found = fanout.discover(df, ["key_a", "key_b"])
    assert found == {"key_b": ["key_a"]} and fanout.fanout_on(found) == {"key_a": ["key_b"]}
    inc = fanout.Incremental(["key_a", "key_b"], stable=2)
    assert [inc.add(df), inc.add(df), inc.add(df)] == [False, False, True] and ("key_b", "key_a") in inc.result()


# --- series


def test_series(spark, events):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("a", 4, 9.0), ("b", 1, 5.0), ("b", 1, 7.0)], "s string, t int, v double")
    got = series.derive(df, ["s"], "t", ["v"], 2, ["v"]).orderBy("s", "t", "v").collect()
    assert [r.v_delta_1 for r in got] == [None, 2.0, 6.0, None, 2.0] and [r.v_rate_1 for r in got] == [None, 2.0, 3.0, None, 2000.0]
    assert got[2].v_delta_2 == 4.0 and got[2].v_rate_2 == pytest.approx(0.5)
    assert series.time_invariant(df.withColumn("c", F.lit(1)), ["s"], ["s", "v", "c"], "t") == ["s", "c"]
    assert series.lags_needed({"v": 3, "w": [1, 7]}, {"v": 2}) == 7
    b = series.derived_bounds(df, ["s"], "t", ["v"], 1, {"v_delta": {}, "v": {"max": {1: 100.0}}})
    assert b["v_delta_1"][1] == 100.0


def test_numbered(events):
    got = series.numbered(events.select("user_id"), "name").collect()
    assert sorted(r.name for r in got) == sorted(f"series_{i + 1}" for i in range(len(got)))


def test_forecast_stops(spark):
    df = spark.createDataFrame([(s, t, float(t % 5), s * 1000 + t) for s in range(4) for t in range(30)], "s int, t int, v double, k bigint")
    learned = series.training_rows(df, ["s"], "t", {"v": "continuous"}, 2, "k")
    got = series.forecast(df, ["s"], "t", {"v": "continuous"}, metric_of(learned, ["v_lag_1", "v_lag_2"]), 4, key="k", stop={"v": [1.5, None]}).orderBy("s", "step").collect()
    by = {s: [r.v for r in got if r.s == s] for s in range(4)}
    assert all(v == pytest.approx([0.0, 1.0, 2.0]) for v in by.values())


# --- store, reduction, imputation, synthesis


def test_store(spark, part, tmp_path):
    store = CaseStore(spark, str(tmp_path / "a"))
    assert store.train(part.limit(50), "one") == 50 and store.train(part.orderBy(F.desc("id")).limit(10), "two") == 10
    assert [(r._session, r.n) for r in store.sessions().orderBy("_session").collect()] == [("one", 50), ("two", 10)]
    assert sorted(r._idx for r in store.cases().collect()) == list(range(60))
    assert store.get(["id"], indices=[("one", 3), ("two", 55)]).count() == 2
    assert store.edit({"p_size": 77}, {"p_size": [1, 25]}) == store.get(condition={"p_size": 77}).count()
    n = store.count()
    gone = store.remove(session="two", distribute_features=["p_size"])
    assert gone == 10 and store.count() == n - 10
    assert store.cases().agg(F.sum("_case_weight")).first()[0] == pytest.approx(60)
    other = CaseStore(spark, str(tmp_path / "b"))
    moved = store.move(other, {"p_size": 77})
    assert moved == other.count() and store.count() + moved == 50
    store.combine(other)
    assert store.count() == 50
    session = store.begin_session("Blue sky", {"a": 1})
    assert store.query_sessions("blue").first().session == session
    store.set_params("p_size", ["p_type"], {"k": 3})
    store.set_params("p_brand", ["p_type"], {"k": 9})
    assert store.params("p_size", ["p_type"]) == {"k": 3}
    store.append_series("s1", part.limit(3))
    assert store.series("s1").count() == 3
    store.remove_series("s1")
    assert store.similar({"p_size": 40}, 4).count() == 4 and store.extreme("p_retailprice", -2).count() == 2
    assert store.copy(str(tmp_path / "c")).count() == 50


def test_reduce_keeps_mass(part):
    got = reduce.reduce_cases(part, metric_of(part, ["p_size", "p_type"]), 50, 5)
    assert got.count() == 50 and got.agg(F.sum("_case_weight")).first()[0] == pytest.approx(part.count())


def test_impute_and_clear(part):
    df = part.withColumn("p_brand", F.when(F.col("id") % 9 != 0, F.col("p_brand"))).withColumn("p_retailprice", F.when(F.col("id") % 5 != 0, F.col("p_retailprice")))
    got = reduce.impute(df, {"p_brand": "nominal", "p_retailprice": "continuous"}, ["p_size", "p_type"], 5, rounds=2)
    assert got.where("p_brand IS NULL OR p_retailprice IS NULL").count() == 0
    back = reduce.clear_imputed(got, "impute")
    assert back.where("p_brand IS NULL").count() == df.where("p_brand IS NULL").count()


def test_synthesis(part):
    m = metric_of(part, ["p_size", "p_type"])
    args = dict(residuals={"p_size": 3.0}, bounds={"p_size": (1, 50)}, decimals={"p_size": 0}, seed=4)
    a = synth.generate(part, m, {"p_size": "continuous", "p_type": "nominal"}, 100, **args)
    b = synth.generate(part, m, {"p_size": "continuous", "p_type": "nominal"}, 100, **args)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 100
    assert not a.where("p_size < 1 OR p_size > 50").count() and synth.shortfall(a, 120) == 20
    p = synth.privacy(a, part, m, 0.5)
    assert p.count() == 100
    with pytest.raises(ValueError):
        synth.generate(part, m, {"p_size": "continuous"}, 1, residuals={}, conviction=0)


def test_new_cases_repeat_none(part):
    m = metric_of(part, ["p_size", "p_type"])
    got = synth.generate_new(part, m, {"p_size": "continuous", "p_type": "nominal"}, 60, mode="always", residuals={"p_size": 30.0}, bounds={"p_size": (1, 50)})
    known = {(float(r.p_size), r.p_type) for r in part.collect()}
    assert not [r for r in got.collect() if (r.p_size, r.p_type) in known]


def test_analyze(part):
    m = metric_of(part, ["p_size", "p_type", "p_retailprice"])
    got = analyze.analyze(part, m, {"p_retailprice": "continuous", "p_size": "continuous"}, "p_retailprice", k_values=[3, 7], use_deviations=True, inverse_weights=True)
    assert got["p_retailprice"]["k"] in (3, 7) and sum(got["p_retailprice"]["weights"].values()) == pytest.approx(2)
    auto = analyze.AutoAnalyze(threshold=100)
    assert not auto.due(99) and auto.due(100) and not auto.done(100).due(101)
    assert analyze.shared({"a": 1.0, "b": 3.0}, [["a", "b", "c"]]) == {"a": 2.0, "b": 2.0, "c": 2.0}


# --- sources


def test_sources(spark, part, tmp_path):
    path = str(tmp_path)
    readers.write(part, f"{path}/p", partition_by=["p_type"])
    part.write.csv(f"{path}/c", sep="\t", header=True)
    part.write.json(f"{path}/j")
    part.createOrReplaceTempView("kinfold_part")
    n = part.count()
    assert [readers.parquet(spark, f"{path}/p").count(), readers.delimited(spark, f"{path}/c", "\t").count(), readers.documents(spark, f"{path}/j").count(), readers.sql_table(spark, "kinfold_part").count()] == [n] * 4
    with pytest.raises(Exception):
        readers.write(part, f"{path}/p")
    keys = readers.map_keys(part, "p_brand").collect()
    assert sorted(r.surrogate for r in keys) == list(range(len(keys)))
    assert readers.column_type(part.schema["p_retailprice"].dataType) == ("numeric", 8)


def test_mutated_maps_use_every_key(spark):
    """More distinct keys than any limit: each of the drawn base cases gives all of its entries."""
    df = spark.range(1100).withColumn("m", F.map_from_entries(F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.struct(F.concat_ws("-", "id", i).alias("k"), F.col("id").alias("v")))))
    got = synth.mutate_maps(df, "m", 700, 3)
    assert got.count() == 700 and got.select("id").distinct().count() == 700
    entries = got.select(F.explode("m").alias("k", "v"))
    assert entries.count() == 700 * 11 and not entries.where("split(k, '-')[0] <> v").count()
    plain = synth.mutate_maps(spark.range(50).select("id", F.create_map(F.lit("a"), F.col("id"), F.lit("b"), F.col("id")).alias("m")), "m", 400, 3).collect()
    assert all(set(r.m) == {"a", "b"} for r in plain) and sum(r.m["a"] != r.m["b"] for r in plain) > 300


def test_store_numbers_cases_in_order(spark, tmp_path):
    """The order holds over many partitions, none of which has all rows."""
    store = CaseStore(spark, f"{tmp_path}/store")
    store.train(spark.range(5000).select(F.pmod(F.col("id") * 7, F.lit(5000)).alias("key")).repartition(6), "a", order=["key"])
    store.train(spark.range(5000, 5100).repartition(3).select(F.col("id").alias("key")), "b", order=["key"])
    assert not store.cases().where("_idx <> key").count() and store.count() == 5100


# --- repairs and later additions


def test_store_numbers_single_cases(spark, tmp_path):
    store = CaseStore(spark, str(tmp_path / "s"))
    for x in (1, 2, 3):
        store.train(spark.createDataFrame([(x,)], "x int"), f"s{x}")
    assert sorted((r.x, r._idx) for r in store.cases().collect()) == [(1, 0), (2, 1), (3, 2)]
    assert store.edit({"x": 9}, indices=[("s1", 0)]) == 1


def test_combined_stores_keep_cases_apart(spark, tmp_path):
    a, b = CaseStore(spark, str(tmp_path / "a")), CaseStore(spark, str(tmp_path / "b"))
    a.train(spark.createDataFrame([(i, float(i)) for i in range(6)], "x int, y double"), "a")
    b.train(spark.createDataFrame([(10 + i, 10.0 + i) for i in range(6)], "x int, y double"), "b")
    a.combine(b)
    assert sorted(r.x for r in a.similar({"x": 12}, 3).collect()) == [11, 12, 13]
    a.remove({"x": [12, 12]}, distribute_features=["x"], k=2)
    mass = {r.x: r._case_weight for r in a.cases().collect()}
    assert sum(mass.values()) == pytest.approx(12) and mass[11] == pytest.approx(1.5) and mass[13] == pytest.approx(1.5) and mass[1] == 1
    a.train_weights(spark.createDataFrame([(3,)], "x int"), ["x"], 1)
    assert {r.x: r._case_weight for r in a.cases().collect()}[3] == pytest.approx(2)


def test_ordinals_and_formats_as_observed(spark):
    df = spark.createDataFrame([("b", "9:30", "2024-01-02 03:04:05.120", "2024-01-02T03:04:05Z"), ("c", "10:15", "2024-01-02 03:04:06.130", "2024-01-02T03:04:06Z"), (None, None, None, None)], "o string, t string, d string, z string")
    got = profile.infer(df, ordinal_values={"o": ["a", "b", "c", "d"]})
    assert (got["o"].observed_min, got["o"].observed_max, got["o"].allowed) == ("b", "c", ["a", "b", "c", "d"])
    assert (got["t"].format, got["t"].cycle_length) == ("HH:mm", 86400.0)
    assert got["d"].format == "yyyy-MM-dd HH:mm:ss.SSS" and got["z"].format == "yyyy-MM-dd'T'HH:mm:ssXXX"
    assert profile.infer(df.select(F.lit(None).cast("string").alias("o")), ordinal_values={"o": ["a"]})["o"].observed_min is None


def test_mode_bounds_among_many_modes(spark):
    """More than a hundred tied modes: the bound that is one of them still holds."""
    df = spark.createDataFrame([(float(i) + 0.5,) for i in range(300) for _ in range(4)], "x double")
    got = profile.infer(df)["x"]
    assert (got.min, got.max) == (0.5, 299.5)


def test_semi_structured_distances(spark):
    data = [(1, '{"a":1,"b":[1,2]}'), (2, '{"b":[1,3],"a":1}'), (3, None), (4, "plain words here"), (5, "plain words"), (6, "{}"), (7, None)]
    df = spark.createDataFrame(data, "id int, v string")
    m = Metric((Feature("v", "json"),))
    near = {(r.query_id, r.case_id): r.distance for r in knn.knn(df, df, m, 6).collect()}
    assert near[1, 2] == pytest.approx(0.5) and near[4, 5] == pytest.approx(1 / 3) and near[3, 7] == 0 and near[3, 1] == 1 and near[1, 6] == 1
    assert near == pytest.approx({(r.query_id, r.case_id): r.distance for r in knn.knn_sql(df, df, m, 6).collect()})


def test_learned_class_distances(spark):
    rows = [(i, float(i % 4 // 2), "abcd"[i % 4]) for i in range(80)]  # a and b share their contexts, as do c and d
    df = spark.createDataFrame(rows, "id int, x double, c string")
    learned = influence.class_distances(df, metric_of(df, ["x", "c"]), "c", 20)
    got = {(r.a, r.b): r.difference for r in learned.collect()}
    assert got.keys() == {("a", "b"), ("b", "a"), ("c", "d"), ("d", "c")} and 0.3 < got["a", "b"] < 0.8 and got["a", "b"] == got["b", "a"]
    m = influence.with_class_distances(metric_of(df, ["c"]), "c", learned)
    near = {(r.query_id, r.case_id): r.distance for r in knn.knn(df.where("id = 0"), df.where("id in (1, 2, 4)"), m, 3).collect()}
    assert near[0, 4] == 0 and near[0, 1] == pytest.approx(got["a", "b"]) and near[0, 2] == 1


def test_groups_of_conditions(spark):
    df = spark.createDataFrame([(i, float(i % 10), float(i)) for i in range(60)], "id int, x double, y double")
    m = metric_of(df, ["x", "y"])
    got = {r.group_id: r for r in conviction.groups_of(df, m, {"low": {"y": [0, 19]}, "all": None, "two": df.where("id < 2").select("id")}, 5).collect()}
    assert got["low"].n == 20 and got["two"].n == 2 and "all" not in got  # nothing is left of it once held out
    assert all(r.familiarity_conviction_removal > 0 and 0 < r.p_value_of_removal <= 1 for r in got.values())


def test_forecast_stops_and_follows(spark):
    rows = [(s, i, float(i) * (1 if s < 2 else 10), 100 * s + i) for s in range(4) for i in range(12)]
    df = spark.createDataFrame(rows, "s int, t int, v double, k int").withColumn("t", F.timestamp_seconds(F.col("t") * 60))
    learned = series.training_rows(df, ["s"], "t", {"v": "continuous"}, 2, "k")
    m = metric_of(learned, ["v_lag_1", "v_lag_2"])
    run = lambda **o: {(r.s, r.step): r for r in series.forecast(df, ["s"], "t", {"v": "continuous"}, m, 4, key="k", lags=2, k=3, **o).collect()}
    limits = spark.createDataFrame([(0, 2, None), (1, None, 60 * 12.5)], "s int, max_length int, final_time double")
    got = run(limits=limits)
    assert max(n for s, n in got if s == 0) == 2 and got[0, 2].series_end and not got[0, 1].series_end
    assert max(n for s, n in got if s == 1) < 4 and max(n for s, n in got if s == 2) == 4
    got = run(stop_maps={"v": {"max": 50}})
    assert max(n for s, n in got if s == 3) == 1 and max(n for s, n in got if s == 0) == 4
    assert len(run(tracking="dynamic")) == 16
    near = spark.createDataFrame([(1, 5, 0.6, 1), (1, 6, 0.3, 2), (1, 7, 0.1, 2), (2, 5, 1.0, 2)], "query_id int, case_id int, weight double, s int")
    assert sorted((r.query_id, r.case_id, r.weight) for r in series.followed(near, ["s"]).collect()) == [(1, 5, 1.0), (2, 5, 1.0)]
    with pytest.raises(ValueError):
        series.infer(df, ["s"], "t", orders=1, derived_orders={"v": 1})


def test_reduce_by_deltas_and_ablation_params(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 7) + (i % 3)) for i in range(160)], "id int, x double, y double")
    m = metric_of(df, ["x"])
    assert reduce.reduce_until(df, m, "y", "continuous", stat="mae", delta=-1.0, least=20, k=5).count() == 160
    assert reduce.reduce_until(df, m, "y", "continuous", stat="mae", delta=-1.0, least=20, most=50, k=5).count() == 40
    assert reduce.reduce_until(df, m, "y", "continuous", stat="mae", delta=10.0, least=30, k=5).count() == 40
    store = CaseStore(spark, str(tmp_path / "s"))
    assert reduce.AblationParams.of(store) == reduce.AblationParams()
    reduce.AblationParams(enabled=True, exact=("y",), tolerance={"y": 0.5}).save(store)
    assert reduce.AblationParams.of(store) == reduce.AblationParams(enabled=True, exact=("y",), tolerance={"y": 0.5})


def test_invalid_features_and_small_details(spark):
    from kinfold.operators.validate import invalid_features

    bad = {"a": profile.Attributes("a", type="text"), "b": profile.Attributes("b", type="ordinal"), "c": profile.Attributes("c", type="continuous", min=2, max=1, dependent=["z"]), "d": profile.Attributes("d", type="nominal")}
    assert {n for n, _ in invalid_features(bad)} == {"a", "b", "c"} and not any(n == "a" for n, _ in invalid_features(bad, ("text",)))
    errors_ = react.observational_errors(spark, {"a": profile.Attributes("a", extra={"observational_error": 0.5}), "b": profile.Attributes("b")}).collect()
    assert [(r.feature, r.observational_error) for r in errors_] == [("a", 0.5), ("b", None)]
    df = spark.createDataFrame([({"1.0": 0.4, "x": 0.6},)], "p map<string,double>")
    assert df.select(react.clean_keys(F.col("p"), "integer").alias("p")).first().p == {"1": 0.4, "x": 0.6}
    both = react.accumulated([spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3,)], "a int")])
    assert both.count() == 2 and both.where("b IS NULL").count() == 1
    details = {"residuals": spark.createDataFrame([("x", 1.0), ("y", 2.0)], "feature string, v double"), "x": both}
    assert react.of_features(details, ["x"])["residuals"].count() == 1 and react.of_features(details, ["y"]).keys() == {"residuals"}


def test_goal_samples_and_robust_details(spark):
    df = spark.createDataFrame([(i, float(i), float((i * 7) % 11), "ab"[i % 2]) for i in range(40)], "id int, x double, y double, c string")
    m = metric_of(df, ["x", "c"])
    got = {r.query_id: r.case_id for r in stats.goal_sample(df, m, {"y": "max"}, 40, 3).collect()}
    y = {r.id: r.y for r in df.collect()}
    assert len(got) == 40 and all(y[c] >= y[q] for q, c in got.items())
    per = influence.robust_case_contributions(df, df, m, "y", 4, samples=5, seed=2)
    assert per.agg(F.max("n")).first()[0] <= 5 and per.where("contribution < 0").count() == 0
    assert {r.feature for r in influence.permutation_accuracy(df, m, "y", 4, robust=3).collect()} == {"x", "c"}
    combos = influence.value_combinations(influence.contributions(df, df, m, "y", 4), df, {"x": "continuous", "c": "nominal"}, buckets=2, least=5)
    assert {(r.value_x, r.value_c) for r in combos.collect()} == {(a, b) for a in (0, 1) for b in "ab"}
    with pytest.raises(ValueError):
        stats.selected(df, ["nothing"])
    near = stats.chosen(df, {"x": 20}, m, precision="similar", most=3)
    assert {r.id for r in near.collect()} == {19, 20, 21}
    assert stats.chosen(df, {"x": [5, None]}, m, most=7).count() == 7


def test_one_sided_bounds_and_draws(spark):
    df = spark.createDataFrame([(i, float(i % 20)) for i in range(500)], "id int, x double")
    m = metric_of(df, ["x"])
    make = lambda b: synth.generate(df, m, {"x": "continuous"}, 300, residuals={"x": 30.0}, bounds={"x": b}).agg(F.min("x"), F.max("x")).first()
    assert make((0, None))[0] == 0 and make((0, None))[1] > 30 and make((None, 10))[1] == 10 and make((None, 10))[0] < -5
    draws = synth.base_cases(df, 2000, 3).groupBy("base").agg(F.count("*").alias("n"))
    assert draws.agg(F.sum("n")).first()[0] == 2000 and draws.count() > 450


def test_boundary_values_with_outcome(spark):
    df = spark.createDataFrame([(i, float(i), float(i * i)) for i in range(12)], "id int, x double, y double")
    m = metric_of(df, ["x"])
    near = react.neighbours(df, df, m, 3, carry=["y"])
    found = react.boundary_cases(df, df, m, react.predict_continuous(near, "y"), "y", 2, kind="continuous", pool=5)
    assert found.groupBy("query_id").count().where("count <> 2").count() == 0
    some = react.boundary_values(found, df, ["x"], outcome={"y": [0, 50]}).collect()
    assert some and all(r.x <= 7 for r in some)


def test_approximate_neighbours_in_crowds(spark):
    """Crowded cells are cut, recall stays, and the aggregates can use the approximate join."""
    df = spark.createDataFrame([(i, (i * 37 % 1009) / (1.0 if i < 500 else 50.0), float(i * 11 % 997)) for i in range(3000)], "id int, x double, y double")
    m = metric_of(df, ["x", "y"])
    true = {(r.query_id, r.case_id) for r in knn.knn(df.where("id % 50 = 0"), df, m, 5).collect()}
    for crowded, least in ((2000, 0.9), (60, 0.6)):
        got = knn.knn_approximate(df.where("id % 50 = 0"), df, m, 5, width=120.0, tables=12, crowded=crowded)
        assert len(true & {(r.query_id, r.case_id) for r in got.collect()}) >= least * len(true)
    exact = stats.leave_one_out(df, metric_of(df, ["x"]), "y", "continuous", 5).agg(F.avg(F.abs(F.col("actual") - F.col("predicted")))).first()[0]
    near = stats.leave_one_out(df, metric_of(df, ["x"]), "y", "continuous", 5, approximate={"width": 30.0}).agg(F.avg(F.abs(F.col("actual") - F.col("predicted")))).first()[0]
    assert near == pytest.approx(exact, rel=0.1)


def test_cases_keep_an_identity_when_stores_meet(spark, tmp_path):
    a, b = CaseStore(spark, str(tmp_path / "a")), CaseStore(spark, str(tmp_path / "b"))
    for store, base in ((a, 0), (b, 10)):
        store.train(spark.createDataFrame([(base + i,) for i in range(4)], "x int"))
    a.combine(b)
    assert a.cases().select("_session", "_idx").distinct().count() == 8
    assert b.move(a, {"x": [10, 11]}) == 2 and a.cases().select("_session", "_idx").distinct().count() == 10 and b.count() == 2


def test_written_times_samples_and_empty_floats(spark):
    df = spark.createDataFrame([("2024-01-02 03:04", 1.5, None), (None, None, None), ("2024-01-05 03:04", 2.5, None)], "t string, x double, e double")
    got = profile.infer(df, include_sample=True)
    assert (got["t"].format, got["t"].observed_min, got["t"].observed_max) == ("yyyy-MM-dd HH:mm", "2024-01-02 03:04", "2024-01-05 03:04")
    assert got["t"].min < got["t"].observed_min and got["t"].max > got["t"].observed_max
    assert got["t"].sample in ("2024-01-02 03:04", "2024-01-05 03:04") and float(got["x"].sample) in (1.5, 2.5)
    assert got["e"].max > 1e308 and got["e"].min < -1e308
    assert profile.infer(df, tight_bounds=["t"])["t"].max == "2024-01-05 03:04"
