"""The pruned search and searches by several lists of features, against the plain search."""

import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import conviction, influence, pruned, stats, synth
from kinfold.operators import knn as knn_module
from kinfold.operators.knn import Feature, Metric, knn, knn_alike, metric_of

SCHEMA = "id bigint, a double, b double, c string, t bigint, extra string"


@pytest.fixture(scope="module")
def cases(spark):
    """Clusters, equal rows, nulls and a far point."""
    r = random.Random(4)
    rows = [(i, r.gauss(r.choice([0, 50, 90]), 2), r.random() * 10, r.choice("xyz"), i % 7, "e") for i in range(300)]
    rows += [(300 + i, 5.0, 5.0, "x", 1, None) for i in range(150)]  # a third are equal
    rows += [(500, None, 3.0, "y", 2, None), (501, None, None, None, 3, None), (502, 1e6, 3.0, "z", 0, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def told(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("p,options", [(1.0, {}), (2.0, {"carry": ["extra"]}), (0.5, {"differ": ["t"]}), (1.0, {"agree": ["c"], "self_too": True}), (2.0, {"not_later": "t", "pivots": 3})])
def test_pruned_rows_are_those_of_the_plain_search(cases, p, options):
    m = metric_of(cases, ["a", "b", "c"], p)
    assert pruned.prunable(cases, m)
    plain = {k: v for k, v in options.items() if k != "pivots"}
    assert told(pruned.search(cases, cases, m, 7, **options).near) == told(knn(cases, cases, m, 7, **plain, pruned=False))


def test_pruned_blocks(cases, monkeypatch):
    for name, value in (("CASE_BLOCK", 40), ("QUERY_BLOCK", 30), ("QUERY_TILE", 8)):
        monkeypatch.setattr(pruned, name, value)
    m = metric_of(cases, ["a", "b", "c"])
    assert told(pruned.knn_pruned(cases.where("id % 3 = 0"), cases, m, 5)) == told(knn(cases.where("id % 3 = 0"), cases, m, 5))


def test_pruned_compares_few_pairs(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    found = pruned.search(part, part, metric_of(part, ["p_size", "p_retailprice"]), 10, id_column="p_partkey")
    work = found.work.first()
    assert found.near.count() == 20_000 and work.all_pairs == 4_000_000 and work.compared + work.to_pivots < 0.2 * work.all_pairs


def test_prunable_metrics(cases):
    assert not pruned.prunable(cases, Metric((Feature("c", "nominal", table=(("x", "y", 0.1),)),)))
    assert not pruned.prunable(cases, Metric((Feature("a", spread=1.0),)))  # two far values would both be near a null
    assert pruned.prunable(cases, Metric((Feature("c", "nominal"), Feature("b", spread=10.0))))
    with pytest.raises(ValueError):
        knn(cases, cases, Metric((Feature("a", spread=1.0),)), 3, pruned=True)


def test_pruned_empty(cases):
    m = metric_of(cases, ["a", "c"])
    none = cases.limit(0)
    assert pruned.search(none, cases, m, 3).near.count() == 0
    got = pruned.search(cases, none, m, 3)
    assert got.near.count() == 0 and got.work.first().compared == 0


def test_masks_are_separate_searches(cases):
    m = metric_of(cases, ["a", "b", "c"], 2.0)
    masks = [["a"], ["b", "c"], ["a", "b", "c"], []]
    got = knn(cases, cases, m, 4, masks=masks, carry=["extra"])
    for i, mask in enumerate(masks):
        own = got.where(F.col("query_id.mask") == i).withColumn("query_id", F.col("query_id.id"))
        assert told(own) == told(knn(cases, cases, m.without(*({"a", "b", "c"} - set(mask))), 4, carry=["extra"]))
    blocked = knn(cases, cases, m, 4, masks=masks, carry=["extra"], broadcast_queries=100)
    assert told(blocked) == told(got)


def test_contributions_take_one_search(spark, cases, monkeypatch):
    calls = []
    monkeypatch.setattr(influence, "neighbours", lambda *a, _f=influence.neighbours, **o: calls.append(1) or _f(*a, **o))
    m = metric_of(cases, ["a", "b", "c"])
    known = cases.where("a IS NOT NULL")
    assert influence.contributions(known, known, m, "a", 5, robust=6, seed=2).count() == 2 * known.count() and len(calls) == 1
    assert influence.residuals(cases, m, {"a": "continuous", "b": "continuous", "c": "nominal"}, 5).count() == 3 and len(calls) == 2


def test_local_statistics_of_nulls_and_classes(spark):
    from kinfold.operators import react

    near = spark.createDataFrame([(1, c) for c in range(6)] + [(2, 0), (3, 5)], "query_id bigint, case_id bigint")
    loo = spark.createDataFrame([(0, 1.0, 2.0), (1, 2.0, 2.0), (2, 4.0, 3.0), (3, None, 1.0), (4, 2.0, None), (5, None, None)], "case_id bigint, actual double, predicted double")
    got = {r.query_id: r for r in react.local_prediction_stats(near, loo, "continuous").collect()}
    one = got[1]
    assert abs(one.mae - 2 / 3) < 1e-12 and abs(one.r2 - (1 - 2 / (14 / 3))) < 1e-12
    assert abs(one.missing_value_accuracy - 4 / 6) < 1e-12 and abs(one.spearman_coeff - 0.8660254037844387) < 1e-9
    assert got[2].mae == 1.0 and got[2].r2 is None and got[2].spearman_coeff is None and got[3].mae is None and got[3].missing_value_accuracy == 1.0
    classes = spark.createDataFrame([(0, "a", "a"), (1, "a", "b"), (2, "b", "b"), (3, "b", "b"), (4, None, "a"), (5, "c", "c")], "case_id bigint, actual string, predicted string")
    one = react.local_prediction_stats(near, classes, "nominal").where("query_id = 1").first()
    assert abs(one.accuracy - 4 / 6) < 1e-12 and abs(one.precision - (1 / 2 + 2 / 3 + 1) / 3) < 1e-12 and abs(one.recall - (1 / 2 + 1 + 0 + 1) / 4) < 1e-12
    assert [tuple(x) for x in one.confusion_matrix] == [(None, "a", 1), ("a", "a", 1), ("a", "b", 1), ("b", "b", 2), ("c", "c", 1)]


def test_means_over_the_neighbours(spark):
    from kinfold.operators import react

    near = spark.createDataFrame([(9, 1), (9, 2), (8, 2)], "query_id bigint, case_id bigint")
    own = spark.createDataFrame([(1, "f", 2.0), (2, "f", None), (2, "g", 5.0)], "query_id bigint, feature string, gain double")
    assert sorted(map(tuple, react.local_means(near, own).collect()), key=str) == [(8, "f", None), (8, "g", 5.0), (9, "f", 2.0), (9, "g", 5.0)]


@pytest.mark.parametrize("p,options", [(1.0, {"carry": ["extra"]}), (2.0, {"differ": ["t"]}), (1.0, {"agree": ["c"], "self_too": True}), (1.0, {"not_later": "t"}), (1.0, {"differ": ["id"], "agree": ["t"]})])
def test_folded_rows_are_those_of_the_plain_search(cases, p, options):
    m = metric_of(cases, ["a", "b", "c"], p)
    assert told(knn(cases, cases, m, 7, folded=True, **options)) == told(knn(cases, cases, m, 7, folded=False, pruned=False, **options))


def test_folded_kinds_of_features(cases):
    some = cases.withColumn("doc", F.concat("c", F.lit(" "), F.col("t").cast("string"))).where("id % 3 = 0")
    m = Metric((Feature("a", "expression", expression="a + t"), Feature("doc", "json"), Feature("id"), Feature("c", "tree")))
    for own in (m, m.without("id"), Metric(())):
        assert told(knn(some, cases.withColumn("doc", F.lit("x 3")), own, 4, folded=True)) == told(knn(some, cases.withColumn("doc", F.lit("x 3")), own, 4, folded=False))


def test_large_searches_compare_distinct_rows_only(cases, monkeypatch):
    from kinfold.operators import knn as module

    copies = cases.where("a IS NOT NULL").crossJoin(cases.sparkSession.range(20).withColumnRenamed("id", "copy")).withColumn("id", F.col("id") * 20 + F.col("copy"))
    m = metric_of(copies, ["b", "c"])
    expected = told(knn(copies, copies, m, 3, folded=False, pruned=False)), told(knn(copies, copies, m, 3, masks=[["b"], ["c"], []]))
    monkeypatch.setattr(module, "FOLDED_PAIRS", 1_000_000)
    sizes = []
    monkeypatch.setattr(module, "_prepared", lambda df, *a, _f=module._prepared, **o: sizes.append(df.count()) or _f(df, *a, **o))
    assert told(knn(copies, copies, m, 3)) == expected[0] and max(sizes) <= 302
    assert told(knn(copies, copies, m, 3, masks=[["b"], ["c"], []])) == expected[1] and max(sizes) <= 302


def test_rows_that_agree_meet_by_key(cases, monkeypatch):
    from kinfold.operators import knn as module

    m = metric_of(cases, ["a", "b"])
    plain = {name: told(knn(cases, cases, m, 4, agree=[name], folded=False, pruned=False)) for name in ("t", "extra")}
    for name, value in (("FOLDED_PAIRS", 1_000), ("AGREE_ROWS", 50), ("CASE_BLOCK", 60)):
        monkeypatch.setattr(module, name, value)
    monkeypatch.setattr(pruned, "search", None)
    for name, expected in plain.items():
        assert told(knn(cases, cases, m, 4, agree=[name], folded=False, broadcast_queries=40)) == expected
        assert told(knn(cases, cases, m, 4, agree=[name], broadcast_queries=40)) == expected


def test_distance_matrix_shuffles_no_pairs(cases):
    from kinfold.operators.knn import distance_matrix

    m = Metric((Feature("a", spread=3.0), Feature("b", "expression", expression="b + t"), Feature("c", "nominal"), Feature("t", "cyclic", cycle=7.0, weight=0.5)), p=2.0)
    some = cases.where("id % 7 = 0 OR id >= 500")
    got = distance_matrix(some, m)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Window" not in plan
    plain = knn(some, some, m, some.count(), self_too=True, pruned=False)
    told = lambda df, *c: sorted((r[0], r[1], round(r[2], 9)) for r in df.select(*c).collect())
    assert told(got, "from_id", "to_id", "distance") == told(plain, "query_id", "case_id", "distance")


def test_folded_approximate_search(cases):
    from kinfold.operators.knn import knn_approximate

    m, known = metric_of(cases, ["a", "b"]), cases.where("a IS NOT NULL")
    exact = {(r.query_id, r.case_id) for r in knn(known, known, m, 5).collect()}
    got = {(r.query_id, r.case_id) for r in knn_approximate(known, known, m, 5, width=5.0, folded=True).collect()}
    plain = {(r.query_id, r.case_id) for r in knn_approximate(known, known, m, 5, width=5.0, folded=False).collect()}
    assert len(got & exact) >= len(plain & exact) > 0.9 * len(exact)


def test_work_of_distinct_rows(cases):
    m = metric_of(cases, ["b", "c"])
    own = pruned.work_of_distinct(cases, cases, m, 5).first()
    assert own.all_pairs == cases.count() ** 2 and own.compared <= 303**2


def test_approximate_search_hands_on_k_a_cell(cases, monkeypatch):
    from kinfold.operators import knn as module

    told_of = []
    monkeypatch.setattr(module, "_dealt_by_agreement", lambda *a, _f=module._dealt_by_agreement: told_of.append(a[2]) or _f(*a))
    known = cases.where("a IS NOT NULL")
    got = module.knn_approximate(known, known, metric_of(cases, ["a", "b"]), 5, width=1e9, carry=["t"])
    assert told_of == ["id"] and told(got) == told(knn(known, known, metric_of(cases, ["a", "b"]), 5, carry=["t"]))


FEW = {"self": {}, "other": {"carry": ["extra"]}, "differ": {"differ": ["t"]}, "later": {"not_later": "t"}, "too": {"self_too": True}}


@pytest.mark.parametrize("name", FEW)
def test_queries_that_stand_for_others_have_their_rows(cases, name):
    """150 rows are equal: at most k of them, and one more, are searched for, and every row still gets what its own neighbours tell."""
    m = metric_of(cases, ["a", "b", "c"])
    queries = cases.where("id % 2 = 0 OR id = 301") if name == "other" else cases
    plain = knn(queries, cases, m, 7, folded=False, **FEW[name]).cache()
    found = knn_alike(queries, cases, m, 7, folded=True, **FEW[name])
    near = found.near.cache()
    who = near.select("query_id").distinct()
    assert who.count() <= 303 + 7 * 8  # the distinct rows, and 7 own ones for each of at most 7 values of t
    assert told(near) == told(plain.join(who, "query_id").select(near.columns))
    sums = lambda near: near.groupBy("query_id").agg(F.array_sort(F.collect_set("case_id")).alias("s"))
    assert told(found.spread(queries, sums(near)).where("s IS NOT NULL").select("id", "s")) == told(sums(plain))


def _rounded(df):
    return sorted(repr([round(x, 8) if isinstance(x, float) else x for x in row]) for row in df.collect())


MADE = {
    "loo": lambda c, m: stats.leave_one_out(c, m, "b", "continuous", 5),
    "loo_nominal": lambda c, m: stats.leave_one_out(c, m, "c", "nominal", 5),
    "residuals": lambda c, m: influence.residuals(c, m, {"b": "continuous", "c": "nominal"}, 5),
    "robust": lambda c, m: influence.robust_errors(c, c, m, "b", "continuous", 5, samples=2),
    "contributions": lambda c, m: influence.contributions(c, c, m, "b", 5),
    "permuted": lambda c, m: influence.permutation_accuracy(c, m, "b", 5),
    "features": lambda c, m: conviction.feature_conviction(c, m, 5),
    "groups": lambda c, m: conviction.groups(c, c, m, "c", 5),
}


@pytest.mark.parametrize("name", MADE)
def test_statistics_of_equal_rows_are_those_of_all_pairs(cases, name, monkeypatch):
    m = metric_of(cases, ["a", "b", "c"])
    plain = _rounded(MADE[name](cases, m))
    for module in (knn_module, influence):
        monkeypatch.setattr(module, "FOLDED_PAIRS", 0)
    assert _rounded(MADE[name](cases, m)) == plain


def test_generation_draws_from_distinct_rows(cases, monkeypatch):
    """Neighbours are kept for the distinct rows drawn, not for every draw; draws and privacy are those of the search of all pairs."""
    m = metric_of(cases, ["a", "b", "c"])
    kinds = {"a": "continuous", "b": "continuous", "c": "nominal"}
    kept = []

    def written(df, label):
        df = df.cache()
        if label in ("synth", "privacy") and "query_id" in df.columns:
            kept.append(df.select("query_id").distinct().count())
        return df

    monkeypatch.setattr(synth, "written", written)

    def run():
        kept.clear()
        got = synth.generate(cases, m, kinds, 600, residuals={"a": 0.0, "b": 0.0}, decimals={"a": 0, "b": 0}, k=4)
        return told(got), told(synth.privacy(got, cases, m, 0.5, k=4)), list(kept)

    plain = run()
    monkeypatch.setattr(knn_module, "FOLDED_PAIRS", 0)
    folded = run()
    assert folded[:2] == plain[:2] and len(plain[0]) == len(plain[1]) == 600
    assert plain[2] == [600, 600] and all(n < 400 for n in folded[2])
