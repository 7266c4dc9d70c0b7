"""Edit costs of trees against their definition, their bound, and the search that skips by it."""

import functools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.functions import trees
from kinfold.functions.trees import How, bounds, costs, edit_cost, tree_of
from kinfold.operators import knn as searching
from kinfold.operators.knn import Feature, Metric, knn, pairwise

HOWS = [How(), How(10.0), How(nominal_numbers=True), How(4.0, nominal_strings=False)]


def forest(x, key=""):
    """(key, kind, value, children) of a JSON value."""
    if isinstance(x, dict):
        return key, "{", None, tuple(forest(v, k) for k, v in sorted(x.items()))
    if isinstance(x, list):
        return key, "[", None, tuple(forest(v) for v in x)
    return key, "n" if isinstance(x, (int, float)) and not isinstance(x, bool) else "s" if isinstance(x, str) else repr(x), x, ()


def levenshtein(a, b):
    @functools.cache
    def d(i, j):
        if not i or not j:
            return i + j
        return min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))

    return d(len(a), len(b)) / max(1, len(a), len(b))


def by_definition(a, b, how):
    """The last trees of two forests are taken apart, or exchanged for each other."""

    def exchange(x, y):
        if x[:2] != y[:2]:
            return 1.0
        if x[1] == "n":
            return float(x[2] != y[2]) if how.nominal_numbers else min(1.0, abs(x[2] - y[2]) / how.scale)
        if x[1] == "s":
            return float(x[2] != y[2]) if how.nominal_strings else levenshtein(x[2], y[2])
        return 0.0

    def size(f):
        return sum(1 + size(t[3]) for t in f)

    @functools.cache
    def d(f, g):
        if not f or not g:
            return float(size(f) + size(g))
        x, y = f[-1], g[-1]
        return min(d(f[:-1] + x[3], g) + 1, d(f, g[:-1] + y[3]) + 1, d(f[:-1], g[:-1]) + d(x[3], y[3]) + exchange(x, y))

    return d((forest(a),), (forest(b),))


def value(r, depth=3):
    kind = r.random()
    if depth and kind < 0.35:
        return {k: value(r, depth - 1) for k in r.sample("abc", r.randint(0, 3))}
    if depth and kind < 0.6:
        return [value(r, depth - 1) for _ in range(r.randint(0, 3))]
    return r.choice([r.randint(0, 12), r.choice(["red", "reed", "blue", ""]), True, None, r.random()])


@pytest.mark.parametrize("how", HOWS)
def test_costs_by_definition(how):
    r = random.Random(3)
    values = [value(r) for _ in range(26)] + [{}, [], {"a": 1, "b": "red"}, {"b": "reed", "a": 4}, [1, 2, 3], [2, 3]]
    made = [tree_of(json.dumps(v)) for v in values]
    got, (low, exact) = costs(made, made, how), bounds(made, made, how)
    for i, a in enumerate(values):
        for j, b in enumerate(values):
            want = by_definition(a, b, how)
            assert got[i, j] == pytest.approx(want, abs=1e-9) and edit_cost(made[i], made[j], how) == pytest.approx(want, abs=1e-9)
            assert low[i, j] <= want + 1e-9 and (not exact[i, j] or low[i, j] == pytest.approx(want, abs=1e-9))
    assert exact.sum() > len(values)


def test_odd_texts():
    deep = "[" * 100_000 + "]" * 100_000
    assert tree_of(None) is None and tree_of("").labels == ("[",) and tree_of(deep).values == (deep, None)
    assert tree_of("two words").values == ("two", "words", None) and tree_of("[NaN]").values == ("NaN", None)
    assert tree_of('{"a": 1, "a": 2}').values == (2.0, None)
    big = tree_of("[1" + "0" * 400 + ", -1e999]")
    assert np.isfinite(costs([big], [tree_of("[0, 0]")], How())).all()
    assert costs([None, tree_of("1")], [None, tree_of("2")], How(4.0), 7.0).tolist() == [[0.0, 7.0], [7.0, 0.25]]
    assert costs([], [tree_of("1")], How()).shape == (0, 1)
    long = [tree_of(json.dumps(list(range(n)))) for n in (400, 401)]
    assert costs(long[:1], long[1:], How(nominal_numbers=True)).tolist() == [[1.0]]


@pytest.fixture(scope="module")
def cases(spark):
    r = random.Random(8)
    rows = [(i, json.dumps(value(r)), float(r.randint(0, 3)), "x") for i in range(60)]
    rows += [(200 + i, '{"a": [1, 2, "red"], "b": [3]}', 1.0, None) for i in range(30)]  # a third are copies
    rows += [(300, None, 1.0, None), (301, "", None, None), (302, "no json", 2.0, None), (303, None, None, None)]
    return spark.createDataFrame(rows, "id bigint, doc string, a double, extra string").repartition(3).cache()


@pytest.mark.parametrize("p,how", [(1.0, How(10.0)), (2.0, How(3.0, nominal_strings=False)), (0.5, How(nominal_numbers=True))])
def test_search_skips_only_what_is_far(cases, monkeypatch, p, how):
    m = Metric((Feature("doc", "tree", weight=2.0, deviation=1.5, spread=4.0, **how._asdict()), Feature("a", spread=3.0)), p)
    rows = cases.collect()
    made = [tree_of(r.doc) for r in rows]
    d = 2.0 * (costs(made, made, how, 4.0) / 1.5) ** p
    for i, x in enumerate(rows):
        for j, y in enumerate(rows):
            gap = 0.0 if x.a is None and y.a is None else 3.0 if x.a is None or y.a is None else abs(x.a - y.a)
            d[i, j] = (d[i, j] + gap**p) ** (1 / p)
    want = []
    for i, x in enumerate(rows):
        near = sorted((round(d[i, j], 9), y.id) for j, y in enumerate(rows) if y.id != x.id)[:6]
        want += [(x.id, c, v, k + 1) for k, (v, c) in enumerate(near)]

    def told(df):
        return sorted((r.query_id, r.case_id, round(r.distance, 9), r.rank) for r in df.collect())

    assert told(knn(cases, cases, m, 6)) == sorted(want)
    assert told(knn(cases, cases, m, 6, broadcast_queries=40, carry=["extra"])) == sorted(want)
    masked = knn(cases, cases, m, 6, masks=[["doc", "a"], ["a"]]).where("query_id.mask = 0").withColumn("query_id", F.col("query_id.id"))
    assert told(masked) == sorted(want)


def test_most_pairs_are_skipped(monkeypatch):
    r = random.Random(1)
    texts = [json.dumps({"n": r.randint(0, 99), "w": [r.choice("abcdefgh") for _ in range(r.randint(3, 9))]}) for _ in range(300)]
    t = np.empty(300, object)
    for i, x in enumerate(texts):
        t[i] = [tree_of(x)]
    none = np.zeros((300, 0))
    block = searching._Block(np.arange(300), none, none.astype(int), np.array([[]] * 300 + [None], object)[:300], none.astype(int), np.zeros(300), t)
    done = []
    monkeypatch.setattr(trees, "edit_cost", lambda a, b, how, real=edit_cost: done.append(1) or real(a, b, how))
    list(searching._best(block.at(slice(0, 30)), block, Metric((Feature("doc", "tree", scale=50.0),)), searching._Rules(), 3))
    assert 0 < len(done) < 0.25 * 30 * 300


def test_paired_distances(spark, cases):
    m = Metric((Feature("doc", "tree", scale=5.0, spread=2.0),))
    left, right = cases.select("id", "doc"), cases.select((F.col("id") - 1).alias("id"), "doc")
    texts = {r.id: r.doc for r in cases.collect()}
    for r in pairwise(left, right, m, ["id"]).collect():
        assert r.distance == pytest.approx(costs([tree_of(texts[r.id])], [tree_of(texts[r.id + 1])], How(5.0), 2.0)[0, 0])


def test_empty_tables(spark, cases):
    m = Metric((Feature("doc", "tree"),))
    assert knn(cases.limit(0), cases, m, 3).count() == 0 and knn(cases, cases.limit(0), m, 3).count() == 0


def test_one_frame_needs_no_dynamic_programme():
    """A list that both trees have stands for its own labels, which stand more than once; before, only trees without such labels were told exactly."""
    texts = [json.dumps({"n": i, "b": b, "l": letters}) for i in (1, 4) for b in ("x", "y") for letters in (["a", "b"], ["b", "a"], ["a", "b", "c"])]
    held = [tree_of(t) for t in texts]
    how = How(10.0)
    low, exact = bounds(held, held, how)
    for i, a in enumerate(held):
        for j, b in enumerate(held):
            assert exact[i, j] == (i % 3 == j % 3)
            assert low[i, j] <= edit_cost(a, b, how) + 1e-9
            if exact[i, j]:
                assert low[i, j] == edit_cost(a, b, how)


def test_sides_are_taken_once_a_block(spark, monkeypatch):
    """Not once a tile of queries, and blocks of trees are smaller than those of numbers."""
    made = []
    one = trees.sides
    monkeypatch.setattr(trees, "sides", lambda a, b, how: made.append((len(a), len(b))) or one(a, b, how))
    texts = np.empty(40, object)
    texts[:] = [[tree_of(json.dumps({"n": i, "l": ["a"] * (i % 3)}))] for i in range(40)]
    none = np.zeros((40, 0))
    block = searching._Block(np.arange(40), none, none.astype(np.int64), texts, none.astype(np.int64), np.zeros(40), texts)
    m = Metric((Feature("doc", "tree", scale=10.0),))
    whole = [tuple(map(np.ndarray.tolist, found[1:])) for found in searching._best(block, block, m, searching._Rules(), 3)]
    assert made[0] == (40, 40)
    made.clear()
    monkeypatch.setattr(searching, "TILE", 400)
    tiles = [tuple(map(np.ndarray.tolist, found[1:])) for found in searching._best(block, block, m, searching._Rules(), 3)]
    assert len(tiles) == 4 and [sum((t[i] for t in tiles), []) for i in range(3)] == list(map(list, whole[0]))
    assert made.count((40, 40)) == 1
    assert searching.STRUCTURED_BLOCK[0] * searching.STRUCTURED_BLOCK[1] <= 100_000_000
