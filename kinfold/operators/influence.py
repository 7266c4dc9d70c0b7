"""What features do for predictions: residuals, deviations, prediction and accuracy contributions, full and robust."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.storage import written
from .knn import FOLDED_PAIRS, Alike, Metric, each_alone
from .react import case_accuracy_contributions, case_contributions, class_probabilities, neighbours, neighbours_alike, predict_continuous
from .stats import leave_one_out, predicted, with_prediction


def errors(df: DataFrame, kind: str) -> DataFrame:
    """(query_id, error): absolute error, or 1 - probability of the true class."""
    e = F.abs(F.col("actual").cast("double") - F.col("predicted")) if kind == "continuous" else 1 - F.col("p_true")
    return df.select("query_id", e.alias("error"))


def masked_neighbours(queries: DataFrame, cases: DataFrame, metric: Metric, masks: list[tuple[str, ...]], k: int, *, carry: list[str], id_column: str = "id", **options) -> DataFrame:
    """Neighbours by each of several lists of features; query_id is a struct (id, mask). One search, however many masks; the approximate join searches once a mask."""
    if options.get("approximate") is None:
        return neighbours(queries, cases, metric, k, carry=carry, id_column=id_column, masks=[list(m) for m in masks], **options)
    out = []
    for i, mask in enumerate(masks):
        near = neighbours(queries, cases, metric.without(*(n for n in metric.names() if n not in mask)), k, carry=carry, id_column=id_column, **options)
        out.append(near.withColumn("query_id", F.struct(F.col("query_id").alias("id"), F.lit(i).alias("mask"))))
    return reduce(lambda a, b: a.union(b), out)


def masked_alike(queries: DataFrame, cases: DataFrame, metric: Metric, masks: list[tuple[str, ...]], k: int, *, carry: list[str], id_column: str = "id", folded: bool | None = None, **options) -> list[Alike]:
    """`neighbours_alike` by each of several lists of features. One search of all pairs of rows, or where these are many one of distinct rows a mask."""
    if options.get("approximate") is None and (folded or folded is None and queries.count() * cases.count() * len(masks) > FOLDED_PAIRS):
        each = (metric.without(*(n for n in metric.names() if n not in mask)) for mask in masks)
        return [neighbours_alike(queries, cases, own, k, carry=carry, id_column=id_column, folded=True, **options) for own in each]
    near = written(masked_neighbours(queries, cases, metric, masks, k, carry=carry, id_column=id_column, **options, **({} if folded is None else {"folded": folded})), "masked").hint("merge")
    return [each_alone(near.where(F.col("query_id.mask") == i).withColumn("query_id", F.col("query_id.id")), id_column) for i in range(len(masks))]


def _asked(queries: DataFrame, action: str, masks: int, id_column: str) -> DataFrame:
    """(query_id (id, mask), actual): a row for every query and mask."""
    mask = F.explode(F.array(*map(F.lit, range(masks)))).alias("mask")
    return queries.select(F.col(id_column).alias("id"), F.col(action).alias("actual"), mask).select(F.struct("id", "mask").alias("query_id"), "actual")


def residuals(cases: DataFrame, metric: Metric, kinds: dict[str, str], k: int = 10, *, id_column: str = "id", queries: DataFrame | None = None, **options) -> DataFrame:
    """(feature, residual, null_residual): mean leave-one-out error of each feature from all others, and the error of its null-ness. All features come from one search."""
    asked = cases if queries is None else queries
    masks = [tuple(n for n in metric.names() if n != f) for f in kinds]
    found = masked_alike(asked, cases, metric, masks, k, carry=list(kinds), id_column=id_column, **options)
    out = []
    for (f, kind), own in zip(kinds.items(), found, strict=True):
        got = predicted(asked, own, f, kind, id_column)
        missing = F.avg((F.col("actual").isNull() != F.col("predicted").isNull()).cast("double"))
        e = F.abs(F.col("actual").cast("double") - F.col("predicted")) if kind == "continuous" else F.when(F.col("actual").isNotNull(), 1 - F.col("p_true"))
        out.append(got.agg(F.lit(f).alias("feature"), F.avg(e).alias("residual"), missing.alias("null_residual")).select("feature", "residual", "null_residual"))
    return reduce(lambda a, b: a.union(b), out)


def deviations(cases: DataFrame, metric: Metric, kinds: dict[str, str], k: int = 10, *, id_column: str = "id", **options) -> DataFrame:
    """(feature, deviation): as residuals, but the feature itself is a context too. All features come from one search."""
    near = written(neighbours(cases, cases, metric, k, carry=list(kinds), id_column=id_column, **options), "deviations").hint("merge")
    out = []
    for f, kind in kinds.items():
        actual = cases.select(F.col(id_column).alias("query_id"), F.col(f).alias("actual"))
        if kind == "continuous":
            df = actual.join(predict_continuous(near, f, name="predicted"), "query_id")
            e = F.avg(F.abs(F.col("actual").cast("double") - F.col("predicted")))
        else:
            probs = class_probabilities(near, f).withColumnRenamed("class", "actual")
            df = actual.join(probs, ["query_id", "actual"], "left")
            e = 1 - F.avg(F.coalesce("probability", F.lit(0.0)))
        out.append(df.agg(F.lit(f).alias("feature"), e.alias("deviation")).select("feature", "deviation"))
    return reduce(lambda a, b: a.union(b), out)


def subsets(features: list[str], n: int, seed: int = 0) -> list[tuple[str, ...]]:
    """n random non-empty subsets, each feature in or out with equal chance; the same ones for a seed."""
    draw = random.Random(seed)
    out = []
    while len(out) < n:
        got = tuple(f for f in features if draw.random() < 0.5)
        if got:
            out.append(got)
    return out


def robust_errors(queries: DataFrame, cases: DataFrame, metric: Metric, action: str, kind: str, k: int = 10, *, samples: int = 10, seed: int = 0, id_column: str = "id", **options) -> DataFrame:
    """(query_id, error): mean error of an action over `samples` random subsets of the contexts, the same subsets for a seed."""
    drawn = subsets([n for n in metric.names() if n != action], samples, seed)
    masks = sorted(set(drawn))
    df = queries
    for i, own in enumerate(masked_alike(queries, cases, metric, masks, k, carry=[action], id_column=id_column, **options)):
        df = with_prediction(df, own, action, kind, f"__p{i}")
    one = lambda i: F.abs(F.col(action).cast("double") - F.col(f"__p{i}.predicted")) if kind == "continuous" else 1 - F.col(f"__p{i}.p_true")
    known = [(one(i), drawn.count(m)) for i, m in enumerate(masks)]
    total = reduce(Column.__add__, (F.coalesce(e * n, F.lit(0.0)) for e, n in known))
    times = reduce(Column.__add__, (F.when(e.isNotNull(), n).otherwise(0) for e, n in known))
    return df.select(F.col(id_column).alias("query_id"), F.try_divide(total, times).alias("error"))


def robust_residuals(cases: DataFrame, metric: Metric, kinds: dict[str, str], k: int = 10, **options) -> DataFrame:
    """(feature, residual): mean of `robust_errors` of each feature from random subsets of all others."""
    out = [robust_errors(cases, cases, metric, f, kind, k, **options).agg(F.lit(f).alias("feature"), F.avg("error").alias("residual")).select("feature", "residual") for f, kind in kinds.items()]
    return reduce(lambda a, b: a.union(b), out)


def robust_case_contributions(queries: DataFrame, cases: DataFrame, metric: Metric, action: str, k: int = 10, *, samples: int = 10, seed: int = 0, id_column: str = "id", **options) -> DataFrame:
    """(query_id, case_id, contribution, directional, accuracy_contribution, n): means of a case's contributions over the random subsets of contexts in which
    it is a neighbour, `n` of them."""
    drawn = subsets([n for n in metric.names() if n != action], samples, seed)
    masks = sorted(set(drawn))
    near = written(masked_neighbours(queries, cases, metric, masks, k, carry=[action], id_column=id_column, **options), "robust")
    actual = _asked(queries, action, len(masks), id_column).withColumn("actual", F.col("actual").cast("double"))
    one = case_contributions(near, action).join(case_accuracy_contributions(near, action, actual), ["query_id", "case_id"])
    times = F.element_at(F.array(*(F.lit(drawn.count(m)) for m in masks)), F.col("query_id.mask") + 1)
    df = one.withColumn("times", times).withColumn("query_id", F.col("query_id.id"))
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("times")), F.sum(F.when(F.col(c).isNotNull(), F.col("times")))).alias(c)
    return df.groupBy("query_id", "case_id").agg(mean("contribution"), mean("directional"), mean("accuracy_contribution"), F.sum("times").alias("n"))


def class_distances(cases: DataFrame, metric: Metric, feature: str, k: int = 10, **options) -> DataFrame:
    """(a, b, difference): learned distances of the values of a nominal: 1 - the mean probability that cases of value a are given to value b by their
    neighbours in the other features, in both directions. Pairs that are never mixed up have no row: they differ by 1."""
    options = dict(options)
    id_column = options.pop("id_column", "id")
    near = neighbours(cases, cases, metric.without(feature), k, carry=[feature], id_column=id_column, **options)
    own = cases.where(F.col(feature).isNotNull()).select(F.col(id_column).alias("query_id"), F.col(feature).alias("a"))
    n = own.groupBy("a").agg(F.count("*").alias("__n"))
    p = class_probabilities(near, feature).join(own, "query_id").groupBy("a", F.col("class").alias("b")).agg(F.sum("probability").alias("__p"))
    p = p.join(n, "a").select("a", "b", (F.col("__p") / F.col("__n")).alias("p")).where("a <> b AND p > 0")
    both = p.union(p.select(F.col("b").alias("a"), F.col("a").alias("b"), "p")).groupBy("a", "b").agg(F.sum("p").alias("p"))
    return both.select("a", "b", (1 - F.col("p") / 2).alias("difference"))


def with_class_distances(metric: Metric, feature: str, learned: DataFrame) -> Metric:
    """`metric` with the learned differences of a nominal: at most k pairs a case are ever mixed up, few for a nominal of few values."""
    from dataclasses import replace

    rows = tuple(sorted((r.a, r.b, r.difference) for r in learned.collect()))
    return replace(metric, features=tuple(replace(f, table=rows) if f.name == feature else f for f in metric.features))


def contributions(queries: DataFrame, cases: DataFrame, metric: Metric, action: str, k: int = 10, *, id_column: str = "id", robust: int = 0, seed: int = 0, **options) -> DataFrame:
    """(query_id, feature, prediction_contribution, directional, accuracy_contribution) of a continuous action.

    Full: the prediction with all contexts less the one without the feature. Robust: the mean of that over `robust` random subsets of
    the other contexts. The accuracy contribution is the error without the feature less the error with it.
    """
    names = [n for n in metric.names() if n != action]
    metric = metric.without(action)
    plan = []  # (feature, its contexts with it, without it, how often they are drawn)
    for f in names:
        rests = subsets([n for n in names if n != f], robust, seed) if robust else [tuple(n for n in names if n != f)]
        plan += [(f, tuple(n for n in names if n == f or n in rest), tuple(n for n in names if n in rest), rests.count(rest)) for rest in sorted(set(rests))]
    masks = sorted({m for _, a, b, _ in plan for m in (a, b)})
    df = queries
    for i, own in enumerate(masked_alike(queries, cases, metric, masks, k, carry=[action], id_column=id_column, **options)):
        df = own.spread(df, predict_continuous(own.near, action, name="p").select("query_id", F.struct("p").alias(f"__p{i}")))
    actual, told = F.col(action).cast("double"), []
    for f in names:
        parts = [(F.col(f"__p{masks.index(a)}"), F.col(f"__p{masks.index(b)}"), times) for g, a, b, times in plan if g == f]
        drawn = reduce(Column.__add__, (F.when(x.isNotNull() & z.isNotNull(), n).otherwise(0) for x, z, n in parts))  # without any neighbour nothing is told

        def mean(value, parts=parts, drawn=drawn):
            each = [value(x["p"], z["p"]) * n for x, z, n in parts]
            known = reduce(Column.__or__, (e.isNotNull() for e in each))
            return F.when(known, F.try_divide(reduce(Column.__add__, (F.coalesce(e, F.lit(0.0)) for e in each)), drawn))

        gain = lambda x, z: F.abs(actual - z) - F.abs(actual - x)
        told.append(F.struct(F.lit(f).alias("feature"), drawn.alias("n"), mean(lambda x, z: F.abs(x - z)).alias("prediction_contribution"), mean(lambda x, z: x - z).alias("directional"), mean(gain).alias("accuracy_contribution")))
    df = df.select(F.col(id_column).alias("query_id"), F.explode(F.array(*told)).alias("x"))
    return df.where("x.n > 0").select("query_id", "x.feature", "x.prediction_contribution", "x.directional", "x.accuracy_contribution")


def mean_contributions(per_case: DataFrame) -> DataFrame:
    """(feature, ...): averages of `contributions` over the queries."""
    names = [c for c in per_case.columns if c not in ("query_id", "feature")]
    return per_case.groupBy("feature").agg(*(F.avg(c).alias(c) for c in names))


def contribution_matrix(cases: DataFrame, metric: Metric, k: int = 10, **options) -> DataFrame:
    """(row, col, value): mean prediction contribution of feature `col` to action `row`, for all continuous features as actions."""
    out = []
    for f in metric.features:
        if not f.nominal:
            got = mean_contributions(contributions(cases, cases, metric, f.name, k, **options))
            out.append(got.select(F.lit(f.name).alias("row"), F.col("feature").alias("col"), F.col("prediction_contribution").alias("value")))
    return reduce(lambda a, b: a.union(b), out)


def permuted(df: DataFrame, feature: str, seed: int = 0, id_column: str = "id", blocks: int = 1024) -> DataFrame:
    """`df` with the values of a feature dealt anew: rows of a hash block get the values of that block in another seeded order."""
    b = F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(blocks))
    left = df.withColumn("__b", b).withColumn("__r", F.row_number().over(W.partitionBy("__b").orderBy(F.xxhash64(F.lit(seed + 1), id_column), id_column)))
    right = df.select(F.col(feature).alias("__v"), b.alias("__b"), F.xxhash64(F.lit(seed + 2), id_column).alias("__o"), id_column)
    right = right.select("__v", "__b", F.row_number().over(W.partitionBy("__b").orderBy("__o", id_column)).alias("__r"))
    return left.join(right, ["__b", "__r"]).select(*(F.col("__v").alias(feature) if c == feature else F.col(c) for c in df.columns))


def permutation_accuracy(cases: DataFrame, metric: Metric, action: str, k: int = 10, *, id_column: str = "id", seed: int = 0, blocks: int = 1024, robust: int = 0, **options) -> DataFrame:
    """(feature, accuracy_contribution): mean error with the feature scrambled in the queries less the mean error as it is. `robust`: the mean of
    that over so many random subsets of the other contexts."""
    metric = metric.without(action)
    if robust:
        out = []
        for f in metric.names():
            drawn = subsets([n for n in metric.names() if n != f], robust, seed)
            for rest in sorted(set(drawn)):
                own = metric.without(*(n for n in metric.names() if n != f and n not in rest))
                one = permutation_accuracy(cases, own, action, k, id_column=id_column, seed=seed, blocks=blocks, **options).where(F.col("feature") == f)
                out.append(one.withColumn("times", F.lit(drawn.count(rest))))
        df = reduce(lambda a, b: a.union(b), out)
        return df.groupBy("feature").agg((F.sum(F.col("accuracy_contribution") * F.col("times")) / F.sum("times")).alias("accuracy_contribution"))

    def error(queries):
        got = leave_one_out(cases, metric, action, "continuous", k, id_column=id_column, queries=queries, **options)
        return got.agg(F.avg(F.abs(F.col("actual").cast("double") - F.col("predicted"))).alias("e"))

    base = error(cases)
    out = [error(written(permuted(cases, f, seed, id_column, blocks), "permuted")).crossJoin(base.withColumnRenamed("e", "e0")).select(F.lit(f).alias("feature"), (F.col("e") - F.col("e0")).alias("accuracy_contribution")) for f in metric.names()]
    return reduce(lambda a, b: a.union(b), out)


def value_contributions(per_case: DataFrame, queries: DataFrame, feature: str, kind: str, buckets: int = 30, least: int = 15, id_column: str = "id") -> DataFrame:
    """Contributions of a feature by its value: nominals by value, continuous ones by quantile bucket; groups under `least` cases are left out."""
    own = queries.select(F.col(id_column).alias("query_id"), F.col(feature).alias("value"))
    df = per_case.where(F.col("feature") == feature).join(own, "query_id")
    if kind != "nominal":
        edges = own.agg(F.percentile_approx("value", [i / buckets for i in range(1, buckets)], 10_000).alias("e"))
        df = df.crossJoin(F.broadcast(edges)).withColumn("value", F.size(F.filter("e", lambda x: x < F.col("value")))).drop("e")
    g = df.groupBy("value").agg(F.count("*").alias("n"), F.avg("prediction_contribution").alias("prediction_contribution"), F.avg("directional").alias("directional"), F.avg("accuracy_contribution").alias("accuracy_contribution"))
    return g.where(F.col("n") >= least)


def value_combinations(per_case: DataFrame, queries: DataFrame, features: dict[str, str], buckets: int = 30, least: int = 15, id_column: str = "id") -> DataFrame:
    """Contributions of each of `features` (name: kind) by the combination of their values: nominals as they are, continuous ones by quantile bucket; combinations
    under `least` cases are left out."""
    def _above(f: str):
        return F.filter(f"__e_{f}", lambda x: x < F.col(f))

    own = queries.select(F.col(id_column).alias("query_id"), *features)
    cuts = [f for f, kind in features.items() if kind != "nominal"]
    if cuts:
        edges = own.agg(*(F.percentile_approx(f, [i / buckets for i in range(1, buckets)], 10_000).alias(f"__e_{f}") for f in cuts))
        own = own.crossJoin(F.broadcast(edges))
        own = own.select("query_id", *((F.size(_above(f)) if f in cuts else F.col(f)).alias(f) for f in features))
    df = per_case.where(F.col("feature").isin(list(features))).join(own, "query_id")
    means = [F.avg(c).alias(c) for c in ("prediction_contribution", "directional", "accuracy_contribution")]
    return df.groupBy("feature", *(F.col(f).alias(f"value_{f}") for f in features)).agg(F.count("*").alias("n"), *means).where(F.col("n") >= least)


def surprisal(residual, deviation):
    """Surprisal of a residual at a deviation, in nats."""
    return F.abs(residual) / deviation


def missing_information(with_value: DataFrame, without: DataFrame, deviation: float) -> DataFrame:
    """Mean surprisal of the errors without a value less that with it; both (query_id, error)."""
    df = with_value.withColumnRenamed("error", "a").join(without.withColumnRenamed("error", "b"), "query_id")
    return df.agg(F.avg((F.col("b") - F.col("a")) / F.lit(float(deviation))).alias("missing_information"))


def surprisal_asymmetry(per_case: DataFrame, queries: DataFrame, feature: str, deviation: float, id_column: str = "id") -> DataFrame:
    """(value, asymmetry): mean surprisal of positive directional contributions less that of negative ones, by value of a nominal."""
    own = queries.select(F.col(id_column).alias("query_id"), F.col(feature).alias("value"))
    df = per_case.where(F.col("feature") == feature).join(own, "query_id")
    up, down = (F.avg(F.when(c, F.abs("directional") / F.lit(float(deviation))).otherwise(F.lit(0.0))) for c in (F.col("directional") > 0, F.col("directional") < 0))
    return df.groupBy("value").agg((up - down).alias("asymmetry"))


def residual_contribution(per_feature: DataFrame, devs: dict[str, float]) -> DataFrame:
    """(query_id, residual_contribution): mean over features of error / deviation; `per_feature`: (query_id, feature, error)."""
    table = F.create_map(*(F.lit(x) for f, d in devs.items() for x in (f, float(d))))
    return per_feature.groupBy("query_id").agg(F.avg(F.col("error") / table[F.col("feature")]).alias("residual_contribution"))
