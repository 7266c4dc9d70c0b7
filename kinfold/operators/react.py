"""Prediction and explanation of query rows from their neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .condition import compile_condition
from .knn import Alike, Metric, each_alone, knn, knn_alike, knn_approximate

#: Digits to which shares are rounded where they decide an order.
DIGITS = 9


def influence(near: DataFrame, dt: float = -1.0, weight: str | None = None) -> DataFrame:
    """`near` with raw_weight and weight: `distance ** dt`, times the case weight, normalized per query. If some distance is
    zero only those cases share the influence."""
    own = W.partitionBy("query_id")
    mass = F.col(weight).cast("double") if weight else F.lit(1.0)
    zero = F.min("distance").over(own) == 0
    raw = F.when(zero, F.when(F.col("distance") == 0, mass).otherwise(F.lit(0.0))).otherwise(F.pow(F.greatest("distance", F.lit(1e-300)), F.lit(dt)) * mass)
    return near.withColumn("raw_weight", raw).withColumn("weight", F.try_divide("raw_weight", F.sum("raw_weight").over(own)))


def neighbours(queries: DataFrame, cases: DataFrame, metric: Metric, k: int = 10, dt: float = -1.0, weight: str | None = None, **options) -> DataFrame:
    """Neighbours with their influence: the table that all details are derived from. Compute it once and keep it.

    `approximate`: options of `knn_approximate` (its `width` at least), which then takes the place of the exact join, in every operator that
    hands its options on to this one: for tables too large for all pairs. Its recall is to be measured on a sample.
    """
    options = dict(options)
    carry = list(dict.fromkeys([*options.pop("carry", ()), *([weight] if weight else [])]))
    approximate = options.pop("approximate", None)
    if approximate is not None:
        return influence(knn_approximate(queries, cases, metric, k, carry=carry, **options, **approximate), dt, weight)
    return influence(knn(queries, cases, metric, k, carry=carry, **options), dt, weight)


def neighbours_alike(queries: DataFrame, cases: DataFrame, metric: Metric, k: int = 10, dt: float = -1.0, weight: str | None = None, **options) -> Alike:
    """As `neighbours`, of queries that stand for those with the same neighbours (`knn_alike`)."""
    if options.get("approximate") is not None:
        return each_alone(neighbours(queries, cases, metric, k, dt, weight, **options), options.get("id_column", "id"))
    options.pop("approximate", None)
    carry = list(dict.fromkeys([*options.pop("carry", ()), *([weight] if weight else [])]))
    found = knn_alike(queries, cases, metric, k, carry=carry, **options)
    return found._replace(near=influence(found.near, dt, weight))


def predict_continuous(near: DataFrame, action: str, allow_nulls: bool = False, name: str | None = None) -> DataFrame:
    """(query_id, action): the influence-weighted mean of the neighbours' values. Null values are dropped; with `allow_nulls` the
    prediction is null where nulls have more than half of the influence."""
    y, w = F.col(action).cast("double"), F.col("weight")
    known = F.sum(F.when(y.isNotNull(), w))
    value = F.try_divide(F.sum(y * w), known)
    if allow_nulls:
        value = F.when(F.coalesce(F.sum(F.when(y.isNull(), w)), F.lit(0.0)) <= 0.5, value)
    return near.groupBy("query_id").agg(value.alias(name or action))


def class_probabilities(near: DataFrame, action: str, allow_nulls: bool = False) -> DataFrame:
    """(query_id, class, probability): the influence of every class among the neighbours."""
    df = near if allow_nulls else near.where(F.col(action).isNotNull())
    sums = df.groupBy("query_id", F.col(action).alias("class")).agg(F.sum("weight").alias("__w"))
    return sums.select("query_id", "class", F.try_divide("__w", F.sum("__w").over(W.partitionBy("query_id"))).alias("probability"))


def predict_nominal(near: DataFrame, action: str, allow_nulls: bool = False, name: str | None = None) -> DataFrame:
    """(query_id, action, probability): the class of the highest probability, ties by value."""
    probs = class_probabilities(near, action, allow_nulls)
    order = W.partitionBy("query_id").orderBy(F.desc(F.round("probability", DIGITS)), F.asc_nulls_last("class"))
    return probs.withColumn("__r", F.row_number().over(order)).where("__r = 1").select("query_id", F.col("class").alias(name or action), "probability")


def react(
    queries: DataFrame,
    cases: DataFrame,
    metric: Metric,
    actions: dict[str, str],
    k: int = 10,
    *,
    condition: dict | None = None,
    derived_contexts: list[tuple[str, str]] = (),
    derived_actions: list[tuple[str, str]] = (),
    post_process: dict[str, str] | None = None,
    return_contexts: list[str] = (),
    preserve: list[str] = (),
    allow_nulls: bool = False,
    id_column: str = "id",
    **options,
) -> DataFrame:
    """One row per query with the predicted actions.

    `actions`: feature by kind (continuous or nominal). `condition` restricts the cases and reaches their scan.
    `derived_contexts` and `derived_actions`: (name, SQL expression) in order, over the queries and over the result;
    `post_process`: SQL expression by action. `preserve`: actions whose given value in the query is kept.
    """
    for name, expression in derived_contexts:
        queries = queries.withColumn(name, F.expr(expression))
    near = neighbours(queries, cases.where(compile_condition(condition)), metric, k, carry=list(actions), id_column=id_column, **options)
    out = queries.select(F.col(id_column).alias("query_id"), *return_contexts, *(F.col(c).alias(f"__given_{c}") for c in preserve))
    for name, kind in actions.items():
        got = predict_continuous(near, name, allow_nulls) if kind == "continuous" else predict_nominal(near, name, allow_nulls).drop("probability")
        out = out.join(got, "query_id", "left")
    for c in preserve:
        out = out.withColumn(c, F.coalesce(f"__given_{c}", c)).drop(f"__given_{c}")
    for name, expression in [*derived_actions, *(post_process or {}).items()]:
        out = out.withColumn(name, F.expr(expression))
    return out


def react_to_cases(cases: DataFrame, keys: DataFrame, metric: Metric, actions: dict[str, str], k: int = 10, *, on: list[str], preserve: list[str] = (), id_column: str = "id", **options) -> DataFrame:
    """`react` to stored cases, chosen by `keys` (the columns `on`, as session and number), each from all others. `preserve`: actions whose stored value is
    kept."""
    return react(cases.join(keys.select(*on).distinct(), on, "left_semi"), cases, metric, actions, k, preserve=preserve, id_column=id_column, **options)


def goal_seek(near: DataFrame, goal: str, aim: str | float, n: int, action: str) -> DataFrame:
    """Continuous prediction from the n neighbours that come closest to the goal ("min", "max" or a value), in place of the n nearest."""
    g = F.col(goal).cast("double")
    order = g if aim == "min" else F.desc(goal) if aim == "max" else F.abs(g - F.lit(float(aim)))
    best = near.withColumn("__r", F.row_number().over(W.partitionBy("query_id").orderBy(order, "rank"))).where(F.col("__r") <= n).drop("__r")
    return predict_continuous(influence(best), action)


# --- details of a prediction, all from the neighbour table


def influential_cases(near: DataFrame) -> DataFrame:
    """The neighbours with any influence, the most influential first."""
    order = W.partitionBy("query_id").orderBy(F.desc(F.round("weight", DIGITS)), "rank")
    return near.where("weight > 0").withColumn("place", F.row_number().over(order))


def most_similar(near: DataFrame, n: int) -> DataFrame:
    return near.where(F.col("rank") <= n)


def distance_contribution(near: DataFrame, dt: float = -1.0, weight: str | None = None) -> DataFrame:
    """(query_id, distance_contribution): the weighted power mean of the neighbour distances, 0 if one of them is 0."""
    mass = F.col(weight).cast("double") if weight else F.lit(1.0)
    mean = F.pow(F.sum(mass * F.pow(F.greatest("distance", F.lit(1e-300)), F.lit(dt))) / F.sum(mass), F.lit(1 / dt))
    return near.groupBy("query_id").agg(F.when(F.min("distance") == 0, F.lit(0.0)).otherwise(mean).alias("distance_contribution"))


def similarity_conviction(near: DataFrame, own: DataFrame, of_cases: DataFrame) -> DataFrame:
    """Mean distance contribution of the neighbours over the query's own. `of_cases`: (case_id, case_contribution)."""
    local = near.join(of_cases, "case_id").groupBy("query_id").agg(F.avg("case_contribution").alias("__local"))
    ratio = F.when(F.col("distance_contribution") == 0, F.when(F.col("__local") == 0, F.lit(1.0))).otherwise(F.col("__local") / F.col("distance_contribution"))
    return own.join(local, "query_id").select("query_id", ratio.alias("similarity_conviction"))


def boundary_cases(queries: DataFrame, cases: DataFrame, metric: Metric, predicted: DataFrame, action: str, n: int = 3, *, kind: str = "nominal", id_column: str = "id", pool: int = 100, **options) -> DataFrame:
    """The n cases at the boundary of the outcome predicted (query_id, action). Of a nominal action the nearest cases with another class; of a
    continuous one those of the `pool` nearest whose value differs most from the prediction for their distance, with `boundary`, that ratio."""
    asked = queries.join(predicted.select(F.col("query_id").alias(id_column), F.col(action).alias("__outcome")), id_column)
    if kind == "nominal":
        return knn(asked.withColumn(action, F.col("__outcome")), cases, metric, n, id_column=id_column, carry=[action], differ=[action], **options)
    near = knn(asked, cases, metric, pool, id_column=id_column, carry=[action], **options).join(predicted.select("query_id", F.col(action).alias("__outcome")), "query_id")
    off = F.abs(F.col(action).cast("double") - F.col("__outcome"))
    near = near.withColumn("boundary", F.when(off > 0, off / F.greatest("distance", F.lit(1e-12))).otherwise(F.lit(0.0)))
    order = W.partitionBy("query_id").orderBy(F.desc(F.round("boundary", DIGITS)), "rank")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("__outcome")


def boundary_values(boundary: DataFrame, cases: DataFrame, features: list[str], id_column: str = "id", outcome: dict | None = None) -> DataFrame:
    """Values of `features` of the first boundary case, of those that the condition `outcome` (over the carried action) allows."""
    first = boundary.where(compile_condition(outcome)).withColumn("__r", F.row_number().over(W.partitionBy("query_id").orderBy("rank"))).where("__r = 1").select("query_id", "case_id", "distance")
    return first.join(cases.select(F.col(id_column).alias("case_id"), *features), "case_id")


def given_action(queries: DataFrame, near: DataFrame, action: str, kind: str, *, id_column: str = "id") -> DataFrame:
    """What the neighbours say of an action value that the query gives, instead of predicting one: (query_id, given, predicted, error) of a
    continuous action, (query_id, given, predicted, probability) of a nominal one, where the probability is that of the given class."""
    own = queries.select(F.col(id_column).alias("query_id"), F.col(action).alias("given"))
    if kind == "continuous":
        df = own.join(predict_continuous(near, action, name="predicted"), "query_id", "left")
        return df.withColumn("error", F.abs(F.col("given").cast("double") - F.col("predicted")))
    df = own.join(predict_nominal(near, action, name="predicted").drop("probability"), "query_id", "left")
    p = class_probabilities(near, action).select("query_id", F.col("class").alias("given"), "probability")
    return df.join(p, ["query_id", "given"], "left").withColumn("probability", F.coalesce("probability", F.lit(0.0)))


def relevant_values(near: DataFrame, feature: str, kind: str, quantiles: tuple = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """(query_id, values): distinct values of a nominal among the neighbours, quantiles of a continuous feature."""
    if kind == "nominal":
        return near.where("weight > 0").groupBy("query_id").agg(F.array_sort(F.collect_set(feature)).alias("values"))
    return near.where("weight > 0").groupBy("query_id").agg(F.percentile(F.col(feature).cast("double"), F.array(*map(F.lit, quantiles))).alias("values"))


def distance_ratio(near: DataFrame, cases_near: DataFrame) -> DataFrame:
    """Distance to the nearest case over the least distance between any of the neighbours and its own nearest case.
    `cases_near`: neighbour table of the cases."""
    own = cases_near.where("rank = 1").select(F.col("query_id").alias("case_id"), F.col("distance").alias("__d"))
    df = near.join(own, "case_id").groupBy("query_id").agg(F.min("distance").alias("nearest"), F.min("__d").alias("local"))
    return df.select("query_id", F.when(F.col("local") > 0, F.col("nearest") / F.col("local")).alias("distance_ratio"))


def outlying_values(queries: DataFrame, near: DataFrame, feature: str, id_column: str = "id") -> DataFrame:
    """Queries whose value lies outside of their neighbours' range, with the range."""
    span = near.groupBy("query_id").agg(F.min(feature).alias("local_min"), F.max(feature).alias("local_max"))
    df = queries.select(F.col(id_column).alias("query_id"), F.col(feature).alias("value")).join(span, "query_id")
    return df.where((F.col("value") < F.col("local_min")) | (F.col("value") > F.col("local_max")))


def local_deviation(near: DataFrame, feature: str, action: str | None = None) -> DataFrame:
    """Weighted mean absolute deviation of the neighbours' values from their weighted mean."""
    mean = predict_continuous(near, feature, name="__m")
    df = near.join(mean, "query_id")
    y = F.col(feature).cast("double")
    return df.groupBy("query_id").agg(F.try_divide(F.sum(F.abs(y - F.col("__m")) * F.col("weight")), F.sum(F.when(y.isNotNull(), F.col("weight")))).alias("local_mad"))


def density_conviction(queries: DataFrame, near: DataFrame, feature: str, id_column: str = "id") -> DataFrame:
    """Local deviation over the query's own distance from the local mean: under 1, the value stands out."""
    own = queries.select(F.col(id_column).alias("query_id"), F.col(feature).cast("double").alias("__v"))
    df = own.join(predict_continuous(near, feature, name="__m"), "query_id").join(local_deviation(near, feature), "query_id")
    off = F.round(F.abs(F.col("__v") - F.col("__m")), DIGITS)
    return df.select("query_id", F.when(off == 0, F.lit(float("inf"))).otherwise(F.col("local_mad") / off).alias("density_conviction"), "local_mad")


def case_contributions(near: DataFrame, action: str) -> DataFrame:
    """(query_id, case_id, contribution, directional): change of a continuous prediction when the neighbour is left out."""
    own = W.partitionBy("query_id")
    y, w = F.col(action).cast("double"), F.col("weight")
    total, mass = F.sum(y * w).over(own), F.sum(w).over(own)
    rest = (F.col("__t") - y * w) / (F.col("__m") - w)
    df = near.withColumn("__t", total).withColumn("__m", mass)
    change = F.when(F.col("__m") - w > 1e-12, F.col("__t") / F.col("__m") - rest)
    return df.select("query_id", "case_id", change.alias("directional"), F.abs(change).alias("contribution"))


def case_accuracy_contributions(near: DataFrame, action: str, actual: DataFrame) -> DataFrame:
    """Error without the neighbour less the error with it; `actual`: (query_id, actual)."""
    y, w, own = F.col(action).cast("double"), F.col("weight"), W.partitionBy("query_id")
    df = near.withColumn("__t", F.sum(y * w).over(own)).withColumn("__m", F.sum(w).over(own)).join(actual, "query_id")
    rest = (F.col("__t") - y * w) / (F.col("__m") - w)
    change = F.when(F.col("__m") - w > 1e-12, F.abs(F.col("actual") - rest) - F.abs(F.col("actual") - F.col("__t") / F.col("__m")))
    return df.select("query_id", "case_id", change.alias("accuracy_contribution"))


def hypothetical(queries: DataFrame, cases: DataFrame, metric: Metric, action: str, values: dict, k: int = 10, id_column: str = "id", **options) -> DataFrame:
    """Prediction of a continuous action if contexts had the given values, next to the one as they are."""
    changed = queries.select(*(F.lit(values[c]).cast(t).alias(c) if c in values else F.col(c) for c, t in queries.dtypes))
    a = predict_continuous(neighbours(queries, cases, metric, k, carry=[action], id_column=id_column, **options), action, name="as_is")
    b = predict_continuous(neighbours(changed, cases, metric, k, carry=[action], id_column=id_column, **options), action, name="if_changed")
    return a.join(b, "query_id")


def local_residual(near: DataFrame, loo: DataFrame) -> DataFrame:
    """Mean absolute leave-one-out error over the neighbours; `loo`: (case_id, error)."""
    return near.join(loo, "case_id").groupBy("query_id").agg(F.try_divide(F.sum(F.col("error") * F.col("weight")), F.sum("weight")).alias("local_residual"))


def parameters(metric: Metric, k: int, dt: float) -> Column:
    """The parameters of a prediction as a struct."""
    weights = F.create_map(*(F.lit(v) for f in metric.features for v in (f.name, float(f.weight))))
    deviations = F.create_map(*(F.lit(v) for f in metric.features for v in (f.name, float(f.deviation))))
    return F.struct(F.lit(k).alias("k"), F.lit(float(metric.p)).alias("p"), F.lit(float(dt)).alias("dt"), weights.alias("weights"), deviations.alias("deviations"))


def residual_conviction(region: DataFrame, own: DataFrame) -> DataFrame:
    """Mean error of the region over the case's own: under 1, the case is harder than its surroundings. `region`: (query_id,
    local_residual); `own`: (query_id, error)."""
    df = region.join(own, "query_id")
    return df.select("query_id", F.when(F.round("error", DIGITS) == 0, F.lit(float("inf"))).otherwise(F.col("local_residual") / F.round("error", DIGITS)).alias("residual_conviction"))


def local_stats(near: DataFrame, loo: DataFrame) -> DataFrame:
    """Statistics of the neighbours' own leave-one-out predictions per query; `loo`: (case_id, actual, predicted)."""
    e = F.col("actual") - F.col("predicted")
    return near.join(loo, "case_id").groupBy("query_id").agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))


def local_prediction_stats(near: DataFrame, loo: DataFrame, kind: str, selected: list[str] | None = None) -> DataFrame:
    """(query_id, statistics) of the neighbours' own leave-one-out predictions; `loo`: (case_id, actual, predicted); `selected`: names of statistics.

    Continuous: mae, rmse, r2, smape, adjusted_smape, spearman_coeff over the neighbours with both values; a statistic that constant values leave open is null. Nominal:
    accuracy, macro precision and recall, mcc, confusion_matrix (cells as structs, sorted). Both: missing_value_accuracy, the share of neighbours whose
    null-ness is predicted right. Every group is one query's neighbours, k rows at most.
    """
    df = near.select("query_id", "case_id").join(loo.select("case_id", "actual", "predicted"), "case_id")
    own = W.partitionBy("query_id")
    nulls = df.groupBy("query_id").agg(F.avg((F.col("actual").isNull() == F.col("predicted").isNull()).cast("double")).alias("missing_value_accuracy"))
    if kind == "continuous":
        a, p = F.col("a"), F.col("p")
        df = df.select("query_id", F.col("actual").cast("double").alias("a"), F.col("predicted").cast("double").alias("p")).dropna(subset=["a", "p"])
        df = df.withColumn("q", F.round("p", DIGITS))  # ties of ranks do not hang on the last digits of a sum
        rank = lambda c: F.rank().over(own.orderBy(c)) + (F.count("*").over(W.partitionBy("query_id", c)) - 1) / 2
        df = df.withColumn("mean", F.avg("a").over(own)).withColumn("ra", rank("a")).withColumn("rp", rank("q"))
        values = F.array_sort(F.collect_set("a"))  # k values at most
        gap = F.coalesce(F.array_min(F.zip_with(F.slice(values, 2, 1_000_000), values, lambda x, y: x - y)), F.lit(0.0))
        size = F.abs(a) + F.abs(p)
        df = df.join(df.groupBy("query_id").agg(gap.alias("gap")), "query_id")
        share = lambda whole: F.avg(F.when(whole == 0, F.lit(0.0)).otherwise(F.abs(a - p) / whole))
        flat = (F.min("a") == F.max("a")) | (F.min("q") == F.max("q"))
        out = df.groupBy("query_id").agg(
            F.avg(F.abs(a - p)).alias("mae"),
            F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
            (1 - F.try_divide(F.sum((a - p) * (a - p)), F.sum((a - F.col("mean")) * (a - F.col("mean"))))).alias("r2"),
            share(size).alias("smape"),
            share(size + F.col("gap") / 2).alias("adjusted_smape"),
            F.when(~flat, F.corr("ra", "rp")).alias("spearman_coeff"),
        )
    else:
        cells = df.groupBy("query_id", "actual", "predicted").agg(F.count("*").alias("n"))
        hit = F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)
        rows = cells.groupBy("query_id", F.col("actual").alias("class")).agg(F.sum("n").alias("t"), F.sum(hit).alias("hit"))
        columns = cells.groupBy(F.col("query_id").alias("__q"), F.col("predicted").alias("__c")).agg(F.sum("n").alias("p"))
        per = rows.join(columns, (F.col("query_id") == F.col("__q")) & F.col("class").eqNullSafe(F.col("__c")), "full").withColumn("query_id", F.coalesce("query_id", "__q"))
        t, p, right = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("t", "p", "hit"))
        sums = per.groupBy("query_id").agg(
            F.sum(t).alias("s"), F.sum(right).alias("c"), F.sum(t * p).alias("tp"), F.sum(t * t).alias("tt"), F.sum(p * p).alias("pp"),
            F.avg(F.when(p > 0, right / p)).alias("precision"), F.avg(F.when(t > 0, right / t)).alias("recall"),
        )
        s, c = F.col("s"), F.col("c")
        bottom = F.sqrt((s * s - F.col("pp")) * (s * s - F.col("tt")))
        table = cells.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("actual", "predicted", "n"))).alias("confusion_matrix"))
        mcc = F.when(bottom == 0, F.lit(0.0)).otherwise((c * s - F.col("tp")) / bottom).alias("mcc")
        out = sums.select("query_id", (c / s).alias("accuracy"), "precision", "recall", mcc).join(table, "query_id")
    out = nulls.join(out, "query_id", "left")
    return out.select("query_id", *(selected or [c for c in out.columns if c != "query_id"]))


def local_means(near: DataFrame, per_case: DataFrame, columns: list[str] | None = None, by: str = "feature") -> DataFrame:
    """(query_id, by, means): details of the cases, averaged over the neighbours of each query. With contributions of all cases and neighbours by contexts
    and the given action these are the contributions ex post, with neighbours by contexts alone the local ones."""
    names = columns or [c for c in per_case.columns if c not in ("query_id", by)]
    df = near.select("query_id", "case_id").join(per_case.withColumnRenamed("query_id", "case_id"), "case_id")
    return df.groupBy("query_id", by).agg(*(F.avg(c).alias(c) for c in names))


def observational_errors(spark, profile: dict, features: list[str] | None = None) -> DataFrame:
    """(feature, observational_error) as the profile declares them (extra["observational_error"]); null where it does not."""
    rows = [(n, a.extra.get("observational_error")) for n, a in profile.items() if features is None or n in features]
    return spark.createDataFrame([(n, None if e is None else float(e)) for n, e in rows], "feature string, observational_error double")


def of_features(details: dict[str, DataFrame], features: list[str]) -> dict[str, DataFrame]:
    """Details of the chosen features only: rows of tables that have a column `feature`, tables named after a feature otherwise."""
    return {n: df.where(F.col("feature").isin(features)) if "feature" in df.columns else df for n, df in details.items() if "feature" in df.columns or n in features}


def accumulated(parts: list[DataFrame]) -> DataFrame:
    """Results of batches as one; columns that a batch lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def clean_keys(probabilities: Column, kind: str) -> Column:
    """Keys of a map of class probabilities as the nominal has them: whole numbers without decimals, booleans as true and false."""
    if kind == "boolean":
        return F.transform_keys(probabilities, lambda k, v: F.when(F.lower(k).isin("true", "1", "1.0"), "true").otherwise("false"))
    if kind == "integer":
        return F.transform_keys(probabilities, lambda k, v: F.coalesce(k.try_cast("double").try_cast("bigint").cast("string"), k))
    return probabilities


def influential_with_conviction(near: DataFrame, convictions: DataFrame, name: str = "familiarity_conviction") -> DataFrame:
    """`influential_cases` with the conviction of each case; `convictions`: (query_id, name)."""
    return influential_cases(near).join(convictions.select(F.col("query_id").alias("case_id"), name), "case_id", "left")
