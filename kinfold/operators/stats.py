"""Quality of predictions: statistics over a table of actual and predicted values, and matrices made from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .condition import compile_condition
from .knn import Alike, Metric, knn
from .react import class_probabilities, neighbours_alike, predict_continuous, predict_nominal


def leave_one_out(cases: DataFrame, metric: Metric, action: str, kind: str, k: int = 10, *, id_column: str = "id", queries: DataFrame | None = None, **options) -> DataFrame:
    """(id, actual, predicted, p_true for nominals) of every case predicted from the others; `queries`: a sample of the cases."""
    asked = cases if queries is None else queries
    return predicted(asked, neighbours_alike(asked, cases, metric.without(action), k, carry=[action], id_column=id_column, **options), action, kind, id_column)


def predicted(queries: DataFrame, found: Alike, action: str, kind: str, id_column: str = "id") -> DataFrame:
    """(query_id, actual, predicted, p_true for nominals) of the queries by their neighbours."""
    df = with_prediction(queries, found, action, kind, "__got")
    return df.select(F.col(id_column).alias("query_id"), F.col(action).alias("actual"), "__got.*")


def with_prediction(queries: DataFrame, found: Alike, action: str, kind: str, name: str) -> DataFrame:
    """The queries with a struct `name` of what their neighbours predict: predicted, and for nominals p_true, the probability of the query's own class."""
    if kind == "continuous":
        return found.spread(queries, predict_continuous(found.near, action, name="__p")).withColumn(name, F.struct(F.col("__p").alias("predicted"))).drop("__p")
    probs = class_probabilities(found.near, action).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("class", "probability"))).alias("__probs"))  # at most k classes a query
    df = found.spread(queries, predict_nominal(found.near, action, name="__p").select("query_id", "__p").join(probs, "query_id"))
    true = F.coalesce(F.try_element_at("__probs", F.col(action)), F.lit(0.0))
    return df.withColumn(name, F.struct(F.col("__p").alias("predicted"), true.alias("p_true"))).drop("__p", "__probs")


def continuous_stats(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: mae, rmse, r2, smape, adjusted_smape, spearman_coeff. Rows with a null on either side are left out.

    adjusted_smape adds half of the least gap between distinct actual values to the denominator.
    """
    a, p = F.col("a"), F.col("p")
    df = df.select(F.col(actual).cast("double").alias("a"), F.col(predicted).cast("double").alias("p")).dropna()
    gap = least_gap(df, "a")
    mean = df.agg(F.avg("a").alias("m"))
    df = df.crossJoin(F.broadcast(gap)).crossJoin(F.broadcast(mean))  # one row each
    denominator = F.abs(a) + F.abs(p)
    main = df.agg(
        F.avg(F.abs(a - p)).alias("mae"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        (1 - F.try_divide(F.sum((a - p) * (a - p)), F.sum((a - F.col("m")) * (a - F.col("m"))))).alias("r2"),
        F.avg(F.when(denominator == 0, F.lit(0.0)).otherwise(F.abs(a - p) / denominator)).alias("smape"),
        F.avg(F.when(denominator + F.col("gap") / 2 == 0, F.lit(0.0)).otherwise(F.abs(a - p) / (denominator + F.col("gap") / 2))).alias("adjusted_smape"),
    )
    return main.crossJoin(F.broadcast(spearman(df, "a", "p")))


def least_gap(df: DataFrame, column: str) -> DataFrame:
    """(gap): least difference of neighbouring distinct values, 0 if there are fewer than two.

    Values are range-partitioned by Spark's sort; the first of each partition meets the last of the one before through
    a table of one row per bucket, so no task sorts all.
    """
    values = df.select(F.col(column).alias("v")).where("v IS NOT NULL").distinct()
    bucket = F.floor(F.log1p(F.abs("v")) * F.signum("v") * 64)
    values = values.withColumn("b", bucket)
    inner = values.withColumn("d", F.col("v") - F.lag("v").over(W.partitionBy("b").orderBy("v"))).agg(F.min("d").alias("d"))
    ends = values.groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))  # one row per bucket: a few thousand
    outer = ends.withColumn("d", F.col("lo") - F.lag("hi").over(W.orderBy("b"))).agg(F.min("d").alias("d"))
    return inner.union(outer).agg(F.coalesce(F.min("d"), F.lit(0.0)).alias("gap"))


def spearman(df: DataFrame, a: str, p: str) -> DataFrame:
    """(spearman_coeff): correlation of average ranks. Ranks come from counts per distinct value, bucketed by value."""
    ra, rp = average_ranks(df, a).withColumnRenamed("rank", "ra"), average_ranks(df, p).withColumnRenamed("rank", "rp")
    both = df.select(F.col(a).alias("__a"), F.col(p).alias("__p"))
    both = both.join(ra.withColumnRenamed("value", "__a"), "__a").join(rp.withColumnRenamed("value", "__p"), "__p")
    return both.agg(F.corr("ra", "rp").alias("spearman_coeff"))


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """(value, rank): average rank of every distinct value, by prefix sums over value buckets."""
    n = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).where("value IS NOT NULL")
    n = n.withColumn("b", F.floor(F.log1p(F.abs("value")) * F.signum("value") * 64))
    sums = n.groupBy("b").agg(F.sum("n").alias("s"))
    sums = sums.select("b", F.coalesce(F.sum("s").over(W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n").over(W.partitionBy("b").orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    return n.withColumn("upto", inside).join(sums, "b").select("value", (F.col("before") + F.col("upto") - (F.col("n") - 1) / 2).alias("rank"))


def nominal_stats(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: accuracy, macro precision and recall, mcc, and mae = 1 - mean probability of the true class if p_true is there."""
    cells = confusion(df, actual, predicted)
    total = cells.agg(F.sum("n").alias("s"), F.sum(F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)).alias("c"))
    rows = cells.groupBy(F.col("actual").alias("class")).agg(F.sum("n").alias("t"), F.sum(F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)).alias("hit"))
    cols = cells.groupBy(F.col("predicted").alias("class2")).agg(F.sum("n").alias("p"))
    per = rows.join(cols, rows["class"].eqNullSafe(cols["class2"]), "full")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    per = per.agg(
        F.avg(F.when(F.col("p") > 0, z("hit") / F.col("p"))).alias("precision"),
        F.avg(F.when(F.col("t") > 0, z("hit") / F.col("t"))).alias("recall"),
        F.sum(z("t") * z("p")).alias("tp"), F.sum(z("t") * z("t")).alias("tt"), F.sum(z("p") * z("p")).alias("pp"),
    )
    s, c = F.col("s").cast("double"), F.col("c").cast("double")
    bottom = F.sqrt((s * s - F.col("pp")) * (s * s - F.col("tt")))
    out = total.crossJoin(per).select((c / s).alias("accuracy"), "precision", "recall", F.when(bottom == 0, F.lit(0.0)).otherwise((c * s - F.col("tp")) / bottom).alias("mcc"))
    if "p_true" in df.columns:
        out = out.crossJoin(df.agg((1 - F.avg("p_true")).alias("mae")))
    return out


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(actual, predicted, n)."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_folded(df: DataFrame, least: int = 10) -> DataFrame:
    """Confusion cells with n >= `least`; smaller wrong cells are folded, per actual value, into one with a null prediction."""
    cells = confusion(df)
    small = (F.col("n") < least) & ~F.col("actual").eqNullSafe(F.col("predicted"))
    return cells.select("actual", F.when(~small, F.col("predicted")).alias("predicted"), small.alias("other"), "n").groupBy("actual", "predicted", "other").agg(F.sum("n").alias("n"))


def confusion_dense(cells: DataFrame) -> DataFrame:
    """A row per actual label and a column per label, over the sorted union of labels (a few), missing cells 0."""
    labels = sorted({r[0] for r in cells.select("actual").union(cells.select("predicted")).distinct().collect() if r[0] is not None})
    wide = cells.groupBy("actual").pivot("predicted", labels).agg(F.sum("n"))
    all_rows = cells.sparkSession.createDataFrame([(x,) for x in labels], f"actual {dict(cells.dtypes)['actual']}")
    return all_rows.join(wide, "actual", "left").fillna(0, subset=[str(x) for x in labels])


def missing_value_accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Share of rows in which null-ness is predicted right."""
    return df.agg(F.avg((F.col(actual).isNull() == F.col(predicted).isNull()).cast("double")).alias("missing_value_accuracy"))


def score(df: DataFrame, kind: str) -> DataFrame:
    return nominal_stats(df).select(F.col("accuracy").alias("score")) if kind == "nominal" else continuous_stats(df).select(F.col("r2").alias("score"))


def normalize_matrix(cells: DataFrame, method: str | None = "relative", *, ignore_diagonal: bool = True, absolute: bool = False, fill_diagonal: float | None = None, custom=None) -> DataFrame:
    """A square matrix in long form (row, col, value), normalized per row: by the largest absolute value (relative), the sum
    (fractional) or the sum of absolute values (fractional_absolute); a zero divisor leaves the row as it is. The diagonal takes no part if `ignore_diagonal`;
    then absolute values are taken and the diagonal is filled. `custom`: pandas function of one row's (row, col, value) in place of a method.
    """
    diagonal = F.col("row").eqNullSafe(F.col("col"))
    v = F.when(diagonal & F.lit(ignore_diagonal), None).otherwise(F.col("value"))
    if custom is not None:
        out = cells.groupBy("row").applyInPandas(custom, cells.schema)
    elif method:
        own = W.partitionBy("row")
        by = {"relative": F.max(F.abs(v)), "fractional": F.sum(v), "fractional_absolute": F.sum(F.abs(v))}[method].over(own)
        scaled = F.when(diagonal & F.lit(ignore_diagonal), F.col("value")).otherwise(F.when(F.col("__by") == 0, F.col("value")).otherwise(F.col("value") / F.col("__by")))
        out = cells.withColumn("__by", by).select("row", "col", scaled.alias("value"))
    else:
        out = cells.select("row", "col", "value")
    if absolute:
        out = out.withColumn("value", F.abs("value"))
    if fill_diagonal is not None:
        out = out.withColumn("value", F.when(diagonal, F.lit(float(fill_diagonal))).otherwise(F.col("value")))
    return out


def metric_table(parts: dict[str, DataFrame]) -> DataFrame:
    """(metric, feature, value) from one-row tables of metrics by feature."""
    longs = []
    for feature, df in parts.items():
        pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in df.columns)
        longs.append(df.selectExpr(f"stack({len(df.columns)}, {pairs}) as (metric, value)").select("metric", F.lit(feature).alias("feature"), "value"))
    return reduce(lambda a, b: a.union(b), longs)


def sample(df: DataFrame, n: int = 1000, seed: int = 0, id_column: str = "id") -> DataFrame:
    """n rows by a hash of their id: the same ones at every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), id_column), id_column).limit(n)


def converge(run, df: DataFrame, start: int = 5000, growth: float = 1.05, threshold: float = 0.005, id_column: str = "id", seed: int = 0) -> tuple[float, int]:
    """Value of `run(sample)` (a number) on growing samples until it changes by less than `threshold` of itself, and the sample size."""
    n, total, before = start, df.count(), None
    while True:
        now = run(sample(df, min(n, total), seed, id_column))
        if n >= total or before is not None and abs(now - before) <= threshold * abs(before):
            return now, min(n, total)
        before, n = now, max(n + 1, int(n * growth))


def residual_lower_bound(near: DataFrame, actual: DataFrame, action: str) -> DataFrame:
    """(residual_lower_bound): mean absolute difference of the action between cases and their nearest case: no model of these
    contexts is expected to do better."""
    first = near.where("rank = 1").join(actual, "query_id")
    return first.agg(F.avg(F.abs(F.col("actual") - F.col(action))).alias("residual_lower_bound"))


def selected(table: DataFrame, names: list[str] | None) -> DataFrame:
    """The chosen statistics of a table of them; all for None."""
    unknown = [n for n in names or () if n not in table.columns]
    if unknown:
        raise ValueError(f"no such statistic: {unknown}")
    return table if names is None else table.select(*names)


def chosen(cases: DataFrame, condition: dict | None, metric: Metric, *, precision: str = "exact", most: int | None = None, seed: int = 0, id_column: str = "id") -> DataFrame:
    """Cases for which a condition holds, or ("similar") the `most` ones closest to its values; an exact choice of more than `most` is sampled by id."""
    if precision == "similar" and condition:
        point = {f: (sum(v) / 2 if isinstance(v, (list, tuple)) else v) for f, v in condition.items()}
        kinds = dict(cases.dtypes)
        asked = cases.sparkSession.range(1).select(F.lit(-1).cast(kinds[id_column]).alias(id_column), *(F.lit(v).cast(kinds[f]).alias(f) for f, v in point.items()))
        own = metric.without(*(n for n in metric.names() if n not in point))
        return cases.join(knn(asked, cases, own, most or 10, id_column=id_column).select(F.col("case_id").alias(id_column)), id_column, "left_semi")
    df = cases.where(compile_condition(condition))
    return df if most is None else sample(df, most, seed, id_column)


def measured(cases: DataFrame, metric: Metric, action: str, kind: str, k: int = 10, *, action_condition: dict | None = None, context_condition: dict | None = None, action_precision: str = "exact", context_precision: str = "exact", action_samples: int | None = None, context_samples: int | None = None, names: list[str] | None = None, id_column: str = "id", **options) -> DataFrame:
    """Statistics of predictions of the cases that `action_condition` chooses from those that `context_condition` chooses."""
    asked = chosen(cases, action_condition, metric, precision=action_precision, most=action_samples, id_column=id_column)
    known = chosen(cases, context_condition, metric, precision=context_precision, most=context_samples, id_column=id_column)
    got = leave_one_out(known, metric, action, kind, k, id_column=id_column, queries=asked, **options)
    return selected(continuous_stats(got) if kind == "continuous" else nominal_stats(got), names)


def derived_predictions(cases: DataFrame, metric: Metric, actions: dict[str, str], derive: dict[str, str], k: int = 10, *, id_column: str = "id", **options) -> DataFrame:
    """(query_id, feature, actual, predicted): features that SQL derives from several actions, from their values and from their predictions."""
    actual, predicted = cases.select(F.col(id_column).alias("query_id"), *actions), None
    for a, kind in actions.items():
        got = leave_one_out(cases, metric.without(*actions), a, kind, k, id_column=id_column, **options).select("query_id", F.col("predicted").alias(a))
        predicted = got if predicted is None else predicted.join(got, "query_id")
    out = []
    for name, expression in derive.items():
        a = actual.select("query_id", F.expr(expression).cast("double").alias("actual"))
        b = predicted.select("query_id", F.expr(expression).cast("double").alias("predicted"))
        out.append(a.join(b, "query_id").select("query_id", F.lit(name).alias("feature"), "actual", "predicted"))
    return reduce(lambda a, b: a.union(b), out)


def goal_sample(cases: DataFrame, metric: Metric, goals: dict[str, str | float], n: int = 1000, k: int = 10, *, seed: int = 0, id_column: str = "id", **options) -> DataFrame:
    """(query_id, case_id): a sample of n cases, each replaced by that of its k neighbours and itself which comes closest to the goals ("min",
    "max" or a value); several goals are summed in units of their standard deviations; ties go to the nearer case."""
    some = sample(cases, n, seed, id_column)
    near = knn(some, cases, metric, k + 1, id_column=id_column, carry=list(goals), self_too=True, **options)
    row = cases.agg(*(F.stddev_pop(g).alias(g) for g in goals)).first()
    off = F.lit(0.0)
    for g, aim in goals.items():
        c = F.col(g).cast("double")
        off = off + (c if aim == "min" else -c if aim == "max" else F.abs(c - F.lit(float(aim)))) / F.lit(float(row[g] or 1.0))
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.round(off, 9), "rank"))
    return near.withColumn("__r", best).where("__r = 1").select("query_id", "case_id")
