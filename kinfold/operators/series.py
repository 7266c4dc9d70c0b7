"""Time series: features derived within a series, their bounds, lags, forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.storage import written
from .condition import compile_condition
from .knn import Metric, knn
from .profile import loose_bounds
from .react import influence, predict_continuous, predict_nominal

#: Stands for a time step of zero in a rate.
LEAST_STEP = 0.001


def seconds(df: DataFrame, time: str) -> Column:
    kind = dict(df.dtypes)[time]
    return F.unix_micros(F.col(time).cast("timestamp")) / 1e6 if kind in ("timestamp", "timestamp_ntz", "date") else F.col(time).cast("double")


def time_invariant(df: DataFrame, ids: list[str], columns: list[str], time: str | None = None) -> list[str]:
    """Columns with one value (null counts) at most in every series; columns that are null throughout are among them, ids always are."""
    rest = [c for c in columns if c not in ids and c != time]
    if time in columns and columns == [time]:
        raise ValueError("the time feature varies by its nature")
    varies = [(F.min(F.coalesce(F.col(c).cast("string"), F.lit("\0"))) != F.max(F.coalesce(F.col(c).cast("string"), F.lit("\0")))).alias(c) for c in rest]
    row = df.groupBy(*ids).agg(*varies).agg(*(F.max(c).alias(c) for c in rest)).first() if rest else {}
    return [*ids, *(c for c in rest if not row[c])]


def derive(df: DataFrame, ids: list[str], time: str, columns: list[str], orders: int = 1, key: list[str] = ()) -> DataFrame:
    """`df` with, per column and order: c_delta_n, the difference from the row before in the series, and c_rate_n, that difference over the
    time step. Order n is taken of order n - 1, always within the series and over the row's own time step."""
    own = W.partitionBy(*ids).orderBy(time, *key)
    t = seconds(df, time)
    df = df.withColumn("__t", t)
    df = df.withColumn("__step", F.col("__t") - F.lag("__t").over(own))
    step = F.when(F.col("__step") != 0, F.col("__step")).when(F.col("__step").isNotNull(), F.lit(LEAST_STEP))
    for c in columns:
        delta = rate = F.col("__t") if c == time else F.col(c).cast("double")
        for n in range(1, orders + 1):
            df = df.withColumn("__d", delta).withColumn("__r", rate)
            df = df.withColumn(f"{c}_delta_{n}", F.col("__d") - F.lag("__d").over(own)).withColumn(f"{c}_rate_{n}", (F.col("__r") - F.lag("__r").over(own)) / step)
            delta, rate = F.col(f"{c}_delta_{n}"), F.col(f"{c}_rate_{n}")
    return df.drop("__t", "__step", "__d", "__r")


def derived_bounds(df: DataFrame, ids: list[str], time: str, columns: list[str], orders: int = 1, overrides: dict | None = None) -> dict[str, tuple[float, float] | None]:
    """Loose bounds of every derived feature over all series, in one aggregate; none for a feature without values. The time feature's delta
    is not negative. `overrides`: {feature: {"min" or "max": {order: value}}} of the deltas and rates, other orders stay."""
    names = [f"{c}_{kind}_{n}" for c in columns for kind in ("delta", "rate") for n in range(1, orders + 1)]
    row = derive(df, ids, time, columns, orders).agg(*(F.struct(F.min(x).alias("a"), F.max(x).alias("b")).alias(x) for x in names)).first()
    out: dict = {}
    for x in names:
        a, b = row[x].a, row[x].b
        out[x] = None if a is None else loose_bounds(a, b)
        if out[x] and x.startswith(f"{time}_delta"):
            out[x] = (max(0.0, out[x][0]), out[x][1])
        feature, _, order = x.rsplit("_", 2)
        own = (overrides or {}).get(feature, {})
        low, high = own.get("min", {}).get(int(order)), own.get("max", {}).get(int(order))
        if out[x] and (low is not None or high is not None):
            out[x] = (out[x][0] if low is None else low, out[x][1] if high is None else high)
    return out


def lag_features(df: DataFrame, ids: list[str], time: str, lags: dict[str, int | list[int]], key: list[str] = ()) -> DataFrame:
    """`df` with c_lag_i; a number means the lags 1 to that number, a list those in it."""
    own = W.partitionBy(*ids).orderBy(time, *key)
    wanted = [(c, i) for c, n in lags.items() for i in (range(1, n + 1) if isinstance(n, int) else n)]
    return df.select("*", *(F.lag(c, i).over(own).alias(f"{c}_lag_{i}") for c, i in wanted))


def lags_needed(lags: dict[str, int | list[int]], orders: dict[str, int] | None = None) -> int:
    """Rows of the past that derived features look back on."""
    most = [n if isinstance(n, int) else max(n, default=0) for n in lags.values()]
    return max([*most, *(orders or {}).values()], default=0)


def described(columns: list[str], orders: int, lags: dict) -> list[dict]:
    """What the derived columns are: name, parent, kind, order, and how many rows they look back."""
    out = [{"name": f"{c}_{k}_{n}", "parent": c, "ts_type": k, "ts_order": n, "max_row_lag": n} for c in columns for k in ("delta", "rate") for n in range(1, orders + 1)]
    return out + [{"name": f"{c}_lag_{i}", "parent": c, "ts_type": "lag", "ts_order": i, "max_row_lag": i} for c, n in lags.items() for i in (range(1, n + 1) if isinstance(n, int) else n)]


def progress(df: DataFrame, ids: list[str], time: str) -> DataFrame:
    """`df` with the share of its series that lies behind each row, from 0 to 1, and whether it is the last one."""
    t = seconds(df, time)
    ends = df.groupBy(*ids).agg(F.min(t).alias("__a"), F.max(t).alias("__b"))
    joined = df.join(ends, ids)
    return joined.withColumn("progress", F.when(F.col("__b") == F.col("__a"), F.lit(1.0)).otherwise((t - F.col("__a")) / (F.col("__b") - F.col("__a")))).withColumn("series_end", t == F.col("__b")).drop("__a", "__b")


def training_rows(df: DataFrame, ids: list[str], time: str, targets: dict[str, str], lags: int, key: str) -> DataFrame:
    """(id, ids, time, lagged contexts, the values at the row): what a forecast learns from. Rows without all lags of all targets are left out."""
    own = W.partitionBy(*ids).orderBy(time, key)
    step = (F.col("__t") - F.lag("__t").over(own)).alias("__step")
    df = df.withColumn("__t", seconds(df, time))
    past = [F.lag(c, i).over(own).alias(f"{c}_lag_{i}") for c in targets for i in range(1, lags + 1)]
    return df.select(F.col(key).alias("id"), *ids, "__t", *targets, step, *past).dropna(subset=[f"{c}_lag_{i}" for c in targets for i in range(1, lags + 1)] or None)


def forecast(
    history: DataFrame,
    ids: list[str],
    time: str,
    targets: dict[str, str],
    metric: Metric,
    steps: int,
    *,
    key: str,
    lags: int = 2,
    k: int = 10,
    tracking: str = "no",
    universal: bool = False,
    stop: dict | None = None,
    stop_maps: dict[str, dict] | None = None,
    limits: DataFrame | None = None,
    conditioned: DataFrame | None = None,
    seed: int | None = None,
) -> DataFrame:
    """(ids, step, time, targets, series_end): every series of `history` continued by up to `steps` rows.

    One job per step over all series: the contexts are the last `lags` values, the next values and time step come from the nearest
    rows. `tracking`: "fixed" looks only at rows of the same series; "dynamic" follows, step by step, the series with the most influence among the
    nearest rows. `universal`: rows later than the last one known are left out. `stop`: a series ends after the row for which this condition
    holds. `stop_maps`: by target, "min", "max" and "values" at or beyond which a series ends. `limits`: (ids, max_length and final_time, either can be
    missing): the most steps of a series, and the seconds since the epoch at or after which it ends. `conditioned`: (ids, step, columns) whose values are used in
    place of predictions. `seed`: one neighbour is drawn by influence instead of the mean. Every step is written out.

    A series without an admissible neighbour (a short one that is followed by itself, or one older than all others with `universal`) ends there: its row has null
    values, or those that `conditioned` gives, at the time last known.
    """
    learned = written(training_rows(history, ids, time, targets, lags, key), "series")
    last = history.withColumn("__t", seconds(history, time))
    newest = W.partitionBy(*ids).orderBy(F.desc("__t"), F.desc(key))
    state = last.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= lags)
    state = state.groupBy(*ids).agg(F.max("__t").alias("__t"), *(F.max(F.when(F.col("__r") == i, F.col(c))).alias(f"{c}_lag_{i}") for c in targets for i in range(1, lags + 1)))
    state = written(state.withColumn("id", -1 - F.xxhash64(*ids).bitwiseAND(F.lit((1 << 62) - 1))), "series")
    rows = []
    for step in range(1, steps + 1):
        near = influence(knn(state, learned, metric, k, carry=[*targets, "__step", *(ids if tracking == "dynamic" else [])], agree=ids if tracking == "fixed" else (), not_later="__t" if universal else None))
        if tracking == "dynamic":
            near = followed(near, ids)
        if seed is not None:
            near = drawn(near, seed + step)
        near = written(near, "series")
        new = state.join(near.select(F.col("query_id").alias("id"), F.lit(True).alias("__found")).distinct(), "id", "left")
        for c, kind in [*targets.items(), ("__step", "continuous")]:
            got = predict_continuous(near, c) if kind == "continuous" else predict_nominal(near, c).drop("probability")
            new = new.join(got.withColumnRenamed("query_id", "id"), "id", "left")
        new = new.withColumn("__t", F.col("__t") + F.greatest("__step", F.lit(0.0)))
        if conditioned is not None:
            given = conditioned.where(F.col("step") == step).drop("step")
            over = [c for c in given.columns if c not in ids]
            new = new.join(given.select(*ids, *(F.col(c).alias(f"__given_{c}") for c in over)), ids, "left")
            for c in over:
                new = new.withColumn(c, F.coalesce(f"__given_{c}", c)).drop(f"__given_{c}")
        ends = F.col("__found").isNull()
        ends = ends | F.coalesce(compile_condition(stop), F.lit(False)) if stop else ends
        for c, rule in (stop_maps or {}).items():
            parts = [F.col(c) <= F.lit(rule["min"])] if rule.get("min") is not None else []
            parts += [F.col(c) >= F.lit(rule["max"])] if rule.get("max") is not None else []
            parts += [F.col(c).isin(rule["values"])] if rule.get("values") else []
            for p in parts:
                ends = ends | F.coalesce(p, F.lit(False))
        if limits is not None:
            own = [x for x in ("max_length", "final_time") if x in limits.columns]
            new = new.join(limits.select(*ids, *(F.col(x).alias(f"__{x}") for x in own)), ids, "left")
            ends = ends | (F.coalesce(F.lit(step) >= F.col("__max_length"), F.lit(False)) if "max_length" in own else F.lit(False))
            ends = ends | (F.coalesce(F.col("__t") >= F.col("__final_time"), F.lit(False)) if "final_time" in own else F.lit(False))
        new = written(new.withColumn("series_end", F.coalesce(ends, F.lit(False)) | F.lit(step == steps)), "series")
        rows.append(new.select(*ids, F.lit(step).alias("step"), F.timestamp_seconds("__t").alias(time), *targets, "series_end"))
        older = [(f"{c}_lag_{i}", F.col(c) if i == 1 else F.col(f"{c}_lag_{i - 1}")) for c in targets for i in range(1, lags + 1)]
        state = new.where("NOT series_end").select("id", *ids, "__t", *(v.alias(n) for n, v in older))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def followed(near: DataFrame, ids: list[str]) -> DataFrame:
    """`near` (with the ids of its rows) without the rows of other series than that with the most influence on a query; ties go to the lesser ids."""
    sums = near.groupBy("query_id", *ids).agg(F.sum("weight").alias("__w"))
    best = sums.withColumn("__r", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc(F.round("__w", 9)), *ids))).where("__r = 1").drop("__r")
    out = near.join(best, ["query_id", *ids]).withColumn("weight", F.try_divide("weight", "__w"))
    return out.drop("__w", *ids)


def forecast_accuracy(df: DataFrame, ids: list[str], time: str, targets: dict[str, str], metric: Metric, window: int, *, key: str, **options) -> DataFrame:
    """(target, step, n, error): forecasts of the last `window` rows of every series from those before: mean absolute error by step, or for nominals the share
    of wrong classes."""
    history, tail = holdout(df, ids, time, window, key)
    got = forecast(history, ids, time, targets, metric, window, key=key, **options)
    both = written(got.select(*ids, "step", *(F.col(c).alias(f"__{c}") for c in targets)).join(tail.select(*ids, "step", *targets), [*ids, "step"]), "series")
    out = None
    for c, kind in targets.items():
        off = F.abs(F.col(c).cast("double") - F.col(f"__{c}")) if kind == "continuous" else (~F.col(c).eqNullSafe(F.col(f"__{c}"))).cast("double")
        one = both.groupBy("step").agg(F.count(off).alias("n"), F.avg(off).alias("error")).select(F.lit(c).alias("target"), "step", "n", "error")
        out = one if out is None else out.union(one)
    return out


def drawn(near: DataFrame, seed: int) -> DataFrame:
    """One neighbour per query, drawn by its influence with a seeded number."""
    upto = F.sum("weight").over(W.partitionBy("query_id").orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    u = F.pmod(F.xxhash64(F.lit(seed), "query_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    df = near.withColumn("__u", upto).where(F.col("__u") > u * (1 - 1e-9))
    return df.withColumn("__r", F.row_number().over(W.partitionBy("query_id").orderBy("rank"))).where("__r = 1").drop("__r", "__u").withColumn("weight", F.lit(1.0))


def series_residuals(runs: list[DataFrame], ids: list[str], target: str) -> DataFrame:
    """Mean absolute deviation of seeded forecasts from their mean, by series and step."""
    df = runs[0].select(*ids, "step", target)
    for r in runs[1:]:
        df = df.union(r.select(*ids, "step", target))
    mean = df.groupBy(*ids, "step").agg(F.avg(target).alias("__m"))
    return df.join(mean, [*ids, "step"]).groupBy(*ids, "step").agg(F.avg(F.abs(F.col(target) - F.col("__m"))).alias("residual"))


def stationary(df: DataFrame, ids: list[str], contexts: list[str], target: str, queries: DataFrame, k: int = 10) -> DataFrame:
    """(ids, target): a constant of each query series voted by the series with the most similar means, deviations and lengths."""
    from .knn import metric_of

    def summary(x: DataFrame) -> DataFrame:
        stats = [s for c in contexts for s in (F.avg(c).alias(f"{c}_mean"), F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(f"{c}_dev"))]
        return x.groupBy(*ids).agg(*stats, F.count("*").cast("double").alias("rows"), F.first(target, ignorenulls=True).alias(target)).withColumn("id", F.xxhash64(*ids))

    a, b = written(summary(queries.withColumn(target, F.lit(None).cast(dict(df.dtypes)[target]))), "series"), written(summary(df), "series")
    names = [c for c in b.columns if c not in (*ids, target, "id")]
    near = influence(knn(a, b, metric_of(b, names), k, carry=[target]))
    nominal = dict(df.dtypes)[target] in ("string", "boolean")
    got = predict_nominal(near, target) if nominal else predict_continuous(near, target)
    return a.select("id", *ids).join(got.withColumnRenamed("query_id", "id"), "id").drop("id")


def mean_probabilities(probs: DataFrame, series: str) -> DataFrame:
    """(series, class, probability): class probabilities averaged over the rows of a series, a class that a row lacks being 0 there."""
    rows = probs.select(series, "query_id").distinct().groupBy(series).agg(F.count("*").alias("__n"))
    return probs.groupBy(series, "class").agg(F.sum("probability").alias("__p")).join(rows, series).select(series, "class", (F.col("__p") / F.col("__n")).alias("probability"))


def numbered(ids: DataFrame, name: str = ".series") -> DataFrame:
    """Series named series_1, series_2, ...: distinct ids numbered hash bucket by hash bucket, so no task orders them all."""
    keys = ids.distinct().withColumn("__b", F.pmod(F.xxhash64(*ids.columns), F.lit(4096)))
    sizes = keys.groupBy("__b").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per bucket
    inside = F.row_number().over(W.partitionBy("__b").orderBy(*ids.columns))
    keys = keys.withColumn("__i", inside).join(sizes.select("__b", before.alias("__before")), "__b")
    return keys.select(*ids.columns, F.concat(F.lit("series_"), (F.col("__before") + F.col("__i")).cast("string")).alias(name))


def holdout(df: DataFrame, ids: list[str], time: str, steps: int, key: str) -> tuple[DataFrame, DataFrame]:
    """(history, last `steps` rows with their step number): to measure forecasts on a window."""
    back = F.row_number().over(W.partitionBy(*ids).orderBy(F.desc(time), F.desc(key)))
    df = df.withColumn("__back", back)
    return df.where(F.col("__back") > steps).drop("__back"), df.where(F.col("__back") <= steps).withColumn("step", F.lit(steps + 1) - F.col("__back")).drop("__back")


def infer(df: DataFrame, ids: list[str], time: str, *, orders: int = 1, lags: dict | None = None, universal: bool = False, kinds: dict[str, str] | None = None, overrides: dict | None = None, derived_orders: dict[str, int] | None = None, **options) -> dict:
    """The profile of a series table: attributes of every column with, in `extra`, its series type (rate, delta or covariate), whether it is
    invariant, the bounds of its derived features, its lags, and for the time feature that it is a delta and whether it is universal."""
    from dataclasses import replace

    from .profile import infer as infer_columns

    for c, n in (derived_orders or {}).items():  # orders that are derived back from the highest rather than predicted
        if not 0 <= n < orders:
            raise ValueError(f"derived orders of {c}: {n} of {orders}")
    fixed = time_invariant(df, ids, df.columns, time)
    out = infer_columns(df, series_ids=ids, invariant=fixed, ids=ids, **options)
    moving = [c for c, a in out.items() if a.type == "continuous" and a.data_type in ("number", "formatted_date_time") and c not in fixed]
    bounds = derived_bounds(df, ids, time, moving, orders, overrides)
    for c, a in out.items():
        kind = "delta" if c == time else (kinds or {}).get(c, "rate" if c in moving else "covariate")
        extra = {"series_type": kind, "invariant": c in fixed, "lags": (lags or {}).get(c, 0)}
        if c in moving:
            extra |= {"orders": orders, "derived_orders": (derived_orders or {}).get(c, 0)}
            extra["derived_bounds"] = {k: v for k, v in bounds.items() if k.startswith(f"{c}_")}
        if c == time:
            extra |= {"universal": universal}
            a = replace(a, type="continuous", allow_null=False)
        out[c] = replace(a, extra=a.extra | extra)
    return out
