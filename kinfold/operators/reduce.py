"""Fewer cases with the same mass, and imputation of missing values."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import written
from ..sources.store import distribute
from .conviction import weight_entropy
from .knn import Metric, metric_of
from .react import distance_contribution, neighbours, predict_continuous, predict_nominal
from .stats import continuous_stats, leave_one_out, nominal_stats

# Defaults of ablation.
ENTROPY_QUANTILE = 0.15
BATCH = 2000


@dataclass(frozen=True)
class AblationParams:
    """How a growing store is kept small; kept beside the store's other parameters."""

    enabled: bool = False
    least_cases: int = 1000
    most_cases: int | None = None
    batch: int = BATCH
    quantile: float = ENTROPY_QUANTILE
    exact: tuple[str, ...] = ()  # features whose exact prediction makes a case dispensable
    tolerance: dict[str, float] | None = None
    relative: dict[str, float] | None = None

    def save(self, store) -> None:
        store.set_params(".ablation", [], asdict(self))

    @classmethod
    def of(cls, store) -> AblationParams:
        """The parameters set last, or the defaults."""
        got = store.params(".ablation", [], exactly=True)
        return cls(**(got | {"exact": tuple(got["exact"])})) if got else cls()


def reduce_cases(cases: DataFrame, metric: Metric, most: int, k: int = 10, *, id_column: str = "id", weight: str = "_case_weight") -> DataFrame:
    """The `most` cases with the lowest influence-weight entropy, in which the mass of all others is gathered by their influence.

    A case of high entropy is expressed evenly by many neighbours and is missed least. The total of weights is kept.
    """
    if cases.count() <= most:
        return cases if weight in cases.columns else cases.withColumn(weight, F.lit(1.0))
    near = neighbours(cases, cases, metric, k, id_column=id_column)
    order = weight_entropy(near).select(F.col("query_id").alias(id_column), F.round("influence_weight_entropy", 9).alias("__e"))
    keep = written(order.orderBy("__e", id_column).limit(most).select(id_column), "reduce")
    stay, go = cases.join(keep, id_column, "left_semi"), cases.join(keep, id_column, "left_anti")
    return distribute(stay, go, metric, k, weight, id_column)


def reduce_until(cases: DataFrame, metric: Metric, action: str, kind: str, *, stat: str, absolute: float | None = None, relative: float | None = None, delta: float | None = None, least: int = 100, most: int | None = None, share: float = 0.5, k: int = 10, id_column: str = "id") -> DataFrame:
    """Cases halved again and again while the leave-one-out statistic stays within the thresholds of its first value (`absolute`, `relative`) and of that of the
    round before (`delta`), and `least` cases are left. Down to `most` cases no threshold counts."""

    def measure(df: DataFrame) -> float:
        got = leave_one_out(df, metric, action, kind, k, id_column=id_column)
        return (continuous_stats(got) if kind == "continuous" else nominal_stats(got)).first()[stat]

    first, now = measure(cases), cases
    before = first
    while (n := now.count()) * share >= least:
        new = written(reduce_cases(now, metric, int(n * share), k, id_column=id_column), "reduce")
        value = measure(new)
        off, step = abs(value - first), abs(value - before)
        beyond = absolute is not None and off > absolute or relative is not None and off > relative * abs(first) or delta is not None and step > delta
        if beyond and (most is None or n <= most):
            break
        now, before = new, value
    return now


def ablate(cases: DataFrame, batch: DataFrame, metric: Metric, k: int = 10, *, quantile: float = ENTROPY_QUANTILE, least_cases: int = 1000, id_column: str = "id", weight: str = "_case_weight") -> DataFrame:
    """`cases` with those of `batch` that they express badly: whose entropy is under the quantile of the cases' own entropies; the mass of the
    others goes to their neighbours. Up to `least_cases` all are taken."""
    if cases.count() < least_cases:
        return cases.unionByName(batch, allowMissingColumns=True)
    own = weight_entropy(neighbours(cases, cases, metric, k, id_column=id_column)).agg(F.percentile_approx("influence_weight_entropy", 1 - quantile, 10_000).alias("e")).first().e
    e = weight_entropy(neighbours(batch, cases, metric, k, id_column=id_column)).select(F.col("query_id").alias(id_column), (F.col("influence_weight_entropy") <= own).alias("__new"))
    marked = written(batch.join(e, id_column, "left"), "ablate")
    new, known = marked.where("coalesce(__new, true)").drop("__new"), marked.where("NOT coalesce(__new, true)").drop("__new")
    mass = lambda df: df if weight in df.columns else df.withColumn(weight, F.lit(1.0))
    return distribute(mass(cases), mass(known), metric, k, weight, id_column).unionByName(mass(new), allowMissingColumns=True)


def predicted_well(cases: DataFrame, batch: DataFrame, metric: Metric, action: str, kind: str, *, tolerance: float | None = None, relative: float | None = None, residual: float | None = None, k: int = 10, id_column: str = "id") -> DataFrame:
    """Rows of `batch` that need not be kept: the action is predicted exactly, or within a tolerance, a share of its value, or a residual."""
    near = neighbours(batch, cases, metric.without(action), k, carry=[action], id_column=id_column)
    got = predict_continuous(near, action, name="__p") if kind == "continuous" else predict_nominal(near, action, name="__p").drop("probability")
    df = batch.join(got.withColumnRenamed("query_id", id_column), id_column)
    if kind == "nominal":
        return df.where(F.col(action).eqNullSafe(F.col("__p"))).drop("__p")
    off = F.abs(F.col(action) - F.col("__p"))
    limit = F.lit(0.0)
    for x in (tolerance, residual):
        limit = F.greatest(limit, F.lit(float(x or 0.0)))
    if relative:
        limit = F.greatest(limit, F.abs(action) * F.lit(relative))
    return df.where(off <= limit).drop("__p")


def by_conviction(scored: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Cases with a conviction within the thresholds."""
    c = F.col(column)
    return scored.where((F.lit(low is None) | (c >= F.lit(low if low is not None else 0.0))) & (F.lit(high is None) | (c <= F.lit(high if high is not None else 0.0))))


def impute(cases: DataFrame, features: dict[str, str], contexts: list[str], k: int = 10, *, rounds: int = 1, session: str = "impute", id_column: str = "id") -> DataFrame:
    """`cases` with null values predicted from cases that have them, and `_imputed` (array of the features), `_imputed_session`.

    In each round a share of the cases with missing values, those closest to known ones first, is completed; they are known in the next.
    """
    metric = metric_of(cases, contexts)
    df = cases.withColumn("_imputed", F.array().cast("array<string>")).withColumn("_imputed_session", F.lit(None).cast("string"))
    for r in range(rounds):
        for f, kind in features.items():
            own = metric.without(f)
            missing, known = df.where(F.col(f).isNull()), df.where(F.col(f).isNotNull())
            near = written(neighbours(missing, known, own, k, carry=[f], id_column=id_column), "impute")
            if r < rounds - 1:
                dc = distance_contribution(near)
                edge = dc.agg(F.percentile_approx("distance_contribution", 1 / (rounds - r), 10_000).alias("e")).first().e
                near = near.join(dc.where(F.col("distance_contribution") <= F.lit(edge)).select("query_id"), "query_id", "left_semi")
            got = predict_continuous(near, f, name="__p") if kind == "continuous" else predict_nominal(near, f, name="__p").drop("probability")
            df = df.join(got.withColumnRenamed("query_id", id_column), id_column, "left")
            hit = F.col(f).isNull() & F.col("__p").isNotNull()
            df = df.withColumn("_imputed", F.when(hit, F.concat("_imputed", F.array(F.lit(f)))).otherwise(F.col("_imputed"))).withColumn("_imputed_session", F.when(hit, F.lit(session)).otherwise(F.col("_imputed_session")))
            df = written(df.withColumn(f, F.coalesce(f, F.col("__p").cast(dict(cases.dtypes)[f]))).drop("__p"), "impute")
    return df


def clear_imputed(df: DataFrame, session: str, edited: str | None = None) -> DataFrame:
    """Imputed values of a session back to null; features named in the array column `edited` were set by hand since and stay."""
    mine = F.col("_imputed_session") == session
    kept = F.col(edited) if edited else F.array().cast("array<string>")
    columns = [c for c in df.columns if not c.startswith("_imputed")]
    out = [F.when(mine & F.array_contains("_imputed", c) & ~F.coalesce(F.array_contains(kept, c), F.lit(False)), None).otherwise(F.col(c)).alias(c) for c in columns]
    return df.select(*out, F.when(mine, F.array().cast("array<string>")).otherwise(F.col("_imputed")).alias("_imputed"), F.when(~F.coalesce(mine, F.lit(False)), F.col("_imputed_session")).alias("_imputed_session"))
