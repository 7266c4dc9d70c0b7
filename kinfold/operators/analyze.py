"""Search for the parameters of a metric."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.storage import written
from .influence import deviations, residuals
from .knn import Metric, knn


def fold(id_column: str, folds: int, seed: int = 0):
    return F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(folds)).cast("int")


def grid(
    cases: DataFrame,
    metric: Metric,
    action: str,
    kind: str,
    *,
    k_values: list[int],
    p_values: list[float] = (1.0,),
    dt_values: list[float] = (-1.0,),
    folds: int = 6,
    fold_by: str | None = None,
    seed: int = 0,
    id_column: str = "id",
    queries: DataFrame | None = None,
) -> DataFrame:
    """(p, k, dt, n, error): mean error by parameters over `folds` folds, 1 meaning that each case is held out alone. `fold_by`: an SQL expression
    that names the fold of a case, in place of a hash of its id; `queries`: those of the cases that are predicted.

    One search with the largest k per p, in which a column keeps the cases of a fold out, so all folds are one job. The influences of a
    query's neighbours do not depend on k but for their sum, so every k and dt is one more pair of sums up to a rank in a single aggregate.
    """
    metric = metric.without(action)
    own = F.expr(fold_by) if fold_by else fold(id_column, folds, seed)
    alone = not fold_by and folds <= 1  # a case is never its own neighbour, so no fold has to differ
    df = cases if alone else cases.withColumn("__fold", own)
    asked = df if queries is None else queries if alone else queries.withColumn("__fold", own)
    actual = asked.select(F.col(id_column).alias("query_id"), F.col(action).alias("__actual"))
    cells = [(k, float(dt)) for k in k_values for dt in dt_values]
    whole = W.partitionBy("query_id")
    out = None
    for p in p_values:
        near = knn(asked, df, replace(metric, p=p), max(k_values), id_column=id_column, carry=[action], differ=[] if alone else ["__fold"])
        near = near.join(actual, "query_id").withColumn("__zero", F.min("distance").over(whole) == 0)
        known = F.col(action).isNotNull()
        hit = F.col(action).cast("double") if kind == "continuous" else (F.col(action) == F.col("__actual")).cast("double")
        sums = []
        for i, (k, dt) in enumerate(cells):
            raw = F.when(F.col("__zero"), (F.col("distance") == 0).cast("double")).otherwise(F.pow(F.greatest("distance", F.lit(1e-300)), F.lit(dt)))
            held = known & (F.col("rank") <= k)
            sums += [F.sum(F.when(held, raw)).alias(f"w{i}"), F.sum(F.when(held, raw * hit)).alias(f"y{i}")]
        by_query = near.groupBy("query_id").agg(F.first("__actual").alias("__actual"), *sums)
        errors = []
        for i in range(len(cells)):
            got = F.try_divide(F.col(f"y{i}"), F.col(f"w{i}"))
            errors.append(F.abs(F.col("__actual").cast("double") - got) if kind == "continuous" else F.when(F.col("__actual").isNotNull(), 1 - F.coalesce(got, F.lit(0.0))))
        one = by_query.agg(*(f(e).alias(f"{x}{i}") for i, e in enumerate(errors) for x, f in (("n", F.count), ("e", F.avg))))
        rows = F.array(*(F.struct(F.lit(float(p)).alias("p"), F.lit(k).alias("k"), F.lit(dt).alias("dt"), F.col(f"n{i}").alias("n"), F.col(f"e{i}").alias("error")) for i, (k, dt) in enumerate(cells)))
        got = one.select(F.inline(rows))
        out = got if out is None else out.union(got)
    return out


def halving(cases: DataFrame, metric: Metric, action: str, kind: str, *, p_values: list[float], share: int = 8, sample_by: str | None = None, seed: int = 0, id_column: str = "id", **options) -> DataFrame:
    """(p, k, dt, n, error) of the exponents that are left in the end: all are tried on one case in `share`, the better half of them on twice as many, and so on until
    one is left or all cases were asked. The neighbours are always looked for among all cases. `sample_by`: an SQL integer whose remainder by `share` picks
    the cases, in place of a hash of the id."""
    place = F.pmod(F.expr(sample_by), F.lit(share)) if sample_by else fold(id_column, share, seed + 1)
    left, taken = list(p_values), 1
    while True:
        got = written(grid(cases, metric, action, kind, p_values=left, seed=seed, id_column=id_column, queries=cases.where(place < taken), **options), "halving")
        if taken >= share:
            return got
        errors = {r.p: r.error for r in got.groupBy("p").agg(F.min("error").alias("error")).collect()}  # a row per exponent
        left = sorted(left, key=lambda p: (errors[p] is None, errors[p], p))[: -(-len(left) // 2)]
        taken = share if len(left) == 1 else min(share, 2 * taken)


def best(results: DataFrame) -> dict:
    r = results.orderBy("error", "k", "p", "dt").first()
    return {"k": r.k, "p": r.p, "dt": r.dt, "error": r.error}


def feature_weights(res: DataFrame) -> dict[str, float]:
    """Inverse residuals that sum to the number of features; a residual of 0 counts as the least other one."""
    rows = {r.feature: r.residual for r in res.collect()}
    least = min((x for x in rows.values() if x), default=1.0)
    inverse = {f: 1 / (x or least) for f, x in rows.items()}
    total = sum(inverse.values())
    return {f: w * len(inverse) / total for f, w in inverse.items()}


def shared(values: dict[str, float], groups: list[list[str]]) -> dict[str, float]:
    """Deviations pooled within groups of features (and their lags)."""
    out = dict(values)
    for g in groups:
        known = [values[f] for f in g if f in values]
        if known:
            out |= {f: sum(known) / len(known) for f in g}
    return out


def analyze(cases: DataFrame, metric: Metric, kinds: dict[str, str], action: str | None = None, *, targeting: str = "single_targeted", use_deviations: bool = False, inverse_weights: bool = False, id_column: str = "id", **search) -> dict[str, dict]:
    """Parameters by target: of the one action (single_targeted), of each feature (omni_targeted), or one set for all, of the least
    mean error over the features in units of their deviations (targetless)."""
    search = {"k_values": [3, 5, 10, 20]} | search
    out: dict[str, dict] = {}
    res = residuals(cases, metric, kinds, id_column=id_column) if inverse_weights else None
    dev = {r.feature: r.deviation for r in deviations(cases, metric, kinds, id_column=id_column).collect()} if use_deviations or targeting == "targetless" else {}
    targets = [action] if targeting == "single_targeted" else list(kinds)
    for t in targets:
        m = metric.with_deviations(dev) if use_deviations else metric
        out[t] = best(grid(cases, m, t, kinds[t], id_column=id_column, **search)) if targeting != "targetless" else {}
    if targeting == "targetless":
        scores: dict = {}
        for t in kinds:
            for r in grid(cases, metric, t, kinds[t], id_column=id_column, **search).collect():
                scores.setdefault((r.k, r.p, r.dt), []).append(r.error / (dev[t] or 1.0))
        k, p, dt = min(scores, key=lambda x: (sum(scores[x]), x))
        out = {".targetless": {"k": k, "p": p, "dt": dt}}
    for params in out.values():
        params |= ({"deviations": dev} if use_deviations else {}) | ({"weights": feature_weights(res)} if res is not None else {})
    return out


@dataclass
class AutoAnalyze:
    """When a growing store should be analyzed again: at `threshold` cases, then each time that they have grown by `growth`."""

    enabled: bool = True
    threshold: int = 100
    growth: float = 7.389

    def due(self, cases: int) -> bool:
        return self.enabled and cases >= self.threshold

    def done(self, cases: int) -> AutoAnalyze:
        t = self.threshold
        while t <= cases:
            t = int(t * self.growth) + 1
        return replace(self, threshold=t)

