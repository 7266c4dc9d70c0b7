"""Aggregates with differential privacy: bounded contributions, clipped sums and counts, noise from a stated budget."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .synth import laplace


@dataclass(frozen=True)
class Bounds:
    """What one unit (a person, say) can change: rows in at most `groups` groups, at most `rows` in each, values within `clip` by column."""

    unit: str
    groups: int
    rows: int
    clip: dict[str, tuple[float, float]]

    def __post_init__(self):
        if self.groups < 1 or self.rows < 1 or any(lo > hi for lo, hi in self.clip.values()):
            raise ValueError("at least one group and one row, and clips from low to high")

    def sensitivity(self, column: str | None = None) -> float:
        """The most by which all counts (or all sums of a column) together can change if the rows of one unit are added or taken away."""
        most = 1.0 if column is None else max(abs(float(x)) for x in self.clip[column])
        return self.groups * self.rows * most


def bounded(df: DataFrame, by: list[str], bounds: Bounds, *, order: list[str] | None = None, seed: int = 0) -> DataFrame:
    """Rows of `df` that count: of each unit its first groups and in them its first rows, by `order` or by a seeded hash of the row; values are clipped, nulls kept.

    What is kept of a unit depends on its own rows only. A null unit is one unit. The windows are by unit, of which one with very many
    rows is cut down by (unit, group) first.
    """
    place = [F.col(c) for c in order] if order else [F.xxhash64(F.lit(seed), *df.columns), *(F.col(c) for c in df.columns)]
    df = df.withColumn("__row", F.row_number().over(W.partitionBy(bounds.unit, *by).orderBy(*place))).where(F.col("__row") <= bounds.rows)
    first = df.where("`__row` = 1")
    ranked = first.withColumn("__g", F.row_number().over(W.partitionBy(bounds.unit).orderBy(*place))).where(F.col("__g") <= bounds.groups)
    held = ranked.select(F.col(bounds.unit).alias("__unit"), *(F.col(c).alias(f"__by_{c}") for c in by))
    same = F.col(bounds.unit).eqNullSafe(F.col("__unit"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    df = df.join(held, same, "left_semi").drop("__row")
    for c, (lo, hi) in bounds.clip.items():
        df = df.withColumn(c, F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c).cast("double"), F.lit(float(hi))), F.lit(float(lo)))))
    return df


def clipped_totals(df: DataFrame, by: list[str], bounds: Bounds, **options) -> DataFrame:
    """(by, n, sum_<column>, units) of the bounded rows: exact, and so not to be released."""
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"sum_{c}") for c in bounds.clip]
    return bounded(df, by, bounds, **options).groupBy(*by).agg(F.count("*").alias("n"), *sums, F.countDistinct(bounds.unit).alias("units"))


def budget(epsilon: float, bounds: Bounds, shares: dict[str, float] | None = None) -> dict[str, tuple[float, float]]:
    """(epsilon, scale of the noise) of the count (`n`) and of each sum: the shares, by default equal, add up to the whole budget."""
    names = ["n", *bounds.clip]
    shares = shares or dict.fromkeys(names, 1.0)
    if epsilon <= 0 or set(shares) != set(names) or min(shares.values()) <= 0:
        raise ValueError("a positive budget, and a positive share of it for the count and every sum")
    whole = sum(shares.values())
    return {x: (epsilon * shares[x] / whole, bounds.sensitivity(None if x == "n" else x) / (epsilon * shares[x] / whole)) for x in names}


def private_aggregates(df: DataFrame, by: list[str], bounds: Bounds, epsilon: float, *, groups: DataFrame | None = None, delta: float | None = None, shares: dict[str, float] | None = None, seed: int = 0, **options) -> DataFrame:
    """(by, n, sum_<column>, mean_<column>): bounded counts and sums with Laplace noise, `epsilon` being spent over all of them together.

    `groups`: the groups that are public, each of which has a row, empty or not. Without them a group is released if its noisy count passes the threshold that one
    unit alone passes with probability `delta` at most, so that the list of groups tells little. Means are noisy sums over noisy counts, null below
    one. The seed fixes the noise of a group, so that a rerun does not average it away; keep it secret.
    """
    if (groups is None) == (delta is None):
        raise ValueError("either the public groups or a delta")
    totals = clipped_totals(df, by, bounds, seed=seed, **options)
    if groups is not None:
        keys = groups.select(*by).distinct()
        right = totals.select(*(F.col(c).alias(f"__by_{c}") for c in by), *(c for c in totals.columns if c not in by))
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(f"__by_{c}"))
        totals = keys.join(right, same, "left").drop(*(f"__by_{c}" for c in by)).fillna(0, ["n", "units", *(f"sum_{c}" for c in bounds.clip)])
    spent = budget(epsilon, bounds, shares)

    def noisy(column: str, name: str, at: int) -> Column:
        return F.col(column).cast("double") + laplace(seed + at, *by) * F.lit(spent[name][1])

    out = totals.select(*by, noisy("n", "n", 1).alias("n"), *(noisy(f"sum_{c}", c, 2 + i).alias(f"sum_{c}") for i, c in enumerate(bounds.clip)))
    if delta is not None:
        scale = spent["n"][1]
        out = out.where(F.col("n") >= bounds.rows + scale * math.log(bounds.groups / (2 * delta)))
    return out.select("*", *(F.when(F.col("n") >= 1, F.col(f"sum_{c}") / F.col("n")).alias(f"mean_{c}") for c in bounds.clip))
