"""Rare values, their weights, and marginal statistics of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .condition import compile_condition
from .profile import chunk_size, value_counts

THRESHOLD = 30
TARGET = 25_000
#: Candidates that are shown per feature.
SHOWN = 5


def target_rows(n: int, most: int | None) -> int:
    return chunk_size(n, most) if most else TARGET


def rare_values(df: DataFrame, features: list[str], target: int, threshold: int = THRESHOLD, shown: int = SHOWN) -> DataFrame:
    """(feature, value, n, multiplier): values that are frequent enough in all rows but would be rare among `target` of them."""
    counts = value_counts(df, features)
    total = df.agg(F.count("*").alias("__rows"))
    df = counts.crossJoin(F.broadcast(total))
    scaled = F.lit(float(target)) / F.col("__rows") * F.col("n")
    # a feature without any repeated value has none to keep
    keep = counts.groupBy("feature").agg(F.max("n").alias("__top")).where("__top > 1").select("feature")
    rank = F.row_number().over(W.partitionBy("feature").orderBy("n", "value"))
    found = df.join(keep, "feature").where((F.col("n") >= threshold) & (scaled < threshold))
    return found.withColumn("__r", rank).where(F.col("__r") <= shown).select("feature", "value", "n", (threshold / scaled).alias("multiplier"))


def unprotected_multipliers(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """(feature, unprotected): factor for all other values, so that the total weight stays; at most 1."""
    total = df.agg(F.count("*").alias("__rows"))
    sums = chosen.groupBy("feature").agg(F.sum(F.col("n") * F.col("multiplier")).alias("__w"), F.sum("n").alias("__n")).crossJoin(F.broadcast(total))
    return sums.select("feature", F.least((F.col("__rows") - F.col("__w")) / (F.col("__rows") - F.col("__n")), F.lit(1.0)).alias("unprotected"))


def preserve(df: DataFrame, want: str | dict, features: list[str], target: int, threshold: int = THRESHOLD) -> DataFrame:
    """Multipliers by workflow: "all" candidates, "off" for none, or a map of feature to listed values. A listed value that never occurs is an error."""
    if want == "off":
        return rare_values(df.limit(0), features, target, threshold)
    if want == "all":
        return rare_values(df, features, target, threshold)
    counts = value_counts(df, list(want))
    total = df.count()
    listed = df.sparkSession.createDataFrame([(f, None if v is None else str(v)) for f, vs in want.items() for v in vs], "feature string, value string")
    a, b = listed.alias("a"), counts.alias("b")
    found = a.join(b, (F.col("a.feature") == F.col("b.feature")) & F.col("a.value").eqNullSafe(F.col("b.value")), "left").select("a.feature", "a.value", "n")
    if not found.where("n IS NULL").isEmpty():
        raise ValueError("a listed value does not occur")
    return found.withColumn("multiplier", F.lit(float(threshold)) / (F.lit(float(target) / total) * F.col("n"))).where("multiplier >= 1")


def weigh(df: DataFrame, chosen: DataFrame, unprotected: DataFrame, weight: str = "_case_weight") -> DataFrame:
    """`df` with its case weight multiplied, per feature of `chosen`, by the value's multiplier or the feature's factor for all others.

    The tables of multipliers have at most a few values per feature.
    """
    out = df if weight in df.columns else df.withColumn(weight, F.lit(1.0))
    factors = {r.feature: r.unprotected for r in unprotected.collect()}
    for f, factor in factors.items():
        own = chosen.where(F.col("feature") == f).select(F.col("value").alias("__v"), F.col("multiplier").alias("__m"))
        out = out.join(F.broadcast(own), out[f].cast("string").eqNullSafe(own["__v"]), "left").withColumn(weight, F.col(weight) * F.coalesce("__m", F.lit(factor))).drop("__v", "__m")
    return out


def rebalance(df: DataFrame, features: list[str], weight: str = "_case_weight") -> DataFrame:
    """Weights that give every combination of `features` the same mass: rows / (combinations * rows of the combination).

    Counts are aggregated and joined back, so a frequent combination is no window of its own.
    """
    counts = df.groupBy(*features).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"), F.count("*").alias("__k"))
    w = counts.crossJoin(F.broadcast(total)).select(*(F.col(f).alias(f"__{f}") for f in features), (F.col("__all") / (F.col("__k") * F.col("__n"))).alias(weight))
    on = [df[f].eqNullSafe(w[f"__{f}"]) for f in features]
    return df.drop(weight).join(w, on).drop(*(f"__{f}" for f in features))


def value_masses(df: DataFrame, features: list[str], least: float = 0.0, weight: str | None = None) -> DataFrame:
    """(feature, value, mass, remaining): weight of every value; those under `least` are summed up in one row that is marked remaining."""
    mass = F.col(weight).cast("double") if weight else F.lit(1.0)
    cells = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features))
    sums = df.select(F.explode(cells).alias("x"), mass.alias("__m")).groupBy("x.feature", "x.value").agg(F.sum("__m").alias("mass"))
    small = F.col("mass") < least
    return sums.select("feature", F.when(~small, F.col("value")).alias("value"), "mass", small.alias("remaining")).groupBy("feature", "value", "remaining").agg(F.sum("mass").alias("mass"))


def marginal_stats(df: DataFrame, features: list[str], condition: dict | None = None, weight: str | None = None) -> DataFrame:
    """(feature, count, mean, variance, stddev, min, max, median, skew, kurtosis) of numbers under a condition, weighted if asked."""
    df = df.where(compile_condition(condition))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    cells = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features))
    long = df.select(F.explode(cells).alias("x"), w.alias("w")).select("x.feature", "x.v", "w").where("v IS NOT NULL")
    mean = F.sum(F.col("v") * F.col("w")) / F.sum("w")

    def variance(v: Column) -> Column:
        return F.sum(v * v * F.col("w")) / F.sum("w") - F.pow(F.sum(v * F.col("w")) / F.sum("w"), 2)

    return long.groupBy("feature").agg(
        F.count("*").alias("count"), mean.alias("mean"), variance(F.col("v")).alias("variance"), F.sqrt(F.greatest(variance(F.col("v")), F.lit(0.0))).alias("stddev"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.percentile_approx("v", 0.5, 10_000).alias("median"), F.skewness("v").alias("skew"), F.kurtosis("v").alias("kurtosis"),
    )


def entropy(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, entropy, n_distinct, mode): of nominal values."""
    counts = value_counts(df, features).where("value IS NOT NULL")
    total = counts.groupBy("feature").agg(F.sum("n").alias("__t"))
    p = F.col("n") / F.col("__t")
    return counts.join(total, "feature").groupBy("feature").agg((-F.sum(p * F.ln(p))).alias("entropy"), F.count("*").alias("n_distinct"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
