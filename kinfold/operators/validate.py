"""Validation and coercion of a table against its profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .profile import Attributes


def out_of_bounds(df: DataFrame, feature: str, low=None, high=None, allowed: list | None = None, shown: int = 5) -> DataFrame:
    """(feature, values, n_more): distinct non-null values outside, the first `shown` in order and the number of the others."""
    c = F.col(feature)
    if allowed is not None:
        bad = ~c.isin(allowed)
    else:
        parts = ([c < F.lit(low).cast(dict(df.dtypes)[feature])] if low is not None else []) + ([c > F.lit(high).cast(dict(df.dtypes)[feature])] if high is not None else [])
        bad = reduce(lambda a, b: a | b, parts, F.lit(False))
    values = df.where(c.isNotNull() & bad).select(F.col(feature).cast("string").alias("v"), c.alias("o")).distinct()
    top = values.orderBy("o").limit(shown).agg(F.sort_array(F.collect_list(F.struct("o", "v"))).alias("x")).select(F.col("x.v").alias("values"))
    n = values.agg(F.count("*").alias("n"))
    return n.crossJoin(top).where("n > 0").select(F.lit(feature).alias("feature"), "values", F.greatest(F.col("n") - shown, F.lit(0)).alias("n_more"))


def violations(df: DataFrame, profile: dict[str, Attributes], *, allow_missing: bool = False, types: dict[str, str] | None = None) -> DataFrame:
    """(feature, kind, n): missing and unexpected columns, values that do not cast to the wanted type, out of bounds, nulls."""
    spark, rows = df.sparkSession, []
    rows += [(f, "missing", None) for f in profile if f not in df.columns and not allow_missing]
    rows += [(f, "unexpected", None) for f in df.columns if f not in profile]
    kinds, counts = dict(df.dtypes), []
    for f, a in profile.items():
        if f not in kinds:
            continue
        c = F.col(f)
        want = (types or {}).get(f, a.original)
        value = c.try_cast(want) if kinds[f] != want else c
        if kinds[f] != want:
            counts.append(((f, "type"), F.count_if(c.isNotNull() & value.isNull())))
        if a.allowed:
            counts.append(((f, "allowed"), F.count_if(c.isNotNull() & ~c.isin(a.allowed))))
        elif a.type == "continuous" and a.min is not None and a.data_type in ("number", "formatted_date_time"):
            low, high = (F.lit(x).cast("double" if a.data_type == "number" else want) for x in (a.min, a.max))
            counts.append(((f, "bounds"), F.count_if((value < low) | (value > high))))
        if not a.allow_null:
            counts.append(((f, "null"), F.count_if(c.isNull())))
    if counts:
        got = df.agg(*(x.alias(f"c{i}") for i, (_, x) in enumerate(counts))).first()
        rows += [(f, kind, got[f"c{i}"]) for i, ((f, kind), _) in enumerate(counts) if got[f"c{i}"]]
    return spark.createDataFrame(rows, "feature string, kind string, n bigint")


def coerce(df: DataFrame, profile: dict[str, Attributes], time_zone: str | None = None) -> DataFrame:
    """Columns cast to their profile's type, what does not cast becomes null; zoned times go to UTC."""
    kinds = dict(df.dtypes)

    def one(f: str) -> Column:
        if f not in profile:
            return F.col(f)
        c = F.col(f).try_cast(profile[f].original)
        zone = profile[f].time_zone or time_zone
        if zone and profile[f].original.startswith("timestamp") and kinds[f] != "timestamp":
            c = F.to_utc_timestamp(c.cast("timestamp"), zone)
        return c.alias(f)

    return df.select(*(one(f) for f in df.columns))


def check(df: DataFrame, profile: dict[str, Attributes], **options) -> None:
    """Raises with all violations."""
    bad = violations(df, profile, **options).collect()
    if bad:
        raise ValueError("; ".join(f"{r.feature}: {r.kind}" + (f" ({r.n})" if r.n else "") for r in bad))


def name_check(actual: list[str], expected: list[str]) -> tuple[list[str], list[str]]:
    """(missing, extra)."""
    return [x for x in expected if x not in actual], [x for x in actual if x not in expected]


def substitute(df: DataFrame, feature: str, values: dict, inverse: bool = False) -> DataFrame:
    """Nominal values replaced by their substitutes (or back), others as they are."""
    pairs = {v: k for k, v in values.items()} if inverse else values
    table = F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))
    return df.withColumn(feature, F.coalesce(F.try_element_at(table, F.col(feature)), F.col(feature)))


def unexpected_values(df: DataFrame, feature: str, allowed: DataFrame) -> DataFrame:
    """Distinct values that are not in the one column of `allowed`."""
    known = allowed.select(F.col(allowed.columns[0]).alias(feature))
    return df.select(feature).dropna().distinct().join(known, feature, "left_anti")


def first_per(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("__r = 1").drop("__r")


def invalid_features(profile: dict[str, Attributes], extended: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(feature, reason) of attributes that cannot be: an unknown or missing type (`extended` names further ones), an ordinal without values, a cycle of no length or of a feature that is not
    continuous, bounds that cross, a dependency on an unknown feature."""
    out = []
    for n, a in profile.items():
        if a.type not in ("nominal", "ordinal", "continuous", *extended):
            out.append((n, f"type {a.type}"))
        if a.type == "ordinal" and not a.allowed:
            out.append((n, "ordinal without values"))
        if a.cycle_length is not None and (a.cycle_length <= 0 or a.type != "continuous"):
            out.append((n, "cycle"))
        if a.type == "continuous" and isinstance(a.min, (int, float)) and isinstance(a.max, (int, float)) and a.min > a.max:
            out.append((n, "bounds"))
        out += [(n, f"depends on {d}") for d in a.dependent or () if d not in profile]
    return out
