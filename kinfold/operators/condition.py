"""Conditions on cases, compiled to column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compile_condition(condition: dict | None, types: dict[str, str] | None = None) -> Column:
    """A condition maps features to: None (is null), a scalar (equal), a list of strings (one of them), or a pair [low, high]
    (inclusive; None leaves a side open; [None, None]: is not null). For a feature that `types` calls nominal a list is
    always a set of values. All features must hold; an empty condition holds for every case."""
    types = types or {}

    def one(name: str, want) -> Column:
        c = F.col(name)
        if want is None:
            return c.isNull()
        if isinstance(want, (list, tuple)):
            if types.get(name) == "nominal" or any(isinstance(x, str) for x in want) and types.get(name) is None:
                plain = [x for x in want if x is not None]
                found = c.isin(plain)
                return found | c.isNull() if len(plain) < len(want) else found
            if len(want) != 2:
                raise ValueError(f"{name}: a range has two ends")
            low, high = want
            if low is None and high is None:
                return c.isNotNull()
            parts = ([c >= F.lit(low)] if low is not None else []) + ([c <= F.lit(high)] if high is not None else [])
            return reduce(lambda a, b: a & b, parts)
        return c == F.lit(want)

    return reduce(lambda a, b: a & b, (one(k, v) for k, v in (condition or {}).items()), F.lit(True))


def select_exact(df: DataFrame, condition: dict | None, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Cases for which the condition holds, the first `limit` in `order` if a limit is given."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    out = df.where(compile_condition(condition))
    return out if limit is None else out.orderBy(*(order or df.columns)).limit(limit)
