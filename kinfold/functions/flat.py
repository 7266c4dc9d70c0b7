"""Semi-structured values: JSON flattened to paths, and distances between such values."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def _flat(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import json

    def walk(x, path: str, out: list[str]) -> None:
        if isinstance(x, dict):
            for k, v in x.items():
                walk(v, f"{path}.{k}", out)
        elif isinstance(x, list):
            for v in x:
                walk(v, f"{path}[]", out)
        else:
            out.append(f"{path}={json.dumps(x)}")

    for s in batches:
        got = []
        for text in s:
            out: list[str] = []
            try:
                walk(json.loads(text), "$", out)
            except (TypeError, ValueError):
                out = [] if text is None else [f"$={w}" for w in str(text).split()]
            got.append(sorted(set(out)))
        yield pd.Series(got)


def paths(c: Column) -> Column:
    """Sorted distinct `path=value` strings of a JSON text; of a text that is no JSON its words; empty for null."""
    return F.pandas_udf(_flat, ArrayType(StringType()))(c)


def jaccard(a: Column, b: Column) -> Column:
    """1 - shared paths / all paths of two arrays; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(1.0 - F.size(F.array_intersect(a, b)) / union)


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over the longer length."""
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / most)
