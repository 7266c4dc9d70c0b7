"""Functional dependencies and the hierarchy of keys that they form."""

from __future__ import annotations

import warnings
from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Cells of a sketch as a power of two (a standard error of 1.6 %), the excess at which a pair is ruled out, and sketches of one pass.
LG_CELLS, TOLERANCE, SKETCHES = 12, 0.35, 400


def distinct_sizes(df: DataFrame, columns: list[str], pairs: list[tuple[str, str]] = ()) -> dict:
    """Exact distinct counts of columns and of pairs (null is a value), from one unpivoted pass: a set of (name, hash) rows."""
    items = [F.struct(F.lit(c).alias("k"), F.xxhash64(F.lit(1), F.coalesce(F.col(c).cast("string"), F.lit("\0null"))).alias("h"), F.coalesce(F.col(c).cast("string"), F.lit("\0null")).alias("v")) for c in columns]
    items += [
        F.struct(F.lit(f"{a}\0{b}").alias("k"), F.xxhash64(F.coalesce(F.col(a).cast("string"), F.lit("\0null")), F.coalesce(F.col(b).cast("string"), F.lit("\0null"))).alias("h"), F.lit(None).cast("string").alias("v"))
        for a, b in pairs
    ]
    got = df.select(F.explode(F.array(*items)).alias("x")).select("x.*").distinct().groupBy("k").agg(F.count("*").alias("n")).collect()
    return {tuple(r.k.split("\0")) if "\0" in r.k else r.k: r.n for r in got}


def _value(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("\0null"))


def sketches(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(a, b, sketch): a distinct-count sketch of every column (b empty) and every pair of columns, from one pass over rows that stay rows.

    A few kilobytes a pair, whatever the number of rows. Sketches of parts of a table are merged by `merged`, so they can be kept with the parts.
    """
    columns = columns or df.columns
    pairs = [(a, "") for a in columns] + list(combinations(columns, 2))
    out = []
    for at in range(0, len(pairs), SKETCHES):
        some = pairs[at : at + SKETCHES]
        one = df.agg(*(F.hll_sketch_agg(F.xxhash64(_value(a), *([_value(b)] if b else [])), LG_CELLS).alias(f"s{i}") for i, (a, b) in enumerate(some)))
        out.append(one.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"s{i}").alias("sketch")) for i, (a, b) in enumerate(some))))))
    return reduce(DataFrame.union, out)


def merged(states: list[DataFrame]) -> DataFrame:
    """Sketches of the union of what `states` are sketches of."""
    return reduce(DataFrame.union, states).groupBy("a", "b").agg(F.hll_union_agg("sketch").alias("sketch"))


def candidates(state: DataFrame) -> list[tuple[str, str]]:
    """(k, x) that the sketches do not rule out: pairs with more than `TOLERANCE` more values than k, over ten standard errors of both, cannot be determined by k."""
    rows = state.select("a", "b", F.hll_sketch_estimate("sketch").alias("n")).collect()  # a row per pair of columns
    n = {(r.a, r.b): r.n for r in rows}
    columns = [r.a for r in rows if not r.b]
    pair = lambda k, x: n[k, x] if (k, x) in n else n[x, k]
    return [(k, x) for k, x in permutations(columns, 2) if max(pair(k, x), n[x, ""]) <= n[k, ""] * (1 + TOLERANCE)]


def holding(df: DataFrame, pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Those of `pairs` (k, x) that hold, exactly: one grouping for each k, in which the least and the greatest value of every x are compared."""
    if not pairs:
        return []
    by: dict[str, list[str]] = {}
    for k, x in pairs:
        by.setdefault(k, []).append(x)
    out = []
    for k, owned in by.items():
        ends = [(F.min(_value(x)) == F.max(_value(x))).alias(f"x{i}") for i, x in enumerate(owned)]
        one = df.groupBy(_value(k).alias("k")).agg(*ends).agg(*(F.min(f"x{i}").alias(f"x{i}") for i in range(len(owned))))
        out.append(one.select(F.inline(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(x).alias("x"), F.col(f"x{i}").alias("holds")) for i, x in enumerate(owned))))))
    held = {(r.k, r.x) for r in reduce(DataFrame.union, out).collect() if r.holds is not False}
    return [p for p in pairs if p in held]


def dependencies(df: DataFrame, columns: list[str] | None = None, sizes: dict | None = None, state: DataFrame | None = None) -> list[tuple[str, str]]:
    """(k, x) for which every value of k has one value of x (null is a value). `state`: sketches of the table, made where they are not given; only pairs that they
    and the `sizes` leave open are compared. In an empty table every pair holds."""
    columns = columns or df.columns
    if len(columns) < 2:
        return []
    open_pairs = [(k, x) for k, x in candidates(sketches(df, columns) if state is None else state) if k in columns and x in columns]
    return holding(df, [(k, x) for k, x in open_pairs if sizes is None or sizes[x] <= sizes[k]])


def hierarchy(found: list[tuple[str, str]], sizes: dict, keys: list[str], floor: int = 2) -> list[tuple[list[str], set[str]]]:
    """Levels (keys, columns that they fix, themselves among them), the outermost, which fixes least, first.

    Columns of one value take no part; keys that fix the same columns share a level; a level that is not within the next one
    is reported: the table is no strict tree then.
    """
    keys = [k for k in keys if sizes[k] >= floor]
    levels: dict[frozenset, list[str]] = {}
    for k in keys:
        own = frozenset(x for a, x in found if a == k and sizes[x] > 1) | {k}
        if len(own) > 1:
            levels.setdefault(own, []).append(k)
    out = [(sorted(levels[own]), set(own)) for own in sorted(levels, key=len)]
    for upper, lower in zip(out, out[1:], strict=False):
        if not upper[1] < lower[1]:
            warnings.warn(f"{upper[0]} is not above {lower[0]}", stacklevel=2)
    return out


def chain(levels: list[tuple[list[str], set[str]]]) -> dict[str, list[str]]:
    """Key to the columns that it owns, the innermost level first: what it fixes less what the level above it does."""
    above: set[str] = set()
    rows = []
    for keys, own in levels:
        rows.append((keys[0], sorted(own - above - {keys[0]})))
        above = own
    return dict(reversed(rows))


def nested(levels: list[tuple[list[str], set[str]]]) -> dict:
    """The chain as a tree, the outermost key at the top."""
    tree: dict = {}
    for key, columns in chain(levels).items():  # from the inside out
        tree = {key: {"columns": columns, **({"inner": tree} if tree else {})}}
    return tree


def discover(df: DataFrame, keys: list[str], floor: int = 2) -> dict[str, list[str]]:
    """The fanout chain of a table."""
    sizes = distinct_sizes(df, df.columns)
    columns = [c for c in df.columns if sizes[c] > 1]
    return chain(hierarchy(dependencies(df, columns, sizes), sizes, [k for k in keys if k in columns], floor))


def fanout_on(found: dict[str, list[str]]) -> dict[str, list[str]]:
    """Feature to the keys on which its values are fanned out."""
    return {f: [k] for k, owned in found.items() for f in owned}


def once_per_key(near: DataFrame, key: str) -> DataFrame:
    """Neighbours of which only the nearest per value of the key counts."""
    order = W.partitionBy("query_id", key).orderBy("rank")
    return near.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


class Incremental:
    """Dependencies over batches; discovery ends when `stable` batches in a row change nothing or `most` rows are seen.

    Each batch leaves its sketches and its distinct rows as one more part; nothing is rewritten. A pair that failed once has failed for good, so only
    pairs that held so far, or that no batch has refuted, are compared over all parts.
    """

    def __init__(self, columns: list[str], stable: int = 2, most: int = 10_000_000):
        self.columns, self.stable, self.most = columns, stable, most
        self.parts: list[DataFrame] = []
        self.states: list[DataFrame] = []
        self.same, self.before, self.rows = 0, None, 0

    def add(self, batch: DataFrame) -> bool:
        """True once the dependencies have converged."""
        from ..plans.storage import written

        part = written(batch.select(*self.columns).distinct(), "fanout")
        self.parts.append(part)
        self.states.append(written(sketches(part, self.columns), "fanout-sketches"))
        self.rows += batch.count()
        own = holding(part, list(self.before) if self.before is not None else list(permutations(self.columns, 2)))
        allowed = set(candidates(merged(self.states))) & set(own)
        now = set(holding(reduce(DataFrame.unionByName, self.parts), sorted(allowed)))
        self.same = self.same + 1 if now == self.before else 0
        self.before = now
        return self.same >= self.stable or self.rows >= self.most

    def result(self) -> list[tuple[str, str]]:
        return sorted(self.before or ())
