"""The exact top-k join without all pairs: Voronoi cells around pivots, pruned by the triangle inequality.

Every case belongs to the cell of its nearest pivot and keeps its distance r to it. A query at distance D from a pivot is at least
|D - r| away from a case of its cell, and at least half of what the pivot is farther than the query's own one. First a query meets the cells that may
hold its nearest cases, until they have more than k; its k-th distance there bounds all that follows: of the other cells it meets those
whose bound is not above, and in them only cases whose r is within that distance of D. Cells with many cases or queries are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.storage import written
from .knn import CASE_BLOCK, TILE, Metric, _arrays, _best, _Block, _prepared, _Rules, distances, fold

#: Most pivots: with their distances and cells they are broadcast, so this bounds the broadcast.
MOST_PIVOTS = 4096
#: Queries of a block of a cell, and of a tile, which shares one stretch of cases.
QUERY_BLOCK, QUERY_TILE = 20_000, 64
#: Rows, each a query with a cell that it meets, that a task hands on at once.
MEETINGS = 20_000
_FIELDS = ("__x", "__z", "__s", "__same", "__time")
_ARRAYS = "`__x` array<double>, `__z` array<bigint>, `__s` array<array<bigint>>, `__same` array<bigint>, `__time` double"


class Found(NamedTuple):
    """`near`: the rows of `knn`. `work`: one row (compared, to_pivots, all_pairs) of pairs of rows."""

    near: DataFrame
    work: DataFrame


def prunable(cases: DataFrame, metric: Metric, queries: DataFrame | None = None) -> bool:
    """Whether the distances obey the triangle inequality and are of a kind that cells hold: no trees, no learned differences between nominal values, weights not negative, and a null not nearer to the ends of
    a feature's range than half of it. Below 1, p stands for the sum of powers, which obeys it as well."""
    if any(f.table or f.tree or f.weight < 0 or f.deviation <= 0 for f in metric.features):
        return False
    plain = [f for f in metric.features if not f.nominal and not f.structured]
    if not plain:
        return True
    rows = [df.select(_arrays(df, metric)[0].alias("x")) for df in [cases] + ([queries] if queries is not None else [])]
    both = rows[0] if len(rows) == 1 else rows[0].union(rows[1])
    x = [F.nanvl(F.col("x")[i], F.lit(None)) for i in range(len(plain))]
    got = both.agg(*(F.struct(F.min(c), F.max(c), F.count(c), F.count("*")) for c in x)).first()
    for f, (lo, hi, known, n) in zip(plain, got, strict=True):
        if known < n and known and 2 * f.spread < (f.cycle / 2 if f.kind == "cyclic" and f.cycle else hi - lo):
            return False
    return True


class _Cells(NamedTuple):
    """Pivots and, by cell, the number of cases, the least and the greatest r (no case: never met), and the blocks of its cases and queries."""

    pivots: _Block
    n: np.ndarray
    near: np.ndarray
    far: np.ndarray
    blocks: np.ndarray


def _slices(block: _Block, step: int) -> Iterator[_Block]:
    for lo in range(0, len(block.ids), step):
        yield _Block(*(getattr(block, a)[lo : lo + step] for a in ("ids", "x", "z", "s", "same", "time")))


def _to_pivots(block: _Block, pivots: _Block, metric: Metric, rules: _Rules) -> np.ndarray:
    d = distances(block, pivots, metric, rules)
    return d if metric.p >= 1 else d**metric.p


def _bounds(d: np.ndarray, cells: _Cells) -> np.ndarray:
    """Least distances of a query at `d` from the pivots to the cases of every cell, less what rounding may add."""
    bound = np.maximum(np.maximum(d - cells.far, cells.near - d), (d - d.min(axis=1, keepdims=True)) / 2)
    bound -= 1e-9 * (d + np.where(np.isfinite(cells.far), cells.far, 0.0))
    return np.where(cells.n > 0, np.maximum(bound, 0.0), np.inf)


def _first(bound: np.ndarray, d: np.ndarray, cells: _Cells, least: int) -> np.ndarray:
    """Which cells a query meets first: in order of their bounds, until they hold `least` cases."""
    order = np.lexsort((d, bound), axis=1)
    held = np.cumsum(cells.n[order], axis=1)
    wanted = np.zeros(bound.shape, bool)
    before = np.concatenate((np.zeros((len(bound), 1)), held[:, :-1]), axis=1)
    np.put_along_axis(wanted, order, before < least, axis=1)
    return wanted & (cells.n > 0)


def search(
    queries: DataFrame,
    cases: DataFrame,
    metric: Metric,
    k: int,
    *,
    id_column: str = "id",
    carry: list[str] = (),
    differ: list[str] = (),
    agree: list[str] = (),
    not_later: str | None = None,
    self_too: bool = False,
    pivots: int | None = None,
    seed: int = 0,
) -> Found:
    """As `knn`, with its options: the same rows, and how many pairs were compared. The metric has to be `prunable`.

    `pivots`: by default the square root of the number of cases, at most `MOST_PIVOTS`; they are cases drawn by a hash of their ids. A query
    that finds fewer than k admissible cases in its first cells meets all others, so conditions that hold for few cases belong into a filter of the cases.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = queries.sparkSession
    carry = [c for c in carry if c != id_column]
    kind = {f.name: f.dataType.simpleString() for f in cases.schema}
    query_kind = queries.schema[id_column].dataType.simpleString()
    options = {"id_column": id_column, "differ": differ, "agree": agree, "not_later": not_later}
    q, c = _prepared(queries, metric, [], **options), _prepared(cases, metric, carry, **options)
    rules = _Rules(len(differ), len(agree), not_later is not None, self_too)
    n_cases = cases.count()
    most = min(MOST_PIVOTS, max(1, int(np.ceil(n_cases**0.5)) if pivots is None else pivots))
    drawn = c.select(id_column, *_FIELDS).orderBy(F.xxhash64(F.lit(seed), id_column), id_column).limit(most).toPandas()
    drawn = drawn.loc[~pd.Series([repr((list(x), list(z), str(s))) for x, z, s in zip(drawn["__x"], drawn["__z"], drawn["__s"], strict=True)]).duplicated().to_numpy()] if len(drawn) else drawn
    centres = _Block.of(drawn, id_column) if len(drawn) else None
    shared_pivots = spark.sparkContext.broadcast(centres)
    step = max(1, TILE // max(1, len(drawn)))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            cell, r = [np.zeros(0, np.int32)], [np.zeros(0)]
            for part in _slices(_Block.of(df, id_column), step) if len(df) else ():
                d = _to_pivots(part, shared_pivots.value, metric, rules)
                cell.append(d.argmin(axis=1).astype(np.int32))
                r.append(d.min(axis=1))
            yield df.assign(__cell=np.concatenate(cell), __r=np.concatenate(r))

    extra = "".join(f", `{n}` {kind[n]}" for n in carry)
    dealt = written(c.mapInPandas(assign, f"`{id_column}` {kind[id_column]}, {_ARRAYS}{extra}, `__cell` int, `__r` double"), "pruned-cells")
    summary = dealt.groupBy("__cell").agg(F.count("*").alias("n"), F.min("__r").alias("near"), F.max("__r").alias("far")).collect()  # a row per pivot
    size = len(drawn)
    n, near, far = np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf)
    for row in summary:
        n[row["__cell"]], near[row["__cell"]], far[row["__cell"]] = row.n, row.near, row.far
    shared = spark.sparkContext.broadcast(_Cells(centres, n, near, far, -(-n // CASE_BLOCK)))
    least = k + (0 if self_too else 1)

    def meeting(second: bool):
        """Queries, with `__tau` for the second round, to a row for each block of cases that they meet."""

        def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cells = shared.value
            for df in batches:
                if not len(df) or cells.pivots is None:
                    continue
                for lo, part in zip(range(0, len(df), step), _slices(_Block.of(df, id_column), step), strict=True):
                    d = _to_pivots(part, cells.pivots, metric, rules)
                    bound = _bounds(d, cells)
                    wanted = _first(bound, d, cells, least)
                    if second:
                        tau = df["__tau"].to_numpy(np.float64)[lo : lo + step, None]
                        wanted = (bound <= tau) & ~wanted & (cells.n > 0)
                    rows, to = np.nonzero(wanted)
                    times = cells.blocks[to]
                    rows, to = np.repeat(rows, times), np.repeat(to, times)
                    block = np.arange(len(to)) - np.repeat(np.cumsum(times) - times, times)
                    for at in range(0, len(to), MEETINGS):
                        some = slice(at, at + MEETINGS)
                        out = df.iloc[lo + rows[some]].assign(__cell=to[some].astype(np.int32), __block=block[some].astype(np.int32), __d=d[rows[some], to[some]])
                        yield out if second else out.assign(__tau=np.inf)

        return meet

    query_schema = f"`{id_column}` {query_kind}, {_ARRAYS}, `__tau` double, `__cell` int, `__block` int, `__d` double"
    schema = f"query_id {query_kind}, case_id {kind[id_column]}, distance double{extra}, pairs bigint"
    names = ["query_id", "case_id", "distance", *carry]

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """One block of queries of a cell with one block of its cases, both in the order of their distances to the pivot."""
        pairs, out = 0, []
        if len(left) and len(right):
            left, right = left.sort_values("__d"), right.sort_values("__r")
            r, d = right["__r"].to_numpy(), left["__d"].to_numpy()
            slack = 1e-9 * (d + r[-1])
            lo = np.searchsorted(r, d - left["__tau"].to_numpy() - slack, side="left")
            hi = np.searchsorted(r, d + left["__tau"].to_numpy() + slack, side="right")
            asked, held = _Block.of(left, id_column), _Block.of(right, id_column)
            for at in range(0, len(left), QUERY_TILE):
                a, b = int(lo[at : at + QUERY_TILE].min()), int(hi[at : at + QUERY_TILE].max())
                if a >= b:
                    continue
                part, some = next(_slices(_Block(*(getattr(asked, x)[at : at + QUERY_TILE] for x in _NAMES)), QUERY_TILE)), _Block(*(getattr(held, x)[a:b] for x in _NAMES))
                pairs += len(part.ids) * (b - a)
                for _, rows, cols, dist in _best(part, some, metric, rules, k):
                    out.append(pd.DataFrame({"query_id": part.ids[rows], "case_id": some.ids[cols], "distance": dist} | {x: right[x].to_numpy()[a + cols] for x in carry}))
        told = pd.concat(out, ignore_index=True) if any(map(len, out)) else pd.DataFrame({x: [None] for x in names})
        return told.assign(pairs=np.where(np.arange(len(told)) == 0, pairs, 0))  # the pairs stand in the first row, which names no case if none is near

    numbered = dealt.withColumn("__block", F.pmod(F.xxhash64(id_column), F.lit(1 << 30)))

    def round_of(asked: DataFrame, second: bool, label: str) -> DataFrame:
        sent = written(asked.mapInPandas(meeting(second), query_schema), label)
        crowds = {r["__cell"]: -(-r.n // QUERY_BLOCK) for r in sent.where("`__block` = 0").groupBy("__cell").agg(F.count("*").alias("n")).collect()}  # a row per pivot at most
        cells = [(i, int(b), int(crowds[i])) for i, b in enumerate(shared.value.blocks.tolist()) if crowds.get(i)]
        of = F.broadcast(spark.createDataFrame(cells, "`__cell` int, `__of` int, `__crowd` int"))  # at most MOST_PIVOTS rows
        left = sent.join(of, "__cell").withColumn("__part", F.pmod(F.xxhash64(F.lit(1), id_column), F.col("__crowd")).cast("int")).drop("__of", "__crowd")
        right = numbered.join(of, "__cell").withColumn("__block", (F.col("__block") % F.col("__of")).cast("int"))
        right = right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__crowd") - 1))).drop("__of", "__crowd")
        key = ["__cell", "__block", "__part"]
        return written(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, schema), label + "-found")

    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "case_id"))
    one = round_of(q, False, "pruned-first")
    kth = F.when(F.count("*") == k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("__tau")
    tau = one.where("case_id IS NOT NULL").withColumn("rank", rank).where(F.col("rank") <= k).groupBy(F.col("query_id").alias("__asked")).agg(kth)
    if metric.p < 1:
        tau = tau.withColumn("__tau", F.pow("__tau", F.lit(metric.p)))
    later = q.join(tau.hint("merge"), F.col(id_column) == F.col("__asked"), "left").drop("__asked").withColumn("__tau", F.coalesce("__tau", F.lit(float("inf"))))
    two = round_of(later.select(id_column, *_FIELDS, "__tau"), True, "pruned-second")
    both = one.union(two)
    near_rows = both.where("case_id IS NOT NULL").withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "case_id", "distance", "rank", *carry)
    n_queries = queries.count()
    work = both.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("compared")).select("compared", F.lit((2 * n_queries + n_cases) * size).alias("to_pivots"), F.lit(n_queries * n_cases).alias("all_pairs"))
    return Found(near_rows.hint("merge"), work)  # a row per query and neighbour: no join should broadcast it


def work_of_distinct(queries: DataFrame, cases: DataFrame, metric: Metric, k: int, *, id_column: str = "id") -> DataFrame:
    """The `work` of `search` where equal rows are searched once, as `knn` does it with large tables; all_pairs counts all rows."""
    few = [own.groupBy("__key").agg(F.min(id_column).alias("__id")).select(F.col("__id").alias("__who"), "__key.*") for own, _ in (fold(df, metric, [], id_column) for df in (queries, cases))]
    asked, held = (written(df, "pruned-distinct") for df in few)
    found = search(asked, held, fold(cases, metric, [], id_column)[1], k + 1, id_column="__who", self_too=True)
    return found.work.withColumn("all_pairs", F.lit(queries.count() * cases.count()))


_NAMES = ("ids", "x", "z", "s", "same", "time")


def knn_pruned(queries: DataFrame, cases: DataFrame, metric: Metric, k: int, **options) -> DataFrame:
    """(query_id, case_id, distance, rank, carried columns): `search` without its account of the work."""
    return search(queries, cases, metric, k, **options).near
