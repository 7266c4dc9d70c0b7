"""Mixing sources to target weights by min-cost flow over membership patterns (operator 6).

Documents are aggregated by membership pattern (the set of sources that they belong to). A small flow network routes the
tokens of the patterns to the quotas of the sources; the first copy of a token is free and every further copy costs
one more, so repetition is convex and is spread before it is deepened. Documents are then selected in a seeded order,
pattern by pattern, with prefix sums over hash buckets, so no task holds a whole pattern.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import stash, table, words

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_COPIES = 2
SEED = "mix-7:"
#: Documents by which a selection is adjusted after the seeded prefix.
ROUNDS = 4
#: The flow network is solved on the driver; more patterns than this are refused, never dropped.
MAX_PATTERNS = 20_000
#: Documents that one task orders at a time, about; no result depends on it.
BUCKET_ROWS = 100_000


def water_fill(sizes: dict, weights: dict, total: float, copies: int = MAX_COPIES) -> dict:
    """Targets by weight that sum to `total`, none above `copies` times its source's size.

    The excess of capped sources is shared again by weight until none is above: sources are capped in the order of
    cap per weight while their cap is below what the rest would give them.
    """
    order = sorted(sizes, key=lambda s: (copies * sizes[s] / weights[s], s is None, s or ""))
    capped, weight = 0, sum(weights.values())
    targets = {}
    for i, s in enumerate(order):
        level = (total - capped) / weight
        if copies * sizes[s] > level * weights[s]:
            targets |= {r: level * weights[r] for r in order[i:]}
            break
        targets[s] = float(copies * sizes[s])
        capped += copies * sizes[s]
        weight -= weights[s]
    return targets


def route(patterns: dict[tuple, int], quotas: dict, copies: int = MAX_COPIES) -> dict[tuple, list[int]]:
    """Tokens that each pattern gives in its first, second, ... copy, by successive shortest paths.

    `patterns`: tokens by tuple of sources; `quotas`: tokens wanted by source.
    """
    arcs: list[list[int]] = []  # [to, capacity left, cost]; arc i and i ^ 1 are a pair
    out: dict = {}

    def arc(a, b, capacity, cost):
        for x, y, c, p in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out.setdefault(x, []).append(len(arcs))
            arcs.append([y, c, p])

    layers = {}
    for p, tokens in patterns.items():
        layers[p] = []
        for copy in range(copies):
            layers[p].append(len(arcs))
            arc("from", ("pattern", p), tokens, copy)
        for s in p:
            arc(("pattern", p), ("source", s), copies * tokens, 0)
    for s, wanted in quotas.items():
        arc(("source", s), "to", wanted, 0)
    while True:
        cost, via, queue, queued = {"from": 0}, {}, deque(["from"]), {"from"}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for i in out.get(x, ()):
                y, left, price = arcs[i]
                if left > 0 and cost[x] + price < cost.get(y, 1 << 60):
                    cost[y], via[y] = cost[x] + price, i
                    if y not in queued:
                        queue.append(y)
                        queued.add(y)
        if "to" not in via:
            return {p: [arcs[i ^ 1][1] for i in own] for p, own in layers.items()}
        path, y = [], "to"
        while y != "from":
            path.append(via[y])
            y = arcs[via[y] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount


def seeded(doc_id: Column, seed: str = SEED) -> Column:
    """The place of a document in the seeded order, as a string."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))


def select(sized: DataFrame, given: DataFrame, copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """`sized` (doc_id, size, pattern, ...) with `taken`: whole documents in seeded order while they fit what `given` (pattern,
    give: array by copy) lets each copy take; then, `ROUNDS` times, one document is added (or taken out, where
    too much is in) whose size comes closest to the rest. With `layers` and `prefix` (arrays by copy: whether it is in, whether it was before
    the adjustment) and `__h`, its place in the order.

    A round keeps one row per pattern: what is left of each copy, and the few places that were turned so far. It meets the
    documents in one broadcast join (patterns are at most `MAX_PATTERNS`), so rounds do not build on each other's plans.
    """
    df = sized.withColumn("__h", seeded(F.col("doc_id"), seed))
    df = df.withColumn("__b", F.substring("__h", 1, _bucket_digits(sized.count())))
    sums = df.groupBy("pattern", "__b").agg(F.sum("size").alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(W.partitionBy("pattern").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("pattern").alias("__p"), F.col("__b").alias("__c"), before.alias("__before"))
    # the documents, in a file that holds each pattern once, are taken for smaller than the sums and would be broadcast
    df = df.hint("merge").join(sums, df["pattern"].eqNullSafe(sums["__p"]) & (df["__b"] == sums["__c"]))
    inside = W.partitionBy("pattern", "__b").orderBy("__h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    df = df.withColumn("__end", F.col("__before") + F.sum("size").over(inside))
    df = stash(df.select(*sized.columns, "__h", "__end"), "mixing-order")

    def placed(state: DataFrame) -> DataFrame:
        """The documents with `__in`: whether each copy takes them, given the places turned so far."""
        state = state.withColumnRenamed("pattern", "__p")
        now = df.join(F.broadcast(state), df["pattern"].eqNullSafe(state["__p"])).drop("__p")
        prefix = [F.col("__end") <= F.col("give")[i] for i in range(copies)]
        # a document without words shares its place with the one before and is never turned
        turned = [(F.col("size") > 0) & F.array_contains(F.col("turned")[i], F.col("__end")) for i in range(copies)]
        return now.withColumn("prefix", F.array(*prefix)).withColumn("__in", F.array(*(a != b for a, b in zip(prefix, turned, strict=True))))

    none = F.array(*(F.array().cast("array<bigint>") for _ in range(copies)))
    state = given.select("pattern", "give", none.alias("turned"))
    sums = placed(state).groupBy("pattern").agg(*(F.coalesce(F.sum(F.when(F.col("__in")[i], F.col("size"))), F.lit(0)).alias(f"__s{i}") for i in range(copies)))
    sums = sums.withColumnRenamed("pattern", "__p")
    state = state.join(sums, state["pattern"].eqNullSafe(sums["__p"]))
    state = stash(state.select("pattern", "give", "turned", F.array(*(F.col("give")[i] - F.col(f"__s{i}") for i in range(copies))).alias("left")), "mixing-left")
    for _ in range(ROUNDS):
        now, best = placed(state), []
        for i in range(copies):
            r, taken = F.col("left")[i], F.col("__in")[i]
            off = F.abs(F.col("size") - F.abs(r))
            may = (F.col("size") > 0) & (off < F.abs(r)) & F.when(r > 0, ~taken).otherwise(taken)
            best.append(F.min(F.when(may, F.struct(off.alias("off"), F.col("__end").alias("end"), F.col("size").alias("size")))).alias(f"__x{i}"))
        found = now.groupBy("pattern").agg(*best).withColumnRenamed("pattern", "__p")
        state = state.join(found, state["pattern"].eqNullSafe(found["__p"]))
        # a place that is turned twice is as it was
        ends = [F.array_compact(F.array(F.col(f"__x{i}")["end"])) for i in range(copies)]
        turned = [F.concat(F.array_except(F.col("turned")[i], ends[i]), F.array_except(ends[i], F.col("turned")[i])) for i in range(copies)]
        moved = [F.coalesce(F.when(F.col("left")[i] > 0, F.col(f"__x{i}")["size"]).otherwise(-F.col(f"__x{i}")["size"]), F.lit(0)) for i in range(copies)]
        left = [F.col("left")[i] - moved[i] for i in range(copies)]
        state = stash(state.select("pattern", "give", F.array(*turned).alias("turned"), F.array(*left).alias("left")), "mixing-left")
    taken = sum((F.when(F.col("__in")[i], F.col("size")).otherwise(F.lit(0)) for i in range(copies)), F.lit(0))
    return placed(state).select(*sized.columns, taken.cast("long").alias("taken"), F.col("__in").alias("layers"), "prefix", "__h")


def _bucket_digits(rows: int) -> int:
    """Hexadecimal digits of the order that make a bucket: about `BUCKET_ROWS` documents in each, 4,096 buckets at least."""
    digits = 3
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def rules(selection: DataFrame, copies: int = MAX_COPIES) -> DataFrame:
    """A selection as one row per pattern: for each copy, the last place of its prefix (cut) and the few places that the adjustment turned."""
    h = F.col("__h")
    cuts = stash(selection.groupBy("pattern").agg(F.array(*(F.max(F.when(F.col("prefix")[i], h)) for i in range(copies))).alias("cut")), "mixing-cuts")
    known = cuts.select(F.col("pattern").alias("__p"), "cut")
    df = selection.join(F.broadcast(known), selection["pattern"].eqNullSafe(known["__p"])).drop("__p")
    beyond = [F.coalesce(h > F.col("cut")[i], F.lit(True)) for i in range(copies)]
    turned = [(F.col("prefix")[i] & ~F.col("layers")[i]) | (beyond[i] & F.col("layers")[i]) for i in range(copies)]
    return df.groupBy("pattern").agg(F.max("cut").alias("cut"), F.array(*(F.collect_set(F.when(turned[i], h)) for i in range(copies))).alias("turned"))


def mix(spark: SparkSession, sized: DataFrame, weights, share_percent: int = SHARE_PERCENT, copies: int = MAX_COPIES, seed: str = SEED) -> tuple[DataFrame, dict, dict]:
    """(selection, sizes by source, targets by source). `sized`: doc_id, size (long), sources (array of names, null among them).

    `weights`: called with the sources in order, gives a weight for each. A document of several sources counts towards the
    size of each; its tokens are routed to the quotas that they serve best. Empty tables give an empty selection.
    Broadcast tables have one row per membership pattern, of which there are at most `MAX_PATTERNS` (checked).
    """
    sized = sized.withColumn("pattern", F.array_sort(F.array_distinct("sources"))).drop("sources")
    per = sized.groupBy("pattern").agg(F.sum("size").alias("tokens")).limit(MAX_PATTERNS + 1).collect()
    if len(per) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r.pattern): int(r.tokens) for r in per}
    sizes: dict = {}
    for p, tokens in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + tokens
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    share = weights(names)
    targets = water_fill(sizes, share, share_percent * sum(patterns.values()) / 100, copies)
    flow = route(patterns, {s: int(targets[s] + 0.5) for s in names}, copies)
    kinds = pa.schema([("pattern", pa.list_(pa.string())), ("give", pa.list_(pa.int64()))])
    given = spark.createDataFrame(pa.Table.from_pylist([{"pattern": list(p), "give": give} for p, give in flow.items()], kinds))
    return select(sized, given, copies, seed), sizes, targets


def by_rank(names: list) -> dict:
    return {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of `docs` (doc_id, text, source): one source per document, null being one."""
    spark = docs.sparkSession
    got, sizes, targets = mix(spark, sizes_of(docs), by_rank)
    kinds = pa.schema([("__q", pa.list_(pa.string())), ("source_size", pa.int64()), ("target", pa.float64())])
    own = spark.createDataFrame(pa.Table.from_pylist([{"__q": [s], "source_size": sizes[s], "target": round(targets[s], 6)} for s in sizes], kinds))
    got = got.join(F.broadcast(own), got["pattern"].eqNullSafe(own["__q"]))
    return got.select("doc_id", "size", "source_size", "target", "taken")


def pattern_of(source: Column) -> Column:
    return F.array(source.cast("string"))


def sizes_of(docs: DataFrame) -> DataFrame:
    return stash(docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("size"), pattern_of(F.col("source")).alias("sources")), "mixing-sizes")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with `copies`, the number of times that each is taken; repeated rows are taken together.

    A document without words adds nothing to any source and is left out. A column `copies` of `docs` is replaced; other extra columns
    stay. The selection comes back as a rule by source (checked to be few), so no text is shuffled.
    """
    got, _, _ = mix(spark, sizes_of(docs), by_rank)
    rule = stash(rules(got), "mixing-rules").select(F.col("pattern").alias("__p"), F.col("cut").alias("__cut"), F.col("turned").alias("__turned"))
    df = docs.join(F.broadcast(rule), pattern_of(docs["source"]).eqNullSafe(rule["__p"]))
    h = seeded(docs["doc_id"])
    within = [F.coalesce(h <= rule["__cut"][i], F.lit(False)) != F.array_contains(rule["__turned"][i], h) for i in range(MAX_COPIES)]
    copies = sum((x.cast("int") for x in within), F.lit(0))
    df = df.where((copies > 0) & docs["text"].rlike(r"[^\x20\x09-\x0D]"))
    return df.select(*(docs[c] for c in docs.columns if c.lower() != "copies"), copies.alias("copies"))


_BASE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
o AS (SELECT *, CAST(2 * n AS DOUBLE) / weight AS ratio FROM w),
c AS (
  SELECT *, (SELECT CAST(150 * sum(n) AS DOUBLE) / 100 FROM s) AS total,
         coalesce(sum(2 * n) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight,
         row_number() OVER (ORDER BY ratio, source NULLS LAST) AS r
  FROM o),
e AS (SELECT *, (total - CAST(capped AS DOUBLE)) / CAST(left_weight AS DOUBLE) AS level FROM c),
f AS (SELECT min(r) AS r FROM e WHERE 2 * n > level * weight),
t AS (
  SELECT e.source, e.n, CASE WHEN f.r IS NULL OR e.r < f.r THEN CAST(2 * e.n AS DOUBLE) ELSE (SELECT level FROM e AS y WHERE y.r = f.r) * e.weight END AS target
  FROM e, f),
g AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM t),
p AS (
  SELECT d.*, g.n, g.target, least(goal, g.n) AS g1, greatest(goal - g.n, 0) AS g2,
         sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS e
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
r AS (
  SELECT source, max(g1) - coalesce(sum(size) FILTER (e <= g1), 0) AS r1, max(g2) - coalesce(sum(size) FILTER (e <= g2), 0) AS r2
  FROM p GROUP BY source),
q0 AS (SELECT p.*, e <= g1 AS in1, e <= g2 AS in2, r1, r2 FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source)
"""


def _round(i: int) -> str:
    """One adjustment, as SQL."""
    best, turn, rest = [], [], []
    for k in (1, 2):
        may = f"size > 0 AND abs(size - abs(r{k})) < abs(r{k}) AND CASE WHEN r{k} > 0 THEN NOT in{k} ELSE in{k} END"
        best.append(f"min({{'a': abs(size - abs(r{k})), 'e': e, 's': size}}) FILTER ({may}) AS x{k}")
        turn.append(f"in{k} <> coalesce(size > 0 AND e = x{k}.e, false) AS in{k}")
        rest.append(f"r{k} - coalesce(CASE WHEN r{k} > 0 THEN x{k}.s ELSE -x{k}.s END, 0) AS r{k}")
    return f""",
x{i} AS (SELECT source, {", ".join(best)} FROM q{i} GROUP BY source),
q{i + 1} AS (
  SELECT doc_id, q.source, size, n, target, e, {", ".join(turn + rest)}
  FROM q{i} AS q JOIN x{i} AS x ON q.source IS NOT DISTINCT FROM x.source)"""


SQL = (
    _BASE.rstrip()
    + "".join(_round(i) for i in range(ROUNDS))
    + f"""
SELECT doc_id, size, n AS source_size, round(target, 6) AS target,
       CAST(CASE WHEN in1 THEN size ELSE 0 END + CASE WHEN in2 THEN size ELSE 0 END AS BIGINT) AS taken
FROM q{ROUNDS}
"""
)
