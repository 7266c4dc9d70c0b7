"""Merkle manifest of a table, with proofs by octopus multiproofs (operator 13).

A row is a leaf: the SHA-256 of its fields with their lengths. The leaves of a language, by doc_id, are the base of a tree in which every
`ARITY` neighbours become one node; the subroots of the languages, in order, are the base of one more tree, whose root names the data.

For proofs the leaves lie in ranges. A range works out the least set of nodes that its own leaves cannot give it, fetches them in one join, derives
the nodes that its leaves share once, and takes the proof of each leaf from them. So what is fetched for a range grows with the height of the tree, not with
the leaves. Digests travel as 32 bytes; texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import stash, table

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves of a range, and levels that one task builds over neighbouring nodes (8 ** 4 = 4,096 of them).
RANGE_ROWS = 1 << 15
LEVELS = 4
#: The tree over the subroots.
TOP = -1

_NODES = "tree bigint, level int, idx bigint, n bigint, hash binary"


class Manifest(NamedTuple):
    """Leaves (doc_id, leaf, other, tree, trees, idx, n, part), inner nodes (tree, level, idx, n, hash), trees (group, tree, n)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def _field(c: Column) -> Column:
    """`-` for a null, else the number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def _parent(digests: list[bytes]) -> bytes:
    return sha256(b"".join(digests).hex().encode()).digest()


def height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _placed(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """`df` with idx, its place within the group by `order`, n, the size of the group, and part, the range that it lies in.

    Ranges are sorted where they lie; only the first row and the count of each group in each range are brought together.
    """
    ranges = max(1, ceil(df.count() / RANGE_ROWS))
    keys = [*group, *order]
    ranged = df.repartitionByRange(ranges, *keys) if ranges > 1 else df.coalesce(1)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = stash(ranged.sortWithinPartitions(*keys).select("*", F.spark_partition_id().alias("part"), at.alias("__at")), label)
    here = ranged.groupBy("part", *group).agg(F.min("__at").alias("__lo"), F.count("*").alias("__here"))
    own = W.partitionBy(*(group or [F.lit(0)]))
    before = F.coalesce(F.sum("__here").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    here = here.select(F.col("part").alias("__part"), *(F.col(g).alias("__" + g) for g in group), "__lo", before.alias("__before"), F.sum("__here").over(own).alias("n"))
    same = F.col("part") == F.col("__part")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col("__" + g))
    idx = (F.col("__at") - F.col("__lo") + F.col("__before")).alias("idx")
    return ranged.join(here, same).select(*df.columns, "part", idx, "n")


def _inner(base: DataFrame, highest: int, label: str) -> DataFrame | None:
    """Nodes above `base` (tree, level, idx, n, hash), where n counts the nodes of the tree at level 0; none if no tree has two leaves."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        tree, n, level = int(pdf["tree"].iloc[0]), int(pdf["n"].iloc[0]), int(pdf["level"].iloc[0])
        start, now, out = int(pdf["idx"].iloc[0]), list(pdf["hash"]), []
        top = height(n)
        for up in range(level + 1, min(level + LEVELS, top) + 1):
            now = [_parent(now[i : i + ARITY]) for i in range(0, len(now), ARITY)]
            start //= ARITY
            out += [(tree, up, start + i, n, h) for i, h in enumerate(now)]
        return pd.DataFrame(out, columns=["tree", "level", "idx", "n", "hash"])

    found = None
    for level in range(0, highest, LEVELS):
        block = F.floor(F.col("idx") / F.lit(ARITY**LEVELS)).alias("block")
        now = base.where(F.col("n") > ARITY**level).where(F.col("level") == level)
        base = stash(now.groupBy("tree", block).applyInPandas(build, _NODES), label)
        found = base if found is None else found.union(base)
    return found


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", other: Column | None = None) -> Manifest:
    """The trees of `docs`; `other` is the leaf of each row as someone else holds it (null: the same).

    Leaves of a group lie by `order` (null first; rows that tie, by their leaf), groups by their bytes, null first. Repeated rows are leaves of their own.
    Columns that are not in `fields` are ignored. An empty table has no tree.
    """
    other = F.lit(None).cast("binary") if other is None else other
    rows = docs.select(F.col(order).alias("key"), F.col(group).cast("string").alias("grp"), leaf([F.col(f) for f in fields]).alias("leaf"), other.alias("other"))
    rows = stash(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-hashes")
    placed = _placed(rows, ["grp"], ["key", "leaf", "row"], "merkle-leaves")
    trees = _placed(placed.groupBy("grp").agg(F.first("n").alias("size")), [], ["grp"], "merkle-trees")
    trees = stash(trees.select(F.col("grp").alias("of"), F.col("idx").alias("tree"), F.col("n").alias("trees"), "size"), "merkle-groups")
    leaves = placed.join(trees, F.col("grp").eqNullSafe(F.col("of"))).select("key", "grp", "leaf", "other", "tree", "trees", "idx", "n", "part")
    leaves = stash(leaves, "merkle-placed")
    most, n_trees = trees.agg(F.max("size"), F.max("trees")).first()
    base = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", F.col("leaf").alias("hash"))
    nodes = _inner(base, height(most or 0), "merkle-nodes")
    lone = base.where("n = 1").select("tree", "hash")
    roots = lone if nodes is None else lone.union(nodes.where("idx = 0").groupBy("tree").agg(F.max_by("hash", "level").alias("hash")))
    tops = stash(roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(n_trees or 0).cast("bigint").alias("n"), "hash"), "merkle-tops")
    above = _inner(tops, height(n_trees or 0), "merkle-above")
    for more in (nodes, above):
        tops = tops if more is None else tops.union(more)
    return Manifest(leaves, tops, trees)


def missing(at: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """By level, the least set of nodes that proofs of the leaves `at` (sorted, of n) need and those leaves do not give."""
    level = 0
    while n > 1:
        up = np.unique(at // ARITY)
        run = (up[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(run[run < n], at, assume_unique=True)
        at, n, level = up, -(-n // ARITY), level + 1


def _coordinates(pdf: pd.DataFrame) -> pd.DataFrame:
    part, trees = pdf["part"].iloc[0], int(pdf["trees"].iloc[0])
    found = [(tree, *x) for tree, own in pdf.groupby("tree") for x in missing(np.sort(own["idx"].to_numpy()), int(own["n"].iloc[0]))]
    found += [(TOP, *x) for x in missing(np.sort(pdf["tree"].unique()), trees)]
    found.append((TOP, height(trees), np.zeros(1, np.int64)))  # the root, to compare with
    frames = [pd.DataFrame({"part": part, "tree": tree, "level": level, "idx": idx}) for tree, level, idx in found if len(idx)]
    return pd.concat(frames, ignore_index=True)


def coordinates(asked: DataFrame) -> DataFrame:
    """(part, tree, level, idx): the nodes that each range of `asked` leaves has to fetch, each once."""
    return asked.select("part", "tree", "trees", "idx", "n").groupBy("part").applyInPandas(_coordinates, "part int, tree bigint, level int, idx bigint")


class _Range:
    """The proofs of one range of leaves, from its own leaves and what was fetched."""

    def __init__(self, fetched: pd.DataFrame):
        self.fetched = {(t, level, i): h.hex().encode() for t, level, i, h in zip(fetched["tree"], fetched["level"], fetched["idx"], fetched["hash"], strict=True)}

    def runs(self, tree: int, now: dict[int, bytes], n: int) -> tuple[list[dict[int, bytes]], bytes]:
        """The runs of siblings over the nodes `now`, by level and parent, and the root: every shared node is derived once."""
        levels = []
        while n > 1:
            level, runs = len(levels), {}
            for up in {i // ARITY for i in now}:
                members = range(up * ARITY, min(up * ARITY + ARITY, n))
                runs[up] = b"".join(now[i] if i in now else self.fetched[tree, level, i] for i in members)
            levels.append(runs)
            now, n = {up: sha256(run).hexdigest().encode() for up, run in runs.items()}, -(-n // ARITY)
        return levels, now[0]

    @staticmethod
    def paths(levels: list[dict[int, bytes]], asked: dict[int, bytes], beyond: tuple) -> dict[int, tuple]:
        """By leaf, ((left, right), rest): its siblings on both sides, and the same for its parent; `beyond` is the path of the tree's root."""
        wanted = [set(asked)]
        for _ in levels:
            wanted.append({i // ARITY for i in wanted[-1]})
        above = {0: beyond}
        for level in reversed(range(len(levels))):
            runs, here = levels[level], {}
            for i in wanted[level]:
                run, at = runs[i // ARITY], 64 * (i % ARITY)
                here[i] = ((run[:at], run[at + 64 :]), above[i // ARITY])
            above = here
        return above


def _fold(digest: bytes, path: tuple) -> bytes:
    while path:
        (left, right), path = path
        digest = sha256(left + digest + right).hexdigest().encode()
    return digest


def _siblings(path: tuple) -> Iterator[bytes]:
    while path:
        (left, right), path = path
        yield left
        yield right


_PROOFS = "key {id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(found: Manifest, asked: DataFrame | None = None, siblings: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of the `asked` leaves, rows of `found.leaves`; all if none are named.

    The proof holds the siblings on the way to the subroot and from there to the root, by level and from left to right; with `siblings` it is returned as an
    array of digests. folded_root is what `other` (the leaf itself where that is null) and the proof give.
    """
    asked = found.leaves if asked is None else asked
    wanted = stash(coordinates(asked), "merkle-wanted")
    base = found.leaves.select("tree", F.lit(0).alias("level"), "idx", F.col("leaf").alias("hash"))
    key = ["tree", "level", "idx"]
    low = wanted.where(f"level = 0 AND tree <> {TOP}").join(base, key)
    fetched = low.unionByName(wanted.where(f"level > 0 OR tree = {TOP}").join(found.nodes.drop("n"), key)).select("part", *key, "hash")

    def expand(leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        if not len(leaves):
            return pd.DataFrame(columns=columns)
        own, trees, out = _Range(fetched), {}, []
        for tree, rows in leaves.groupby("tree"):
            known = {i: h.hex().encode() for i, h in zip(rows["idx"], rows["leaf"], strict=True)}
            trees[tree] = (rows, known, *own.runs(tree, known, int(rows["n"].iloc[0])))
        width = int(leaves["trees"].iloc[0])
        top, root = own.runs(TOP, {t: x[3] for t, x in trees.items()}, width)
        if root != own.fetched[TOP, height(width), 0]:
            raise ValueError("the leaves and the nodes of the manifest disagree")
        tops = own.paths(top, {t: b"" for t in trees}, ())
        for tree, (rows, known, levels, subroot) in trees.items():
            paths = own.paths(levels, known, tops[tree])
            for key, i, other in zip(rows["key"], rows["idx"], rows["other"], strict=True):
                path = paths[i]
                folded = _fold(known[i] if other is None else other.hex().encode(), path)
                proof = b"".join(_siblings(path))
                row = (key, known[i].decode(), subroot.decode(), root.decode(), sha256(proof).hexdigest(), folded.decode(), folded == root)
                out.append((*row, [proof[j : j + 64].decode() for j in range(0, len(proof), 64)]) if siblings else row)
        got = pd.DataFrame(out, columns=columns)
        got["key"] = got["key"].astype(leaves["key"].dtype)
        return got

    kind = found.leaves.schema["key"].dataType.simpleString()
    schema = _PROOFS.format(id=kind) + (", siblings array<string>" if siblings else "")
    columns = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + ["siblings"] * siblings
    key_of_long = "bigint" in kind or "int" in kind
    own = asked.select("part", "tree", "trees", "idx", "n", F.col("key").cast("string").alias("key") if key_of_long else "key", "leaf", "other")
    schema = schema.replace(f"key {kind}", "key string", 1) if key_of_long else schema  # a null among whole numbers makes pandas use doubles
    got = own.groupBy("part").cogroup(fetched.groupBy("part")).applyInPandas(expand, schema)
    return got.withColumn("key", F.col("key").cast(kind))


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row whose text has lost its capitals A-Z, where 3 divides the crc32 of the decimal doc_id; null elsewhere."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(lowered))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return proofs(manifest(docs, other=tampered(docs))).withColumnRenamed("key", "doc_id")


_CRC = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(unicode(ch) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"""
_SQL_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_SQL_FIELD.format(text if f == "text" else f) for f in FIELDS) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('x' || lang, '') AS grp, {_sql_leaf("text")} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf(_LOWER)} END AS other FROM documents),
leaves AS (
  SELECT *, row_number() OVER (ORDER BY grp, doc_id, leaf) AS rid, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n FROM hashed),
tree AS (
  SELECT grp, 0 AS level, idx, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT grp, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY grp, level, idx // 8, n),
subroots AS (SELECT grp, hash, row_number() OVER (ORDER BY CAST(grp AS BLOB)) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, idx, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 8, n),
runs AS (SELECT grp, level, idx // 8 AS up, list(hash ORDER BY idx) AS hashes FROM tree WHERE n > 1 GROUP BY grp, level, idx // 8),
top_runs AS (SELECT level, idx // 8 AS up, list(hash ORDER BY idx) AS hashes FROM top WHERE n > 1 GROUP BY level, idx // 8),
walk AS (
  SELECT rid, grp, 0 AS level, idx, '' AS proof, coalesce(other, leaf) AS fold FROM leaves
  UNION ALL
  SELECT w.rid, w.grp, w.level + 1, w.idx // 8,
    w.proof || array_to_string(r.hashes[1 : w.idx % 8], '') || array_to_string(r.hashes[w.idx % 8 + 2 : 8], ''),
    sha256(array_to_string(r.hashes[1 : w.idx % 8], '') || w.fold || array_to_string(r.hashes[w.idx % 8 + 2 : 8], ''))
  FROM walk w JOIN runs r ON r.grp = w.grp AND r.level = w.level AND r.up = w.idx // 8),
ended AS (SELECT rid, grp, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold FROM walk GROUP BY rid, grp),
climb AS (
  SELECT e.rid, 0 AS level, s.idx, e.proof, e.fold FROM ended e JOIN subroots s USING (grp)
  UNION ALL
  SELECT w.rid, w.level + 1, w.idx // 8,
    w.proof || array_to_string(r.hashes[1 : w.idx % 8], '') || array_to_string(r.hashes[w.idx % 8 + 2 : 8], ''),
    sha256(array_to_string(r.hashes[1 : w.idx % 8], '') || w.fold || array_to_string(r.hashes[w.idx % 8 + 2 : 8], ''))
  FROM climb w JOIN top_runs r ON r.level = w.level AND r.up = w.idx // 8),
done AS (SELECT rid, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold FROM climb GROUP BY rid)
SELECT l.doc_id, l.leaf, s.hash AS subroot, t.hash AS root, sha256(d.proof) AS proof_sha256, d.fold AS folded_root, d.fold = t.hash AS verified
FROM leaves l JOIN done d USING (rid) JOIN subroots s USING (grp) CROSS JOIN (SELECT hash FROM top WHERE n = 1) t
"""
