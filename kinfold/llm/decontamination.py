"""Benchmark decontamination by size-partitioned MinHash containment (operator 3, DataFrame functions only).

A test item is the set of its five-word shingles; one of fewer words is a single shingle, its whole sequence. Items are partitioned by
size (powers of two); the partition fixes the length of the bottom-k MinHash sketch: k is large enough that a document with at
least `CONTAINMENT_PERCENT` of any item of that size must hold some of the k least hashes of the item (at most n - ceil(0.8 n)
shingles may be missing), and how many it must hold at least is known for each item. Documents of any length are searched for
the sketches without a sketch of their own, whose resemblance to a short item would be too low to band. Candidates, which hold
as many as that, are verified by exact shingle containment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import keep_rows, stash, table

SHINGLE_WORDS = 5
CONTAINMENT_PERCENT = 80
#: A table of item shingles is broadcast up to this many rows (under 100 MB); beyond it Spark shuffles both sides.
MAX_BROADCAST_ROWS = 500_000
#: Words are runs of letters and digits of the lower-cased text.
BETWEEN = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _grams(ws: Column, k: int) -> Column:
    """The k-word n-grams of a text, repeats included: shifted copies of its words side by side."""
    n = F.greatest(F.size(ws) - k + 1, F.lit(0))
    return F.arrays_zip(*(F.slice(ws, i + 1, n) for i in range(k)))


def _hash(z: Column, k: int) -> Column:
    return F.xxhash64(*(z[str(i)] for i in range(k)))


def _joined(z: Column, k: int) -> Column:
    return F.concat_ws(" ", *(z[str(i)] for i in range(k)))


def _each(ws: Column, lengths: list[int], of: Callable[[Column, int], Column]) -> Column:
    """An array of `of` each n-gram of these lengths."""
    parts = [(lambda k: F.transform(_grams(ws, k), lambda z: of(z, k)))(k) for k in lengths]
    return F.flatten(F.array(*parts)) if len(parts) > 1 else parts[0]


def _texts_and_hashes(ws: Column, lengths: list[int]) -> Column:
    """An array of (h, shingle) of all n-grams of these lengths."""
    return _each(ws, lengths, lambda z, k: F.struct(_hash(z, k).alias("h"), _joined(z, k).alias("shingle")))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, words, shingle, h, n, partition, in_sketch, at_least): the distinct shingles of every item, of `words` words each.

    An item of one to four words has one shingle, the whole of it; without words it has none and matches nothing. Rows that share an
    item_id are one item. `at_least`: the shingles of the sketch that a document with enough of the item holds.
    """
    ws = items.select("item_id", _words(F.col("text")).alias("ws"))
    one = None
    for k in range(1, SHINGLE_WORDS + 1):
        own = ws.where(F.size("ws") >= k if k == SHINGLE_WORDS else F.size("ws") == k)
        own = own.select("item_id", F.lit(k).alias("words"), F.explode(_texts_and_hashes(F.col("ws"), [k])).alias("z")).select("item_id", "words", "z.shingle", "z.h")
        one = own if one is None else one.union(own)
    one = one.distinct()
    own = W.partitionBy("item_id")
    one = one.withColumn("n", F.count("*").over(own))
    may_lack = lambda n: n - F.ceil(n * CONTAINMENT_PERCENT / 100)
    k = may_lack(F.pow(F.lit(2), F.col("partition") + 1) - 1) + 1
    one = one.withColumn("partition", F.floor(F.log2("n"))).withColumn("__rank", F.row_number().over(own.orderBy("h", "shingle")))
    return one.select("*", (F.col("__rank") <= k).alias("in_sketch"), (F.least(k, F.col("n")) - may_lack(F.col("n"))).cast("long").alias("at_least")).drop("__rank")


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for every document that holds at least 80 % of an item's shingles.

    `docs`: doc_id, text; `items`: item_id, text. Rows that share a doc_id are one document, null being an id as well.
    Null and empty texts match nothing; an item of one word is found wherever that word is. Long documents and very frequent passages
    cost what they hold: a row per shingle that an item has, no pairs of documents. Extra columns are ignored.
    """
    all_of = stash(item_shingles(items.select("item_id", "text")), "benchmark-shingles")
    lengths = sorted(r.words for r in all_of.select("words").distinct().collect()) or [SHINGLE_WORDS]  # five at most
    small = all_of.count() <= MAX_BROADCAST_ROWS
    hint = F.broadcast if small else (lambda df: df.hint("merge"))
    sketch = all_of.where("in_sketch").select("h", "item_id", "at_least")

    ws = docs.select("doc_id", _words(F.col("text")).alias("ws"))
    probe = ws.select("doc_id", F.explode(F.array_distinct(_each(F.col("ws"), lengths, _hash))).alias("h"))
    found = probe.join(hint(sketch), "h").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("held"), F.max("at_least").alias("at_least"))
    found = stash(found.where("held >= at_least").select("doc_id", "item_id"), "benchmark-candidates")

    # exact containment, of the documents with a candidate only
    who = found.select(F.col("doc_id").alias("__doc")).distinct()
    suspects = docs.select("doc_id", "text")
    suspects = suspects.join(who, suspects["doc_id"].eqNullSafe(who["__doc"]), "left_semi")
    ws = suspects.select("doc_id", _words(F.col("text")).alias("ws"))
    z = ws.select("doc_id", F.explode(_texts_and_hashes(F.col("ws"), lengths)).alias("z")).select("doc_id", "z.h", F.col("z.shingle").alias("__text"))
    hits = z.join(hint(all_of.select("h", "shingle", "item_id", "n")), "h").where(F.col("__text") == F.col("shingle"))
    hits = hits.select("doc_id", "item_id", "n", "h", "shingle").distinct()
    left, right = hits.alias("l"), found.alias("r")
    hits = left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("l.item_id").eqNullSafe(F.col("r.item_id")), "left_semi")
    shared = hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"), F.max("n").alias("n_item"))
    shared = shared.where(100 * F.col("n_shared") >= CONTAINMENT_PERCENT * F.col("n_item"))
    return shared.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    bad = stash(contained(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "benchmark-rejects")
    return keep_rows(docs, bad)


SQL = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
ni AS (SELECT *, least(len(w), 5) AS k FROM i WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM ni),
si AS (SELECT DISTINCT item_id, array_to_string(w[j:j+k-1], ' ') AS s FROM ni, unnest(range(1, len(w) - k + 2)) AS u(j)),
dk AS (SELECT doc_id, w, k FROM d, ks WHERE len(w) >= k),
sd AS (SELECT DISTINCT doc_id, array_to_string(w[j:j+k-1], ' ') AS s FROM dk, unnest(range(1, len(w) - k + 2)) AS u(j)),
n AS (SELECT item_id, count(*) AS n_item FROM si GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM sd JOIN si USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, CAST(n_shared AS DOUBLE) / n_item AS containment
FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""
