"""SimHash near-duplicates by a byte-position inverted index (operator 2).

Fingerprints of 64 bits are computed in Arrow batches. Two fingerprints that differ in `MAX_BITS` = 4 bits or fewer
differ in at most four of their eight bytes, so at least `MIN_MATCHES` = 4 positional bytes match: each distinct
fingerprint is posted once for every choice of four byte positions. To share a posting is to have four equal bytes, so every pair
that meets has reached the minimum; the tally of its equal positional bytes names the one choice at which the pair is reported, so that no
pair comes twice, and its bits verify it. Postings that many fingerprints share never become all pairs:
they are linked to a pivot first, and only members of different components are compared after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .shared import components, keep_rows, stash, table

SHINGLE_WORDS = 4
MAX_BITS = 4
MIN_MATCHES = 8 - MAX_BITS
#: Postings of up to this many fingerprints are compared pair by pair at once.
SMALL = 128
#: After pivots are linked, larger postings with several components are met half way instead of compared.
LARGE = 4096
SEED = 42

_CHOICES = list(combinations(range(8), MIN_MATCHES))
_signed = lambda x: x - (1 << 64) if x >> 63 else x
_MASKS = [_signed(sum(0xFF << (8 * b) for b in c)) for c in _CHOICES]


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the four-word shingles of a text; zero without words."""
    from xxhash import xxh64_intdigest as h

    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lower() is A-Z, split() is ASCII white space
    if not ws:
        return 0
    whole = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE_WORDS, len(ws))
    hashes = np.fromiter((h(whole[i:j], SEED) for i, j in zip(starts[: len(ws) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(ws) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; a null or empty text has fingerprint zero."""
    return docs.select("doc_id", F.pandas_udf(_fingerprints, LongType())("text").alias("fp"))


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS


def _matches(a: Column, b: Column) -> Column:
    """Bit i is set if positional byte i is equal."""
    x = a.bitwiseXOR(b)
    return sum((F.when(x.bitwiseAND(F.lit(_signed(0xFF << (8 * i)))) == 0, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(8)), F.lit(0))


def _first_choice(matches: Column) -> Column:
    """The first choice of positions that all match; -1 if fewer than four match. A pair is reported there only."""
    first = []
    for m in range(256):
        own = [i for i in range(8) if m >> i & 1]
        first.append(_CHOICES.index(tuple(own[:MIN_MATCHES])) if len(own) >= MIN_MATCHES else -1)
    return F.element_at(F.array(*map(F.lit, first)), matches + 1)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): edges whose components are those of all fingerprints that differ in four bits or fewer.

    `fps` has one row per distinct fingerprint (fp). Work is linear in the fingerprints but for comparisons in
    postings of at most `SMALL`, or of `LARGE` between different components. Spark sizes postings by the fingerprints they are
    exploded from, or by their compressed files, so their joins are told to shuffle: else it broadcasts 70 rows a fingerprint.
    """
    chosen = F.posexplode(F.array(*map(F.lit, _MASKS))).alias("choice", "mask")
    posted = fps.select("fp", chosen).select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"))
    key = ["choice", "bytes"]
    lists = posted.groupBy(*key).agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).where("n > 1")
    posted = stash(posted.hint("merge").join(lists, key), "simhash-postings")  # only those that some other fingerprint shares

    small = posted.where(F.col("n") <= SMALL)
    a, b = small.alias("a"), small.alias("b")
    once = F.col("a.choice") == _first_choice(_matches(F.col("a.fp"), F.col("b.fp")))
    pairs = a.hint("merge").join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key] + [F.col("a.fp") < F.col("b.fp"), once, _near(F.col("a.fp"), F.col("b.fp"))])
    edges = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    crowd = posted.where(F.col("n") > SMALL)
    edges = stash(edges.union(crowd.where("fp <> pivot").where(_near(F.col("fp"), F.col("pivot"))).select("fp", "pivot").distinct()), "simhash-edges")
    if crowd.isEmpty():
        return edges

    # members of crowded postings that are in several components so far
    known = components(edges, "simhash-first")
    named = crowd.join(known, crowd["fp"] == known["node"], "left").select(*key, "n", "fp", F.coalesce("component", "fp").alias("component"))
    several = named.groupBy(*key).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select(*key)
    named = stash(named.join(several, key), "simhash-crowd")
    some = named.where(F.col("n") <= LARGE)
    a, b = some.alias("a"), some.alias("b")
    once = F.col("a.choice") == _first_choice(_matches(F.col("a.fp"), F.col("b.fp")))
    more = a.hint("merge").join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key] + [F.col("a.component") < F.col("b.component"), _near(F.col("a.fp"), F.col("b.fp")), once])
    more = more.groupBy("a.component", "b.component").agg(F.min("a.fp").alias("a"), F.max("b.component").alias("b")).select("a", "b")
    many = named.where(F.col("n") > LARGE)
    if not many.isEmpty():
        more = more.union(_half_way(many.select("fp").distinct()))
    return edges.union(more)


def _half_way(fps: DataFrame) -> DataFrame:
    """Links by the points that are at most two bits away from a fingerprint: two fingerprints at most four bits apart
    share such a point. Each is linked to the least one at the point, so hot points make no pairs."""
    one = [1 << i for i in range(64)]
    flips = [0, *one, *(x | y for x, y in combinations(one, 2))]
    near = fps.select("fp", F.explode(F.array(*(F.lit(_signed(x)) for x in flips))).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    least = near.groupBy("point").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    return near.hint("merge").join(least, "point").where("fp <> least").select("fp", "least").distinct()


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) per row of `docs` (doc_id, text): component_id is the least doc_id that is reachable
    over links of at most four bits, the row's own included.

    Texts without words share fingerprint zero and are linked like any other; repeated rows are returned each; a row
    with a null doc_id takes part and is never named as a component unless its group has no other.
    """
    own = stash(fingerprints(docs), "simhash")
    fps = stash(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = components(links(fps.select("fp")), "simhash-components")
    named = fps.join(found, fps["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = stash(named, "simhash-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = stash(named.hint("merge").join(least, "component").select("fp", "component_id"), "simhash-by-fp")
    return own.hint("merge").join(by_fp, "fp").select("doc_id", "fp", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least doc_id, of every group."""
    gone = stash(groups(docs).where("doc_id <> component_id").select("doc_id"), "simhash-rejects")
    return keep_rows(docs, gone)
