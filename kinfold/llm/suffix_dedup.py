"""Removal of repeated passages by winnowing with exact verification (operator 7).

A byte is removed if a string of `LENGTH` = 50 bytes that covers it also starts in a document with a smaller doc_id. Positions
are ranked by growing prefixes, and what is unique to one document at some length leaves the sort:

1. Length 16, sparse. Of the 35 places at which a 16-byte string fits in a 50-byte one, the one with the least
   rank, its anchor, stands for it, so equal 50-byte strings stand at equal ranks. Neighbouring positions with the
   same anchor form a run. Spark sorts the pairs (rank of the anchor, rank of the whole run). A rank of one document only is unique and done.
   Runs that are equal to their end are past the threshold at once: all but those of the least document are repeats.
2. Length 50, dense, for the least document of a run whose rank other runs share: their bytes are sorted by rank again, and
   every 50-byte string in them is compared with those of the documents before.

Ranks are fingerprints of the prefix, which need no global numbering. Runs are taken for equal to their end if 32 bits of the rank and 64 of their
fingerprint agree, which is not verified; strings are compared by their bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import stash, table

LENGTH = 50
PREFIX = 16
#: Runs of one rank that one task compares; the strings of a rank with more are compared over all tasks, by their bytes as well.
HOT_RUNS = 10_000
#: Positions and counts share a number in the first sort: the count has the low bits.
COUNT_BITS = 22
#: Bytes that are ranked at once, and the most of a document in a piece (pieces overlap, so none is cut short).
PIECE = 1 << 19

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BASE = np.uint64(0x5851F42D4C957F2D)


def _prefix_ranks(data: np.ndarray) -> np.ndarray:
    """Fingerprints of the 16-byte strings at every position, by doubling 1, 2, 4, 8, 16."""
    rank = (data.astype(np.uint64) + np.uint64(1)) * _MIX[0]
    rank ^= rank >> np.uint64(29)
    size = 1
    while size < PREFIX:
        rank = rank[:-size] * _MIX[1] + rank[size:]
        rank ^= rank >> np.uint64(31)
        rank *= _MIX[2]
        size *= 2
    return rank


def _least(rank: np.ndarray, width: int) -> np.ndarray:
    """Least rank of `width` positions from every position on."""
    size = 1
    while size * 2 <= width:
        rank = np.minimum(rank[:-size], rank[size:])
        size *= 2
    return np.minimum(rank[: len(rank) - (width - size)], rank[width - size :]) if size < width else rank


class _Strings:
    """Fingerprints of substrings [a, b) of a buffer by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        scattered = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
        power = np.full(len(data) + 1, _BASE)
        power[0] = 1
        self.down = np.full(len(data) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
        self.down[0] = 1
        np.cumprod(self.down, out=self.down)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(scattered[data] * np.cumprod(power)[:-1], dtype=np.uint64)))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (self.sums[b] - self.sums[a]) * self.down[a]
        return (x ^ (x >> np.uint64(32))) * _MIX[1] + (b - a).astype(np.uint64)


def _pieces(lengths: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, from, to) within the texts, each list about PIECE bytes; pieces of a text overlap by 49 bytes."""
    now, held = [], 0
    for row in np.flatnonzero(lengths >= LENGTH).tolist():
        n, at = int(lengths[row]), 0
        while at < n - LENGTH + 1:
            end = min(n, at + PIECE)
            if held and held + end - at > PIECE:
                yield now
                now, held = [], 0
            now.append((row, at, end))
            held += end - at
            at = end - LENGTH + 1
    if now:
        yield now


def _texts(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def _runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first, count, rank, run rank): runs of positions that share the least rank, from every piece."""
    for piece in _pieces(np.diff(offsets)):
        part = np.concatenate([data[offsets[r] + a : offsets[r] + b] for r, a, b in piece])
        sizes = np.array([b - a for _, a, b in piece])
        ends = np.cumsum(sizes)
        rank = _least(_prefix_ranks(part), LENGTH - PREFIX + 1)
        fits = np.ones(len(rank) + 1, bool)  # whether a 50-byte string starts here, within its piece
        fits[-1] = False
        inner = (ends[:-1, None] - np.arange(1, LENGTH)).ravel()
        fits[inner] = False
        same = rank[1:] == rank[:-1]
        first = np.flatnonzero(fits[:-1] & np.concatenate(([True], ~(same & fits[:-2]))))
        last = np.flatnonzero(fits[:-1] & np.concatenate((~(same & fits[1:-1]), [True])))
        which = np.searchsorted(ends, first, side="right")
        rows, froms = np.array([r for r, _, _ in piece]), np.array([a for _, a, _ in piece])
        run = _Strings(part).rank(first, last + LENGTH)
        yield rows[which], first - (ends - sizes)[which] + froms[which], last - first + 1, rank[first], run


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, run, doc, at): the runs of all documents, `at` being first and count in one number; 32 bits of the rank.

    Of equal runs of a batch only those of the least document are compared; the others are known to be repeats, have a negative
    `at` and a rank of their own, by which they are dealt evenly. So a passage that many documents share is compared once a batch.
    """
    for batch in batches:
        ids = batch.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        found = list(_runs(*_texts(batch.column("text"))))
        if not found:
            continue
        row, first, count, rank, run = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = known[row]
        row, first, count, rank, run = row[keep], first[keep], count[keep], rank[keep], run[keep]
        doc = ids[row]
        order = np.lexsort((doc, run, rank))
        new = np.concatenate(([True], (rank[order][1:] != rank[order][:-1]) | (run[order][1:] != run[order][:-1])))[: len(rank)]
        least = np.empty_like(doc)
        least[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        closed = doc > least
        at = first << COUNT_BITS | count
        spread = (doc.view(np.uint64) * _MIX[0] + first.astype(np.uint64)) * _MIX[1]
        short = (np.where(closed, spread, rank * _MIX[2]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(short), pa.array(np.where(closed, 0, run.view(np.int64))), pa.array(doc), pa.array(np.where(closed, -at, at))], names=["rank", "run", "doc", "at"])


def _bytes_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, doc, first, content) of the runs in `__runs`. A run that does not fit the text, as the doc_id is not unique, is left out."""
    for batch in batches:
        data, offsets = _texts(batch.column("text"))
        ids, runs = batch.column("doc_id").to_numpy(), batch.column("__runs")
        rank, at = (runs.values.field(k).to_numpy(zero_copy_only=False) for k in ("rank", "at"))
        sizes = np.diff(runs.offsets.to_numpy())
        own = slice(runs.offsets[0].as_py(), runs.offsets[-1].as_py())
        row, rank, at = np.repeat(np.arange(batch.num_rows), sizes), rank[own], at[own]
        first, length = at >> COUNT_BITS, (at & ((1 << COUNT_BITS) - 1)) + LENGTH - 1
        ok = first + length <= np.diff(offsets)[row]
        row, rank, first, length = row[ok], rank[ok], first[ok], length[ok]
        start = offsets[row] + first
        content = [data[a:b].tobytes() for a, b in zip(start.tolist(), (start + length).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(rank), pa.array(ids[row]), pa.array(first), pa.array(content, pa.binary())], names=["rank", "doc", "first", "content"])


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, at): the strings of the runs that a smaller document has as well. Rows come sorted by rank and doc; a rank may go on in
    the next batch."""
    seen: dict[bytes, int] = {}
    now = None
    for batch in batches:
        docs, ats = [], []
        for rank, doc, first, content in zip(*(batch.column(k).to_pylist() for k in ("rank", "doc", "first", "content")), strict=True):
            if rank != now:
                now, seen = rank, {}
            for i in range(len(content) - LENGTH + 1):
                if seen.setdefault(content[i : i + LENGTH], doc) < doc:
                    if docs and docs[-1] == doc and (ats[-1] >> COUNT_BITS) + (ats[-1] & ((1 << COUNT_BITS) - 1)) == first + i:
                        ats[-1] += 1  # the string before was one as well
                    else:
                        docs.append(doc)
                        ats.append((first + i) << COUNT_BITS | 1)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ats, pa.int64())], names=["doc", "at"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(whole, doc, at, sure): every 50-byte string of the runs, itself. `sure`: a smaller document of the batch has it as well, so it is a repeat whatever
    the other batches hold; it then gets a key of its own, by which it is dealt evenly."""
    for batch in batches:
        whole, docs, ats, least = [], [], [], {}
        for doc, first, content in zip(*(batch.column(k).to_pylist() for k in ("doc", "first", "content")), strict=True):
            for i in range(len(content) - LENGTH + 1):
                string = content[i : i + LENGTH]
                least[string] = min(least.get(string, doc), doc)
                whole.append(string)
                docs.append(doc)
                ats.append((first + i) << COUNT_BITS | 1)
        sure = [least[w] < d for w, d in zip(whole, docs, strict=True)]
        keys = [d.to_bytes(8, "big", signed=True) + a.to_bytes(8, "big") if x else w for w, d, a, x in zip(whole, docs, ats, sure, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(ats, pa.int64()), pa.array(sure, pa.bool_())], names=["whole", "doc", "at", "sure"])


def _cut(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept bytes of a text and its removed spans (from, to); at `count` positions from each `first` on a repeat starts."""
    edge = np.zeros(len(data) + LENGTH, np.int64)
    np.add.at(edge, np.minimum(first, len(data)), 1)
    np.add.at(edge, np.minimum(first + count + LENGTH - 1, len(data)), -1)
    gone = np.cumsum(edge)[: len(data)] > 0
    step = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return data[~gone].tobytes(), step.reshape(-1, 2)


def _cuts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each row of (text, __runs): what `_cut` gives."""
    data, offsets = _texts(batch.column("text"))
    runs = batch.column("__runs")
    has, at = runs.is_valid().to_numpy(zero_copy_only=False), runs.offsets.to_numpy()
    place = runs.values.field("at").to_numpy(zero_copy_only=False)
    first, count = place >> COUNT_BITS, place & ((1 << COUNT_BITS) - 1)
    for i in range(batch.num_rows):
        own = slice(at[i], at[i + 1]) if has[i] else slice(0, 0)
        yield _cut(data[offsets[i] : offsets[i + 1]], first[own], count[own])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, spans = zip(*_cuts(batch), strict=True) if batch.num_rows else ((), ())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(np.diff(_texts(batch.column("text"))[1]), pa.int64()), pa.array([int((x[:, 1] - x[:, 0]).sum()) for x in spans], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in x.tolist()] for x in spans], kind), pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def _long_ids(docs: DataFrame) -> DataFrame:
    """A cast that changes nothing would keep the two joins from reading one exchange."""
    return docs if dict(docs.dtypes)["doc_id"] == "bigint" else docs.withColumn("doc_id", F.col("doc_id").cast("long"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id a long) with `__runs`: the positions at which repeated strings start; null if there are none."""
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    anchors = texts.mapInArrow(_anchors, "rank int, run bigint, doc bigint, at bigint")
    every, equal = W.partitionBy("rank"), W.partitionBy("rank", "run")
    found = anchors.select("*", F.min("doc").over(every).alias("lo"), F.max("doc").over(every).alias("hi")).where("at < 0 OR lo < hi")
    found = found.withColumn("several", F.min("run").over(every) != F.max("run").over(every)).withColumn("least", F.min("doc").over(equal))
    gone = (F.col("at") < 0) | (F.col("doc") > F.col("least"))
    judged = stash(found.where(gone | F.col("several")).select("rank", "doc", F.abs("at").alias("at"), gone.alias("gone")), "repeats")

    def join(left: DataFrame, found: DataFrame, columns: list[str], how: str) -> DataFrame:
        own = found.groupBy("doc").agg(F.collect_list(F.struct(*columns)).alias("__runs")).withColumnRenamed("doc", "__doc")
        return left.join(own, left["doc_id"] == own["__doc"], how).drop("__doc")

    def contents(found: DataFrame) -> DataFrame:
        return join(texts, found, ["rank", "at"], "inner").mapInArrow(_bytes_of_runs, "rank int, doc bigint, first bigint, content binary")

    unsure = judged.where("NOT gone")
    hot = stash(unsure.groupBy("rank").agg(F.count("*").alias("n")).where(F.col("n") > HOT_RUNS).select("rank"), "repeats-hot")
    some = not hot.isEmpty()
    cold = unsure.join(hot, "rank", "left_anti") if some else unsure
    dense = contents(cold).repartition("rank").sortWithinPartitions("rank", "doc").mapInArrow(_dense, "doc bigint, at bigint")
    if some:
        strings = contents(unsure.join(hot, "rank", "left_semi")).mapInArrow(_strings, "whole binary, doc bigint, at bigint, sure boolean")
        strings = strings.withColumn("least", F.min("doc").over(W.partitionBy("whole")))  # a string comes once a batch at most, but for one document's own
        dense = dense.union(strings.where("sure OR doc > least").select("doc", "at"))
    # texts without an id take no part; with the same filter both joins read one exchange of the texts
    repeats = judged.where("gone").select("doc", "at").union(dense)
    nameless = docs.where("doc_id IS NULL").withColumn("__runs", F.lit(None).cast("array<struct<at:bigint>>"))
    return join(docs.where("doc_id IS NOT NULL"), repeats, ["at"], "left").union(nameless)


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) per row of `docs` (doc_id integer, text): the removed byte spans and the rest.

    A null text is empty; texts under 50 bytes are never changed. Rows that share a doc_id are taken for repeats of one row: they
    do not remove each other, and if their texts differ the positions found in any count for all. A row with a null doc_id
    stays whole and removes nothing. Repeats are judged on the input, so removal does not depend on an order of work.
    """
    kind = docs.schema["doc_id"].dataType
    out = with_repeats(_long_ids(docs.select("doc_id", "text")))
    out = out.mapInArrow(_spans, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out if kind.simpleString() == "bigint" else out.withColumn("doc_id", F.col("doc_id").cast(kind))


def cleaned(docs: DataFrame) -> DataFrame:
    """`docs` with their repeated passages cut out of `text`; a character that a span cuts in two goes with it. A null text stays null."""
    kind = docs.schema["doc_id"].dataType
    clash = {c: f"__kept_{i}_{uuid.uuid4().hex}" for i, c in enumerate(docs.columns) if c.lower() in ("__runs", "__doc")}
    docs = _long_ids(docs.withColumnsRenamed(clash))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            new = [bytes(k).decode("utf-8", "ignore") if len(s) else t for (k, s), t in zip(_cuts(batch), text.to_pylist(), strict=True)]
            own = batch.drop_columns(["__runs"])
            yield own.set_column(own.schema.get_field_index("text"), "text", pa.array(new, text.type))

    return with_repeats(docs).mapInArrow(cut, docs.schema).withColumn("doc_id", F.col("doc_id").cast(kind)).withColumnsRenamed({v: k for k, v in clash.items()})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the repeated passages; a document of which nothing is left stays, empty."""
    return cleaned(docs)
