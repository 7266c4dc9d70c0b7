"""Exact duplicates by deterministic block naming (operator 12).

A text without its white space is cut into blocks of `BLOCK` bytes. All blocks are sorted, and equal ones get the same integer, their
name. Then neighbouring names of a document are paired, the pairs are sorted and named in turn, and so on until each document has one
name. Two documents have the same (round, name) if and only if all their blocks are equal by their bytes: nothing is hashed, so nothing collides.

A batch of documents keeps a dictionary of its own: a block or pair is sorted once a batch, however many documents of the batch hold
it, and names return to the batch. So the copies of a text, however many, make one row a batch at the place where they are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import stash, table

BLOCK = 1024
#: Bytes of distinct blocks, and blocks in all, of a batch; the document that passes either is the batch's last.
BATCH_BYTES = 16 << 20
BATCH_BLOCKS = 100_000
#: Bytes of a block in the sample that cuts the ranges.
PREFIX = 16
#: What is deleted before texts are compared.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_CUT = "batch bigint, at int, doc_id {id}, n_chars bigint, sha binary, seq array<int>, first int, fresh array<binary>"
_NAMED = "batch bigint, at int, name bigint, seq array<int>, first int, a array<bigint>, b array<bigint>"


def _batch_id(number: int) -> int:
    return TaskContext.get().partitionId() << 32 | number


def _cut(docs: DataFrame) -> DataFrame:
    """A row per document: its blocks by their numbers in the batch, and the blocks that it is the first of its batch to hold."""
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    types = [pa.int64(), pa.int32(), id_type, pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.binary())]
    names = ["batch", "at", "doc_id", "n_chars", "sha", "seq", "first", "fresh"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        number, at, known, held, blocks = 0, 0, {}, 0, 0
        out: list[tuple] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            texts = batch.column("text")
            chars = pc.utf8_length(texts)
            for doc_id, text, n in zip(batch.column("doc_id"), texts.cast(pa.large_binary()), chars, strict=True):
                data = (text.as_py() or b"").translate(None, SPACE)
                seq, fresh, first = [], [], len(known)
                for i in range(0, len(data), BLOCK):
                    block = data[i : i + BLOCK]
                    local = known.get(block)
                    if local is None:
                        local = known[block] = len(known)
                        fresh.append(block)
                        held += len(block)
                    seq.append(local)
                out.append((_batch_id(number), at, doc_id.as_py(), n.as_py() or 0, sha256(data).digest(), seq, first, fresh))
                at, blocks, waiting = at + 1, blocks + len(seq) + 1, waiting + len(data)
                if held > BATCH_BYTES or blocks > BATCH_BLOCKS:
                    number, at, known, held, blocks = number + 1, 0, {}, 0, 0
                if waiting > BATCH_BYTES:
                    yield flush()
                    out, waiting = [], 0
        yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, _CUT.format(id=kind))


def _names(entries: DataFrame, keys: list[str]) -> DataFrame:
    """(batch, local, name) of `entries` (batch, local, keys): the keys in order, equal ones with one name.

    Blocks are ordered by their first bytes, then a fingerprint, then all bytes: equal ones still lie together, names are given by all bytes, and the sample that
    Spark draws on the driver to cut the ranges holds `PREFIX` bytes a block in place of the whole. A name is the number of the range (high bits) and the rank in it, so names keep the order of the keys over all ranges.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, last = (TaskContext.get().partitionId() << 40) - 1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            now = tuple(c[0].as_py() for c in columns)
            new[0] = now != last
            own = name + np.cumsum(new)
            name, last = int(own[-1]), tuple(c[-1].as_py() for c in columns)
            yield pa.RecordBatch.from_arrays([batch.column("batch"), batch.column("local"), pa.array(own)], names=["batch", "local", "name"])

    first = [F.substring("block", 1, PREFIX).alias("first"), F.xxhash64("block").alias("mark")] if keys == ["block"] else []
    cuts = ["first", "mark"] if first else keys
    ranged = entries.select("batch", "local", *keys, *first).repartitionByRange(*cuts).sortWithinPartitions(*dict.fromkeys([*cuts, *keys])).select("batch", "local", *keys)
    return ranged.mapInArrow(number, "batch bigint, local int, name bigint")


def _paired(docs: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
    """One batch: names in place of its numbers; a document with one name is done, the others get numbers of their pairs."""
    of = np.zeros(len(names), np.int64)
    of[names["local"].to_numpy()] = names["name"].to_numpy()
    known: dict[tuple[int, int], int] = {}
    out = []
    for batch, at, seq in zip(docs["batch"], docs["at"], docs["seq"], strict=True):
        own = of[seq].tolist() if len(seq) else [-1]  # an empty text
        if len(own) == 1:
            out.append((batch, at, own[0], [], 0, [], []))
            continue
        own += [-1] * (len(own) % 2)
        pairs, first = list(zip(own[::2], own[1::2], strict=True)), len(known)
        numbers = [known.setdefault(p, len(known)) for p in pairs]
        fresh = list(known)[first:] if len(known) > first else []
        out.append((batch, at, None, numbers, first, [a for a, _ in fresh], [b for _, b in fresh]))
    got = pd.DataFrame(out, columns=["batch", "at", "name", "seq", "first", "a", "b"])
    return got.astype({"name": "Int64"})


def _identities(cut: DataFrame) -> DataFrame:
    """(batch, at, round, name): equal pairs of round and name are equal texts."""
    fresh = cut.select("batch", "first", F.posexplode("fresh").alias("pos", "block"))
    entries, keys, state, rounds = fresh.withColumn("local", F.col("first") + F.col("pos")), ["block"], cut, []
    while True:
        names = stash(_names(entries, keys), "exact-names")
        found = state.select("batch", "at", "seq").groupBy("batch").cogroup(names.groupBy("batch")).applyInPandas(_paired, _NAMED)
        found = stash(found, "exact-round")
        rounds.append(found.where("name IS NOT NULL").select("batch", "at", F.lit(len(rounds)).alias("round"), "name"))
        state = found.where("name IS NULL")
        if state.isEmpty():
            return reduce(DataFrame.union, rounds)
        pairs = state.select("batch", "first", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "pair"))
        entries, keys = pairs.select("batch", (F.col("first") + F.col("pos")).alias("local"), "pair.a", "pair.b"), ["a", "b"]


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of `docs` (doc_id, text).

    Texts are equal if they are identical without ASCII white space; a null text counts as empty, and all empty ones are equal. Of equal
    texts the row with the most code points in the original stays; a tie goes to the smallest doc_id, a null one last. Repeated rows are
    rows of their own, of which at most one stays. Other columns are ignored. Texts of any length take part whole: a text of n blocks
    takes log2(n) rounds.
    """
    cut = stash(_cut(docs), "exact-blocks", codec="zstd")
    named = cut.select("batch", "at", "doc_id", "n_chars", "sha").join(_identities(cut), ["batch", "at"])
    named = stash(named, "exact-identities")
    key = ["round", "name"]
    best = F.min(F.struct((-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "batch", "at")).alias("best")
    partial = stash(named.groupBy("batch", *key).agg(F.count("*").alias("n"), best), "exact-partial")
    whole = partial.groupBy(*key).agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    back = partial.select("batch", *key).join(whole, key)  # a row for each batch of a group, not for each copy
    stays = (F.col("best.batch") == F.col("batch")) & (F.col("best.at") == F.col("at"))
    return named.join(back, ["batch", *key]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", stays.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS own FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY own) AS group_size, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
      FROM t WINDOW w AS (PARTITION BY own ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(own) AS text_sha256 FROM g
"""
