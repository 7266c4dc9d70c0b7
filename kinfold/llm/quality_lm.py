"""Quality classifier: interpolated modified Kneser-Ney n-grams of characters (operator 4).

The model is trained on all trusted text and tells all of its characters apart. Spark counts the n-grams, derives the
continuation counts of the lower orders, and joins counts with the totals of their contexts, sharded by context. The tables stay in
Spark: documents are packed into blocks, the distinct n-grams of each block are joined with the sharded counts and back-off weights,
and the probabilities return to their block. Every document gets its perplexity over its whole text and is kept up to a quantile of
the trusted documents' perplexities in its language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stash, table

ORDER = 4
#: Characters that there can be: one that the trusted text lacks has its even share of what the model leaves to them.
ALPHABET = 0x110000
#: Documents up to this quantile of the trusted ones, times SLACK, are kept.
QUANTILE = 0.99
SLACK = 1.02
#: Trusted ids, and n-grams with their probabilities, are broadcast up to this many rows of two numbers (about 60 MB as a
#: table of the join); beyond it Spark shuffles both sides.
MAX_BROADCAST_ROWS = 500_000
PIECE = 1 << 22
#: Characters of a block of documents, a longer document being one of its own.
BLOCK = 1 << 23


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _base(letters: list[int]) -> int:
    """Number of symbols: 0 is the start of a text, 1 any character that the trusted text lacks, the rest are `letters`."""
    base = len(letters) + 2
    if base**ORDER >= 1 << 63:
        raise ValueError(f"{len(letters)} distinct characters: the code of {ORDER} does not fit 64 bits")
    return base


def _symbols(letters: list[int]) -> np.ndarray:
    out = np.ones(0x110000, np.int32)
    out[letters] = np.arange(2, 2 + len(letters))
    return out


def _codes(text: str, symbols: np.ndarray, base: int) -> np.ndarray:
    """Code of the n-gram that ends at every character, a number with `base` as its base."""
    s = np.concatenate((np.zeros(ORDER - 1, np.int64), symbols[_points(text)]))
    code = np.zeros(len(s) - ORDER + 1, np.int64)
    for i in range(ORDER):
        code = code * base + s[i : len(s) - ORDER + 1 + i]
    return code


def alphabet(trusted: DataFrame) -> list[int]:
    """Code points of all characters of `trusted` (text), the most frequent first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0x110000, np.int64)
        for df in batches:
            for t in df["text"]:
                if t:
                    at, n = np.unique(_points(t), return_counts=True)
                    total[at] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"c": at, "n": total[at]})

    got = trusted.select("text").mapInPandas(count, "c int, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    return [r.c for r in got.orderBy(F.desc("n"), "c").collect()]


def ngrams(trusted: DataFrame, letters: list[int]) -> DataFrame:
    """(code, n): counts of the n-grams of the highest order over all of `trusted`."""
    base = _base(letters)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbols, total, held, size = _symbols(letters), {}, [], 0

        def fold() -> None:
            nonlocal held, size
            at, n = np.unique(np.concatenate(held), return_counts=True)
            old = total.get("at")
            if old is not None:
                both = np.concatenate((old, at))
                at, back = np.unique(both, return_inverse=True)
                n = np.bincount(back, weights=np.concatenate((total["n"], n))).astype(np.int64)
            total["at"], total["n"] = at, n
            held, size = [], 0

        for df in batches:
            for t in df["text"]:
                if t:
                    held.append(_codes(t, symbols, base))
                    size += len(held[-1])
                    if size > PIECE:
                        fold()
        if held:
            fold()
        if total:
            yield pd.DataFrame({"code": total["at"], "n": total["n"]})

    return trusted.select("text").mapInPandas(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    n = {r.n: r.k for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (max(1, n.get(i, 0)) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(i - (i + 1) * y * b / a, 0.05), i) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def train(trusted: DataFrame, letters: list[int]) -> dict:
    """The interpolated model: `base`, and `orders`, for every order from 1 the tables (code, p) of the discounted shares of the n-grams
    and (context, w) of the back-off weights. Both grow with the trusted text and are never collected.

    Without trusted text every character is as likely as any other.
    """
    base = _base(letters)
    counts = {ORDER: stash(ngrams(trusted, letters), "lm-counts")}
    for k in range(ORDER - 1, 0, -1):  # distinct symbols before an n-gram
        counts[k] = stash(counts[k + 1].groupBy((F.col("code") % base**k).alias("code")).agg(F.count("*").alias("n")), "lm-counts")
    orders = []
    for k in range(1, ORDER + 1):
        d = _discounts(counts[k])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        gram = counts[k].withColumn("context", F.expr(f"code div {base}")).withColumn("cut", F.least(cut, F.col("n").cast("double")))
        context = gram.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("mass"))
        shares = gram.join(context, "context").select("code", ((F.col("n") - F.col("cut")) / F.col("total")).alias("p"))
        weights = context.select("context", (F.col("mass") / F.col("total")).alias("w"))
        orders.append((stash(shares, "lm-shares"), stash(weights, "lm-weights")))
    return {"base": base, "orders": orders}


def probabilities(codes: DataFrame, model: dict) -> DataFrame:
    """(code, q): probability of the last symbol of each of the distinct `codes` (code) after the others.

    Order by order from the lowest, the suffixes that are asked for are joined with the counts, the weights of their contexts and the
    order below. An n-gram stands once in each join, so a key meets at most a row per symbol.
    """
    base, asked = model["base"], {ORDER: codes}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = asked[k + 1].select((F.col("code") % base**k).alias("code")).distinct()
    below = None
    for k, (shares, weights) in enumerate(model["orders"], 1):
        got = asked[k].join(shares, "code", "left").withColumn("context", F.expr(f"code div {base}")).join(weights, "context", "left")
        if below is None:
            got = got.withColumn("below", F.lit(1.0 / ALPHABET))
        else:
            got = got.withColumn("suffix", F.col("code") % base ** (k - 1)).join(below.select(F.col("code").alias("suffix"), F.col("q").alias("below")), "suffix")
        below = got.select("code", (F.coalesce("p", F.lit(0.0)) + F.coalesce("w", F.lit(1.0)) * F.col("below")).alias("q"))
    return below


def perplexities(docs: DataFrame, letters: list[int], model: dict) -> DataFrame:
    """(doc_id, lang, perplexity) of every row of `docs`; null for a null or empty text.

    A block of documents is one row: its compressed texts and its distinct n-grams. Only the n-grams meet the model, once a block
    however often they occur in it.
    """
    base, kind = model["base"], docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        symbols, number = _symbols(letters), TaskContext.get().partitionId() << 32
        schema = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("codes", pa.list_(pa.int64()))])
        packed = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))

        def block(rows: list[pa.RecordBatch], texts: list[str]) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema, options=packed) as out:
                for part in rows:
                    out.write_batch(part)
            found = np.unique(np.concatenate([np.zeros(0, np.int64), *(_codes(t, symbols, base) for t in texts)]))
            return pa.record_batch([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([found], pa.list_(pa.int64()))], schema=schema)

        rows, texts, size = [], [], 0
        for batch in batches:
            start = 0
            for i, t in enumerate(batch.column("text").to_pylist()):
                if t:
                    texts.append(t)
                    size += len(t)
                if size >= BLOCK:
                    yield block([*rows, batch.slice(start, i + 1 - start)], texts)
                    number, rows, texts, size, start = number + 1, [], [], 0, i + 1
            if start < batch.num_rows:
                rows.append(batch.slice(start))
        if rows:
            yield block(rows, texts)

    def score(packed: pa.Table, known: pa.Table) -> pa.Table:
        symbols = _symbols(letters)
        codes, logs = known.column("code").to_numpy(), known.column("log2").to_numpy().astype(np.float64)
        order = np.argsort(codes)
        codes, logs, out = codes[order], logs[order], []
        for raw in packed.column("docs"):
            rows = pa.ipc.open_stream(pa.BufferReader(raw.as_py())).read_all()
            values = [2.0 ** -float(logs[np.searchsorted(codes, _codes(t, symbols, base))].mean()) if t else None for t in rows.column("text").to_pylist()]
            out.append(pa.table({"doc_id": rows.column("doc_id"), "lang": rows.column("lang"), "perplexity": pa.array(values, pa.float64())}))
        return pa.concat_tables(out)

    blocks = stash(docs.select("doc_id", "lang", "text").mapInArrow(pack, "block bigint, docs binary, codes array<bigint>"), "lm-blocks")
    grams = blocks.select(F.col("block").alias("home"), F.explode("codes").alias("code"))
    known = probabilities(grams.select("code").distinct(), model).select("code", F.log2("q").cast("float").alias("log2"))
    known = stash(known, "lm-known")
    found = grams.join(_hint(known), "code").select("home", "code", "log2")
    return blocks.select("block", "docs").groupBy("block").cogroup(found.groupBy("home")).applyInArrow(score, f"doc_id {kind}, lang string, perplexity double")


def _hint(df: DataFrame) -> DataFrame:
    """`df`, a written table of narrow rows, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) of every row of `docs` (doc_id, text, lang): kept up to the `quantile` of the trusted
    documents' perplexities times `slack`, which lets a document a little above the last trusted one pass.

    Repeated rows are scored each and count each in training; a null doc_id is scored and never trusted; extra columns are ignored; a tie with
    the threshold is kept.

    Trusted are the documents that `labels` (doc_id, quality, toxic) calls good and not toxic. A language without one, null among
    them, has the threshold of all trusted documents; without any the model is uniform and everything with text is kept. A
    document without text has no perplexity and is not kept.
    """
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    good = stash(good, "lm-trusted")
    trusted = docs.select("doc_id", "lang", "text").join(_hint(good), "doc_id", "left_semi")
    letters = alphabet(trusted)
    model = train(trusted, letters)
    scored = stash(perplexities(docs.select("doc_id", "lang", "text"), letters, model), "lm-scores")
    sure = scored.join(_hint(good), "doc_id", "left_semi").where("perplexity IS NOT NULL")
    cut = lambda: F.percentile_approx("perplexity", quantile, 10_000) * slack
    limits = stash(sure.groupBy("lang").agg(cut().alias("threshold")), "lm-limits").withColumnRenamed("lang", "__lang")
    rest = sure.agg(cut().alias("t")).first().t
    out = scored.join(limits, scored["lang"].eqNullSafe(limits["__lang"]), "left").drop("__lang")
    out = out.withColumn("threshold", F.coalesce("threshold", F.lit(rest), F.lit(float("inf"))))
    return out.select("doc_id", "lang", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
