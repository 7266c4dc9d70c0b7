"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 1).

Training counts hashed n-grams by language in Arrow batches, summed by Spark; the log-probability matrix (buckets x languages,
bounded by its parameters) is broadcast. Scoring treats a batch as a sparse matrix (row offsets and column indices of
the n-grams, each a one) and multiplies it with the matrix in numpy, in pieces of bounded size.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import stash, table

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Training texts of a language, at most about this many: a sample by hash; the bound keeps training from growing with the corpus.
TRAIN_PER_LANG = 4000
#: Bytes of the matrix (buckets x languages). With so many languages that it would be larger, buckets are halved until it fits; at 65,536
#: buckets that is beyond 512 languages.
MATRIX_BYTES = 1 << 28
#: N-grams times languages that are scored at once.
PIECE = 1 << 23
UNDETERMINED = "und"


@functools.cache
def _folded() -> np.ndarray:
    """Lower-case code point of every letter; 32, a boundary, for everything else."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low[0]) if low[0].isalpha() else i
    return out


def _codes(text: str) -> np.ndarray:
    """Folded letters with runs of other characters as one boundary, and a boundary at both ends."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.concatenate(([32], _folded()[raw], [32])).astype(np.uint32)
    return code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))]


def _hashed(code: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all n-grams of one text, order after order."""
    out, h = [], np.zeros(len(code), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(code) < n:
            break
        h = (h[: len(code) - n + 1] * np.uint32(0x01000193)) ^ (code[n - 1 :] * np.uint32(0x9E3779B1) + np.uint32(n))
        if n in ORDERS:
            mixed = h ^ (h >> np.uint32(15))
            out.append((mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - (buckets - 1).bit_length()))
    return np.concatenate(out)


def has_letter(code: np.ndarray) -> bool:
    return bool((code != 32).any())


def counts(labelled: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) of `labelled` (text, lang), summed by Spark."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for lang, texts in df.groupby("lang")["text"]:
                total = np.zeros(buckets, np.int64)
                for t in texts:
                    if t and has_letter(c := _codes(t)):
                        total += np.bincount(_hashed(c, buckets), minlength=buckets)
                at = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    parts = labelled.select("text", "lang").mapInPandas(count, "lang string, bucket bigint, n bigint")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, per_lang: int = TRAIN_PER_LANG, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages in order and the matrix (buckets, languages) of log probabilities, a uniform prior over languages.

    `labelled`: doc_id, text, lang; rows without a language are ignored. A language with more than `per_lang` rows is sampled by a
    hash of doc_id, so reruns train alike; rows without a doc_id share one hash. Repeated rows count each. Without any row the list is
    empty and every prediction is `und`.
    """
    rows = labelled.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = stash(rows.groupBy("lang").agg(F.count("*").alias("__rows")), "languages")
    n_langs = sizes.count()
    while buckets * n_langs * 8 > MATRIX_BYTES and buckets > 2:
        buckets //= 2
    share = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1_000_000)) < 1_000_000.0 * per_lang / F.col("__rows")
    sample = rows.join(F.broadcast(sizes), "lang").where(share)
    got = counts(sample, buckets).toPandas()  # at most buckets x languages rows
    langs = sorted(got["lang"].unique())
    n = np.full((buckets, len(langs)), SMOOTHING)
    n[got["bucket"], got["lang"].map({x: i for i, x in enumerate(langs)})] += got["n"]
    n /= n.sum(axis=0, keepdims=True)
    return langs, np.log(n, out=n).astype(np.float32)


def score_batch(texts: list[str | None], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log probabilities (texts x languages) and whether a text has a letter."""
    total, known = np.zeros((len(texts), matrix.shape[1])), np.zeros(len(texts), bool)
    rows, held = [], 0
    most = max(1, PIECE // max(1, matrix.shape[1]))

    def flush():
        nonlocal rows, held
        if rows:
            starts = np.cumsum([0, *(len(x) for _, x in rows[:-1])])
            np.add.at(total, [i for i, _ in rows], np.add.reduceat(matrix[np.concatenate([x for _, x in rows])], starts, axis=0, dtype=np.float64))
        rows, held = [], 0

    for i, t in enumerate(texts):
        if not t or not has_letter(code := _codes(t)):
            continue
        known[i] = True
        grams = _hashed(code, len(matrix))
        for at in range(0, len(grams), most):
            part = grams[at : at + most]
            if held + len(part) > most:
                flush()
            rows.append((i, part))
            held += len(part)
    flush()
    return total, known


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """`docs` columns other than text, and lang_pred, score (the posterior of the prediction). Columns of these two names are replaced.

    `und` with score 0 if the text is null or has no letter, or if no language was learned. Ties go to the first language.
    """
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))
    docs = docs.drop("lang_pred", "score")
    rest = [c for c in docs.columns if c != "text"]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, matrix = model.value
        names = np.array([*langs, UNDETERMINED], dtype=object)
        for df in batches:
            out = df[rest].copy()
            if not langs:
                yield out.assign(lang_pred=UNDETERMINED, score=0.0)
                continue
            total, known = score_batch(df["text"].tolist(), matrix)
            best = total.argmax(axis=1)
            post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            yield out.assign(lang_pred=names[np.where(known, best, len(langs))], score=np.where(known, post, 0.0))

    schema = StructType([f for f in docs.schema if f.name != "text"]).add("lang_pred", "string").add("score", "double")
    return docs.mapInPandas(score, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    langs, matrix = train(docs.where(~held))
    return predict(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text"), langs, matrix)
