"""Documents with odd and clashing column names go through the operators that keep them."""

import numpy as np
from pyspark.sql import functions as F

from kinfold.llm import language_id, mixing, suffix_dedup

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd(spark):
    line = "a line of over fifty bytes that stands in two of these documents, word for word"
    rows = [(i, f"document {i} has some words of its own {i * 7919} and ends", "en", "s" if i % 2 else None, 1) for i in range(40)] + [(100, line, "en", "s", 1), (101, f"x {line} y", None, None, None), (102, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("my col", "__cut", "__p", "__turned", "__copies", "__runs", "__Doc", "copies", "score"):
        df = df.withColumn(name, F.concat(F.lit("kept "), F.coalesce(F.col("doc_id"), F.lit(0))))
    return df


def test_language_id_keeps_odd_names(spark):
    got = language_id.predict(odd(spark), ["en"], np.zeros((language_id.BUCKETS, 1), np.float32))
    assert got.count() == 43 and {"my col", "__cut"} <= set(got.columns) and dict(got.dtypes)["score"] == "double"
    assert {r["my col"] == f"kept {r.doc_id}" for r in got.collect()} == {True}


def test_mixing_keeps_odd_names(spark):
    df = odd(spark)
    got = mixing.stage(spark, df, "")
    assert set(got.columns) == set(df.columns) and got.count() > 0
    assert all(r["__cut"] == r["__copies"] == f"kept {r.doc_id}" and r.copies > 0 for r in got.collect())


def test_repeated_passages_keep_odd_names(spark):
    df = odd(spark)
    got = suffix_dedup.cleaned(df)
    assert got.columns == df.columns and got.count() == df.count()
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[101] == "x  y" and texts[100].startswith("a line") and texts[102] is None
    assert all(r["__runs"] == r["__Doc"] == f"kept {r.doc_id}" for r in got.collect())
