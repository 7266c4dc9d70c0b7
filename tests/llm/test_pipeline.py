"""The corpus pipeline against a brute-force version of its stages."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from kinfold.llm import decontamination, quality_rules
from tests.llm.test_operators import brute_components, brute_dedup, brute_fp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_stages(spark, stages):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.verdicts(base).where("kept").collect()}
    one = {r.doc_id: r.text for r in stages[0].collect()}
    assert one.keys() == kept

    ids = sorted(one)
    comp = brute_components(ids, [brute_fp(one[i]) for i in ids])
    two = {r.doc_id: r.text for r in stages[1].collect()}
    assert two.keys() == {i for i, c in zip(ids, comp, strict=True) if i == c}

    want = {d: k.decode("utf-8", "ignore") for d, (k, _) in brute_dedup(list(two.items())).items()}
    three = {r.doc_id: r.text for r in stages[2].collect()}
    assert three == want

    leaks = {r.doc_id for r in decontamination.contained(stages[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    four = {r.doc_id for r in stages[3].collect()}
    assert four == three.keys() - leaks and leaks

    last = stages[4]
    assert last.columns == [*base.columns, "copies"]
    sizes = {r.doc_id: len(r.text.encode().split()) for r in stages[3].collect()}
    taken = sum(r.copies * sizes[r.doc_id] for r in last.collect())
    assert taken == pytest.approx(1.5 * sum(sizes.values()), rel=0.03)
    assert all(s.columns == base.columns for s in stages[:4]) and not last.where("copies NOT IN (1, 2)").count()


def test_run_agrees(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.exceptAll(stages[-1]).count() == 0 and got.count() == stages[-1].count()
    assert got.select(F.sum("copies")).first()[0] > 0
