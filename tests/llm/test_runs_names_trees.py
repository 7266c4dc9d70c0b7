"""Operators 11 to 13 against brute force, SQL and exact round trips, and their behaviour on nulls, ties, repeats and empty tables."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import exact_dedup, merkle_manifest, periodic_runs

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """Real documents and odd ones: nulls, empty, long, repeats, ties, and extra columns with clashing names."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    first = df.orderBy("doc_id").limit(1).first()
    odd = [
        (900001, None, "en", "a", None), (900002, "", None, None, 0), (900003, " \t\n", "fr", "a", 3), (900004, first.text, None, "b", 1), (900004, first.text, None, "b", 1),
        (900005, "Word " * 3_000, "en", "b", 15_000), (900006, "ünïcödé ☃ 漢字 🎈 " * 20, "de", None, 1), (None, "a ROW without an id " * 10, "en", "a", 1), (900007, "x" * 5000, "", "a", 5000),
        (900008, first.text.replace(" ", "  "), "en", "a", 2), (None, None, None, None, None), (None, None, None, None, None), (900009, "x" * 4096 + "y" * 904, "lone", "a", 5000),
    ]
    df = df.unionByName(spark.createDataFrame(odd, DOCS))
    for clash in ("batch", "at", "name", "key", "tree", "my col", "idx"):
        df = df.withColumn(clash, F.lit("clash"))
    return df.cache()


def words(t):
    return (t or "").encode().split()


# --- 11


def brute_runs(x):
    """Every run (start, length, period) from the definition: all periods, one after the other, the least of equal stretches."""
    found = {}
    for q in range(1, len(x) // 2 + 1):
        begin = None
        for i in range(len(x) - q + 1):
            same = i < len(x) - q and x[i] == x[i + q]
            if same and begin is None:
                begin = i
            elif not same and begin is not None:
                length = i - begin + q
                if length >= max(12, 2 * q):
                    found.setdefault((begin, length), q)
                begin = None
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text):
    ws = words(text)
    n = len(ws)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = brute_runs(ws)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(ws) if i not in dropped)
    s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    told = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
    return (doc_id, len(runs), s, m, q, 1000 * m // q if m else None, hashlib.sha256(told).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_transforms_are_exact():
    rng = np.random.default_rng(1)
    for n in (8, 128, 256, 1024, 4096):
        x = periodic_runs._mod(rng.integers(0, periodic_runs.MODULUS, (2, n)).astype(float))
        f = periodic_runs.ntt(x.copy(), n)
        root = pow(periodic_runs.ROOT, (periodic_runs.MODULUS - 1) // n, periodic_runs.MODULUS)
        for at in rng.integers(0, n, 3).tolist():
            assert int(f[1, at]) % periodic_runs.MODULUS == sum(int(x[1, i]) * pow(root, i * at, periodic_runs.MODULUS) for i in range(n)) % periodic_runs.MODULUS
        assert ((periodic_runs.ntt(f, n, inverse=True) - x * n) % periodic_runs.MODULUS == 0).all()


def hard_sequences():
    rng, out = random.Random(3), []
    for _ in range(250):
        n, k = rng.randint(0, 160), rng.choice([1, 2, 3, 5, 30])
        d = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            d = d[:a] + [d[a + (i - a) % p] for i in range(a, n)]
        out.append(d)
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    return [*out, b, [0] * 500, ([1] * 40 + [2]) * 12, [*range(300)] * 3, [], [7] * 11, [7] * 12]


@pytest.mark.parametrize("longest", [8, 1024])
def test_runs_by_definition(monkeypatch, longest):
    monkeypatch.setattr(periodic_runs, "LONGEST", longest)  # short probes stand for blocks of long periods
    cases = hard_sequences()
    got = periodic_runs.find_runs([np.array(c, np.int64) for c in cases])
    for c, g in zip(cases, got, strict=True):
        assert [tuple(r) for r in g.tolist()] == brute_runs(c)


def test_long_texts_of_one_word_and_of_long_periods():
    rng = np.random.default_rng(5)
    long = rng.integers(0, 50_000, 9000)
    got = periodic_runs.find_runs([np.zeros(60_000, np.int64), np.concatenate((np.arange(60_000, 60_007), long, long, long[:100]))])
    assert got[0].tolist() == [[0, 60_000, 1]] and got[1].tolist() == [[7, 18_100, 9000]]


def test_periodic_runs_of_documents(spark, docs):
    data = docs.where("length(text) < 12000 OR text IS NULL").select("doc_id", "text", "my col")
    got = periodic_runs.periodic_runs(data, periodic_runs.planted(F.col("text"), F.col("doc_id")))
    want = [brute_row(r.doc_id, r.text) for r in data.collect()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert any(w[1] for w in want) and any(zlib.crc32(str(w[0]).encode()) % 10 == 0 and w[4] for w in want if w[0] is not None)


def test_collapsed_text_and_runs(spark):
    text = "one two " + "la di da " * 9 + "end"
    (r,) = periodic_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), whole=True).collect()
    assert r.collapsed == "one two la di da end" and [tuple(x) for x in r.runs] == [(2, 27, 3)] and r.exponent_milli == 9000


# --- 12


def brute_groups(rows):
    by = {}
    for at, r in enumerate(rows):
        by.setdefault(b"".join(words(r.text)), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, at))
    out = []
    for text, members in by.items():
        best = min(members)
        keep = rows[best[3]].doc_id
        out += [(rows[m[3]].doc_id, keep, len(members), m is best, hashlib.sha256(text).hexdigest()) for m in members]
    return sorted(map(repr, out))


@pytest.mark.parametrize("block,batch", [(1024, 100_000), (8, 40), (1, 300)])
def test_exact_groups_by_definition(spark, docs, monkeypatch, block, batch):
    """Small blocks and batches: many rounds, and names that travel between batches."""
    monkeypatch.setattr(exact_dedup, "BLOCK", block)
    monkeypatch.setattr(exact_dedup, "BATCH_BLOCKS", batch)
    data = docs if block > 8 else docs.where("length(text) < 400 OR text IS NULL OR doc_id IN (900007, 900009)")
    rows = data.collect()
    assert sorted(map(repr, map(tuple, exact_dedup.groups(data.repartition(5)).collect()))) == brute_groups(rows)


def test_blocks_are_compared_by_their_bytes(spark):
    block, half = exact_dedup.BLOCK, exact_dedup.BLOCK // 2
    texts = ["a" * block + "b" * block, "b" * block + "a" * block, "a" * block, "a" * half + " " + "a" * half, "a" * 2 * block, "a" * 3 * block, "a" * (3 * block - 1), "\x00", ""]
    got = exact_dedup.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == {0: 0, 1: 1, 2: 3, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8}
    assert {r.doc_id for r in got if not r.kept} == {2}


# --- 13


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_leaf(r, text):
    values = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Levels of runs from the leaves to the root."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        levels.append(runs)
        nodes = [digest("".join(r)) for r in runs]
    return levels, nodes[0]


def path(levels, i):
    for runs in levels:
        run = runs[i // 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def brute_proofs(rows):
    by = {}
    for r in rows:
        by.setdefault(None if r.lang is None else r.lang.encode(), []).append(r)
    order, trees = sorted(by, key=lambda x: (x is not None, x or b"")), {}
    for lang, members in by.items():
        members.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, brute_leaf(r, r.text)))
        trees[lang] = climb([brute_leaf(r, r.text) for r in members])
    top, root = climb([trees[lang][1] for lang in order])
    out = []
    for t, lang in enumerate(order):
        levels, subroot = trees[lang]
        for i, r in enumerate(by[lang]):
            leaf = brute_leaf(r, r.text)
            steps = [*path(levels, i), *path(top, t)]
            changed = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and changed is not None:
                changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in changed)
            fold = brute_leaf(r, changed)
            for left, right in steps:
                fold = digest("".join([*left, fold, *right]))
            proof = digest("".join("".join([*left, *right]) for left, right in steps))
            out.append((r.doc_id, leaf, subroot, root, proof, fold, fold == root))
    return sorted(map(repr, out))


@pytest.mark.parametrize("range_rows,levels", [(1 << 15, 4), (37, 1), (3, 2)])
def test_proofs_by_definition(docs, monkeypatch, range_rows, levels):
    monkeypatch.setattr(merkle_manifest, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    data = docs.where("doc_id < 60 OR doc_id >= 900000 OR doc_id IS NULL") if range_rows < 10 else docs
    got = merkle_manifest.proofs(merkle_manifest.manifest(data, other=merkle_manifest.tampered(data)))
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_proofs(data.collect())


def test_proof_of_some_leaves_and_least_fetch(docs):
    found = merkle_manifest.manifest(docs)
    some = found.leaves.where("key % 7 = 0")
    got = merkle_manifest.proofs(found, some, siblings=True).collect()
    assert len(got) == some.count() and all(r.verified and digest("".join(r.siblings)) == r.proof_sha256 for r in got)
    at = np.array([0, 1, 2, 3, 4, 5, 6, 7, 9])
    fetched = {(level, i) for level, x in merkle_manifest.missing(at, 100) for i in x.tolist()}
    assert fetched == {(0, i) for i in (8, *range(10, 16))} | {(1, i) for i in range(2, 8)} | {(2, 1)}  # node (1, 0) and (1, 1) are derived


def test_every_change_of_a_row_shows(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else None, "s", i) for i in range(30)]
    base = spark.createDataFrame(rows, DOCS)
    root = lambda df: merkle_manifest.proofs(merkle_manifest.manifest(df)).first().root
    before = root(base)
    assert root(base.repartition(3).withColumn("extra", F.lit(1))) == before
    assert root(base.withColumn("source", F.when(F.col("doc_id") == 5, "-").otherwise(F.col("source")))) != before
    assert root(base.where("doc_id <> 29")) != before


# --- all three


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert periodic_runs.periodic_runs(none).count() == 0
    assert exact_dedup.groups(none).count() == 0
    assert merkle_manifest.proofs(merkle_manifest.manifest(none)).count() == 0


@pytest.mark.parametrize("module", [exact_dedup, merkle_manifest])
def test_sql_agrees(spark, module):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = module.query(spark, SF)
    want = con.execute(module.SQL)
    columns = [x[0] for x in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))
