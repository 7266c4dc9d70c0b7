"""The ten operators against brute force on small tables, and their behaviour on nulls, empty tables and repeats."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kinfold.llm import chat_format, decontamination, html_extraction, language_id, mixing, quality_lm, quality_rules, shared, simhash, suffix_dedup, token_counts

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """Real documents and odd ones: nulls, empty, long, repeats, and a clashing extra column."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    first = df.orderBy("doc_id").limit(1).first()
    odd = [
        (900001, None, "en", "a", None), (900002, "", None, None, 0), (900003, " \t\n", "fr", "a", 3), (900004, first.text, None, "b", 1), (900004, first.text, None, "b", 1),
        (900005, "word " * 30_000, "en", "b", 150_000), (900006, "ünïcödé ☃ 漢字 🎈 " * 20, "de", None, 1), (None, "a row without an id " * 10, "en", "a", 1), (900007, "x" * 5000, "en", "a", 5000),
    ]
    return df.unionByName(spark.createDataFrame(odd, DOCS)).withColumn("size", F.lit("clash")).withColumn("fp", F.lit(1)).withColumn("rank", F.lit("x")).cache()


def rows(df):
    return [r.asDict() for r in df.collect()]


def words(t):
    return (t or "").encode().split()


# --- 10


def test_quality_counts(docs):
    got = quality_rules.verdicts(docs)
    texts = {}
    for r in docs.collect():
        texts[r.doc_id] = r.text
    assert got.count() == docs.count()
    for r in got.collect():
        t = texts[r.doc_id] or ""
        ws = words(t)
        wins = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
        many = {w for w in wins if wins.count(w) > 1} if len(wins) < 3000 else set(wins)
        cover = {j for i, w in enumerate(wins) if w in many for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words(x)]
        want = (len(ws), sum(len(w.decode()) for w in ws), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == want, r.doc_id
        if len(wins) < 3000 or r.doc_id == 900005:
            assert r.n_repeat_words == len(cover), r.doc_id
            assert r.base_failed == (len(ws) < 50 or 100 * len(cover) > 50 * len(ws))
        assert not (r.base_failed and r.kept)


def test_quality_keeps_clean_and_drops_symbols(spark):
    clean = " ".join(f"w{i}" for i in range(80))
    data = [(i, clean + f" end{i}", "en", "s", 1) for i in range(200)] + [(999, " ".join(f"w{i}$$$" for i in range(80)), "en", "s", 1)]
    got = {r.doc_id: r.kept for r in quality_rules.verdicts(spark.createDataFrame(data, DOCS)).collect()}
    assert all(got[i] for i in range(200)) and not got[999]


def test_quality_fences_follow_the_groups(spark):
    text = lambda i, extra="", word="w": " ".join(f"{word}{i}x{j}" + extra * (j % 20 == 0) for j in range(80))
    data = [(i, text(i), "en", "clean", 1) for i in range(200)] + [(900, text(900, "$"), "en", "clean", 1)]  # 0.05 symbols a word
    data += [(1000 + i, text(i, word="d"), "en", "dirty", 1) for i in range(80)] + [(2000 + i, text(i).replace("x", "$#$"), "en", "dirty", 1) for i in range(120)]
    data += [(3000, text(3000).replace("x", "$$"), "en", "tiny", 1), (3001, text(3001), "en", "small", 1)]
    data += [(4000 + i, text(i, word="w" * 20), "xx", "long", 1) for i in range(60)]
    got = {r.doc_id: r.kept for r in quality_rules.verdicts(spark.createDataFrame(data, DOCS)).collect()}
    bad = {900, 3000, *range(2000, 2120)}
    assert {i for i, kept in got.items() if not kept} == bad


def brute_verdicts(rows):
    """The fences by (lang, source, rate), and whether each of (lang, source, base_failed, rates by name, repeated lines, sizes by name) is kept: exact quantiles, from the definition."""
    quantile = lambda values, q: sorted(values)[max(0, math.ceil(q * len(values)) - 1)] if values else 0.0
    own, by = quality_rules, {}
    for r in rows:
        if not r[2]:
            by.setdefault(r[:2], []).append(r)
    figures = {}
    for g, members in by.items():
        for rate in own.RATES:
            some = [m[3][rate] for m in members if m[3][rate] > 0]
            low, mid, high = (quantile(some, q) for q in (0.25, 0.5, 0.75))
            trust = (len(some) / len(members)) ** 2
            figures[g, rate] = {"low": low, "mid": trust * mid, "wide": trust * (high - mid)}
        figures[g, None] = {size: quantile([m[5][size] for m in members], 0.5) for size in ("n_words", "n_lines")}
    middle = lambda groups, rate, x: quantile([figures[g, rate][x] for g in groups], 0.5)
    blend = lambda k, a, b: k / (k + own.SHRINK) * a + (1 - k / (k + own.SHRINK)) * b
    fence = {}
    for g, members in by.items():
        alike = [x for x in by if x[0] == g[0]]
        n, n_lang = len(members), sum(len(by[x]) for x in alike)
        near = lambda rate, x, g=g, n=n, alike=alike: blend(n, figures[g, rate][x], middle(alike, rate, x))
        for rate, (units, size) in own.RATES.items():
            wide = blend(n, figures[g, rate]["wide"], blend(n_lang, middle(alike, rate, "wide"), middle(list(by), rate, "wide")))
            top = near(rate, "mid") + own.SPREAD * wide + (units / near(None, size) if size else units)
            fence[*g, rate] = min(top, own.BOUNDS[rate] if rate in own.BOUNDS else own.WORD_BOUND * near(rate, "low"))
    kept = []
    for lang, source, failed, rates, repeated, _ in rows:
        kept.append(not failed and not any(rates[r] > fence[lang, source, r] and (r != "dup_line_rate" or repeated > 1) for r in own.RATES))
    return fence, kept


def _judged(got):
    return [(r.lang, r.source, r.base_failed, {x: r[x] for x in quality_rules.RATES}, r.n_dup_lines, {"n_words": r.n_words, "n_lines": r.n_lines}) for r in got]


def test_quality_verdicts_by_definition(spark, docs):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source").unionByName(docs.select("doc_id", "text", "lang", "source"))
    got = quality_rules.verdicts(df).collect()
    fence, want = brute_verdicts(_judged(got))
    assert [r.kept for r in got] == want
    assert sum(want) > 0.6 * len(want)  # most documents stay
    for rate in quality_rules.RATES:  # the groups set the fences, not the constants
        tops = [round(v, 9) for (*_, r), v in fence.items() if r == rate]
        assert max(tops.count(x) for x in tops) <= 0.5 * len(tops), rate


def test_quality_fences_are_no_fixed_cutoffs(spark):
    """Two sources with unlike habits: no one cutoff has the verdicts of both."""
    own = lambda i, n: [" ".join(f"{c}{i:04}x{j:02}" for c in "abcd") for j in range(n)]
    lines = lambda i, n, again: "\n".join(own(i, n) + own(i, again))
    short = [(i, lines(i, 13, 0), "en", "short", 1) for i in range(100)] + [(900, lines(900, 20, 2), "en", "short", 1)]  # 2 of 22 lines
    long = [(1000 + i, lines(i, 60, 0), "fr", "long", 1) for i in range(100)] + [(1900, lines(1900, 60, 5), "fr", "long", 1)]  # 5 of 65 lines, the lower rate
    got = {r.doc_id: r for r in quality_rules.verdicts(spark.createDataFrame(short + long, DOCS)).collect()}
    assert got[900].dup_line_rate > got[1900].dup_line_rate and got[900].repeat_rate > got[1900].repeat_rate
    assert got[900].kept and not got[1900].kept
    assert all(r.kept for i, r in got.items() if i not in (900, 1900))


# --- 2


def brute_fp(t):
    ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))
    if not ws:
        return 0
    k = min(4, len(ws))
    h = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + k]), seed=42) for i in range(len(ws) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return [best.get(root(i)) for i in range(len(ids))]


def test_simhash(docs):
    data = docs.select("doc_id", "text").collect()
    got = simhash.groups(docs).collect()
    fps = {r.doc_id: r.fp & (1 << 64) - 1 for r in got}
    for r in data:
        assert fps[r.doc_id] == brute_fp(r.text), r.doc_id
    ids = [r.doc_id for r in data]
    want = dict(zip(ids, brute_components(ids, [brute_fp(r.text) for r in data]), strict=True))
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(data)


@pytest.mark.parametrize("small,large", [(128, 4096), (4, 4096), (4, 8)])
def test_simhash_links_crowded(spark, monkeypatch, small, large):
    monkeypatch.setattr(simhash, "SMALL", small)
    monkeypatch.setattr(simhash, "LARGE", large)
    draw = random.Random(5)
    center = [draw.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(9))) for c in center for _ in range(40)}
    fps |= {draw.getrandbits(64) for _ in range(40)}
    fps = sorted(simhash._signed(x) for x in fps)
    found = {r.node: r.component for r in shared.components(simhash.links(spark.createDataFrame([(x,) for x in fps], "fp bigint"))).collect()}
    got = [found.get(x, x) for x in fps]
    assert got == brute_components(fps, [x & (1 << 64) - 1 for x in fps])


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7), (101, 102), (100, 102)]
    got = {r.node: r.component for r in shared.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {101: 100, 102: 100}


# --- 3


def test_decontamination(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = items.orderBy("item_id").first()
    ws = one.text.split()
    partly = " ".join([*ws[: len(ws) - 2], "other", "words"])  # most shingles stay
    far = " ".join(f"filler{i}" for i in range(20_000))
    more = [(800004, f"{far} Four words: ONLY here! zweiwort allein {far}", None, None, 0), (800005, "four words only, and here; einzelwort", None, None, 0), (800001, f"{far} {one.text.upper()} {far}", None, None, 0), (800002, partly, None, None, 0), (800003, " ".join(ws[: len(ws) // 2]), None, None, 0)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, DOCS).select("doc_id", "text"))
    items = items.unionByName(spark.createDataFrame([(7001, None), (7002, "four words only here"), (7003, "!?"), (7004, "Zweiwort, allein"), (7005, "einzelwort"), (7006, "no such words"), (None, "an item that has no id at all but text")], "item_id bigint, text string"))

    def shingles(t, lengths=None):
        import regex

        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        return {tuple(w[i : i + k]) for k in lengths or [min(len(w), 5)] for i in range(len(w) - k + 1) if k}

    have = {}
    for r in both.collect():
        have.setdefault(r.doc_id, set()).update(shingles(r.text, range(1, 6)))
    want = {}
    for i in items.collect():
        s = shingles(i.text)
        for d, t in have.items():
            if s and 100 * len(s & t) >= 80 * len(s):
                want[d, i.item_id] = len(s & t)
    got = {(r.doc_id, r.item_id): r.n_shared for r in decontamination.contained(both, items).collect()}
    assert got == want and (800001, one.item_id) in got and (800003, one.item_id) not in got
    assert {(800004, 7002), (800004, 7004), (800005, 7005)} <= got.keys() and (800005, 7002) not in got
    assert decontamination.contained(both, items.limit(0)).count() == 0 and decontamination.contained(both.limit(0), items).count() == 0


def test_decontamination_sql_finds_short_items(spark, tmp_path):
    import duckdb

    items = spark.createDataFrame([(1, "four words only here"), (2, "one"), (3, None), (4, "a b c d e f g h i j")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x four words only here y"), (2, "One, two"), (3, "a b c d e f g h i"), (4, None), (5, "four words only")], "doc_id bigint, text string")
    con = duckdb.connect()
    con.register("benchmark", items.toPandas())
    con.register("documents", docs.toPandas())
    want = sorted(con.execute(decontamination.SQL).fetchall())
    assert sorted(tuple(r) for r in decontamination.contained(docs, items).collect()) == want
    assert [x[:2] for x in want] == [(1, 1), (2, 2), (3, 4)]


# --- 4


def log2_table(model, contexts=4):
    """log2 probability of each of the ALPHABET characters after some contexts of the highest order, one after the other: those of
    `letters` in order, then all others."""
    base = model["base"]
    some = model["orders"][-1][1].orderBy(F.xxhash64("context")).limit(contexts).select("context")
    codes = some.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(base - 1)), lambda x: F.col("context") * base + x)).alias("code"))
    got = np.array([r.q for r in quality_lm.probabilities(codes, model).orderBy("code").collect()]).reshape(-1, base - 1)
    out = np.repeat(got[:, :1], quality_lm.ALPHABET, axis=1)
    out[:, : base - 2] = got[:, 1:]
    return np.log2(out).reshape(-1)


def test_kneser_ney_sums_to_one(spark, docs):
    letters = quality_lm.alphabet(docs)
    logs = log2_table(quality_lm.train(docs, letters)).reshape(-1, quality_lm.ALPHABET).astype(float)
    assert np.allclose((2.0**logs).sum(axis=1), 1, atol=1e-4)


def brute_kn(texts, order):
    """Interpolated modified Kneser-Ney over symbols, written from the definition."""
    from collections import Counter

    grams = Counter(tuple([0] * (order - 1) + t)[i : i + order] for t in texts for i in range(len(t)))
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def d(k, n):
        c = Counter(min(v, 5) for v in counts[k].values())
        n1, n2, n3, n4 = (max(1, c.get(i, 0)) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        i, a, b = {1: (1, n1, n2), 2: (2, n2, n3)}.get(n, (3, n3, n4))
        return min(min(max(i - (i + 1) * y * b / a, 0.05), i), n)

    def p(g):
        k = len(g)
        lower = p(g[1:]) if k > 1 else 1 / quality_lm.ALPHABET
        same = {x: n for x, n in counts[k].items() if x[:-1] == g[:-1]}
        if not same:
            return lower
        total = sum(same.values())
        n = same.get(g, 0)
        return (n - d(k, n) if n else 0) / total + sum(d(k, v) for v in same.values()) / total * lower

    return p


def test_kneser_ney_against_definition(spark):
    texts = ["abracadabra abra", "banana band", "cabbage bad cab"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    letters = quality_lm.alphabet(df)
    symbol = {chr(c): i + 2 for i, c in enumerate(letters)}
    p = brute_kn([[symbol[c] for c in t] for t in texts], quality_lm.ORDER)
    got = {r.doc_id: r.perplexity for r in quality_lm.perplexities(df.union(spark.createDataFrame([(9, "zebra cab", "en"), (8, "", "en"), (7, None, None)], df.schema)), letters, quality_lm.train(df, letters)).collect()}
    for i, t in [*enumerate(texts), (9, "zebra cab")]:
        s = [0] * 3 + [symbol.get(c, 1) for c in t]
        want = 2 ** (-sum(math.log2(p(tuple(s[j : j + 4]))) for j in range(len(t))) / len(t))
        assert got[i] == pytest.approx(want, rel=1e-4)
    assert got[8] is None and got[7] is None


def test_rare_characters_are_told_apart(spark):
    """More characters than any fixed alphabet: each has counts of its own, and a script that the trusted text lacks is not kept."""
    greek, marks = "".join(map(chr, range(0x3B1, 0x3CA))), "".join(map(chr, range(0x4E00, 0x4E50)))
    texts = [(i, f"plain words of number {i} and so on " * 5 + greek + marks, "en") for i in range(60)]
    odd = [(100, "9876543210 " * 30, "en"), (101, "".join(map(chr, range(0x10D0, 0x10F0))) * 9, "en"), (102, marks[::-1] * 3, "en")]
    docs = spark.createDataFrame(texts + odd, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in texts], "doc_id bigint, quality int, toxic int")
    assert len(quality_lm.alphabet(docs.where("doc_id < 100"))) > 110
    got = {r.doc_id: r for r in quality_lm.classify(docs, labels).collect()}
    assert all(got[i].kept for i, *_ in texts) and not any(got[i].kept for i, *_ in odd)


def test_scores_do_not_depend_on_blocks(spark, docs, monkeypatch):
    letters = quality_lm.alphabet(docs)
    model = quality_lm.train(docs, letters)
    key = lambda: sorted((str(r.doc_id), r.lang or "", r.perplexity or 0.0) for r in quality_lm.perplexities(docs, letters, model).collect())
    whole = key()
    monkeypatch.setattr(quality_lm, "BLOCK", 5000)
    small = key()
    assert [x[:2] for x in small] == [x[:2] for x in whole] and len(whole) == docs.count()
    assert [x[2] for x in small] == pytest.approx([x[2] for x in whole])


def test_classifier_separates(spark):
    got = quality_lm.query(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    r = got.join(labels, "doc_id").where("toxic = 0").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    share = {x.quality: x.k for x in r}
    assert share[1] > 0.97 and share[0] < 0.3


# --- 5

CONV = "conv_id bigint, turn bigint, role string, text string"


def check_digest(df, got):
    data = {}
    for r in df.collect():
        data.setdefault(r.conv_id, []).append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
    assert {r.conv_id for r in got} == data.keys()
    for r in got:
        own = sorted(data[r.conv_id])
        turns = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("budget,turns_back,tokens_back", [(1024, 2, 256), (16, 0, 0), (64, 3, 50)])
def test_chat_round_trip(spark, budget, turns_back, tokens_back):
    df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST] &amp;lt; &lt; ] [assistant]x</s> \\ é🎈"
    odd = [(-1, 0, "user", hard), (-1, 1, "assistant", hard), (-2, 0, None, None), (-2, 0, "assistant", ""), (-2, None, "tool]<", "t"), (-3, 5, "assistant", "a b " * 9000), (-3, 5, "assistant", "a b " * 9000), (None, 1, "assistant", "no id"), (-4, 0, "system", "s"), (-4, 10_000, "user", "far"), (-4, 20_000, "assistant", "away")]
    df = df.unionByName(spark.createDataFrame(odd, CONV))
    made = chat_format.windows(df.withColumn("span", F.lit("clash")), budget, turns_back, tokens_back).cache()
    check_digest(df, chat_format.read_back(made).collect())
    for r in made.collect():
        assert all(m.start >= 1 and m.start + m.length - 1 <= len(r.formatted) for m in r.loss)


def brute_windows(rows, budget, turns_back, tokens_back, pack):
    """(first place, formatted, repeated turns, loss) of one conversation's ordered (role, text), by the definition."""
    import regex

    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace("[", "&lsqb;").replace("]", "&rsqb;")
    n = [len(regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]", t)) + 2 for _, t in rows]
    starts, held, total, packed = [], 0, 0, None
    for i, k in enumerate(n):
        total += k
        now = (total - 1) // (pack * budget)
        if not starts or now != packed or held + k > budget:
            starts.append(i)
            held = 0
        held, packed = held + k, now
    out = []
    lead = rows[0][0] == "system"
    for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
        back = [j for j in range(max(0, a - turns_back), a) if sum(n[j:a]) <= tokens_back and not (lead and j == 0)]
        order = ([0] if lead and a else []) + back
        text, loss = "", []
        for j in [*order, *range(a, b)]:
            role, t = rows[j]
            text += f"[{esc(role)}]"
            if role == "assistant" and j >= a:
                loss.append((len(text) + 1, len(esc(t))))
            text += esc(t) + "</s>"
        out.append((a + 1, text, len(order), loss))
    return out


@pytest.mark.parametrize("budget,turns_back,tokens_back,pack", [(1024, 2, 256, 16), (40, 3, 50, 2), (25, 2, 30, 1), (12, 0, 0, 4)])
def test_chat_windows_by_definition(spark, monkeypatch, budget, turns_back, tokens_back, pack):
    monkeypatch.setattr(chat_format, "PACK", pack)
    monkeypatch.setattr(chat_format, "BLOCK", 5)
    draw = random.Random(8)
    roles = ["user", "assistant", "assistant", "tool"]
    data = {c: [("system", "be kind")] * (c % 2) + [(draw.choice(roles), " ".join(draw.choice(["a&b", "<", "]", "é"]) for _ in range(draw.choice([0, 1, 3, 9, 60])))) for _ in range(draw.randrange(1, 40))] for c in range(25)}
    df = spark.createDataFrame([(c, i, role, text) for c, rows in data.items() for i, (role, text) in enumerate(rows)], CONV)
    got = {}
    for r in chat_format.windows(df, budget, turns_back, tokens_back).collect():
        got.setdefault(r.conv_id, []).append((r.first_place, r.formatted, r.n_repeated, [(m.start, m.length) for m in r.loss]))
    assert {c: sorted(x) for c, x in got.items()} == {c: brute_windows(rows, budget, turns_back, tokens_back, pack) for c, rows in data.items()}


def test_chat_blocks_change_nothing(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    key = lambda: sorted((r.conv_id, r.first_place, r.formatted, r.n_repeated) for r in chat_format.windows(df, 64, 3, 80).collect())
    whole = key()
    monkeypatch.setattr(chat_format, "BLOCK", 3)
    assert key() == whole


def test_chat_windows_are_full_and_lead_with_system(spark):
    data = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", f"turn {i} " + "w " * 10) for i in range(1, 400)]
    df = spark.createDataFrame(data, CONV)
    made = chat_format.windows(df, 60, 2, 60).orderBy("first_place").collect()
    assert len(made) > 5 and all(r.formatted.startswith("[system]be kind</s>") for r in made)
    assert all(r.n_repeated >= 2 for r in made[1:]) and made[0].n_repeated == 0
    new = [r.n_turns - r.n_repeated for r in made]
    assert sum(n == 4 for n in new[1:]) > 0.8 * len(new) and max(new) <= 5  # turns of 14 tokens
    assert chat_format.windows(df.limit(0)).count() == 0


# --- 6


def test_water_fill():
    sizes = {"a": 100, "b": 1000, None: 10}
    got = mixing.water_fill(sizes, {"a": 5, "b": 2, None: 1}, 1665.0)
    assert got["a"] == 200 and got[None] == 20 and got["b"] == pytest.approx(1445)


def test_route_overlapping():
    got = mixing.route({("a",): 10, ("b",): 10, ("a", "b"): 10}, {"a": 15, "b": 15})
    assert sum(map(sum, got.values())) == 30 and all(second == 0 for _, second in got.values())
    got = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 10, "b": 12})
    assert sum(map(sum, got.values())) == 22 and got["a", "b"][1] + got["a",][1] == 2


def test_mixing_contract(docs):
    got = [r for r in mixing.mixed(docs).collect()]
    again = [r for r in mixing.mixed(docs.repartition(7)).collect()]
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == docs.count()
    by = {}
    sizes = {}
    for r in docs.collect():
        sizes[r.doc_id] = len(words(r.text))
    source = {r.doc_id: r.source for r in docs.collect()}
    for r in got:
        assert r.size == sizes[r.doc_id] and 0 <= r.taken <= 2 * r.size
        t = by.setdefault(source[r.doc_id], [0, r.target, r.source_size, 0, 0])
        t[0] += r.taken
        t[3] += r.size
        t[4] = max(t[4], r.size)
    assert sum(t[1] for t in by.values()) == pytest.approx(1.5 * sum(t[2] for t in by.values()))
    for t in by.values():
        assert t[2] == t[3] and t[1] <= 2 * t[2] + 1e-6 and abs(t[0] - t[1]) <= max(150, 0.02 * t[1], t[4] / 2)  # whole documents


def test_mixing_several_sources(spark):
    df = spark.createDataFrame([(i, 10, ["a"] if i % 3 == 0 else ["b"] if i % 3 == 1 else ["a", "b"]) for i in range(300)], "doc_id bigint, size bigint, sources array<string>")
    got, sizes, targets = mixing.mix(spark, df, lambda names: {"a": 1, "b": 1}, 100)
    assert sizes == {"a": 2000, "b": 2000} and got.agg(F.sum("taken")).first()[0] == pytest.approx(3000, abs=20)


def test_mixing_stage_on_odd_tables(spark, docs):
    odd = docs.withColumn("copies", F.lit(9))
    out = mixing.stage(spark, odd, SF)
    assert sorted(out.columns) == sorted(odd.columns) and not out.where("copies NOT IN (1, 2)").count()
    assert not out.where("text IS NULL OR trim(text) = ''").count()
    plain = {(str(r.doc_id), r.copies) for r in mixing.stage(spark, docs, SF).select("doc_id", "copies").collect()}
    assert {(str(r.doc_id), r.copies) for r in out.select("doc_id", "copies").collect()} == plain
    empty = docs.limit(0)
    assert mixing.mixed(empty).count() == 0 and mixing.stage(spark, empty, SF).count() == 0


def test_mixing_buckets_change_nothing(docs, monkeypatch):
    key = lambda: sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mixed(docs).collect())
    few = key()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 0.01)
    assert mixing._bucket_digits(1000) == 5 and key() == few


# --- 7


def brute_dedup(data):
    seen, out = {}, {}
    for d, t in sorted((x for x in data if x[0] is not None), key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if seen.get(b[i : i + 50], d) < d:
                gone[i : i + 50] = b"\1" * 50
        for i in range(len(b) - 49):
            seen.setdefault(b[i : i + 50], d)
        out[d] = bytes(x for x, g in zip(b, gone, strict=True) if not g), gone
    return out


def test_suffix_dedup(docs):
    data = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute_dedup(data)
    got = suffix_dedup.dedup(docs).collect()
    assert len(got) == len(data)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        kept, gone = want[r.doc_id]
        assert bytes(r.kept) == kept and r.n_removed == sum(gone) and r.n_bytes == len(gone), r.doc_id
        assert len(r.spans) == sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))


def test_suffix_dedup_periodic_and_small_pieces(spark, monkeypatch):
    draw = random.Random(3)
    bits = ["".join(draw.choice("ab") for _ in range(draw.randrange(40, 90))) for _ in range(12)]
    data = [(i, "".join(draw.choice([*bits, "ab" * 40, "é" * 30]) for _ in range(draw.randrange(1, 9)))) for i in range(60)]
    for piece, hot in ((1 << 21, 10_000), (150, 10_000), (1 << 21, 2)):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
        want = brute_dedup(data)
        for r in suffix_dedup.dedup(spark.createDataFrame(data, "doc_id int, text string")).collect():
            assert bytes(r.kept) == want[r.doc_id][0], (piece, hot, r.doc_id)


def test_suffix_dedup_keeps_columns(docs):
    out = suffix_dedup.cleaned(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


# --- 8


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("<nav>Home</nav>", ""),
        ("<article><h1>A &amp; B</h1><p>One  two\n three&nbsp;four &#233;.<p>Next</article><footer>f</footer>", "A & B\nOne two three four é.\nNext"),
        ("<header>Site</header><main><p>Text one is here.</p><aside>ad</aside><div class='comments'><p>me too</p></div><p>End.</p></main><form>x</form>", "Text one is here.\nEnd."),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><div id=content><ul><li>a<li>b</ul></div><div class='cookie-notice'>c</div>", "a\nb"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <b", "cut"),
        ("<article><h1>T</h1><p><b>bold text<br><p>after</p><!-- <p>no</p> --></article>", "T\nbold text\nafter"),
    ],
)
def test_main_text(page, want):
    assert html_extraction.main_text(page, {}) == want


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article><p>Before.</p><svg width=1/><p>After.</p></article>", "Before.\nAfter."),
        ("<article><p>Before.</p><math/><p>Between.</p><math><mi>x</mi></math><p>After.</p></article>", "Before.\nBetween.\nAfter."),
        ("<article><div><object data=x></div><p>After.</p></article>", "After."),
        ("<article><div><canvas></div><p>One.</p><div><canvas>no</canvas></div><p>Two.</p></article>", "One.\nTwo."),
        ("<form action=x><nav>Home</nav><article><p>Text.</p></article><footer>f</footer></form>", "Text."),
        ("<body class='has-sidebar'><div class='sidebar'>side</div><article><p>Text.</p></article></body>", "Text."),
        ("<div class='post-header'><p>Menu</p><article><p>Text.</p><p>More.</p></article></div>", "Text.\nMore."),
        ("<nav><article><p>Teaser</p></article></nav>", ""),
    ],
)
def test_main_text_is_not_cut(page, want):
    assert html_extraction.main_text(page, {}) == want


def test_trained_cost_overrules_a_name():
    page = "<div class='related'><p>Long text.</p></div><article><p>Long text.</p><p>More.</p></article>"
    assert html_extraction.main_text(page, {}) == "Long text.\nMore."
    page = "<article><p>Text.</p><div><p class='search'>Long text.</p><p>Long text.</p></div><p>More.</p></article>"
    assert html_extraction.main_text(page, {"tag p": 3.0}) == "Text.\nLong text.\nLong text.\nMore."


PARAGRAPH = "A paragraph of the article, with enough words to be a text of its own."


@pytest.mark.parametrize(
    "page",
    [
        "<article><div title='the hidden valley'><p>{}</p></div></article>",
        "<article><p data-id='ad-1'>{}</p></article>",
        "<article><p data-style='display:none' title=\"class='ad'\">{}</p></article>",
        "<article><section id='legal-history'><p>{}</p></section></article>",
        "<article><div class='market-share'><p>{}</p></div></article>",
        "<body class='has-sidebar menu-open'><article><p>{}</p></article></body>",
        "<form action='/x'><article><p>{}</p></article></form>",
        "<form action='/x'><div class='content'><p>{}</p></div></form>",
    ],
)
def test_attributes_do_not_hide_an_article(page):
    assert html_extraction.main_text(page.format(PARAGRAPH), {}) == PARAGRAPH


@pytest.mark.parametrize("name", ["ad", "ads top", "share-buttons", "comment-list", "site-footer", "x sidebar-right", "cookie_notice"])
def test_names_of_boilerplate(name):
    page = f"<article><p>{PARAGRAPH}</p><div class='{name}'><p>Other.</p></div><p>{PARAGRAPH}</p></article>"
    assert html_extraction.main_text(page, {}) == f"{PARAGRAPH}\n{PARAGRAPH}"


def test_flow_flips_labels():
    """Blocks whose own costs say boilerplate are content among content, and the other way round, where no block is settled at once."""
    score, chain = [1.5, -0.5, 1.5, -0.6, 1.2], {(i, i + 1): 1.0 for i in range(4)}
    assert all(html_extraction.min_cut(score, chain)) and not any(html_extraction.min_cut([-x for x in score], chain))
    draw = random.Random(4)
    score, flipped = [draw.choice([-1.0, 1.1]) for _ in range(300)], 0
    label = html_extraction.min_cut(score, {(i, i + 1): 0.9 for i in range(299)})
    flipped = sum(x != (s > 0) for s, x in zip(score, label, strict=True))
    assert 20 < flipped < 280
    page = f"<div><p>{PARAGRAPH}</p><p>and so</p><p>{PARAGRAPH}</p></div>"
    odds = {"length 3": -1.8, "stop True": 2.0, "stop False": 0.0}
    assert html_extraction.main_text(page, odds) == f"{PARAGRAPH}\nand so\n{PARAGRAPH}"


def test_articles_without_names_and_elements(spark):
    """Learned costs and neighbours find the article where neither a name nor an article element is left."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odds, same, n = html_extraction.train(pages), 0, 0
    for r in pages.collect():
        bare = re.sub(r"<(/?)article>", r"<\1div>", re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", r.html or ""))
        same += html_extraction.main_text(bare, odds) == html_extraction.main_text(r.html, odds)
        n += 1
    assert same >= 0.9 * n


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "<a>" * 20_000 + "<b>x</b> " * 20_000 + "</i>" * 20_000
    assert len(html_extraction.main_text(f"<article>{deep}", {}).split()) == 20_000
    many = "".join(f"<section><p>Word {i} and more of it.</p></section>" for i in range(20_000))
    assert html_extraction.main_text(f"<main>{many}</main>", {}).count("\n") == 19_999
    scores = [0.4 if i % 3 else -0.7 for i in range(20_000)]
    assert len(html_extraction.min_cut(scores, {(i, i + 1): 0.5 for i in range(19_999)})) == 20_000


def test_min_cut_against_brute_force():
    draw = random.Random(1)
    for _ in range(200):
        n = draw.randrange(1, 8)
        score = [draw.uniform(-3, 3) for _ in range(n)]
        edges = {(i, j): draw.uniform(0, 3) for i in range(n) for j in range(i + 1, n) if draw.random() < 0.5}

        def cost(label):
            return sum(abs(s) for s, x in zip(score, label, strict=True) if x != (s >= 0)) + sum(w for (i, j), w in edges.items() if label[i] != label[j])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_extraction.min_cut(score, edges)) == pytest.approx(best)


def test_extraction_of_articles(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    more = spark.createDataFrame([(-1, None, None), (-1, None, None), (-2, "u", "")], "page_id bigint, url string, html string")
    pages = pages.unionByName(more).withColumn("text", F.lit("clash"))
    got = html_extraction.extract(pages, html_extraction.train(pages)).collect()
    assert len(got) == pages.count()
    raw = {r.page_id: r.html or "" for r in pages.collect()}
    for r in got:
        m = re.search(r"<article>(.*?)(</article>|$)", raw[r.page_id], re.S)
        body = re.sub(r"<[^>]*$", "", m[1]) if m else ""
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


# --- 9


def brute_tokens(word, pieces, floor, longest=16):
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        best[end] = (best[end - 1][0] + n * floor, best[end - 1][1] - n)
        for start in range(max(0, end - longest), end):
            s = pieces.get(word[start:end])
            if s is not None:
                best[end] = max(best[end], (best[start][0] + s, best[start][1] - 1))
    return -best[-1][1]


def test_token_counts(spark, docs):
    """Whole texts of any length, by the definition."""
    pieces = token_counts.load_pieces()
    floor = min(pieces.values()) - token_counts.BYTE_PENALTY
    got = token_counts.token_counts(docs.withColumn("n_tokens", F.lit("clash")), pieces).collect()
    assert len(got) == docs.count()
    texts, memo = {r.doc_id: r.text for r in docs.collect()}, {}
    for r in got:
        t = texts[r.doc_id]
        ws = re.findall("▁+[^▁]*", "▁" + t.replace(" ", "▁")) if t else []
        for w in set(ws):
            if w not in memo:
                memo[w] = brute_tokens(w, pieces, floor)
        assert r.n_tokens == sum(memo[w] for w in ws), r.doc_id


def test_token_counts_by_other_segmenters(spark, docs):
    """The same pieces in a library's own unigram model, and the merges of the vocabulary file."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, models

    pieces = token_counts.load_pieces()
    assert sum(map(math.exp, pieces.values())) == pytest.approx(1)
    vocabulary = [("<unk>", min(pieces.values())), *(("<0x%02X>" % i, -1e9) for i in range(256)), *pieces.items()]
    unigram = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    merges = SentencePieceProcessor(model_file=token_counts.VOCABULARY)
    counter, ours, theirs = token_counts.Counter(pieces), 0, 0
    for r in docs.where("length(text) < 20000").collect():
        t = r.text or ""
        n = counter.count(t)
        same = sum(len(unigram.encode(w, add_special_tokens=False).ids) for w in token_counts.pretokens(t)) if t else 0
        assert abs(n - same) <= 0.002 * same, r.doc_id
        ours, theirs = ours + n, theirs + len(merges.encode(t))
    assert ours == pytest.approx(theirs, rel=0.05)
    for t in ("The government published important information about international relationships", "understanding transformers requires considerable mathematical background", "a  b   c", "  two leading"):
        assert len(merges.encode(t)) <= counter.count(t) <= 1.3 * len(merges.encode(t)) + 1


def test_token_store_restarts(monkeypatch):
    pieces = {"▁a": -1.0, "b": -2.0, "▁ab": -5.0}
    for most in (1_000_000, 3):
        monkeypatch.setattr(token_counts, "STORE", most)
        c = token_counts.Counter(pieces)
        for t in ("a ab b", "ab abb é", None, "", "b b b", "a", "abb é a", "é" * 5000, "ab" * 3000):
            words = ["▁" + w for w in t.split(" ")] if t else []
            assert c.count(t) == sum(brute_tokens(w, pieces, -15.0) for w in words)


# --- 1


def test_language_id(spark):
    got = language_id.query(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    r = got.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert r[0] > 0.98 and r[1] > 100 and 0 <= r[2] <= r[3] <= 1


def test_language_id_against_plain_bayes(spark):
    data = [(i, t, x) for i, (t, x) in enumerate([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), ("der hund und die katze", "de"), ("the dog ran", "en"), (None, "en"), ("", "fr"), ("123 !!", "de")])]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    langs, matrix = language_id.train(df)
    assert langs == ["de", "en", "fr"]
    asked = [(0, "the hat"), (1, None), (2, "12 ?"), (3, "sur le chat"), (4, "un chat " * 50_000), (5, "")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(spark.createDataFrame(asked, "doc_id bigint, text string"), langs, matrix).collect()}
    for i, t in asked:
        if not t or not any(c.isalpha() for c in t):
            assert got[i] == ("und", 0.0)
        else:
            s = matrix[language_id._hashed(language_id._codes(t), len(matrix))].astype(float).sum(axis=0)
            assert got[i][0] == langs[int(s.argmax())] and got[i][1] == pytest.approx(1 / np.exp(s - s.max()).sum())
    clash = spark.createDataFrame([(None, "the hat", 7, "x", "e"), (None, "the hat", 7, "x", "e")], "doc_id bigint, text string, score int, lang_pred string, extra string")
    twice = language_id.predict(clash, langs, matrix)
    assert sorted(twice.columns) == ["doc_id", "extra", "lang_pred", "score"] and {(r.doc_id, r.lang_pred, r.score) for r in twice.collect()} == {(None, *got[0])} and twice.count() == 2
    none = language_id.train(df.where("lang IS NULL"))
    assert {r.lang_pred for r in language_id.predict(df.drop("lang"), *none).collect()} == {"und"}


def test_many_languages_take_fewer_buckets(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"{chr(97 + i % 26) * 4} {chr(97 + i // 26) * 5}", f"l{i}") for i in range(40)], "doc_id bigint, text string, lang string")
    monkeypatch.setattr(language_id, "MATRIX_BYTES", 1 << 20)
    langs, matrix = language_id.train(df)
    assert len(langs) == 40 and matrix.shape == (2048, 40)
    got = language_id.predict(df.drop("lang"), langs, matrix).join(df, "doc_id")
    assert got.where("lang = lang_pred").count() >= 36


# --- empty tables


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    conv = spark.createDataFrame([], CONV)
    assert [
        quality_rules.verdicts(docs).count(), simhash.groups(docs).count(), decontamination.contained(docs, items).count(), quality_lm.classify(docs, labels).count(),
        chat_format.read_back(chat_format.windows(conv)).count(), mixing.mixed(docs).count(), suffix_dedup.dedup(docs).count(), html_extraction.extract(pages, html_extraction.train(pages)).count(),
        token_counts.token_counts(docs, {"a": -1.0}).count(), language_id.predict(docs.select("doc_id", "text"), *language_id.train(docs)).count(),
    ] == [0] * 10


@pytest.mark.parametrize("operator", [decontamination, chat_format, quality_rules])
def test_native_queries_run_no_python(spark, monkeypatch, operator):
    """Every table that the registered query writes on its way, and its result: no Python in the plan, nor in the RDDs below it."""
    seen = []

    def note(df, label="result"):
        seen.append(df._jdf.queryExecution().toString() + df._jdf.queryExecution().toRdd().toDebugString())
        return shared.stash(df, label)

    if hasattr(operator, "stash"):
        monkeypatch.setattr(operator, "stash", note)
    note(operator.query(spark, SF))
    assert seen and not any(word in text for text in seen for word in ("Python", "Pandas", "Arrow"))
