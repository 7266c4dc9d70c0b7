"""Quality rules with adaptive thresholds (operator 10, DataFrame functions only).

Every document gets a few counts. Quantile sketches of the derived rates and of the sizes of documents, one per language and source, are merged by
Spark's partial aggregation; a document fails if a rate lies beyond its group's upper fence, or if it breaks one of
the two base rules. Figures of small groups are shrunk towards the middle ones of their language, and their spread further towards that of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACES, stash, table, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rates that get an adaptive upper fence, each with what a document of the group's usual size may always have: so many of the rate's units
#: in a document with the group's median of that size. Three stray symbols, a line and a half said again, one sentence of fifteen words said twice.
RATES = {"symbol_rate": (3.0, "n_words"), "dup_line_rate": (1.5, "n_lines"), "repeat_rate": (30.0, "n_words"), "mean_word_chars": (0.5, None)}
#: Most documents have none of what the first three rates count. So quartiles are those of the documents that have some, and count by the square of
#: these documents' share: once as they are rare, once as the few that have any are often the dirty ones. The fence is
#: median + SPREAD * (third quartile - median) and that allowance, but no larger than the bound, so that a dirty group does not
#: lift its own: a fixed share, or for word lengths, which depend on the script, this multiple of the first quartile.
SPREAD = 8.0
BOUNDS = {"symbol_rate": 0.1, "dup_line_rate": 0.3, "repeat_rate": 0.3}
WORD_BOUND = 2.0
#: A group of this many documents counts as much as what it is shrunk towards.
SHRINK = 20
SKETCH_ACCURACY = 1000


def _pairs(a: Column, n: Column) -> Column:
    """Struct of 0: element, 1: next element for the first n - 1 elements."""
    return F.arrays_zip(F.slice(a, 1, n - 1), F.slice(a, 2, n - 1))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) of the column `text`.

    A null text counts as empty. All of it is done within the row: no text is shuffled.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    df = docs.select("*", words(F.col(text)).alias("__w"), lines.alias("__lines"))
    n = F.size("__w")
    three = F.arrays_zip(*(F.slice("__w", i, F.greatest(n - 2, F.lit(0))) for i in (1, 2, 3)))
    hashes = F.when(n >= 3, F.transform(three, lambda z: F.xxhash64(z["0"], z["1"], z["2"]))).otherwise(F.array().cast("array<bigint>"))
    df = df.select("*", n.cast("long").alias("n_words"), hashes.alias("__h"))
    df = df.withColumn("__plain", F.size(F.array_distinct("__h")) == F.size("__h"))
    # only texts with a repeated window are sorted: (hash, place), so that equal windows stand together
    placed = F.when(~F.col("__plain"), F.sort_array(F.arrays_zip(F.col("__h").alias("h"), F.sequence(F.lit(1), F.size("__h")).alias("i"))))
    df = df.withColumn("__s", placed)
    twins = F.filter(_pairs(F.col("__s"), F.size("__s")), lambda z: z["0"]["h"] == z["1"]["h"])
    df = df.withColumn("__at", F.when(~F.col("__plain"), F.array_distinct(F.flatten(F.transform(twins, lambda z: F.array(z["0"]["i"], z["1"]["i"]))))))
    covered = F.array_distinct(F.flatten(F.transform("__at", lambda i: F.array(i, i + 1, i + 2))))
    return df.select(
        *(c for c in docs.columns),
        "n_words",
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all(t, F.lit("([#*$%&|<>])"))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__plain"), F.lit(0)).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
    )


def _fences(base: DataFrame) -> DataFrame:
    """(__lang, __source, __max_<rate>): the upper fences of every group with documents that pass the base rules."""
    sizes = sorted({size for _, size in RATES.values() if size})
    quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    found = [F.percentile_approx(F.when(F.col(r) > 0, F.col(r)), quartiles, SKETCH_ACCURACY).alias(f"q_{r}") for r in RATES]
    found += [F.avg((F.col(r) > 0).cast("double")).alias(f"s_{r}") for r in RATES]
    found += [F.percentile_approx(F.col(s).cast("double"), 0.5, SKETCH_ACCURACY).alias(f"g_size_{s}") for s in sizes]
    groups = base.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("g_n"), *found)
    quartile = lambda r, i: F.coalesce(F.col(f"q_{r}")[i], F.lit(0.0))
    trust = lambda r: F.col(f"s_{r}") * F.col(f"s_{r}")
    parts = [x for r in RATES for x in (
        quartile(r, 0).alias(f"g_low_{r}"), (trust(r) * quartile(r, 1)).alias(f"g_mid_{r}"), (trust(r) * (quartile(r, 2) - quartile(r, 1))).alias(f"g_wide_{r}"),
    )]
    groups = stash(groups.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), "g_n", *parts, *(f"g_size_{s}" for s in sizes)), "quality-groups")
    figures = [f"{part}_{r}" for part in ("low", "mid", "wide") for r in RATES] + [f"size_{s}" for s in sizes]

    def middle_of(p: str, *keys) -> DataFrame:
        """The middle figures of the groups, one group counting as much as another: a large dirty one moves no other."""
        return groups.groupBy(*keys).agg(F.sum("g_n").alias(f"{p}_n"), *(F.percentile_approx(f"g_{x}", 0.5, SKETCH_ACCURACY).alias(f"{p}_{x}") for x in figures))

    df = groups.join(middle_of("l", F.col("__lang").alias("__l_lang")), F.col("__lang").eqNullSafe(F.col("__l_lang"))).crossJoin(F.broadcast(middle_of("a")))
    own = lambda p: F.col(f"{p}_n") / (F.col(f"{p}_n") + SHRINK)
    mixed = lambda p, a, b: own(p) * a + (1 - own(p)) * b
    near = lambda x: mixed("g", F.col(f"g_{x}"), F.col(f"l_{x}"))
    out = []
    for r, (units, size) in RATES.items():
        wide = mixed("g", F.col(f"g_wide_{r}"), mixed("l", F.col(f"l_wide_{r}"), F.col(f"a_wide_{r}")))
        fence = near(f"mid_{r}") + SPREAD * wide + (units / near(f"size_{size}") if size else units)
        out.append(F.least(fence, F.lit(BOUNDS[r]) if r in BOUNDS else WORD_BOUND * near(f"low_{r}")).alias(f"__max_{r}"))
    return df.select("__lang", "__source", *out)


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang, source; other columns are ignored): the counts, the rates,
    base_failed and kept.

    The counts are written once. Sketches are merged per (lang, source), null being a group of its own, so a group with
    a third of all rows sends no more than one sketch per task. An empty text fails the base rules. Repeated rows
    get the same verdict each; ties with a fence are kept, and so is a single repeated line.
    """
    base = counts(docs.select("doc_id", "text", "lang", "source")).drop("text")
    n = F.greatest(F.col("n_words"), F.lit(1))
    base = base.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        (F.col("n_symbols") / n).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_rate"),
        (F.col("n_repeat_words") / n).alias("repeat_rate"),
        (F.col("word_chars") / n).alias("mean_word_chars"),
    )
    base = stash(base, "quality")
    fences = _fences(base)
    joined = base.join(fences, base["lang"].eqNullSafe(fences["__lang"]) & base["source"].eqNullSafe(fences["__source"]), "left")
    beyond = F.lit(False)
    for r in RATES:
        above = F.col(r) > F.col(f"__max_{r}")
        beyond = beyond | (above & (F.col("n_dup_lines") > 1) if r == "dup_line_rate" else above)
    return joined.select(*base.columns, (~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False))).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = verdicts(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from .shared import keep_rows

    bad = stash(verdicts(docs).where(~F.col("kept")).select("doc_id"), "quality-rejects")
    return keep_rows(docs, bad)
