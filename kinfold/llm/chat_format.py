"""Chat formatting in budgeted windows (operator 5, DataFrame functions only).

Every turn is written as `[role]text</s>`; `&`, `<`, `[` and `]` inside roles and texts become character references, so no
text can forge a control string and the original comes back by the inverse replacements. Prefix sums of
turn tokens cut a conversation into packs of a bounded number of tokens, and each pack into turn-aligned spans that take as many turns as fit the
budget. A window is the leading system turn, a limited history that repeats the turns before its span, and the span; the loss
mask covers the texts of the span's assistant turns only, so a repeated target is never trained twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import table

#: Tokens of new turns in a window; the system turn and the history come on top of it.
SPAN_TOKENS = 1024
#: Turns before the span that are repeated, as far as they have no more than HISTORY_TOKENS tokens together.
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
END = "</s>"
#: Turns of one conversation that one task orders at once.
BLOCK = 4096
#: Budgets of a pack: spans are filled within a pack, so one span in about so many is cut short at its end.
PACK = 16
#: Characters that are escaped, in the order of escaping.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))


def escape(c: Column) -> Column:
    for raw, written in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(written))
    return c


def unescape(c: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        c = F.replace(c, F.lit(written), F.lit(raw))
    return c


def _tokens(text: Column) -> Column:
    """Tokens of a turn: words and single other characters, and two for its marks."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + 2


def turns(conversations: DataFrame) -> DataFrame:
    """The rows in order: conv_id, place (1, 2, ... within the conversation), role, text, tokens, upto (prefix sum of tokens).

    Null roles and texts are empty. Rows stand by turn, null first; ties by role, then text. A long conversation is ordered in blocks
    of turns whose totals are summed first, so no task needs to hold a whole one.
    """
    df = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    df = df.withColumn("tokens", _tokens(F.col("text")).cast("long"))
    # a struct is never null, so that ids and turns that are can be joined without another shuffle
    df = df.withColumn("key", F.struct("conv_id", F.floor(F.col("turn") / BLOCK).alias("block")))
    totals = {"place": F.lit(1), "upto": F.col("tokens")}
    inner = W.partitionBy("key").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("key.conv_id").orderBy("key.block").rowsBetween(W.unboundedPreceding, -1)  # a row per block
    sums = df.groupBy("key").agg(*(F.sum(c).alias(f"__{n}") for n, c in totals.items()))
    sums = sums.select("key", *(F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in totals))
    df = df.select("*", *(F.sum(c).over(inner).alias(n) for n, c in totals.items())).join(sums, "key")
    return df.select("conv_id", "role", "text", "tokens", *((F.col(n) + F.col(f"__{n}")).cast("long").alias(n) for n in totals))


def _starts(own: Column, span_tokens: int) -> Column:
    """Places within `own`, an array of turns, at which a span begins: as many turns as fit the budget, one turn at least."""
    zero = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("sum"))

    def add(state: Column, x: Column) -> Column:
        new = (state["n"] == 0) | (state["sum"] + x["tokens"] > span_tokens)
        return F.struct(
            F.when(new, F.concat(state["starts"], F.array(state["n"] + 1))).otherwise(state["starts"]).alias("starts"),
            (state["n"] + 1).alias("n"),
            F.when(new, x["tokens"]).otherwise(state["sum"] + x["tokens"]).alias("sum"),
        )

    return F.aggregate(own, zero, add, lambda state: state["starts"])


def spans(df: DataFrame, span_tokens: int, history_turns: int, history_tokens: int) -> DataFrame:
    """One row per span of `df` (conv_id, upto, turn: a struct with place, tokens, written and leads): conv_id, system (the leading system turn, or
    null), first_place, own and history (arrays of turns).

    A pack holds the turns that end within the same PACK budgets; the last turns of a pack are handed on to the next.
    """
    pack = F.floor((F.col("upto") - 1) / (PACK * span_tokens))
    packs = df.groupBy(F.struct("conv_id", pack.alias("pack")).alias("key")).agg(F.sort_array(F.collect_list("turn")).alias("own"))
    # of a turn that is too long to be repeated only the tokens are handed on
    short = lambda x: x.withField("written", F.when(x["tokens"] <= history_tokens, x["written"]).otherwise(F.lit("")))
    last = F.transform(F.slice("own", F.greatest(F.size("own") - history_turns + 1, F.lit(1)), history_turns), short)
    head = F.get("own", F.lit(0))
    edges = packs.select("key", last.alias("last"), F.when(head["leads"], head).alias("head"))
    ordered = W.partitionBy("key.conv_id").orderBy("key.pack")
    handed = F.flatten(F.collect_list("last").over(ordered.rowsBetween(-history_turns, -1))) if history_turns else F.slice("last", 1, 0)
    edges = edges.select("key", handed.alias("handed"), F.first("head", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0)).alias("system"))
    df = packs.join(edges, "key").withColumn("all", F.concat("handed", "own")).withColumn("starts", _starts(F.col("own"), span_tokens))
    n = F.size("handed")

    def span(at: Column, i: Column) -> Column:
        end = F.coalesce(F.get("starts", i + 1), F.size("own") + 1)
        own = F.slice("own", at, end - at)
        first = F.greatest(n + at - history_turns, F.lit(1))
        return F.struct(F.get(own, F.lit(0))["place"].alias("first_place"), own.alias("own"), F.slice("all", first, n + at - first).alias("history"))

    df = df.select(F.col("key.conv_id").alias("conv_id"), "system", F.explode(F.transform("starts", span)).alias("span"))
    return df.select("conv_id", "system", "span.*")


def windows(conversations: DataFrame, span_tokens: int = SPAN_TOKENS, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row per window: conv_id, first_place, formatted (string), loss (array of 1-based start and length in code points of
    `formatted`), n_repeated (turns at its start that are repeats), n_turns.

    The span of a window has `span_tokens` tokens or fewer; a longer turn stands alone, whole. Empty tables give no window; extra columns are
    ignored, repeated rows are turns of their own.
    """
    df = turns(conversations)
    df = df.withColumn("written", F.concat(F.lit("["), escape(F.col("role")), F.lit("]"), escape(F.col("text")), F.lit(END)))
    turn = F.struct(
        "place", "written", F.length("written").alias("chars"), (F.length(escape(F.col("role"))) + 2).alias("head"), (F.col("role") == "assistant").alias("target"), "tokens",
        ((F.col("place") == 1) & (F.col("role") == "system")).alias("leads"),
    )
    one = spans(df.select("conv_id", "upto", turn.alias("turn")), span_tokens, history_turns, history_tokens)

    # the latest turns of the history that fit, without the system turn, which always leads
    def fits(h: Column) -> Column:
        later = F.aggregate(F.filter("history", lambda x: x["place"] >= h["place"]), F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
        return (later <= history_tokens) & ~((h["place"] == 1) & F.col("system").isNotNull())

    repeats_system = F.col("system").isNotNull() & (F.col("first_place") > 1)
    kept = F.filter("history", fits)
    none = F.slice("own", 1, 0)
    one = one.withColumn("repeated", F.concat(F.when(repeats_system, F.array("system")).otherwise(none), kept))
    one = one.withColumn("all", F.concat("repeated", "own")).withColumn("n_repeated", F.size("repeated"))
    # code points before each turn, then the spans of the assistant texts that are not repeats
    ends = F.aggregate("all", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["chars"])))
    one = one.withColumn("ends", ends)
    loss = F.transform("all", lambda x, i: F.struct((F.get("ends", i) + x["head"] + 1).alias("start"), (x["chars"] - x["head"] - len(END)).alias("length"), ((i >= F.col("n_repeated")) & x["target"]).alias("on")))
    loss = F.transform(F.filter(loss, lambda x: x["on"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return one.select(
        "conv_id", "first_place", F.array_join(F.transform("all", lambda x: x["written"]), "").alias("formatted"), loss.alias("loss"), "n_repeated", F.size("all").alias("n_turns")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of what `windows` wrote, from its own output: the new turns of every window, split at the control strings.

    A digest is of one string, so the texts of one conversation, and no more, meet in one row."""
    parts = F.split("formatted", END)
    new = F.slice(parts, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    turn = F.transform(new, lambda x: F.concat(unescape(F.substring_index(F.substr(x, F.lit(2)), "]", 1)), F.lit("\n"), unescape(F.substr(x, F.instr(x, "]") + 1)), F.lit("\n")))
    loss = F.transform("loss", lambda m: unescape(F.substr("formatted", m["start"], m["length"])))
    df = formatted.select("conv_id", "first_place", F.size(new).alias("n"), F.array_join(turn, "").alias("turns"), F.array_join(loss, "").alias("loss"), F.length("formatted").cast("long").alias("chars"))
    df = df.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("first_place", "turns", "loss"))).alias("all"), F.sum("chars").alias("formatted_chars"))
    whole = {k: F.array_join(F.col(f"all.{k}"), "") for k in ("turns", "loss")}
    return df.select(
        "conv_id", "n_turns", F.sha2(whole["turns"], 256).alias("turns_sha256"), F.length(whole["loss"]).cast("long").alias("loss_chars"),
        F.sha2(whole["loss"], 256).alias("loss_sha256"), "formatted_chars",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind, hard = dict(df.dtypes), F.lit("</s>[INST] ok [/INST]")
    more = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast(kind["conv_id"]).alias("conv_id"), F.col("id").cast(kind["turn"]).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text")
    )
    return read_back(windows(df.unionByName(more)))
