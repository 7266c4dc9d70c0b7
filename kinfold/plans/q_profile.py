"""Queries of profiles, validation, formats, rare values, marginal statistics and dependencies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import formats as fm
from ..operators import fanout, profile, rare, validate
from ..operators.profile import Attributes
from ..sources import readers
from .q_react import rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NOMINALS = ["l_returnflag", "l_linestatus", "l_linenumber"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _union(template: str, names: list[str]) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in names)


@query(_union("SELECT '{c}' AS feature, count(*) AS n_rows, count({c}) AS n, count(*) - count({c}) AS n_null, round(min({c}), 6) + 0.0 AS low, round(max({c}), 6) + 0.0 AS high FROM lineitem", NUMBERS))
def profile_basics(spark, d):
    got = profile.basics(_t(spark, d, "lineitem"), NUMBERS)
    return got.select("feature", "n_rows", "n", "n_null", F.round(F.col("min").cast("double"), 6).alias("low"), F.round(F.col("max").cast("double"), 6).alias("high"))


@query(_union("SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 2", NOMINALS))
def profile_value_counts(spark, d):
    return profile.value_counts(_t(spark, d, "lineitem"), NOMINALS)


@query(_union("SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM lineitem", [*NOMINALS, "l_orderkey", "l_partkey", "l_quantity"]))
def profile_distinct_counts(spark, d):
    counts = profile.value_counts(_t(spark, d, "lineitem"), [*NOMINALS, "l_orderkey", "l_partkey", "l_quantity"])
    return profile.distinct_counts(counts).select("feature", "n_distinct")


@query("SELECT count(*) AS n_distinct FROM (SELECT DISTINCT l_returnflag, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_linestatus END AS x FROM lineitem)")
def profile_distinct_combinations(spark, d):
    df = _t(spark, d, "lineitem").withColumn("x", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_linestatus")))
    return profile.distinct_count(df, ["l_returnflag", "x"])


@query(_union("SELECT * FROM (SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY 2) WHERE n > 1 AND n = (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY {c}))", ["p_brand", "p_type", "p_size"]))
def profile_modes(spark, d):
    return profile.modes(profile.value_counts(_t(spark, d, "part"), ["p_brand", "p_type", "p_size"]))


@query("SELECT 'l_extendedprice' AS feature, CAST(2 AS BIGINT) AS decimal_places UNION ALL SELECT 'l_discount', CAST(max(length(regexp_replace(printf('%.15f', round(l_discount, 12)), '0+$', '')) - 2) AS BIGINT) FROM lineitem".replace("SELECT 'l_extendedprice' AS feature, CAST(2 AS BIGINT) AS decimal_places", "SELECT 'l_tax' AS feature, CAST(max(length(regexp_replace(printf('%.15f', round(l_tax, 12)), '0+$', '')) - 2) AS BIGINT) AS decimal_places FROM lineitem"))
def profile_decimal_places(spark, d):
    return profile.decimal_places(_t(spark, d, "lineitem"), ["l_tax", "l_discount"])


LOOSE = "SELECT '{c}' AS feature, round(CASE WHEN a >= 0 THEN greatest(0, b - w) ELSE b - w END, 4) AS low, round(CASE WHEN b <= 0 THEN least(0, a + w) ELSE a + w END, 4) AS high FROM (SELECT min({c}) AS a, max({c}) AS b, exp(ln(max({c}) - min({c})) + 0.5) AS w FROM {t})"


@query(_union(LOOSE.replace("{t}", "lineitem"), NUMBERS) + " UNION ALL " + LOOSE.replace("{t}", "customer").replace("{c}", "c_acctbal"))
def loose_bounds(spark, d):
    def one(df, c):
        lo, hi = profile.loose_bounds_columns(F.min(c).cast("double"), F.max(c).cast("double"))
        return df.agg(F.lit(c).alias("feature"), F.round(lo, 4).alias("low"), F.round(hi, 4).alias("high")).select("feature", "low", "high")

    parts = [one(_t(spark, d, "lineitem"), c) for c in NUMBERS] + [one(_t(spark, d, "customer"), "c_acctbal")]
    return reduce(lambda a, b: a.union(b), parts)


@query("WITH s AS (SELECT 'l_linenumber' AS feature, count(*) AS n, count(DISTINCT l_linenumber) AS k, min(l_linenumber) AS a, max(l_linenumber) AS b FROM lineitem UNION ALL SELECT 'l_partkey', count(*), count(DISTINCT l_partkey), min(l_partkey), max(l_partkey) FROM lineitem UNION ALL SELECT 'l_orderkey', count(*), count(DISTINCT l_orderkey), min(l_orderkey), max(l_orderkey) FROM lineitem) SELECT feature, CASE WHEN k < ceil(sqrt(n)) OR (a >= -1 AND b >= -1 AND length(CAST(a AS VARCHAR)) = length(CAST(b AS VARCHAR)) AND length(CAST(a AS VARCHAR)) >= 5) THEN 'nominal' ELSE 'continuous' END AS type FROM s UNION ALL SELECT 'l_returnflag', 'nominal' UNION ALL SELECT 'l_quantity', 'continuous'")
def infer_types(spark, d):
    df = _t(spark, d, "lineitem").select("l_linenumber", "l_partkey", "l_orderkey", "l_returnflag", "l_quantity")
    return profile.as_table(spark, profile.infer(df)).select("feature", "type")


@query("SELECT 'ts' AS feature, 'formatted_date_time' AS data_type UNION ALL SELECT 'props', 'json' UNION ALL SELECT 'event_type', 'string' UNION ALL SELECT 'day', 'formatted_date_time' UNION ALL SELECT 'clock', 'formatted_time' UNION ALL SELECT 'flag', 'boolean'")
def infer_data_types(spark, d):
    df = _t(spark, d, "events").select("ts", "props", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH:mm:ss").alias("clock"), F.when(F.col("value") > 0, "true").otherwise("False").alias("flag"))
    return profile.as_table(spark, profile.infer(df)).select("feature", "data_type")


@query("SELECT count(*) AS n, CAST(sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS BIGINT) AS n_bounds, CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE 1 END) AS BIGINT) AS n_allowed FROM orders")
def validate_table(spark, d):
    df = _t(spark, d, "orders")
    want = {
        "o_totalprice": Attributes("o_totalprice", "continuous", "number", "double", min=-1e12, max=100000.0, allow_null=True),
        "o_orderpriority": Attributes("o_orderpriority", "nominal", "string", "string", allowed=["1-URGENT", "2-HIGH"], allow_null=True),
    }
    bad = validate.violations(df.select(*want), want)
    wide = bad.agg(F.max(F.when(F.col("kind") == "bounds", F.col("n"))).alias("n_bounds"), F.max(F.when(F.col("kind") == "allowed", F.col("n"))).alias("n_allowed"))
    return df.agg(F.count("*").alias("n")).crossJoin(wide).select("n", F.coalesce("n_bounds", F.lit(0)).alias("n_bounds"), F.coalesce("n_allowed", F.lit(0)).alias("n_allowed"))


@query("WITH v AS (SELECT DISTINCT p_size AS v FROM part WHERE p_size > 40), r AS (SELECT v, row_number() OVER (ORDER BY v) AS k FROM v) SELECT 'p_size' AS feature, (SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FROM r WHERE k <= 5) AS \"values\", greatest((SELECT count(*) FROM v) - 5, 0) AS n_more")
def out_of_bounds(spark, d):
    got = validate.out_of_bounds(_t(spark, d, "part"), "p_size", None, 40)
    return got.select("feature", F.array_join("values", ",").alias("values"), F.col("n_more").cast("long").alias("n_more"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d %H:%M') AS written, round(epoch_us(o_orderdate) / 1e6, 3) AS epoch, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS whole, o_orderkey % 2 = 0 AS flag FROM orders")
def typed_formats(spark, d):
    df = _t(spark, d, "orders")
    return df.select(
        "o_orderkey",
        fm.format_datetime(F.col("o_orderdate"), "yyyy/MM/dd HH:mm").alias("written"),
        F.round(fm.date_to_epoch(F.col("o_orderdate")), 3).alias("epoch"),
        fm.to_integer(F.when(F.col("o_orderkey") % 3 == 0, F.lit("none")).otherwise(F.col("o_totalprice").cast("string"))).alias("whole"),
        fm.to_boolean(F.when(F.col("o_orderkey") % 2 == 0, F.lit("Yes")).otherwise(F.lit("off"))).alias("flag"),
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(extract('hour' FROM ts) * 3600 + extract('minute' FROM ts) * 60 + extract('second' FROM ts) AS DOUBLE) AS seconds FROM events")
def json_and_clock(spark, d):
    df = _t(spark, d, "events")
    clock = F.date_format("ts", "HH:mm:ss")
    return df.select("event_id", fm.from_json(F.col("props"), "struct<k:bigint>")["k"].alias("k"), F.round(fm.time_to_seconds(clock), 3).alias("seconds"))


@query("SELECT c_custkey, round(CASE WHEN c_acctbal = 0 THEN 0 ELSE round(c_acctbal * pow(10, 3 - 1 - floor(log10(abs(c_acctbal))))) / pow(10, 3 - 1 - floor(log10(abs(c_acctbal)))) END, 1) AS balance FROM customer")
def significant_digits(spark, d):
    return _t(spark, d, "customer").select("c_custkey", fm.significant(F.col("c_acctbal"), 3, 1).alias("balance"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS BIGINT) AS n_tokens FROM documents")
def tokenized(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.size(fm.tokenize(F.col("text"))).cast("long").alias("n_tokens"))


RARE = "WITH c AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1), t AS (SELECT count(*) AS s FROM part), r AS (SELECT value, n, 30 / (500.0 / s * n) AS m, row_number() OVER (ORDER BY n, value) AS k, s FROM c, t WHERE n >= 30 AND 500.0 / s * n < 30) "


@query(RARE + "SELECT 'p_brand' AS feature, value, n, round(CAST(m AS DOUBLE), 6) AS multiplier FROM r WHERE k <= 5")
def rare_values(spark, d):
    return rounded(rare.rare_values(_t(spark, d, "part"), ["p_brand"], 500))


@query(RARE + "SELECT 'p_brand' AS feature, round(CAST(least((any_value(s) - sum(n * m)) / (any_value(s) - sum(n)), 1.0) AS DOUBLE), 6) AS unprotected FROM r WHERE k <= 5 HAVING count(*) > 0")
def rare_unprotected(spark, d):
    df = _t(spark, d, "part")
    return rounded(rare.unprotected_multipliers(df, rare.rare_values(df, ["p_brand"], 500)))


@query(RARE + ", u AS (SELECT least((any_value(s) - sum(n * m)) / (any_value(s) - sum(n)), 1.0) AS f FROM r WHERE k <= 5) SELECT p_partkey, round(CAST(coalesce((SELECT m FROM r WHERE k <= 5 AND value = p_brand), (SELECT f FROM u)) AS DOUBLE), 6) AS _case_weight FROM part")
def rare_weights(spark, d):
    df = _t(spark, d, "part")
    chosen = rare.rare_values(df, ["p_brand"], 500)
    return rounded(rare.weigh(df, chosen, rare.unprotected_multipliers(df, chosen)).select("p_partkey", "_case_weight"))


@query("WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_partkey, round((SELECT sum(n) FROM c) / CAST((SELECT count(*) FROM c) * n AS DOUBLE), 6) AS _case_weight FROM part JOIN c USING (p_brand, p_type)")
def rebalanced_weights(spark, d):
    return rounded(rare.rebalance(_t(spark, d, "part"), ["p_brand", "p_type"]).select("p_partkey", "_case_weight"))


@query("WITH c AS (SELECT event_type AS value, sum(value) AS m FROM events GROUP BY 1) SELECT 'event_type' AS feature, value, round(m, 4) AS mass, false AS remaining FROM c")
def value_masses(spark, d):
    return rounded(rare.value_masses(_t(spark, d, "events"), ["event_type"], -1e18, "value").select("feature", "value", "mass", "remaining"), 4)


@query("WITH c AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1) SELECT 'p_brand' AS feature, CASE WHEN n >= 80 THEN value END AS value, n < 80 AS remaining, CAST(sum(n) AS DOUBLE) AS mass FROM c GROUP BY 2, 3")
def value_masses_remaining(spark, d):
    return rare.value_masses(_t(spark, d, "part"), ["p_brand"], 80)


MARGINAL = "SELECT '{c}' AS feature, count({c}) AS count, round(sum({c} * l_quantity) / sum(l_quantity), 6) AS mean, round(sum({c} * {c} * l_quantity) / sum(l_quantity) - pow(sum({c} * l_quantity) / sum(l_quantity), 2), 3) AS variance, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_tax BETWEEN 0.01 AND 0.05"


@query(_union(MARGINAL, ["l_discount", "l_tax"]))
def marginal_stats(spark, d):
    got = rare.marginal_stats(_t(spark, d, "lineitem"), ["l_discount", "l_tax"], {"l_returnflag": ["A", "N"], "l_tax": [0.01, 0.05]}, "l_quantity")
    return got.select("feature", "count", F.round("mean", 6).alias("mean"), F.round("variance", 3).alias("variance"), F.round("min", 6).alias("min"), F.round("max", 6).alias("max"))


@query(_union("SELECT '{c}' AS feature, round(-sum(p * ln(p)), 6) AS entropy, count(*) AS n_distinct FROM (SELECT count(*) / CAST((SELECT count(*) FROM part) AS DOUBLE) AS p FROM part GROUP BY {c})", ["p_brand", "p_type"]))
def nominal_entropy(spark, d):
    return rounded(rare.entropy(_t(spark, d, "part"), ["p_brand", "p_type"]).select("feature", "entropy", "n_distinct"))


WIDE = "(SELECT o_orderkey, c_custkey, n_nationkey, r_regionkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
KEYS = ["o_orderkey", "c_custkey", "n_nationkey", "r_regionkey", "c_mktsegment"]


def _wide(spark, d):
    o, c, n, r = (_t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    df = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return df.select(*KEYS)


@query(f"WITH t AS (SELECT * FROM {WIDE}) " + " UNION ALL ".join(f"SELECT '{a}' AS determinant, '{b}' AS dependent WHERE (SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM t)) = (SELECT count(DISTINCT {a}) FROM t)" for a in KEYS for b in KEYS if a != b))
def functional_dependencies(spark, d):
    return spark.createDataFrame(fanout.dependencies(_wide(spark, d)), "determinant string, dependent string")


@query(f"WITH t AS (SELECT * FROM {WIDE}) " + " UNION ALL ".join(f"SELECT '{a}' AS determinant, '{b}' AS dependent WHERE (SELECT count(*) FROM (SELECT DISTINCT {a}, {b} FROM t)) = (SELECT count(DISTINCT {a}) FROM t)" for a in KEYS for b in KEYS if a != b))
def dependencies_of_parts(spark, d):
    """Sketches of three parts of the table, merged, say which pairs are compared over the whole."""
    df = _wide(spark, d)
    state = fanout.merged([fanout.sketches(df.where(f"o_orderkey % 3 = {i}")) for i in range(3)])
    return spark.createDataFrame(fanout.dependencies(df, state=state), "determinant string, dependent string")


@query("SELECT 'n_nationkey' AS key, 'r_regionkey' AS owned UNION ALL SELECT 'c_custkey', 'c_mktsegment' UNION ALL SELECT 'o_orderkey', ''")
def fanout_chain(spark, d):
    got = fanout.discover(_wide(spark, d), ["o_orderkey", "c_custkey", "n_nationkey"])
    return spark.createDataFrame([(k, ",".join(v)) for k, v in got.items()], "key string, owned string")


@query("SELECT row_number() OVER (ORDER BY p_brand) - 1 AS surrogate FROM (SELECT DISTINCT p_brand FROM part)")
def surrogate_keys(spark, d):
    """The numbers in use: each once, without a gap (which brand has which depends on a hash)."""
    got = readers.map_keys(_t(spark, d, "part"), "p_brand")
    return got.groupBy("surrogate").agg(F.countDistinct("p_brand").alias("n")).where("n = 1").select("surrogate")



@query("SELECT user_id, event_id, lag(value) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def rows_with_context(spark, d):
    got = readers.with_lags(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["value"], 2)
    return got.select("user_id", "event_id", "value_lag_1", "value_lag_2")
