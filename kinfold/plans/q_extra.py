"""Queries of sources and sinks, declared schemas, learned and robust details, groups, and semi-structured distances."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import formats
from ..operators import analyze, conviction, influence, private, profile, react, series, stats, synth
from ..operators.knn import Feature, Metric, distance_matrix, knn, knn_approximate, knn_dependent, metric_of
from ..sources import readers
from ..sources.store import CaseStore, distribute
from .q_react import ALL, CONTEXTS, DISTANCE, ID, NEAR, PROBS, near, part, rounded, split, sql_near
from .q_series import FORECAST
from .q_stats import CONTRIB, KL, ONE, PRED
from .storage import folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _place(spark, label: str) -> str:
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


# --- sources and sinks


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def delimited_round_trip(spark, d):
    at, df = _place(spark, "delimited"), _t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    df.write.option("header", True).csv(at)
    return readers.delimited(spark, at, schema=df.schema)


@query("SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def partitioned_round_trip(spark, d):
    at = _place(spark, "partitioned")
    readers.write(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), at, partition_by=["o_orderstatus"])
    return readers.parquet(spark, at).groupBy(F.col("o_orderstatus").cast("string").alias("o_orderstatus")).agg(F.count("*").alias("n"), F.sum(F.col("o_custkey").cast("long")).alias("keys"))


@query("SELECT doc_id, lang, source FROM documents")
def collection_round_trip(spark, d):
    at, df = _place(spark, "collection"), _t(spark, d, "documents").select("doc_id", "lang", "source")
    df.write.json(at)
    return readers.documents(spark, at, df.schema)


@query("SELECT DISTINCT p_brand FROM part")
def distinct_brands(spark, d):
    return profile.value_counts(part(spark, d), ["p_brand"]).select(F.col("value").alias("p_brand"))


# --- declared and inferred schemas


@query("SELECT 'p_size' AS feature, CAST(min(p_size) AS DOUBLE) AS low, CAST(max(p_size) AS DOUBLE) AS high FROM part UNION ALL SELECT 'p_retailprice', round(min(p_retailprice), 6), round(max(p_retailprice), 6) FROM part")
def tight_bounds(spark, d):
    got = profile.infer(part(spark, d).select("p_size", "p_retailprice"), types={"p_size": "continuous"}, tight_bounds=["p_size", "p_retailprice"])
    return spark.createDataFrame([(n, float(a.observed_min), float(a.observed_max)) for n, a in got.items()], "feature string, low double, high double").withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query("SELECT 'p_brand' AS feature, min(p_brand) AS low, max(p_brand) AS high FROM part WHERE p_brand < 'Brand#3'")
def ordinal_observed(spark, d):
    df = part(spark, d)
    names = sorted(r.p_brand for r in df.select("p_brand").distinct().collect())  # a few dozen
    got = profile.infer(df.where("p_brand < 'Brand#3'").select("p_brand"), ordinal_values={"p_brand": [*names, "Brand#~"]})
    return spark.createDataFrame([(n, a.observed_min, a.observed_max) for n, a in got.items()], "feature string, low string, high string")


@query("SELECT * FROM (VALUES ('hm', 'formatted_time', 'HH:mm', CAST(86400 AS DOUBLE)), ('hms', 'formatted_time', 'HH:mm:ss', CAST(86400 AS DOUBLE)), ('day', 'formatted_date_time', 'yyyy-MM-dd', NULL), ('iso', 'formatted_date_time', 'yyyy-MM-dd''T''HH:mm:ss', NULL), ('zone', 'formatted_date_time', 'yyyy-MM-dd HH:mm:ssXXX', NULL), ('part', 'formatted_date_time', 'yyyy-MM-dd''T''HH:mm:ss.SSS', NULL)) AS t(feature, data_type, format, cycle_length) WHERE (SELECT count(*) FROM events) > 0")
def time_formats(spark, d):
    patterns = {"hm": "HH:mm", "hms": "HH:mm:ss", "day": "yyyy-MM-dd", "iso": "yyyy-MM-dd'T'HH:mm:ss", "zone": "yyyy-MM-dd HH:mm:ssXXX", "part": "yyyy-MM-dd'T'HH:mm:ss.SSS"}
    got = profile.infer(_t(spark, d, "events").select(*(F.date_format("ts", p).alias(n) for n, p in patterns.items())))
    return spark.createDataFrame([(n, a.data_type, a.format, a.cycle_length) for n, a in got.items()], "feature string, data_type string, format string, cycle_length double")


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'Infinity'::DOUBLE ELSE round(o_totalprice, 6) END AS price FROM orders")
def infinite_sentinels(spark, d):
    price, put = F.col("o_totalprice"), F.col("o_totalprice") > 200000
    stored = F.when(put, F.lit(formats.DOUBLE_MAX)).otherwise(price)
    read = F.when(put, formats.infinity(stored)).otherwise(price)  # a price that happens to be the least double is none of ours
    return _t(spark, d, "orders").select("o_orderkey", formats.round_scaled(read, 6).alias("price"))


# --- the store


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS _idx FROM part WHERE p_partkey IN (SELECT min(p_partkey) FROM part UNION ALL SELECT max(p_partkey) FROM part)")
def store_one_case(spark, d):
    """Two trainings of one case each are two cases."""
    store, df = CaseStore(spark, _place(spark, "store")), part(spark, d)
    ends = df.agg(F.min(ID).alias("a"), F.max(ID).alias("b")).first()
    for key in (ends.a, ends.b):
        store.train(df.where(F.col(ID) == key))
    return store.get([ID]).select(ID, "_idx")


@query("WITH s AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END AS session, row_number() OVER (PARTITION BY p_partkey % 2 ORDER BY p_partkey) AS i FROM part) SELECT p_partkey, rank FROM (SELECT *, row_number() OVER (ORDER BY abs(p_size - 25), i, session) AS rank FROM s) WHERE rank <= 20")
def store_combined_similar(spark, d):
    """Stores whose cases share numbers stay apart after they are combined."""
    one, two, df = CaseStore(spark, _place(spark, "store")), CaseStore(spark, _place(spark, "store")), part(spark, d)
    one.train(df.where(f"{ID} % 2 = 0"), "even", order=[ID])
    two.train(df.where(f"{ID} % 2 = 1"), "odd", order=[ID])
    one.combine(two)
    return rounded(one.similar({"p_size": 25}, 20, [ID]).select(ID, "rank"))


ABSORBED = sql_near(cases="p_partkey % 50 <> 0")


@query(ABSORBED + "SELECT c.p_partkey, round(1.0 + coalesce((SELECT sum(weight) FROM i WHERE case_id = c.p_partkey), 0.0), 6) AS _case_weight FROM c")
def absorbed_weights(spark, d):
    """Cases that leave give their weight to their neighbours among those that stay."""
    df = part(spark, d)
    stay, go = df.where(f"{ID} % 50 <> 0"), df.where(f"{ID} % 50 = 0")
    one = F.lit(1.0).alias("_case_weight")
    return rounded(distribute(stay.select("*", one), go.select("*", one), metric_of(df, CONTEXTS), 10, "_case_weight", ID).select(ID, "_case_weight"))


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 10 AND 20 THEN NULL ELSE CAST(p_size AS BIGINT) END AS p_size FROM part")
def store_feature_removed(spark, d):
    store = CaseStore(spark, _place(spark, "store"))
    store.train(part(spark, d).select(ID, "p_size", "p_type"), "all")
    store.remove_feature("p_size", {"p_size": [10, 20]})
    store.remove_feature("p_type")
    return rounded(store.get().drop("_session", "_idx"))


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey % 2, p_partkey) - 1 AS _idx FROM part")
def store_moved_cases(spark, d):
    """Cases that move to a store with a session of the same name are numbered on there."""
    one, two, df = CaseStore(spark, _place(spark, "store")), CaseStore(spark, _place(spark, "store")), part(spark, d).withColumn("odd", F.col(ID) % 2)
    one.train(df.where("odd = 0"), "all", order=[ID])
    two.train(df.where("odd = 1"), "all", order=[ID])
    two.move(one, {"odd": [1, 1]})
    return one.get([ID]).select(ID, "_idx")


# --- details of predictions


@query(NEAR + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS p FROM i GROUP BY 1) SELECT query_id, round(p, 6) AS p_retailprice, q.p_brand FROM y JOIN q ON q.p_partkey = query_id")
def reactions_to_cases(spark, d):
    q, c = split(spark, d)
    got = react.react_to_cases(c, q.select(ID), metric_of(c, CONTEXTS), {"p_retailprice": "continuous", "p_brand": "nominal"}, 10, on=[ID], preserve=["p_brand"], id_column=ID)
    return rounded(got.select("query_id", "p_retailprice", "p_brand"))


HALF = "(SELECT p_partkey, p_size, p_type, p_retailprice, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS p_brand FROM part)"


@query(sql_near(on="(q.p_brand IS NULL OR q.p_brand = c.p_brand) AND q.p_partkey <> c.p_partkey", k=5, part=HALF) + "SELECT query_id, case_id, round(distance, 6) AS distance, rank FROM n")
def knn_dependent_nulls(spark, d):
    df = part(spark, d).withColumn("p_brand", F.when(F.col(ID) % 4 != 0, F.col("p_brand")))
    return rounded(knn_dependent(df.where(f"{ID} % 50 = 0"), df, metric_of(df, CONTEXTS), 5, ["p_brand"], id_column=ID, null_is_dependent=False).select("query_id", "case_id", "distance", "rank"))


@query("SELECT 'written' AS feature, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS low, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS high FROM events")
def written_time_bounds(spark, d):
    got = profile.infer(_t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("written")))
    return spark.createDataFrame([(n, a.observed_min, a.observed_max) for n, a in got.items()], "feature string, low string, high string")



@query(NEAR + "SELECT query_id, case_id, rank FROM n WHERE rank <= 3")
def most_similar_cases(spark, d):
    return rounded(react.most_similar(near(spark, d), 3).select("query_id", "case_id", "rank"))


@query(NEAR + ", m AS (SELECT query_id, sum(weight * p_retailprice) AS mean FROM i GROUP BY 1) SELECT query_id, round(sum(weight * abs(p_retailprice - mean)), 6) AS local_mad FROM i JOIN m USING (query_id) GROUP BY 1")
def local_deviations(spark, d):
    return rounded(react.local_deviation(near(spark, d), "p_retailprice"))


@query(NEAR + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS p FROM i GROUP BY 1) SELECT query_id, round(q.p_retailprice, 6) AS given, round(p, 6) AS predicted, round(abs(q.p_retailprice - p), 6) AS error FROM y JOIN q ON q.p_partkey = query_id")
def given_values_explained(spark, d):
    q, _ = split(spark, d)
    return rounded(react.given_action(q, near(spark, d), "p_retailprice", "continuous", id_column=ID))


@query(NEAR + PROBS + "SELECT best.query_id, q.p_brand AS given, best.class AS predicted, round(coalesce(pr.p, 0.0), 6) AS probability FROM best JOIN q ON q.p_partkey = best.query_id LEFT JOIN pr ON pr.query_id = best.query_id AND pr.class = q.p_brand")
def given_classes_explained(spark, d):
    q, _ = split(spark, d)
    return rounded(react.given_action(q, near(spark, d), "p_brand", "nominal", id_column=ID).select("query_id", "given", "predicted", "probability"))


BOUNDARY = (
    NEAR
    + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS v FROM i GROUP BY 1), pd AS (SELECT q.p_partkey AS query_id, c.p_partkey AS case_id, "
    + DISTANCE
    + " AS distance, c.p_retailprice FROM q JOIN c ON q.p_partkey <> c.p_partkey), pn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, case_id) AS rank FROM pd) WHERE rank <= 50), pb AS (SELECT query_id, case_id, rank, CASE WHEN abs(p_retailprice - v) > 0 THEN abs(p_retailprice - v) / greatest(distance, 1e-12) ELSE 0.0 END AS b FROM pn JOIN y USING (query_id)), ps AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(b, 9) DESC, rank) AS place FROM pb)"
)


@query(BOUNDARY + " SELECT query_id, case_id, place FROM ps WHERE place <= 3")
def boundary_of_values(spark, d):
    q, c = split(spark, d)
    got = react.predict_continuous(near(spark, d), "p_retailprice")
    return rounded(react.boundary_cases(q, c, metric_of(c, CONTEXTS), got, "p_retailprice", 3, kind="continuous", pool=50, id_column=ID).select("query_id", "case_id", F.col("rank").alias("place")))


NAMES = ("p_size", "p_type", "p_brand")
TERM = {"p_size": "CAST(abs(q.p_size - c.p_size) AS DOUBLE)", "p_type": "CASE WHEN q.p_type = c.p_type THEN 0.0 ELSE 1.0 END", "p_brand": "CASE WHEN q.p_brand = c.p_brand THEN 0.0 ELSE 1.0 END"}


def _by(contexts, k: int = 10) -> str:
    return sql_near(" + ".join(TERM[f] for f in contexts) or "0.0", k, "true", "true")


def _errors_over(samples: int, seed: int) -> str:
    parts = [f"SELECT query_id, abs(part.p_retailprice - p) AS e FROM ({_by(s) + PRED}) JOIN part ON p_partkey = query_id" for s in influence.subsets(list(NAMES), samples, seed)]
    return " UNION ALL ".join(parts)


_USERS = private.Bounds("user_id", groups=2, rows=3, clip={"value": (10.0, 60.0)})


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events),
g AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM r WHERE k = 1)
SELECT event_type, count(*) AS n, round(coalesce(sum(greatest(least(value, 60.0), 10.0)), 0.0), 6) AS sum_value, count(DISTINCT user_id) AS units FROM r JOIN g USING (user_id, event_type) WHERE k <= 3 AND g <= 2 GROUP BY 1""")
def clipped_totals(spark, d):
    return rounded(private.clipped_totals(spark.read.parquet(f"{d}/events.parquet"), ["event_type"], _USERS, order=["event_id"]))


@query()
def private_aggregates(spark, d):
    df = spark.read.parquet(f"{d}/events.parquet")
    return private.private_aggregates(df, ["event_type"], _USERS, 1.0, groups=df.select("event_type"), order=["event_id"])


@query(f"SELECT query_id, round(avg(e), 8) AS error FROM ({_errors_over(4, 3)}) GROUP BY 1")
def robust_errors(spark, d):
    df = part(spark, d)
    return rounded(influence.robust_errors(df, df, metric_of(df, list(NAMES)), "p_retailprice", "continuous", 10, samples=4, seed=3, id_column=ID), 8)


@query(f"SELECT 'p_retailprice' AS feature, round(avg(e), 6) AS residual FROM (SELECT query_id, avg(e) AS e FROM ({_errors_over(4, 3)}) GROUP BY 1)")
def robust_residuals(spark, d):
    df = part(spark, d)
    return rounded(influence.robust_residuals(df, metric_of(df, [*NAMES, "p_retailprice"]), {"p_retailprice": "continuous"}, 10, samples=4, seed=3, id_column=ID))


def _robust_contributions(samples: int, seed: int) -> str:
    parts = []
    for f in NAMES:
        for rest in influence.subsets([n for n in NAMES if n != f], samples, seed):
            with_f = [n for n in NAMES if n == f or n in rest]
            parts.append(f"SELECT query_id, '{f}' AS feature, a.p AS x, b.p AS z FROM ({_by(with_f) + PRED}) AS a JOIN ({_by([n for n in with_f if n != f]) + PRED}) AS b USING (query_id)")
    return " UNION ALL ".join(parts)


@query(f"SELECT query_id, feature, round(avg(abs(x - z)), 7) AS prediction_contribution, round(avg(x - z), 7) + 0.0 AS directional, round(avg(abs(p_retailprice - z) - abs(p_retailprice - x)), 7) + 0.0 AS accuracy_contribution FROM ({_robust_contributions(4, 1)}) JOIN part ON p_partkey = query_id GROUP BY 1, 2")
def contributions_robust(spark, d):
    df = part(spark, d)
    return rounded(influence.contributions(df, df, metric_of(df, list(NAMES)), "p_retailprice", 10, id_column=ID, robust=4, seed=1), 7)


@query(ALL + ", pr AS (SELECT query_id, p_brand AS b, sum(weight) AS p FROM i GROUP BY 1, 2), m AS (SELECT p_brand AS a, b, sum(p) AS s FROM pr JOIN part ON p_partkey = query_id GROUP BY 1, 2), k AS (SELECT p_brand AS a, count(*) AS n FROM part GROUP BY 1), g AS (SELECT a, b, s / n AS p FROM m JOIN k USING (a) WHERE a <> b AND s > 0), h AS (SELECT a, b, p FROM g UNION ALL SELECT b, a, p FROM g) SELECT a, b, round(1 - sum(p) / 2, 6) AS difference FROM h GROUP BY 1, 2")
def class_distances(spark, d):
    df = part(spark, d)
    return rounded(influence.class_distances(df, metric_of(df, [*CONTEXTS, "p_brand"]), "p_brand", 10, id_column=ID))


@query(f"WITH a AS ({ALL + PRED}), t AS ({ONE['p_size'] + PRED}) SELECT round(avg((abs(p_retailprice - t.p) - abs(p_retailprice - a.p)) / 100.0), 6) AS missing_information FROM a JOIN t USING (query_id) JOIN part ON p_partkey = query_id")
def missing_information(spark, d):
    df = part(spark, d)

    def errors(contexts):
        return influence.errors(stats.leave_one_out(df, metric_of(df, contexts), "p_retailprice", "continuous", 10, id_column=ID), "continuous")

    return rounded(influence.missing_information(errors(CONTEXTS), errors(["p_size"]), 100.0))


@query(f"WITH a AS ({ALL + PRED}) SELECT query_id, round(abs(p_retailprice - p) / 50.0, 6) AS residual_contribution FROM a JOIN part ON p_partkey = query_id")
def residual_contributions(spark, d):
    df = part(spark, d)
    own = influence.errors(stats.leave_one_out(df, metric_of(df, CONTEXTS), "p_retailprice", "continuous", 10, id_column=ID), "continuous")
    return rounded(influence.residual_contribution(own.withColumn("feature", F.lit("p_retailprice")), {"p_retailprice": 50.0}))


# --- statistics


@query(sql_near("0.0 + " + TERM["p_brand"], queries="p_size >= 25", cases="p_size < 40") + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS p FROM i GROUP BY 1) SELECT round(avg(abs(p_retailprice - p)), 6) AS mae, round(sqrt(avg((p_retailprice - p) * (p_retailprice - p))), 6) AS rmse FROM y JOIN part ON p_partkey = query_id")
def stats_under_conditions(spark, d):
    df = part(spark, d)
    return rounded(stats.measured(df, metric_of(df, ["p_brand"]), "p_retailprice", "continuous", 10, action_condition={"p_size": [25, None]}, context_condition={"p_size": [None, 39]}, names=["mae", "rmse"], id_column=ID))


BY_TYPE = sql_near(TERM["p_type"], queries="true", cases="true")


@query(BY_TYPE + ", y AS (SELECT query_id, sum(weight * p_retailprice) AS price, sum(weight * p_size) AS size FROM i GROUP BY 1) SELECT query_id, 'unit' AS feature, round(p_retailprice / (p_size + 1), 6) AS actual, round(price / (size + 1), 6) AS predicted FROM y JOIN part ON p_partkey = query_id")
def derived_predictions(spark, d):
    df = part(spark, d)
    m = metric_of(df, ["p_type", "p_size", "p_retailprice"])
    return rounded(stats.derived_predictions(df, m, {"p_retailprice": "continuous", "p_size": "continuous"}, {"unit": "p_retailprice / (p_size + 1)"}, 10, id_column=ID))


GOAL = sql_near(k=6, queries="true", cases="true", on="true")


@query(GOAL + ", g AS (SELECT query_id, case_id, row_number() OVER (PARTITION BY query_id ORDER BY round(p_retailprice / (SELECT stddev_pop(p_retailprice) FROM part), 9), rank) AS place FROM n) SELECT query_id, case_id FROM g WHERE place = 1")
def goal_biased_cases(spark, d):
    df = part(spark, d)
    return stats.goal_sample(df, metric_of(df, CONTEXTS), {"p_retailprice": "min"}, df.count(), 5, id_column=ID)


RESIDUAL = "SELECT avg(abs({f} - p)) AS r FROM (SELECT query_id, sum(weight * {f}) AS p FROM i GROUP BY 1) JOIN part ON p_partkey = query_id"


@query(
    "WITH r AS (SELECT 'p_retailprice' AS feature, r FROM (" + sql_near(TERM["p_size"], queries="true", cases="true") + RESIDUAL.format(f="p_retailprice") + ") UNION ALL SELECT 'p_size', r FROM ("
    + sql_near("abs(q.p_retailprice - c.p_retailprice)", queries="true", cases="true") + RESIDUAL.format(f="p_size") + ")) SELECT feature, round((1 / r) * 2 / (SELECT sum(1 / r) FROM r), 6) AS weight FROM r"
)
def inverse_residual_weights(spark, d):
    df = part(spark, d)
    kinds = {"p_retailprice": "continuous", "p_size": "continuous"}
    got = analyze.feature_weights(influence.residuals(df, metric_of(df, list(kinds)), kinds, 10, id_column=ID))
    return rounded(spark.createDataFrame(list(got.items()), "feature string, weight double"))


@query(NEAR + ", pr AS (SELECT query_id, p_brand AS class, sum(weight) AS p FROM i GROUP BY 1, 2), s AS (SELECT query_id, q.p_type AS series, class, p FROM pr JOIN q ON q.p_partkey = query_id), k AS (SELECT series, count(DISTINCT query_id) AS n FROM s GROUP BY 1) SELECT series, class, round(sum(p) / any_value(n), 6) AS probability FROM s JOIN k USING (series) GROUP BY 1, 2")
def probabilities_by_series(spark, d):
    q, _ = split(spark, d)
    p = react.class_probabilities(near(spark, d), "p_brand").join(q.select(F.col(ID).alias("query_id"), F.col("p_type").alias("series")), "query_id")
    return rounded(series.mean_probabilities(p, "series"))


# --- convictions


ADDED = NEAR + ", new AS (SELECT query_id, CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / greatest(distance, 1e-300)) END AS d FROM n GROUP BY 1)"


@query(f"WITH base AS ({CONTRIB} SELECT query_id, d FROM dc), t AS (SELECT sum(d) AS s, count(*) AS n FROM base), b AS (SELECT CASE WHEN d <= 0 THEN 0.0 ELSE (d / s) * ln(d / s * n) END + CASE WHEN d >= s THEN 0.0 ELSE (1 - d / s) * ln((1 - d / s) / (1 - 1.0 / n)) END AS kl FROM base, t), a AS ({ADDED} SELECT query_id, d FROM new), p AS (SELECT query_id, d / (s + d) AS p, 1.0 / (n + 1) AS q FROM a, t), k AS (SELECT query_id, CASE WHEN p <= 0 THEN 0.0 ELSE p * ln(p / q) END + CASE WHEN p >= 1 THEN 0.0 ELSE (1 - p) * ln((1 - p) / (1 - q)) END AS kl FROM p) SELECT query_id, round(least(CASE WHEN round(kl, 12) <= 0 THEN 1e4 ELSE (SELECT avg(kl) FROM b) / round(kl, 12) END, 1e4), 3) AS familiarity_conviction_addition FROM k")
def familiarity_of_addition(spark, d):
    df = part(spark, d)
    base = conviction.contributions(df, df, metric_of(df, CONTEXTS), 10, id_column=ID)
    return rounded(conviction.familiarity_addition(base, react.distance_contribution(near(spark, d))).drop("kl"), 3)


GROUPS = """WITH base AS ({base}), t AS (SELECT sum(d) AS s, count(*) AS n FROM base),
b AS (SELECT CASE WHEN d <= 0 THEN 0.0 ELSE (d / s) * ln(d / s * n) END + CASE WHEN d >= s THEN 0.0 ELSE (1 - d / s) * ln((1 - d / s) / (1 - 1.0 / n)) END AS kl FROM base, t),
o AS ({out}),
g AS (SELECT p_brand AS group_id, count(*) AS m, avg(o.d) AS d, sum(base.d) AS own FROM o JOIN part ON p_partkey = o.query_id JOIN base ON base.query_id = o.query_id GROUP BY 1),
p AS (SELECT group_id, m, d, d / (s + d) AS pa, 1.0 / (n + 1) AS qa, own / s AS pr, CAST(m AS DOUBLE) / n AS qr FROM g, t),
k AS (SELECT group_id, m, d, CASE WHEN pa <= 0 THEN 0.0 ELSE pa * ln(pa / qa) END + (1 - pa) * ln((1 - pa) / (1 - qa)) AS ka, CASE WHEN pr <= 0 THEN 0.0 ELSE pr * ln(pr / qr) END + (1 - pr) * ln((1 - pr) / (1 - qr)) AS kr FROM p)
SELECT group_id, m AS n, round(d, 4) AS distance_contribution,
round(least(CASE WHEN round(ka, 12) <= 0 THEN 1e4 ELSE (SELECT avg(kl) FROM b) / round(ka, 12) END, 1e4), 2) AS familiarity_conviction_addition,
round(least(CASE WHEN round(kr, 12) <= 0 THEN 1e4 ELSE (SELECT avg(kl) FROM b) / round(kr, 12) END, 1e4), 2) AS familiarity_conviction_removal,
round(ka, 9) AS kl_divergence_addition, round(kr, 9) AS kl_divergence_removal,
round(cume_dist() OVER (ORDER BY round(ka, 15) DESC), 6) AS p_value_of_addition, round(cume_dist() OVER (ORDER BY round(kr, 15) DESC), 6) AS p_value_of_removal FROM k"""
OUT = sql_near(queries="true", cases="true", on="q.p_brand <> c.p_brand") + "SELECT query_id, CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / greatest(distance, 1e-300)) END AS d FROM n GROUP BY 1"


@query(GROUPS.format(base=CONTRIB + " SELECT query_id, d FROM dc", out=OUT))
def group_convictions(spark, d):
    df = part(spark, d)
    got = conviction.groups(df, df, metric_of(df, CONTEXTS), "p_brand", 10, id_column=ID)
    digits = {"distance_contribution": 4, "familiarity_conviction_addition": 2, "familiarity_conviction_removal": 2, "kl_divergence_addition": 9, "kl_divergence_removal": 9, "p_value_of_addition": 6, "p_value_of_removal": 6}
    return got.select("group_id", "n", *((F.round(c, x) + 0.0).alias(c) for c, x in digits.items()))


# --- distances


@query(sql_near("CAST(abs((2 * q.p_size + length(q.p_brand)) - (2 * c.p_size + length(c.p_brand))) AS DOUBLE)", k=5) + "SELECT query_id, case_id, round(distance, 6) AS distance, rank FROM n")
def knn_expression(spark, d):
    q, c = split(spark, d)
    m = Metric((Feature("code", "expression", expression="2 * p_size + length(p_brand)"),))
    return rounded(knn(q, c, m, 5, id_column=ID))


SAME = "CASE WHEN q.p_brand = c.p_brand THEN 1 ELSE 0 END + CASE WHEN q.p_type = c.p_type THEN 1 ELSE 0 END + CASE WHEN q.p_size = c.p_size THEN 1 ELSE 0 END"


@query(sql_near(f"1.0 - ({SAME}) / CAST(6 - ({SAME}) AS DOUBLE)", k=5) + "SELECT query_id, case_id, round(distance, 6) AS distance, rank FROM n")
def knn_semi_structured(spark, d):
    df = part(spark, d).select(ID, F.to_json(F.struct("p_brand", "p_type", "p_size")).alias("doc"))
    return rounded(knn(df.where(f"{ID} % 50 = 0"), df, Metric((Feature("doc", "json"),)), 5, id_column=ID))


TREE_COST = "levenshtein(q.p_name, c.p_name) + CASE WHEN q.p_brand = c.p_brand THEN 0.0 ELSE 1.0 END + least(1.0, abs(q.p_size - c.p_size) / 10.0)"


def _tree_docs(spark, d):
    """Parts as objects of a string, a number and the list of the letters of the name."""
    return part(spark, d).select(ID, F.to_json(F.struct("p_size", "p_brand", F.filter(F.split("p_name", ""), lambda x: x != "").alias("p_name"))).alias("doc"))


@query(sql_near(f"CAST({TREE_COST} AS DOUBLE)", k=5) + "SELECT query_id, case_id, round(distance, 6) AS distance, rank FROM n")
def knn_tree_edit(spark, d):
    """Edit cost of ordered trees: letters put in, taken out or exchanged, another brand, and sizes on a scale of ten."""
    df = _tree_docs(spark, d)
    return rounded(knn(df.where(f"{ID} % 50 = 0"), df, Metric((Feature("doc", "tree", scale=10.0),)), 5, id_column=ID))


@query("SELECT a.s_suppkey AS from_id, b.s_suppkey AS to_id, round(abs(a.s_acctbal - b.s_acctbal), 4) AS distance FROM supplier AS a, supplier AS b")
def supplier_distances(spark, d):
    df = _t(spark, d, "supplier")
    return rounded(distance_matrix(df, metric_of(df, ["s_acctbal"]), "s_suppkey"), 4)


@query()
def knn_approximate_recall(spark, d):
    """(query_id, recall): the share of the ten nearest that the approximate join finds, for every query row."""
    q, df = split(spark, d)
    m = metric_of(df, ["p_size", "p_retailprice"], p_retailprice={"deviation": 20.0})
    true = knn(q, df, m, 10, id_column=ID)
    got = knn_approximate(q, df, m, 10, width=20.0, id_column=ID)
    hit = true.join(got.select("query_id", "case_id", F.lit(1).alias("hit")), ["query_id", "case_id"], "left")
    return hit.groupBy("query_id").agg((F.count("hit") / F.count("*")).alias("recall"))


# --- series and synthesis


@query("WITH p AS (" + FORECAST.replace("WHERE k > 2", "WHERE k > 1") + "), a AS (SELECT user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1) SELECT 'value' AS target, CAST(1 AS BIGINT) AS step, count(*) AS n, round(avg(abs(a.value - p.value)), 5) AS error FROM a JOIN p USING (user_id)")
def forecast_window_accuracy(spark, d):
    df = _t(spark, d, "events")
    learned = series.training_rows(series.holdout(df, ["user_id"], "ts", 1, "event_id")[0], ["user_id"], "ts", {"value": "continuous"}, 2, "event_id")
    got = series.forecast_accuracy(df, ["user_id"], "ts", {"value": "continuous"}, metric_of(learned, ["value_lag_1", "value_lag_2"]), 1, key="event_id", lags=2, k=10)
    return rounded(got, 5)


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS below, (SELECT count(*) FROM part) AS asked FROM part")
def one_sided_bounds(spark, d):
    """Generated sizes with a lower bound only."""
    df = part(spark, d)
    got = synth.generate(df, metric_of(df, ["p_size"]), {"p_size": "continuous"}, df.count(), residuals={"p_size": 20.0}, id_column=ID, bounds={"p_size": (1, None)})
    return got.agg(F.count("p_size").alias("n"), F.count_if(F.col("p_size") < 1).alias("below"), F.count("*").alias("asked"))


# --- SQL of queries of other modules


def _matrix_sql() -> str:
    cells = []
    for action in ("p_size", "p_retailprice"):
        contexts = [f for f in ("p_size", "p_retailprice", "p_type") if f != action]
        own = {**TERM, "p_retailprice": "abs(q.p_retailprice - c.p_retailprice)"}
        pred = f", y AS (SELECT query_id, sum(weight * {action}) AS p FROM i GROUP BY 1) SELECT query_id, p FROM y"
        both = sql_near(" + ".join(own[f] for f in contexts), queries="true", cases="true") + pred
        for f in contexts:
            one = sql_near(own[next(x for x in contexts if x != f)], queries="true", cases="true") + pred
            cells.append(f"SELECT '{action}' AS row, '{f}' AS col, avg(abs(a.p - b.p)) AS value FROM ({both}) AS a JOIN ({one}) AS b USING (query_id)")
    return f"WITH m AS ({' UNION ALL '.join(cells)}) SELECT row, col, round(value / sum(abs(value)) OVER (PARTITION BY row), 4) AS value FROM m"


SQL["contribution_matrix"] = _matrix_sql()

_FEATURE = "SELECT '{f}' AS feature, sum(d) AS d FROM ({near} SELECT query_id, CASE WHEN min(distance) = 0 THEN 0.0 ELSE count(*) / sum(1.0 / greatest(distance, 1e-300)) END AS d FROM n GROUP BY 1)"
_OWN = {"p_size": TERM["p_size"], "p_type": TERM["p_type"], "p_retailprice": "abs(q.p_retailprice - c.p_retailprice)"}
SQL["feature_convictions"] = (
    "WITH f AS (" + " UNION ALL ".join(_FEATURE.format(f=f, near=sql_near(x, queries="true", cases="true")) for f, x in _OWN.items()) + "), "
    "p AS (SELECT feature, CASE WHEN (SELECT sum(d) FROM f) > 0 THEN d / (SELECT sum(d) FROM f) ELSE 0.0 END AS p, 1.0 / (SELECT count(*) FROM f) AS q FROM f), "
    "k AS (SELECT feature, CASE WHEN p <= 0 THEN 0.0 ELSE p * ln(p / q) END + CASE WHEN p >= 1 THEN 0.0 ELSE (1 - p) * ln((1 - p) / (1 - q)) END AS kl FROM p) "
    "SELECT feature, round(least(CASE WHEN round(kl, 12) <= 0 THEN 1e4 ELSE (SELECT avg(kl) FROM k) / round(kl, 12) END, 1e4), 4) AS familiarity_conviction FROM k"
)

SQL["series_stationary"] = """WITH s AS (SELECT user_id, avg(value) AS m, coalesce(stddev_pop(value), 0.0) AS v, CAST(count(*) AS DOUBLE) AS r, CASE WHEN user_id % 3 = 0 THEN 'a' ELSE 'b' END AS kind FROM events GROUP BY 1),
d AS (SELECT a.user_id, b.user_id AS other, abs(a.m - b.m) + abs(a.v - b.v) + abs(a.r - b.r) AS distance, b.kind FROM s AS a JOIN s AS b ON a.user_id <> b.user_id),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, other) AS rank FROM d) WHERE rank <= 5),
w AS (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY user_id) = 0 THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / distance END AS raw FROM n),
p AS (SELECT user_id, kind, sum(raw) / sum(sum(raw)) OVER (PARTITION BY user_id) AS probability FROM w GROUP BY 1, 2)
SELECT user_id, kind, round(probability, 6) AS probability FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(probability, 9) DESC, kind) AS k FROM p) WHERE k = 1"""
